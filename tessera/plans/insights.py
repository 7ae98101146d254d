"""Segment insights, top insights and overall customer metrics."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import SEGMENTS, fmt_currency, fmt_percent, round_half_up

TOP_INSIGHT_RISK_FLOOR = 0.6  # fixed value: a segment is "high risk" above this mean churn risk


def segment_insights(sc: DataFrame) -> DataFrame:
    """Per segment: count, % of customers, mean rfm / monetary / frequency /
    recency / churn risk / satisfaction (rounded 2,2,2,2,1,3,1).

    One grouped aggregate (the reference scans once per segment), packed with
    the customer total into a single row (at most one struct per segment), then
    expanded over the fixed segment list, so empty segments still report and
    the customer plan runs once.
    """
    agg = sc.groupBy("segment").agg(
        F.count(F.lit(1)).alias("_n"), F.avg("rfm_score").alias("_rfm"),
        F.avg("monetary_total").alias("_mon"), F.avg("frequency").alias("_freq"),
        F.avg("recency_days").alias("_rec"), F.avg("churn_risk").alias("_churn"),
        F.avg("satisfaction_score").alias("_sat"))
    packed = agg.agg(F.collect_list(F.struct(*agg.columns)).alias("_segs"), F.sum("_n").alias("_total"))
    domain = F.array(*[F.struct(F.lit(i).alias("segment_order"), F.lit(name).alias("segment"))
                       for i, name in enumerate(SEGMENTS)])
    rows = packed.select(F.explode(domain).alias("_d"), "_segs", "_total")
    hit = F.try_element_at(F.filter("_segs", lambda x: x["segment"] == F.col("_d.segment")), F.lit(1))
    out = rows.select(F.col("_d.segment_order").alias("segment_order"), F.col("_d.segment").alias("segment"),
                      "_total", hit.alias("_s")).select(
        "segment_order", "segment", "_total",
        *[F.col(f"_s.{c}").alias(c) for c in ("_n", "_rfm", "_mon", "_freq", "_rec", "_churn", "_sat")])
    n = F.coalesce(F.col("_n"), F.lit(0))
    return out.select(
        "segment_order", "segment", n.alias("count"),
        round_half_up(F.try_divide(n.cast("double"), F.col("_total").cast("double")) * 100, 2).alias("percentage"),
        round_half_up("_rfm", 2).alias("avg_rfm_score"), round_half_up("_mon", 2).alias("avg_monetary"),
        round_half_up("_freq", 2).alias("avg_frequency"), round_half_up("_rec", 1).alias("avg_recency"),
        round_half_up("_churn", 3).alias("churn_risk"), round_half_up("_sat", 1).alias("satisfaction"))


def top_insights(si: DataFrame) -> DataFrame:
    """Most valuable segment, worst high-risk segment (if any), lowest-frequency segment.

    Compares the *rounded* segment values; ties go to the earlier segment.
    One aggregate over the segment table (arg-max / arg-min by a struct whose
    second field breaks ties), so the segment plan is evaluated once.
    """
    order = F.col("segment_order")
    risky = F.col("churn_risk") > TOP_INSIGHT_RISK_FLOOR
    picked = si.agg(
        F.max_by(F.struct("segment", F.col("avg_monetary").alias("value")),
                 F.struct(F.col("avg_monetary"), -order)).alias("revenue"),
        F.max_by(F.when(risky, F.struct("segment", F.col("churn_risk").alias("value"))),
                 F.when(risky, F.struct(F.col("churn_risk"), -order))).alias("risk"),
        F.min_by(F.struct("segment", F.col("avg_frequency").alias("value")),
                 F.struct(F.col("avg_frequency").isNull(), F.col("avg_frequency"), order)).alias("opportunity"))
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("insight_type"), F.col(k).alias("pick"))
                               for k in ("revenue", "risk", "opportunity")])).alias("r")
    return (picked.select(rows).where(F.col("r.pick").isNotNull())
            .select(F.col("r.insight_type").alias("insight_type"), F.col("r.pick.segment").alias("segment"),
                    F.col("r.pick.value").alias("value")))


# FIXED VALUES: insight and action texts.
INSIGHT_TEXTS = {
    "revenue": ("segment generates highest revenue", "Focus retention efforts on this segment"),
    "risk": ("segment has high churn risk", "Implement immediate retention campaigns"),
    "opportunity": ("segment has low purchase frequency", "Target with engagement campaigns"),
}


def insight_texts(top: DataFrame) -> DataFrame:
    """Presentation text of :func:`top_insights` rows: insight, value and action."""
    kind, v = F.col("insight_type"), F.col("value")
    text = lambda i: F.coalesce(*[F.when(kind == k, F.lit(t[i])) for k, t in INSIGHT_TEXTS.items()])
    value = (F.when(kind == "revenue", F.concat(fmt_currency(v), F.lit(" average per customer")))
             .when(kind == "risk", F.concat(fmt_percent(v), F.lit(" average churn probability")))
             .otherwise(F.concat(F.format_number(v, 1), F.lit(" purchases on average"))))
    return top.select("insight_type", F.concat("segment", F.lit(" "), text(0)).alias("insight"), value.alias("value"),
                      text(1).alias("action"))


def overall_metrics(sc: DataFrame) -> DataFrame:
    return sc.agg(
        F.count(F.lit(1)).alias("total_customers"),
        round_half_up(F.avg("monetary_total"), 2).alias("avg_customer_value"),
        round_half_up(F.avg("frequency"), 1).alias("avg_purchase_frequency"),
        round_half_up(F.avg("churn_risk"), 3).alias("overall_churn_risk"),
        round_half_up(F.avg("satisfaction_score"), 1).alias("customer_satisfaction"))
