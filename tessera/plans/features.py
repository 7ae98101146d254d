"""Customer, RFM, behavioural features and the ML dataset."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators.quantiles import quantile_scores
from tessera.operators.stats import (apply_standard_scaler, fit_standard_scaler, label_encode_many,
                                     one_hot, value_counts)
from tessera.session import materialize


def _as_of(as_of: str):
    return F.lit(as_of).cast("timestamp_ntz")


def days_since(ts: str, as_of: str):
    """Whole days from ``ts`` to ``as_of`` (floored like ``timedelta.days``)."""
    return F.expr(f"timestampdiff(DAY, `{ts}`, TIMESTAMP_NTZ '{as_of}')").cast("int")


# --- RFM ---------------------------------------------------------------------
def rfm_aggregate(tx: DataFrame, as_of: str) -> DataFrame:
    """Per customer: recency_days, frequency, monetary_total/avg/std (2 dp; std of one row -> 0).

    One hash aggregate with a map-side partial step; a customer with a third
    of all transactions is combined in every task before the shuffle.
    """
    agg = tx.groupBy("customer_id").agg(
        F.max("transaction_date").alias("_last"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("amount").alias("_sum"), F.avg("amount").alias("_avg"),
        F.stddev_samp("amount").alias("_std"))
    return agg.select(
        "customer_id",
        F.expr(f"timestampdiff(DAY, _last, TIMESTAMP_NTZ '{as_of}')").cast("int").alias("recency_days"),
        "frequency",
        C.round_half_up("_sum", 2).alias("monetary_total"),
        C.round_half_up("_avg", 2).alias("monetary_avg"),
        F.coalesce(C.round_half_up("_std", 2), F.lit(0.0)).alias("monetary_std"))


def rfm_scores(rfm: DataFrame, on_tie: str = "collapse", method: str = "exact") -> DataFrame:
    """Quintile scores: recency descending (recent = 5), frequency and monetary ascending."""
    return quantile_scores(rfm, {"recency_days": ("recency_score", True),
                                 "frequency": ("frequency_score", False),
                                 "monetary_total": ("monetary_score", False)}, on_tie=on_tie, method=method)


def rfm_features(tx: DataFrame, as_of: str, on_tie: str = "collapse", method: str = "exact") -> DataFrame:
    """RFM aggregate + scores + combined score + segment."""
    scored = rfm_scores(materialize(rfm_aggregate(tx, as_of)), on_tie, method)
    return (scored.withColumn("rfm_score", C.rfm_mean("recency_score", "frequency_score", "monetary_score"))
            .withColumn("customer_segment", C.rfm_segment("rfm_score")))


def segment_distribution(rfm: DataFrame) -> DataFrame:
    return value_counts(rfm, "customer_segment")


# --- customers ----------------------------------------------------------------
def customer_features(customers: DataFrame, as_of: str) -> DataFrame:
    """Tenure days, age band, gender / city codes, loyalty = tenure / max tenure."""
    out = materialize(customers.withColumn("days_since_registration", days_since("registration_date", as_of))
                      .withColumn("age_group", C.age_group("age")))
    out, _ = label_encode_many(out, {"gender": "gender_encoded", "city": "city_encoded"})
    max_days = out.agg(F.max("days_since_registration").alias("_max_days"))
    return (out.crossJoin(F.broadcast(max_days))
            .withColumn("loyalty_score", C.try_ratio(F.col("days_since_registration"), F.col("_max_days")))
            .drop("_max_days"))


# --- behaviour ------------------------------------------------------------------
def behavioral_features(behavior: DataFrame) -> DataFrame:
    """Engagement, satisfaction, interest diversity and churn-risk scores."""
    eng = C.engagement_score("avg_session_duration", "pages_per_session", "bounce_rate",
                             "email_open_rate", "social_media_engagement")
    return (behavior.withColumn("engagement_score", eng)
            .withColumn("satisfaction_score", C.satisfaction_score(F.col("engagement_score"), "support_tickets"))
            .withColumn("interest_diversity", C.interest_diversity("product_categories_visited"))
            .withColumn("churn_risk_score", C.churn_risk_score("cart_abandonment_rate", "bounce_rate",
                                                               "email_open_rate", "support_tickets")))


def behavior_means(beh: DataFrame) -> DataFrame:
    return beh.agg(F.avg("engagement_score").alias("avg_engagement"),
                   F.avg("churn_risk_score").alias("avg_churn_risk"))


# --- ML dataset -------------------------------------------------------------------
NUMERICAL_FEATURES = ["age", "days_since_registration", "loyalty_score", "recency_days", "frequency",
                      "monetary_total", "monetary_avg", "rfm_score", "engagement_score",
                      "satisfaction_score", "interest_diversity", "churn_risk_score"]
CATEGORICAL_FEATURES = ["gender_encoded", "city_encoded", "customer_segment"]


def join_features(cust: DataFrame, rfm: DataFrame, beh: DataFrame) -> DataFrame:
    """customer ⟕ rfm ⟕ behaviour on customer_id (all three keyed by customer_id,
    so the shuffles share one hash partitioning)."""
    return cust.join(rfm, "customer_id", "left").join(beh, "customer_id", "left")


def with_churn_label(df: DataFrame) -> DataFrame:
    return df.withColumn("target_churn", C.churn_label("churn_risk_score", "recency_days", "rfm_score"))


def ml_dataset(cust_feat: DataFrame, rfm: DataFrame, beh_feat: DataFrame,
               drop_leaky: bool = False) -> tuple[DataFrame, DataFrame]:
    """Joined, labelled, zero-filled, standard-scaled, one-hot encoded dataset.

    Returns ``(dataset, scaler_stats)``. ``drop_leaky`` removes the three
    label inputs from the features.
    """
    joined = with_churn_label(join_features(cust_feat, rfm, beh_feat))
    num = [c for c in NUMERICAL_FEATURES
           if not (drop_leaky and c in ("churn_risk_score", "recency_days", "rfm_score"))]
    sel = materialize(joined.select(*num, *CATEGORICAL_FEATURES, "target_churn", "customer_id"))
    filled = sel.fillna(0.0, subset=[c for c in num if dict(sel.dtypes)[c] == "double"]) \
                .fillna(0, subset=[c for c in num if dict(sel.dtypes)[c] != "double"])
    stats = fit_standard_scaler(filled, num)
    scaled = apply_standard_scaler(filled, stats, num)
    return one_hot(scaled, "customer_segment", "segment", C.SEGMENTS), stats


def segment_customers(rfm: DataFrame, beh_feat: DataFrame) -> DataFrame:
    """(customer_id, rfm_score, recency_days, frequency, monetary_total, monetary_avg,
    segment, churn_risk, satisfaction_score, interest_diversity) — the insight input."""
    b = beh_feat.select("customer_id", F.col("churn_risk_score").alias("churn_risk"),
                        "satisfaction_score", "interest_diversity")
    return rfm.select("customer_id", "rfm_score", "recency_days", "frequency", "monetary_total",
                      "monetary_avg", F.col("customer_segment").alias("segment")).join(b, "customer_id", "left")
