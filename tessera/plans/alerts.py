"""Rule-table business alerts and their summary.

Current metrics are computed from real tables as one row, turned into a long
(metric, value) form and joined to the rule table — one plan instead of one
``if`` per rule. Rules compare strictly.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import alert_id, fmt_percent, round_half_up, title_from_snake

# FIXED VALUES: (rule_no, type, metric, operator, threshold, severity, title)
ALERT_RULES = [
    (1, "churn_risk", "avg_churn_risk", ">", 0.7, "high", "High Churn Risk Detected"),
    (2, "model_confidence", "avg_confidence", "<", 0.75, "medium", "Low Model Confidence"),
    (3, "performance_decline", "accuracy_trend", "<", -0.05, "high", "Model Performance Declining"),
    (4, "volume_spike", "volume_ratio", ">", 1.5, "medium", "Unusual Prediction Volume"),
    (5, "business_opportunity", "opportunity_customers", ">", 0.0, "low", "Business Opportunity"),
]
OPPORTUNITY_KIND = "cross_sell"
CHURN_CUSTOMER_FLOOR = 0.7      # customers counted as affected by the churn alert
OPPORTUNITY_SEGMENT = "Loyal Customers"
OPPORTUNITY_DIVERSITY_CEILING = 0.5
METRICS = ["avg_churn_risk", "avg_confidence", "accuracy_trend", "volume_ratio", "opportunity_customers"]


def rules_frame(spark) -> DataFrame:
    rules = spark.createDataFrame(ALERT_RULES, "rule_no int, type string, metric string, op string, "
                                               "threshold double, severity string, title string")
    named = F.concat_ws(": ", "title", title_from_snake(F.lit(OPPORTUNITY_KIND)))
    return rules.withColumn("title", F.when(F.col("type") == "business_opportunity", named).otherwise(F.col("title")))


def mean_of(values: Column) -> Column:
    """Mean of an array's known values (NULL if there is none)."""
    known = F.filter(values, lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))


def alert_metrics(segment_customers: DataFrame, daily: DataFrame, k: int = 7) -> DataFrame:
    """One row: avg_churn_risk, avg_confidence, accuracy_trend (mean of the last k
    days minus the first k), volume_ratio (last day volume / mean of the
    earlier days), opportunity_customers, plus the impact figures the alerts
    carry.

    ``daily`` is the per-day prediction aggregate (day, daily_volume,
    daily_confidence_sum, daily_confidence_count, daily_accuracy): the log is read once and every
    log metric comes from that one-row-per-day table.
    """
    sc = segment_customers
    churn = sc.agg(
        F.avg("churn_risk").alias("avg_churn_risk"),
        F.count_if(F.col("churn_risk") > CHURN_CUSTOMER_FLOOR).alias("affected_customers"),
        F.coalesce(F.sum(F.when(F.col("churn_risk") > CHURN_CUSTOMER_FLOOR, F.col("monetary_total"))),
                   F.lit(0.0)).alias("estimated_revenue_impact"),
        F.count_if((F.col("segment") == OPPORTUNITY_SEGMENT)
                   & (F.col("interest_diversity") < OPPORTUNITY_DIVERSITY_CEILING)).alias("opportunity_customers"),
        F.coalesce(F.sum(F.when((F.col("segment") == OPPORTUNITY_SEGMENT)
                                & (F.col("interest_diversity") < OPPORTUNITY_DIVERSITY_CEILING),
                                F.col("monetary_avg"))), F.lit(0.0)).alias("potential_revenue"))
    # One row per day, gathered in order: the first and last k of them are slices.
    days = F.sort_array(F.collect_list(F.struct("day", F.col("daily_accuracy").alias("a"), F.col("daily_volume").cast("double").alias("v"))))
    sums = daily.agg((F.sum("daily_confidence_sum") / F.sum("daily_confidence_count")).alias("avg_confidence"), days.alias("d"))
    n = F.size("d")
    of = lambda part, c: mean_of(F.transform(part, lambda x: x[c]))
    logm = sums.select(
        "avg_confidence",
        (of(F.slice("d", F.greatest(n - k + 1, F.lit(1)), F.lit(k)), "a") - of(F.slice("d", 1, k), "a")).alias("accuracy_trend"),
        F.try_divide(F.get("d", n - 1)["v"], of(F.slice("d", F.lit(1), F.greatest(n - 1, F.lit(0))), "v")).alias("volume_ratio"))
    return (churn.crossJoin(logm)
            .select(*METRICS, "affected_customers", "estimated_revenue_impact", "potential_revenue"))


def evaluate_rules(metrics: DataFrame, rules: DataFrame, history_len: int = 0) -> DataFrame:
    """Alerts: one row per rule whose metric passes its strict comparison.

    ``alert_id`` = ALERT_%03d of (alerts already issued + rule number).
    """
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in METRICS)
    long = metrics.select(F.expr(f"stack({len(METRICS)}, {stack}) AS (metric, value)"),
                          "affected_customers", "estimated_revenue_impact", "potential_revenue")
    j = long.join(F.broadcast(rules), "metric")
    fired = j.where(F.coalesce(F.when(F.col("op") == ">", F.col("value") > F.col("threshold"))
                               .when(F.col("op") == "<", F.col("value") < F.col("threshold")), F.lit(False)))
    return fired.select(
        alert_id(F.lit(history_len) + F.col("rule_no")).alias("alert_id"), "rule_no", "type", "severity",
        "title", "metric", round_half_up("value", 6).alias("metric_value"), "threshold",
        F.when(F.col("type") == "churn_risk", F.col("affected_customers")).alias("affected_customers"),
        F.when(F.col("type") == "churn_risk", round_half_up("estimated_revenue_impact", 2))
        .alias("estimated_revenue_impact"),
        F.when(F.col("type") == "business_opportunity", F.col("value").cast("long")).alias("opportunity_size"),
        F.when(F.col("type") == "business_opportunity", round_half_up("potential_revenue", 2))
        .alias("potential_revenue"))


def alert_descriptions(alerts: DataFrame) -> DataFrame:
    """Presentation text for alerts (last step only)."""
    v = F.col("metric_value")
    desc = (F.when(F.col("type") == "churn_risk",
                   F.concat(F.lit("Average churn risk is "), fmt_percent(v), F.lit(", above threshold of "),
                            fmt_percent(F.col("threshold"))))
            .when(F.col("type") == "model_confidence",
                  F.concat(F.lit("Model confidence is "), fmt_percent(v), F.lit(", below threshold of "),
                           fmt_percent(F.col("threshold"))))
            .when(F.col("type") == "performance_decline",
                  F.concat(F.lit("Model accuracy dropped by "), fmt_percent(F.abs(v)), F.lit(" recently")))
            .when(F.col("type") == "volume_spike",
                  F.concat(F.lit("Prediction volume is "), F.format_number(v, 1), F.lit("x normal levels")))
            .otherwise(F.concat(F.lit("Identified "), F.col("opportunity_size").cast("string"),
                                F.lit(f" customers for {OPPORTUNITY_KIND} campaigns"))))
    return alerts.withColumn("description", desc)


# FIXED VALUES: recommended actions and impact by alert type; the confidence of rule 2.
CONFIDENCE_LOW = 0.75
ALERT_ACTIONS = {
    "churn_risk": ["Launch retention campaign immediately", "Offer personalized discounts to high-risk customers",
                   "Contact high-value customers personally"],
    "model_confidence": ["Review recent training data quality", "Consider model retraining",
                         "Implement ensemble methods"],
    "performance_decline": ["Investigate data drift", "Schedule immediate model retraining",
                            "Review feature engineering pipeline"],
    "volume_spike": ["Monitor system performance", "Check for data quality issues",
                     "Verify business events causing spike"],
    "business_opportunity": ["Launch targeted cross_sell campaign", "Personalize offers based on customer segments",
                             "Track campaign performance"],
}
ALERT_IMPACTS = {"model_confidence": "Reduced prediction reliability",
                 "performance_decline": "Potential for incorrect business decisions",
                 "volume_spike": "May require scaling"}


def alert_actions(alerts: DataFrame) -> DataFrame:
    """One row per alert and recommended action, in order."""
    table = F.create_map(*[x for k, v in ALERT_ACTIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return alerts.select("alert_id", "type", F.posexplode(table[F.col("type")]).alias("action_no", "action"))


def alert_measures(alerts: DataFrame, log: DataFrame) -> DataFrame:
    """Impact text, predictions below the confidence threshold, performance drop and volume increase of each alert."""
    t, v = F.col("type"), F.col("metric_value")
    low = log.agg(F.count_if(F.col("confidence") < CONFIDENCE_LOW).alias("_low"))
    impact = F.coalesce(*[F.when(t == k, F.lit(x)) for k, x in ALERT_IMPACTS.items()])
    return alerts.crossJoin(F.broadcast(low)).select(
        "alert_id", "type", impact.alias("impact"),
        F.when(t == "model_confidence", F.col("_low")).alias("affected_predictions"),
        F.when(t == "performance_decline", fmt_percent(F.abs(v))).alias("performance_drop"),
        F.when(t == "volume_spike", fmt_percent(v - 1, 0)).alias("volume_increase"))


def alert_summary(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(F.col("severity") == "high").alias("high_priority"),
        F.count_if(F.col("severity") == "medium").alias("medium_priority"),
        F.count_if(F.col("severity") == "low").alias("low_priority"),
        F.count_if(F.col("type") == "business_opportunity").alias("business_opportunities"),
        round_half_up(F.coalesce(F.sum(F.coalesce(F.col("estimated_revenue_impact"), F.lit(0.0))
                                       + F.coalesce(F.col("potential_revenue"), F.lit(0.0))), F.lit(0.0)), 2)
        .alias("total_revenue_impact"),
        (F.count_if(F.col("severity") == "high") > 0).alias("requires_immediate_action"))


def filter_alerts(alerts: DataFrame, severity: str | None = None) -> DataFrame:
    """Case-sensitive severity filter; no severity -> all alerts."""
    return alerts if not severity else alerts.where(F.col("severity") == severity)


def append_history(history: DataFrame | None, new: DataFrame) -> DataFrame:
    """Append new alerts (or prediction records) to a history; columns missing on
    either side become NULL."""
    return new if history is None else history.unionByName(new, allowMissingColumns=True)
