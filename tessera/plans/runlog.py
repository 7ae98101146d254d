"""Pipeline run log: success rate and step-family roll-up."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: step families, checked in order (substring match unless noted).
FAMILIES = [("data_collection", "data_collection"), ("feature_engineering", "feature_engineering"),
            ("model_training", "model_training"), ("prediction", "prediction")]
BI_STEPS = ["customer_insights", "roi_analysis"]


def success_rate(log: DataFrame) -> DataFrame:
    """total_steps, successful_steps, success_rate in % (0 when the log is empty)."""
    return log.agg(F.count(F.lit(1)).alias("total_steps"),
                   F.count_if(F.col("status") == "success").alias("successful_steps")).select(
        "total_steps", "successful_steps",
        F.coalesce(F.try_divide(F.col("successful_steps").cast("double"), F.col("total_steps").cast("double"))
                   * 100, F.lit(0.0)).alias("success_rate"))


def step_family(step: F.Column) -> F.Column:
    out = None
    for fam, sub in FAMILIES:
        cond = step.contains(sub)
        out = F.when(cond, fam) if out is None else out.when(cond, fam)
    return out.when(step.isin(*BI_STEPS), "business_intelligence").otherwise("other")


def log_families(log: DataFrame) -> DataFrame:
    return log.groupBy(step_family(F.col("step")).alias("family")).agg(
        F.count(F.lit(1)).alias("steps"), F.count_if(F.col("status") == "success").alias("successes"))


def tail(log: DataFrame, n: int = 5) -> DataFrame:
    """Last ``n`` steps (newest first; step and status break timestamp ties)."""
    return log.orderBy(F.col("timestamp").desc(), "step", "status").limit(n)
