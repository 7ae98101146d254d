"""The alert rules on streams: every rule of the batch table, per closed hour or day.

* Rules on confidence and volume look at closed hours (``streams.rollup_alerts``).
* The accuracy rule compares the last ``k`` days with the first ``k``.  Closed hours
  are rolled up to days by a second stateful operator behind the first; the days
  seen so far are kept as the first ``k``, the last ``k`` and one row of sums for
  those between, so the state doesn't grow with the stream.
* The churn and opportunity rules look at the customers active on a closed day: a
  stateful aggregate per day and customer, joined with the customers' profiles.

Every sink writes a folder per batch, so a batch that is delivered again gives its
alerts once.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.columns import try_ratio
from tessera.plans.alerts import OPPORTUNITY_DIVERSITY_CEILING, OPPORTUNITY_SEGMENT
from tessera.streaming.change_log import EVERY, ChangeLog

TREND_DAYS = 7


def fired(values: DataFrame, rules: DataFrame) -> DataFrame:
    """Alerts of (window_start, metric, value) rows: the rules whose strict comparison holds."""
    j = values.join(F.broadcast(rules), "metric")
    holds = F.when(F.col("op") == ">", F.col("value") > F.col("threshold")).when(F.col("op") == "<", F.col("value") < F.col("threshold"))
    return j.where(F.coalesce(holds, F.lit(False))).select("window_start", "rule_no", "type", "severity", "title", "value", "threshold")


# --- hours to days, first and last days ------------------------------------------------------
def daily_rollup_stream(log: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Rows, known confidences and their sum per closed day, from closed hours (two stateful operators in a chain)."""
    hours = (log.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour").alias("hour"))
             .agg(F.count(F.lit(1)).alias("volume"), F.sum("confidence").alias("confidence_sum"), F.count("confidence").alias("confidence_count")))
    days = hours.groupBy(F.window(F.window_time("hour"), "1 day").alias("day"))
    return (days.agg(*(F.sum(c).alias(c) for c in ("volume", "confidence_sum", "confidence_count")))
            .select(F.col("day.start").cast("timestamp_ntz").alias("day"), "volume", "confidence_sum", "confidence_count"))


def _bounded(k: int) -> Callable[[DataFrame], DataFrame]:
    """Keep the first and the last ``k`` days; those between become one row of sums.  Days arrive in order (a day closes
    after all before it), so a day between stays between.  The windows run over the kept days only."""
    def merge(rows: DataFrame) -> DataFrame:
        days = rows.where("day IS NOT NULL").withColumn("_a", F.row_number().over(Window.orderBy("day"))).withColumn("_d", F.row_number().over(Window.orderBy(F.desc("day"))))
        outer = (F.col("_a") <= k) | (F.col("_d") <= k)
        between = days.where(~outer).drop("_a", "_d").unionByName(rows.where("day IS NULL")).agg(
            F.lit(None).cast("timestamp_ntz").alias("day"), *(F.sum(c).alias(c) for c in ("days", "volume", "confidence_sum", "confidence_count")))
        return days.where(outer).drop("_a", "_d").unionByName(between.where("days IS NOT NULL"))
    return merge


class DayTrend:
    """Mean daily confidence of the last ``k`` days minus that of the first ``k``, for every day that closes."""

    def __init__(self, spark: SparkSession, path: str, k: int = TREND_DAYS, every: int = EVERY):
        self.k = k
        self.log = ChangeLog(spark, path, "day timestamp_ntz, days long, volume long, confidence_sum double, confidence_count long", ["day"], _bounded(k), 1, every)

    def values(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """(window_start, metric, value) of the days that a batch closed, after all days of earlier batches."""
        days = batch.withColumn("days", F.lit(1).cast("long"))
        before = self.log.read(batch_id - 1)
        known = days if before is None else before.where("day IS NOT NULL").unionByName(days)
        accuracy = try_ratio(F.col("confidence_sum"), F.col("confidence_count"))
        by_day = Window.orderBy("day")
        seen = known.withColumn("accuracy", accuracy).withColumn("nth", F.row_number().over(by_day))
        first = F.avg(F.when(F.col("nth") <= self.k, F.col("accuracy"))).over(by_day.rowsBetween(Window.unboundedPreceding, 0))
        last = F.avg("accuracy").over(by_day.rowsBetween(1 - self.k, 0))
        trend = seen.withColumn("value", last - first).join(days.select(F.col("day").alias("_day")), F.col("day") == F.col("_day"), "left_semi")
        return trend.select(F.col("day").alias("window_start"), F.lit("accuracy_trend").alias("metric"), "value")


def trend_sink(rules: DataFrame, path: str, trend: DayTrend) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: alerts of the closed days, then the days themselves."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= trend.log.compacted():
            return
        batch.persist()  # a few days, used twice: the stateful plan runs once
        fired(trend.values(batch, batch_id), rules).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        trend.log.append(batch.withColumn("days", F.lit(1).cast("long")), batch_id)
        batch.unpersist()
    return write


# --- customers active on a day -----------------------------------------------------------------
def active_customers_stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One row per closed day and customer with an event on it."""
    g = events.withWatermark("ts", delay).groupBy(F.window("ts", "1 day").alias("day"), "user_id").agg(F.count(F.lit(1)).alias("n_events"))
    return g.select(F.col("day.start").cast("timestamp_ntz").alias("day"), F.col("user_id").alias("customer_id"), "n_events")


def customer_metrics(active: DataFrame, profiles: DataFrame) -> DataFrame:
    """Mean churn risk of a day's active customers and how many of them are loyal with few interests, as (window_start, metric, value)."""
    loyal = (F.col("segment") == OPPORTUNITY_SEGMENT) & (F.col("interest_diversity") < OPPORTUNITY_DIVERSITY_CEILING)
    per_day = active.join(profiles, "customer_id").groupBy(F.col("day").alias("window_start")).agg(
        F.avg("churn_risk").alias("avg_churn_risk"), F.count_if(loyal).cast("double").alias("opportunity_customers"))
    return per_day.select("window_start", F.expr("stack(2, 'avg_churn_risk', avg_churn_risk, 'opportunity_customers', opportunity_customers) AS (metric, value)"))


def customer_sink(rules: DataFrame, path: str, profiles: DataFrame) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: alerts on the customers of the closed days."""
    def write(batch: DataFrame, batch_id: int) -> None:
        fired(customer_metrics(batch, profiles), rules).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write
