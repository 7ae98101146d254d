"""Prediction dashboard datasets: hourly roll-up and the four chart datasets."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import DAYPART_LABELS, day_part, round_half_up, try_ratio
from tessera.operators.stats import histogram
from tessera.session import materialize


def hourly_rollup(log: DataFrame) -> DataFrame:
    """Per hour: predictions_count, positive/negative predictions, avg_confidence,
    processing_time, positive_rate — over the full hour grid from the first
    to the last hour (empty hours: counts 0, rate NULL)."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    per_hour = log.groupBy(hour.alias("hour_ts")).agg(
        F.count(F.lit(1)).alias("_count"), F.sum("prediction").alias("_pos"),
        F.avg("confidence").alias("avg_confidence"), F.avg("processing_time").alias("processing_time"))
    # One row per day of the covered span first, dealt out, then the hours of each day: no array or
    # task holds the whole grid. The log is scanned once; the span comes from the hours that occur.
    return hour_grid(materialize(per_hour))


def hour_grid(per_hour: DataFrame) -> DataFrame:
    """The roll-up on the full hour grid from sums per hour that occurs (hour_ts, _count, _pos, avg_confidence, processing_time)."""
    span = per_hour.agg(F.min("hour_ts").alias("_lo"), F.max("hour_ts").alias("_hi"))
    days = span.select("_lo", "_hi", F.explode(F.sequence(F.to_date("_lo"), F.to_date("_hi"), F.expr("INTERVAL 1 DAY"))).alias("_day"))
    hours = F.sequence(F.col("_day").cast("timestamp_ntz"), F.col("_day").cast("timestamp_ntz") + F.expr("INTERVAL 23 HOURS"),
                       F.expr("INTERVAL 1 HOUR"))
    grid = (days.repartition("_day").select("_lo", "_hi", F.explode(hours).alias("hour_ts"))
            .where(F.col("hour_ts").between(F.col("_lo"), F.col("_hi"))).select("hour_ts"))
    out = grid.join(per_hour, "hour_ts", "left")
    cnt = F.coalesce(F.col("_count"), F.lit(0)).cast("long")
    pos = F.coalesce(F.col("_pos"), F.lit(0)).cast("long")
    return out.select("hour_ts", cnt.alias("predictions_count"), pos.alias("positive_predictions"),
                      (cnt - pos).alias("negative_predictions"), "avg_confidence", "processing_time",
                      try_ratio(pos, cnt).alias("positive_rate"))


def current_stats(hourly: DataFrame, as_of: str) -> DataFrame:
    """Totals for the ``as_of`` day (one conditional aggregate) + overall mean processing time."""
    today = F.to_date("hour_ts") == F.lit(as_of).cast("date")
    return hourly.agg(
        F.coalesce(F.sum(F.when(today, F.col("predictions_count"))), F.lit(0)).cast("long")
        .alias("total_predictions_today"),
        round_half_up(F.avg(F.when(today, F.col("avg_confidence"))), 3).alias("avg_confidence_today"),
        round_half_up(F.avg(F.when(today, F.col("positive_rate"))), 3).alias("positive_rate_today"),
        round_half_up(F.avg("processing_time"), 2).alias("avg_processing_time"))


def hourly_profile(hourly: DataFrame) -> DataFrame:
    """Hour-of-day means (rounded 2) of count, positive rate, confidence."""
    return hourly.groupBy(F.hour("hour_ts").alias("hour")).agg(
        round_half_up(F.avg("predictions_count"), 2).alias("predictions_count"),
        round_half_up(F.avg("positive_rate"), 2).alias("positive_rate"),
        round_half_up(F.avg("avg_confidence"), 2).alias("avg_confidence"))


def confidence_heatmap(hourly: DataFrame, include_lowest: bool = False) -> DataFrame:
    """Long form (day_of_week, hour_group, avg_confidence); hour 0 has no day part unless ``include_lowest``."""
    tagged = hourly.select(F.date_format("hour_ts", "EEEE").alias("day_of_week"),
                           day_part(F.hour("hour_ts"), include_lowest).alias("hour_group"), "avg_confidence")
    return (tagged.where(F.col("hour_group").isNotNull())
            .groupBy("day_of_week", "hour_group").agg(F.avg("avg_confidence").alias("avg_confidence")))


def confidence_heatmap_wide(hourly: DataFrame) -> DataFrame:
    """Day x day-part matrix (pivot with the fixed day-part list)."""
    tagged = hourly.select(F.date_format("hour_ts", "EEEE").alias("day_of_week"),
                           day_part(F.hour("hour_ts")).alias("hour_group"), "avg_confidence")
    return tagged.groupBy("day_of_week").pivot("hour_group", DAYPART_LABELS).agg(F.avg("avg_confidence"))


def confidence_histogram(hourly: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(hourly, "avg_confidence", bins)


def dashboard_summary(hourly: DataFrame) -> DataFrame:
    """Points, date range, peak hour (argmax of the rounded hourly mean, lowest
    hour on ties) and best-confidence day (mean over day parts, first day name
    alphabetically on ties)."""
    span = hourly.agg(F.count(F.lit(1)).alias("total_predictions_analyzed"),
                      F.date_format(F.min("hour_ts"), "yyyy-MM-dd").alias("date_from"),
                      F.date_format(F.max("hour_ts"), "yyyy-MM-dd").alias("date_to"))
    peak = (hourly_profile(hourly).orderBy(F.col("predictions_count").desc_nulls_last(), "hour").limit(1)
            .select(F.col("hour").alias("peak_hour")))
    best = (confidence_heatmap(hourly).groupBy("day_of_week").agg(F.avg("avg_confidence").alias("_m"))
            .orderBy(F.col("_m").desc_nulls_last(), "day_of_week").limit(1)
            .select(F.col("day_of_week").alias("best_confidence_day")))
    return span.crossJoin(peak).crossJoin(best)


def dashboard_overview(hourly: DataFrame, as_of: str) -> DataFrame:
    """The summary with the stats of one day as the struct ``current_stats``."""
    stats = current_stats(hourly, as_of)
    return dashboard_summary(hourly).crossJoin(stats.select(F.struct(*stats.columns).alias("current_stats")))
