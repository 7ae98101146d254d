"""Running tables over a stream whose state stays small: RFM per customer, and the last N rows per model with their drift.

Both keep their state in change logs (``change_log``): a micro-batch is reduced
by plain aggregates, which combine before the shuffle, so a customer or model
with a third of all rows is no hot group, and merged with what is stored.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.columns import try_ratio
from tessera.plans.dashboard import hour_grid
from tessera.plans.monitor import drift_of
from tessera.streaming.change_log import BUCKETS, EVERY, ChangeLog


# --- running RFM (ST5) ----------------------------------------------------------------
def _merged_rfm(rows: DataFrame) -> DataFrame:
    return rows.groupBy("customer_id").agg(F.max("last_purchase").alias("last_purchase"), F.sum("frequency").alias("frequency"), F.sum("monetary_total").alias("monetary_total"))


def rfm_log(spark: SparkSession, path: str, buckets: int = BUCKETS, every: int = EVERY) -> ChangeLog:
    """Last purchase, count and spend per customer."""
    return ChangeLog(spark, path, "customer_id long, last_purchase timestamp_ntz, frequency long, monetary_total double", ["customer_id"], _merged_rfm, buckets, every)


def rfm_sink(log: ChangeLog) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: what a batch of transactions adds to each of its customers."""
    def write(batch: DataFrame, batch_id: int) -> None:
        parts = batch.select("customer_id", F.col("transaction_date").cast("timestamp_ntz").alias("last_purchase"), F.lit(1).cast("long").alias("frequency"), F.col("amount").alias("monetary_total"))
        log.append(_merged_rfm(parts), batch_id)
    return write


# --- the last N rows per model (ST3) ----------------------------------------------------
class RecentRows:
    """The newest ``size`` rows of each model (a ring: older ones fall out) and sums over all of its rows."""

    def __init__(self, spark: SparkSession, path: str, size: int, buckets: int = 1, every: int = EVERY):
        self.size = size
        newest = Window.partitionBy("model_name").orderBy(F.col("ts").desc(), F.col("prediction_id").desc())
        self._newest = lambda rows: rows.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= size).drop("_nth")
        self._sums = lambda rows: rows.groupBy("model_name").agg(*(F.sum(c).alias(c) for c in ("n", "p", "c", "np", "nc")))
        self.ring = ChangeLog(spark, f"{path}/ring", "model_name string, ts timestamp_ntz, prediction_id long, prediction int, confidence double", ["model_name"], self._newest, buckets, every)
        self.totals = ChangeLog(spark, f"{path}/totals", "model_name string, n long, p long, c double, np long, nc long", ["model_name"], self._sums, buckets, every)

    @staticmethod
    def _counted(rows: DataFrame) -> DataFrame:
        """One row's part of the sums."""
        has = lambda c: F.col(c).isNotNull().cast("long")
        return rows.select("model_name", F.lit(1).cast("long").alias("n"), F.col("prediction").cast("long").alias("p"), F.col("confidence").alias("c"), has("prediction").alias("np"), has("confidence").alias("nc"))

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Take a micro-batch of the prediction log."""
        rows = batch.select("model_name", F.col("ts").cast("timestamp_ntz").alias("ts"), "prediction_id", "prediction", "confidence")
        self.ring.append(self._newest(rows), batch_id)
        self.totals.append(self._sums(self._counted(rows)), batch_id)

    def drift(self) -> DataFrame | None:
        """Recent rows of each model against all earlier ones (None before the first batch)."""
        ring, totals = self.ring.read(), self.totals.read()
        return None if ring is None or totals is None else drift_of(totals, self._sums(self._counted(ring)), self.size)


def drift_sink(recent: RecentRows) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer that keeps ``recent`` up to date."""
    return recent.append


# --- hourly roll-up kept up to date (A10) ----------------------------------------------------
class HourlyView:
    """Sums per hour of a prediction log that arrives in any order: a batch adds its part to the hours it touches."""

    _SUMS = ["_count", "_pos", "c", "nc", "t", "nt"]

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, every: int = EVERY):
        merge = lambda rows: rows.groupBy("hour_ts").agg(*(F.sum(x).alias(x) for x in self._SUMS))
        self.log = ChangeLog(spark, path, "hour_ts timestamp_ntz, _count long, _pos long, c double, nc long, t double, nt long", ["hour_ts"], merge, buckets, every)

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Take a micro-batch of the log, late rows included."""
        hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
        parts = batch.groupBy(hour.alias("hour_ts")).agg(
            F.count(F.lit(1)).alias("_count"), F.sum(F.col("prediction").cast("long")).alias("_pos"), F.sum("confidence").alias("c"), F.count("confidence").alias("nc"),
            F.sum("processing_time").alias("t"), F.count("processing_time").alias("nt"))
        self.log.append(parts, batch_id)

    def read(self) -> DataFrame | None:
        """The roll-up on the full hour grid so far (None before the first batch)."""
        sums = self.log.read()
        if sums is None:
            return None
        return hour_grid(sums.select("hour_ts", "_count", "_pos", try_ratio(F.col("c"), F.col("nc")).alias("avg_confidence"), try_ratio(F.col("t"), F.col("nt")).alias("processing_time")))
