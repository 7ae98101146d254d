"""Structured Streaming versions of the incremental operators.

Sources are file streams (any directory of parquet files; a Kafka source
plugs in the same way). Event time is cast from ``timestamp_ntz`` to
``timestamp`` because watermarks need the latter. Every stateful query keeps
its checkpoint and its sink under the reliable checkpoint folder, so a
restarted driver or a lost executor resumes from the last committed batch.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import epoch_micros, try_ratio
from tessera.plans.alerts import rules_frame
from tessera.plans.monitor import DRIFT_HIGH, DRIFT_THRESHOLD
from tessera.session import files_in
from tessera.sources.tables import SCHEMAS


def read_stream(spark: SparkSession, directory: str, table: str, file_glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File-stream source over a directory with the table's declared schema;
    ``file_glob`` selects the table's files when the folder holds several tables."""
    r = spark.readStream.schema(SCHEMAS[table])
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def with_event_time(sdf: DataFrame, col: str = "ts") -> DataFrame:
    return sdf.withColumn(col, F.col(col).cast("timestamp"))


def prediction_log_stream(events: DataFrame) -> DataFrame:
    """Streaming form of the events -> prediction log binding."""
    v = F.col("value")
    return with_event_time(events).select(
        F.col("event_id").alias("prediction_id"), "ts", F.col("event_type").alias("model_name"),
        (v > 50).cast("int").alias("prediction"),
        (F.lit(0.5) + F.lit(0.5) * F.least(v, F.lit(100.0)) / F.lit(100.0)).alias("confidence"),
        v.alias("processing_time"))


# --- ST1 ----------------------------------------------------------------------------
def score_stream(sdf: DataFrame, model) -> DataFrame:
    """Stateless scoring: tree / linear models transform each micro-batch."""
    return model.transform(sdf)


# --- ST2 ----------------------------------------------------------------------------
def hourly_rollup_stream(log: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Tumbling 1 h roll-up per model; a window is emitted once the watermark passes it."""
    g = (log.withWatermark("ts", delay)
         .groupBy(F.window("ts", "1 hour").alias("w"), "model_name")
         .agg(F.count(F.lit(1)).alias("predictions_count"), F.sum("prediction").alias("positive_predictions"),
              F.avg("confidence").alias("avg_confidence"), F.avg("processing_time").alias("processing_time"),
              F.sum("confidence").alias("confidence_sum"), F.count("confidence").alias("confidence_count")))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "model_name",
                    "predictions_count", "positive_predictions", "confidence_sum", "confidence_count",
                    (F.col("predictions_count") - F.col("positive_predictions")).alias("negative_predictions"),
                    "avg_confidence", "processing_time",
                    try_ratio(F.col("positive_predictions"), F.col("predictions_count")).alias("positive_rate"))


# --- ST3 ----------------------------------------------------------------------------
def drift_stream(log: DataFrame, baseline: DataFrame, length: str = "1 day", slide: str = "6 hours",
                 delay: str = "1 hour") -> DataFrame:
    """Sliding-window positive rate / confidence per model against a static baseline
    (model_name, base_positive_rate, base_confidence): stream-static join. The
    baseline should end before the stream starts, or it holds what it is compared with."""
    g = (log.withWatermark("ts", delay)
         .groupBy(F.window("ts", length, slide).alias("w"), "model_name")
         .agg(F.avg(F.col("prediction").cast("double")).alias("positive_rate"),
              F.avg("confidence").alias("avg_confidence"), F.count(F.lit(1)).alias("n")))
    j = g.join(baseline, "model_name")
    pr = F.abs(F.col("positive_rate") - F.col("base_positive_rate"))
    cd = F.abs(F.col("avg_confidence") - F.col("base_confidence"))
    det = (pr > DRIFT_THRESHOLD) | (cd > DRIFT_THRESHOLD)
    return j.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "model_name", "n",
                    pr.alias("positive_rate_drift"), cd.alias("confidence_drift"), det.alias("drift_detected"),
                    F.when(det & (pr > DRIFT_HIGH), "high").when(det, "medium").otherwise("low")
                    .alias("drift_severity"))


# --- ST4 ----------------------------------------------------------------------------
def rollup_alerts(batch: DataFrame, rules: DataFrame, baseline_volume: float | None = None) -> DataFrame:
    """Rule table applied to closed hourly windows: the confidence rule on the mean
    over the window's rows (models weigh by their volume, as in the batch rule), and
    with a baseline mean hourly volume also the volume-spike rule (window volume /
    baseline). The trend and churn rules need days of history: batch only."""
    per_window = batch.groupBy("window_start").agg(
        try_ratio(F.sum("confidence_sum"), F.sum("confidence_count")).alias("avg_confidence"),
        F.sum("predictions_count").alias("volume"))
    ratio = (F.col("volume") / F.lit(float(baseline_volume))) if baseline_volume else F.lit(None)
    per_window = per_window.withColumn("volume_ratio", ratio.cast("double"))
    long = per_window.select("window_start", F.expr(
        "stack(2, 'avg_confidence', CAST(avg_confidence AS DOUBLE), 'volume_ratio', volume_ratio) AS (metric, value)"))
    j = long.join(F.broadcast(rules), "metric")
    fired = j.where(F.coalesce(F.when(F.col("op") == ">", F.col("value") > F.col("threshold"))
                               .when(F.col("op") == "<", F.col("value") < F.col("threshold")), F.lit(False)))
    return fired.select("window_start", "rule_no", "type", "severity", "title", "value", "threshold")


def alert_sink(rules: DataFrame, path: str, baseline_volume: float | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer; each batch overwrites its own folder, so a replayed
    batch does not duplicate alerts (idempotent by batch id)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rollup_alerts(batch, rules, baseline_volume).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


# --- ST5 ----------------------------------------------------------------------------
def rfm_stream(tx: DataFrame) -> DataFrame:
    """Running per-customer last purchase, count and spend (stateful aggregate)."""
    return tx.groupBy("customer_id").agg(F.max("transaction_date").alias("last_purchase"),
                                         F.count(F.lit(1)).alias("frequency"),
                                         F.sum("amount").alias("monetary_total"))


def changes_sink(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer for update-mode state: each batch writes only the keys
    it changed, into its own ``batch_id`` folder (a replayed batch overwrites its
    folder, so the sink stays idempotent)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def latest_snapshot(spark: SparkSession, path: str, key: str = "customer_id") -> DataFrame:
    """Current state from an update-mode change log: the newest batch's row per key
    (``row_number() = 1``, reduced per task before the shuffle)."""
    from pyspark.sql import Window
    changes = spark.read.parquet(path)
    w = Window.partitionBy(key).orderBy(F.col("batch_id").desc())
    return changes.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn", "batch_id")


# --- ST6 ----------------------------------------------------------------------------
def sessions_stream(events: DataFrame, gap: str = "6 hours", delay: str = "6 hours") -> DataFrame:
    """Gap sessions per user with ``session_window``, from the first event to the last; emitted once closed."""
    ev = with_event_time(events).withWatermark("ts", delay)
    g = ev.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(
        F.count(F.lit(1)).alias("n_events"), F.max("ts").alias("session_end"))
    return g.select("user_id", F.col("s.start").alias("session_start"), "session_end", "n_events")


# --- ST7 ----------------------------------------------------------------------------
def dedupe_stream(events: DataFrame, keys=("event_id",), delay: str = "1 hour") -> DataFrame:
    """Exactly-once ingest: drop repeats of a key seen within the watermark delay."""
    return with_event_time(events).withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


# --- replay --------------------------------------------------------------------------
CLOSING_ID = -1


#: Rows of a delivery that one file holds, about.
ROWS_PER_FILE = 250_000


def deliver(df: DataFrame, path: str, files: int) -> None:
    """Add ``df`` to a file-stream folder in exactly ``files`` files (empty ones fill up), whatever partitions it has."""
    before = files_in(df.sparkSession, path)
    df.repartition(files).write.mode("append").parquet(path)
    for _ in range(files - (files_in(df.sparkSession, path) - before)):
        df.sparkSession.createDataFrame([], df.schema).write.mode("append").parquet(path)


def replay(df: DataFrame, path: str, ts: str = "ts", parts: int = 4, closing: dict | None = None,
           rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write ``df`` as a file-stream folder in ``parts`` deliveries by event time; returns the files of a delivery.

    The deliveries have consecutive time ranges, are written one after the
    other and have equally many files, so a stream that takes that many files at
    a time reads one delivery a micro-batch, in that order. (Fewer would cut a
    delivery, whose files all reach over its time range: the watermark of the
    first would drop rows of the next.) ``closing`` adds a last delivery of one row
    with these values and an event time 30 days after the last: the heartbeat
    that lets the watermark pass every window of the data (its own stays open and
    is never emitted).
    """
    us = epoch_micros(df, ts)
    lo, hi, last, rows = df.agg(F.min(us), F.max(us), F.max(ts), F.count(F.lit(1))).first()
    files = max(1, -(-rows // (parts * rows_per_file)))
    if lo is None:
        deliver(df, path, files)
        return files
    part = F.least(F.floor((us - F.lit(lo)) * F.lit(parts) / F.lit(hi - lo + 1)), F.lit(parts - 1))
    for k in range(parts):
        deliver(df.where(part == k), path, files)
    if closing is not None:
        row = df.sparkSession.range(1).select(*(F.lit(closing.get(f.name)).cast(f.dataType).alias(f.name) if f.name != ts
                                                else (F.lit(last) + F.expr("INTERVAL 30 DAYS")).cast(f.dataType).alias(ts)
                                                for f in df.schema.fields))
        deliver(row, path, 1)
    return files


# --- runner -------------------------------------------------------------------------
def run_to_completion(sdf: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                      foreach_batch: Callable | None = None, fmt: str = "parquet") -> None:
    """Process everything available now (``trigger(availableNow=True)``) and stop."""
    w = sdf.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format(fmt).option("path", sink).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


__all__ = ["read_stream", "with_event_time", "prediction_log_stream", "score_stream", "hourly_rollup_stream",
           "drift_stream", "rollup_alerts", "alert_sink", "rfm_stream", "sessions_stream",
           "dedupe_stream", "deliver", "replay", "run_to_completion", "rules_frame", "changes_sink", "latest_snapshot"]
