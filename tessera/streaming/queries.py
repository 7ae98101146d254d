"""Streaming catalogue entries.

Each entry delivers a whole test table in several deliveries, one a micro-batch, to
a file source with ``trigger(availableNow=True)``, lets the query commit to a
sink below the reliable checkpoint folder and returns the sink contents as a
DataFrame. Event streams end with a heartbeat row, so every window of the data
is closed and in the sink.
"""
from __future__ import annotations

import os
import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import round_half_up
from tessera.operators.sessions import behavior_from_events
from tessera.plans import features
from tessera.plans.alerts import rules_frame
from tessera.plans.catalog import AS_OF_ORDERS, DRIFT_MEASURES, DRIFT_WINDOW, LINE_KEYS
from tessera.session import scratch_path, written
from tessera.sources.tables import (Tables, browsing_events, prediction_log_from_events, shifting_log_from_events,
                                    transactions_from_orders)
from tessera.streaming import alerting, ingest, running
from tessera.streaming import streams as st


def _dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    base = scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:8]}")
    return os.path.join(base, "sink"), os.path.join(base, "checkpoint")


#: Event streams start here; what lies before is the history that baselines come from.
STREAM_START = "2024-01-10 00:00:00"


def _later(events: DataFrame) -> F.Column:
    return F.col("ts") >= F.lit(STREAM_START).cast("timestamp_ntz")


def _delivered(spark, sf_dir, only=None) -> tuple[str, int]:
    """Folder with the events in several deliveries and a closing heartbeat behind them, and the files of a delivery."""
    src, _ = _dirs(spark, "events-src")
    events = Tables(spark, sf_dir).events
    files = st.replay(events if only is None else events.where(only(events)), src, closing={"event_id": st.CLOSING_ID, "event_type": "heartbeat", "value": 0.0})
    return src, files


def _events(spark, sf_dir, only=None) -> DataFrame:
    """Events as a stream of several deliveries with a closing heartbeat behind them."""
    src, files = _delivered(spark, sf_dir, only)
    return st.read_stream(spark, src, "events", max_files_per_trigger=files)


def _plain_events(spark, sf_dir) -> DataFrame:
    """Events as a stream of several deliveries."""
    src, _ = _dirs(spark, "events-src")
    files = st.replay(Tables(spark, sf_dir).events, src)
    return st.read_stream(spark, src, "events", max_files_per_trigger=files)


def _history(spark, sf_dir) -> DataFrame:
    events = Tables(spark, sf_dir).events
    return prediction_log_from_events(events.where(~_later(events)))


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def q_stream_rollup(spark, sf_dir) -> DataFrame:
    sink, ck = _dirs(spark, "rollup")
    st.run_to_completion(st.hourly_rollup_stream(st.prediction_log_stream(_events(spark, sf_dir))), sink, ck)
    out = _ntz(spark.read.parquet(sink), "window_start", "window_end").drop("confidence_sum", "confidence_count")
    return out.withColumns({c: round_half_up(c, 6) for c in ("avg_confidence", "processing_time", "positive_rate")})


def q_stream_drift(spark, sf_dir) -> DataFrame:
    """Sliding windows of the stream against the history before it."""
    sink, ck = _dirs(spark, "drift")
    baseline = _history(spark, sf_dir).groupBy("model_name").agg(
        F.avg(F.col("prediction").cast("double")).alias("base_positive_rate"),
        F.avg("confidence").alias("base_confidence"))
    stream = st.prediction_log_stream(_events(spark, sf_dir, _later))
    st.run_to_completion(st.drift_stream(stream, baseline), sink, ck)
    out = _ntz(spark.read.parquet(sink), "window_start", "window_end")
    return out.withColumns({c: round_half_up(c, 6) for c in ("positive_rate_drift", "confidence_drift")})


def _profiles(spark, sf_dir) -> DataFrame:
    """Customers who only browse, as they were before the stream."""
    t = Tables(spark, sf_dir)
    rfm = features.rfm_features(transactions_from_orders(t.orders), AS_OF_ORDERS)
    return features.segment_customers(rfm, features.behavioral_features(behavior_from_events(browsing_events(t.events, STREAM_START))))


def q_stream_alerts(spark, sf_dir) -> DataFrame:
    """All five rules over a log whose confidence falls: per closed hour confidence and volume (against the history's
    mean hour), per closed day the accuracy trend, churn risk and opportunities among the day's customers."""
    rules = rules_frame(spark)
    sink, ck = _dirs(spark, "alerts")
    # scaled so that no mean of whole days lies on a threshold
    src, files = _delivered(spark, sf_dir, _later)
    events = lambda: st.read_stream(spark, src, "events", max_files_per_trigger=files)
    log = lambda: st.with_event_time(shifting_log_from_events(events())).withColumn("confidence", F.col("confidence") * 0.99)
    # baseline: mean predictions per hour in the history (one number from one aggregate)
    baseline = (_history(spark, sf_dir).groupBy(F.date_trunc("hour", "ts")).count().agg(F.avg("count")).first()[0])
    st.run_to_completion(st.hourly_rollup_stream(log()), sink, f"{ck}/hours", foreach_batch=st.alert_sink(rules, f"{sink}/hours", baseline))
    trend = alerting.DayTrend(spark, f"{sink}/days", every=2)
    st.run_to_completion(alerting.daily_rollup_stream(log()), sink, f"{ck}/days", foreach_batch=alerting.trend_sink(rules, f"{sink}/trend", trend))
    active = alerting.active_customers_stream(st.with_event_time(events()))
    profiles = written(_profiles(spark, sf_dir), "profiles")
    st.run_to_completion(active, sink, f"{ck}/customers", foreach_batch=alerting.customer_sink(rules, f"{sink}/customers", profiles))
    columns = ["window_start", "rule_no", "type", "severity", "title", "value", "threshold"]
    hours, days, customers = (spark.read.parquet(f"{sink}/{part}").select(*columns) for part in ("hours", "trend", "customers"))
    out = _ntz(hours, "window_start").unionByName(days).unionByName(customers)
    return out.withColumn("value", round_half_up("value", 9))


def q_stream_rfm(spark, sf_dir) -> DataFrame:
    """Running RFM from a change log that is compacted twice on the way."""
    sink, ck = _dirs(spark, "rfm")
    src, _ = _dirs(spark, "orders-src")
    files = st.replay(Tables(spark, sf_dir).orders, src, ts="o_orderdate")
    tx = transactions_from_orders(st.read_stream(spark, src, "orders", max_files_per_trigger=files))
    log = running.rfm_log(spark, sink, every=2)
    st.run_to_completion(tx, sink, ck, foreach_batch=running.rfm_sink(log))
    return log.read().withColumn("monetary_total", round_half_up("monetary_total", 2))


def q_stream_drift_last_rows(spark, sf_dir) -> DataFrame:
    """Drift of the newest rows of each model against all earlier ones, kept while the log arrives."""
    sink, ck = _dirs(spark, "recent")
    recent = running.RecentRows(spark, sink, DRIFT_WINDOW, every=2)
    log = st.with_event_time(shifting_log_from_events(_plain_events(spark, sf_dir)))
    st.run_to_completion(log, sink, ck, foreach_batch=running.drift_sink(recent))
    return recent.drift().withColumns({c: round_half_up(c, 6) for c in DRIFT_MEASURES})


def q_stream_hourly_view(spark, sf_dir) -> DataFrame:
    """The hourly roll-up kept up to date while the events come in four deliveries, each with rows of every hour."""
    sink, ck = _dirs(spark, "hourly-view")
    src, _ = _dirs(spark, "events-src")
    events = Tables(spark, sf_dir).events
    files = max(1, -(-events.count() // (4 * st.ROWS_PER_FILE)))
    for part in (2, 0, 3, 1):
        st.deliver(events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == part), src, files)
    view = running.HourlyView(spark, sink, every=2)
    log = st.prediction_log_stream(st.read_stream(spark, src, "events", max_files_per_trigger=files))
    st.run_to_completion(log, sink, ck, foreach_batch=view.append)
    return view.read().withColumns({c: round_half_up(c, 12) for c in ("avg_confidence", "processing_time", "positive_rate")})


def q_stream_sessions(spark, sf_dir) -> DataFrame:
    sink, ck = _dirs(spark, "sessions")
    st.run_to_completion(st.sessions_stream(_events(spark, sf_dir)), sink, ck)
    return _ntz(spark.read.parquet(sink), "session_start", "session_end")


def q_stream_dedupe(spark, sf_dir) -> DataFrame:
    """Transaction lines, whose keys repeat years apart, ingested once with a state of days: the keys that came through."""
    sink, ck = _dirs(spark, "dedupe")
    src, _ = _dirs(spark, "lines-src")
    files = st.replay(Tables(spark, sf_dir).lineitem, src, ts="l_shipdate")
    stream = st.read_stream(spark, src, "lineitem", max_files_per_trigger=files).withColumnRenamed("l_shipdate", "ts")
    once = st.dedupe_stream(stream, LINE_KEYS, delay="3 days").select(*LINE_KEYS)
    st.run_to_completion(once, sink, ck, foreach_batch=ingest.ingest_sink(spark, sink, LINE_KEYS, every=2))
    return ingest.ingested(spark, sink, once.schema)


def q_stream_scoring(spark, sf_dir) -> DataFrame:
    """Train the default model, then score every customer, arriving as a stream."""
    from tessera.plans.ml_queries import _default_model, training_data

    data = training_data(spark, sf_dir)
    model = _default_model(data)
    src, _ = _dirs(spark, "scoring-src")
    rows = data.select("customer_id", "label", "features")
    rows.write.parquet(src)
    sink, ck = _dirs(spark, "scoring")
    sdf = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(src)
    scored = st.score_stream(sdf, model)
    st.run_to_completion(scored_frame_of(scored), sink, ck)
    return spark.read.parquet(sink)


def scored_frame_of(scored: DataFrame) -> DataFrame:
    """A scored micro-batch as prediction-log rows: prediction, confidence and the time of scoring."""
    return scored.select("customer_id", "label", F.col("prediction").cast("int"),
                         F.array_max(vector_to_array("probability")).alias("confidence"),
                         F.current_timestamp().alias("scored_at"))


STREAM_QUERIES = {
    "stream_rollup": q_stream_rollup, "stream_drift": q_stream_drift, "stream_alerts": q_stream_alerts,
    "stream_rfm": q_stream_rfm, "stream_sessions": q_stream_sessions, "stream_dedupe": q_stream_dedupe,
    "stream_scoring": q_stream_scoring, "stream_drift_last_rows": q_stream_drift_last_rows,
    "stream_hourly_view": q_stream_hourly_view,
}
