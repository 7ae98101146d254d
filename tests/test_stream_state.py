"""Streams with bounded state: change logs, exactly-once ingest, running tables, rules over days."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tessera.plans import alerts, monitor
from tessera.session import folders
from tessera.sources.tables import shifting_log_from_events
from tessera.streaming import alerting, ingest, running
from tessera.streaming import streams as st
from tessera.streaming.change_log import ChangeLog
from tests.conftest import SF_SMALL


def _sum_log(spark, path, **how):
    merge = lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n"))
    return ChangeLog(spark, str(path), "k long, n long", ["k"], merge, **how)


def _rows(log):
    return sorted(tuple(r) for r in log.read().select("k", "n").collect())


def test_change_log_compacts_and_stays_small(spark, tmp_path):
    log = _sum_log(spark, tmp_path / "log", buckets=4, every=3)
    assert log.read() is None
    for b in range(8):
        log.append(spark.createDataFrame([(k, 1) for k in range(b, b + 10)], "k long, n long"), b)
        assert len(log.change_batches()) < 3
        assert len(folders(spark, str(tmp_path / "log" / "snapshots"))) <= 1
    assert log.compacted() == 5 and log.change_batches() == [6, 7]
    want = [(k, sum(b <= k < b + 10 for b in range(8))) for k in range(17)]
    assert _rows(log) == want
    files = sum(f.endswith(".parquet") for _, _, names in os.walk(tmp_path / "log" / "snapshots") for f in names)
    assert files <= 4


def test_change_log_takes_a_batch_once(spark, tmp_path):
    """Batches delivered again, before and after the compaction that holds them, and a writer that was cut off."""
    log = _sum_log(spark, tmp_path / "log", buckets=2, every=3)
    batch = lambda b: spark.createDataFrame([(1, 10 ** b)], "k long, n long")
    for b in (0, 1, 1, 0, 2, 2, 0, 3):
        log.append(batch(b), b)
    assert _rows(log) == [(1, 1111)]
    cut_off = tmp_path / "log" / "changes" / "batch=4"  # no _SUCCESS: never read, overwritten when it comes again
    batch(4).withColumn("bucket", log.bucket()).write.partitionBy("bucket").parquet(str(cut_off))
    os.remove(cut_off / "_SUCCESS")
    assert _rows(log) == [(1, 1111)]
    log.append(batch(4), 4)
    assert _rows(log) == [(1, 11111)]


def test_change_log_keeps_empty_batches_and_old_folders_out(spark, tmp_path):
    log = _sum_log(spark, tmp_path / "log", buckets=2, every=2)
    log.append(spark.createDataFrame([], "k long, n long"), 0)
    assert _rows(log) == []
    log.append(spark.createDataFrame([(1, 1)], "k long, n long"), 1)
    assert _rows(log) == [(1, 1)] and log.compacted() == 1
    # a change folder that a compaction could not remove any more is not read twice
    spark.createDataFrame([(1, 1)], "k long, n long").withColumn("bucket", log.bucket()).write.partitionBy("bucket").parquet(str(tmp_path / "log" / "changes" / "batch=1"))
    assert _rows(log) == [(1, 1)]
    with pytest.raises(ValueError):
        log.read(0)


SCHEMA = "k long, part string, ts timestamp_ntz, v int"


def _day(n, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=hour)


def _ingest(spark, base, deliveries, delay, every=2):
    src, sink, ck = (str(base / x) for x in ("src", "sink", "ck"))
    for n, rows in enumerate(deliveries):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        once = st.dedupe_stream(stream, ("k", "part"), delay) if delay else stream
        st.run_to_completion(once, sink, ck, foreach_batch=ingest.ingest_sink(spark, sink, ["k", "part"], buckets=4, every=every))
    schema = "k long, part string, ts timestamp, v int" if delay else SCHEMA
    return sink, ingest.ingested(spark, sink, schema)


@pytest.mark.parametrize("delay", ["2 days", None])
def test_repeats_beyond_the_watermark(spark, tmp_path, delay):
    """A key comes again within the delay, weeks later (its state is gone), with a null part, and in a batch of its own repeats."""
    deliveries = [
        [(1, "a", _day(0), 1), (2, "a", _day(0, 1), 1), (1, "a", _day(0, 2), 9), (3, None, _day(0), 1)],
        [(2, "a", _day(1), 9), (4, "a", _day(1), 2)],
        [(1, "a", _day(20), 9), (5, "a", _day(20), 3), (3, None, _day(20), 9)],
        [(1, "b", _day(40), 4), (2, "a", _day(40), 9), (5, "a", _day(40, 1), 9)],
        [(6, "a", _day(60), 5), (1, "a", _day(60), 9), (1, "b", _day(60), 9), (6, "a", _day(60, 1), 9)],
    ]
    _, got = _ingest(spark, tmp_path, deliveries, delay)
    keys = sorted((r["k"], r["part"] or "") for r in got.collect())
    assert keys == [(1, "a"), (1, "b"), (2, "a"), (3, ""), (4, "a"), (5, "a"), (6, "a")]
    assert got.where("v = 9 AND k <> 6 AND k <> 1").count() == 0  # the first delivery of a key is the one kept


def test_a_batch_delivered_again_adds_nothing(spark, tmp_path):
    sink = str(tmp_path / "sink")
    write = ingest.ingest_sink(spark, sink, ["k"], buckets=2, every=2)
    batch = lambda *ks: spark.createDataFrame([(k, k * 2) for k in ks], "k long, v long")
    for b, ks in ((0, (1, 2)), (0, (1, 2)), (1, (2, 3)), (1, (2, 3)), (0, (1, 2)), (2, (1, 4)), (2, (1, 4))):
        write(batch(*ks), b)
    got = sorted(tuple(r) for r in ingest.ingested(spark, sink, "k long, v long").collect())
    assert got == [(1, 2), (2, 4), (3, 6), (4, 8)]


def test_lookup_reads_touched_buckets_and_prunes_by_bloom_filter(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "keys"), "k long", ["k"], lambda rows: rows.distinct(), buckets=8, every=2)
    for b in range(2):
        log.append(spark.range(b * 50_000, (b + 1) * 50_000).withColumnRenamed("id", "k"), b)
    spark.range(0, 10).select(F.col("id").alias("k")).withColumn("bucket", log.bucket()).write.partitionBy("bucket").parquet(str(tmp_path / "batch"))
    rows = spark.read.schema("k long, bucket int").parquet(str(tmp_path / "batch"))
    touched = F.col("bucket").isin([r["bucket"] for r in rows.select("bucket").distinct().collect()][:3])
    settings = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        known = ingest.known_keys(log.read(merged=False, only=touched), rows.where(touched), ["k"])
        plan = known._jdf.queryExecution().toString()
        assert "might_contain" in plan and "PartitionFilters: [bucket" in plan
        assert known.count() == rows.where(touched).count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_recent_rows_equal_batch_drift(spark, tmp_path):
    """Rows out of order over many batches: the ring holds the newest rows, drift equals the batch operator's."""
    log = shifting_log_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    recent = running.RecentRows(spark, str(tmp_path / "recent"), 30, every=2)
    assert recent.drift() is None
    for b in range(5):
        recent.append(log.where(F.col("prediction_id") % 5 == (b * 2) % 5), b)
        if b == 2:
            recent.append(log.where(F.col("prediction_id") % 5 == (b * 2) % 5), b)  # delivered again
    assert recent.ring.read().groupBy("model_name").count().agg(F.max("count")).first()[0] == 30
    key = lambda df: sorted((r["model_name"], r["status"], round(r["positive_rate_drift"], 9), round(r["confidence_drift"], 9), r["drift_severity"]) for r in df.collect())
    assert key(recent.drift()) == key(monitor.drift(log, 30))
    short = running.RecentRows(spark, str(tmp_path / "short"), 10_000)
    short.append(log, 0)
    assert {r["status"] for r in short.drift().collect()} == {"warning"}


def test_running_rfm_has_no_operator_state(spark, tmp_path):
    from tessera.sources.tables import transactions_from_orders
    src, sink, ck = (str(tmp_path / x) for x in ("src", "sink", "ck"))
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    log = running.rfm_log(spark, sink, buckets=4, every=3)
    for part in range(7):
        orders.where(F.col("o_orderkey") % 7 == part).coalesce(1).write.mode("append").parquet(src)
        st.run_to_completion(transactions_from_orders(st.read_stream(spark, src, "orders")), sink, ck, foreach_batch=running.rfm_sink(log))
        assert len(log.change_batches()) < 3
    assert log.compacted() == 5 and not os.path.exists(f"{ck}/state")
    got = {r["customer_id"]: (r["last_purchase"], r["frequency"], round(r["monetary_total"], 2)) for r in log.read().collect()}
    want = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("m"), F.count("*").alias("n"), F.sum("o_totalprice").alias("s")).collect()
    assert got == {r["o_custkey"]: (r["m"], r["n"], round(r["s"], 2)) for r in want}


def _days(spark, values, start=0):
    rows = [(_day(start + i), 10, v * 10, 10) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "day timestamp_ntz, volume long, confidence_sum double, confidence_count long")


def test_day_trend_keeps_few_days(spark, tmp_path):
    """Trend of each day over all days so far, from the first k, the last k and one row of sums."""
    k, values = 3, [0.9, 0.8, 0.85, 0.7, 0.75, 0.6, 0.65, 0.5, 0.4, 0.45, 0.3, 0.35]
    trend = alerting.DayTrend(spark, str(tmp_path / "days"), k, every=2)
    rules = alerts.rules_frame(spark)
    write = alerting.trend_sink(rules, str(tmp_path / "out"), trend)
    got = {}
    at = 0
    for b, n in enumerate((1, 4, 0, 3, 2, 2)):
        batch = _days(spark, values[at:at + n], at)
        got |= {r["window_start"]: r["value"] for r in trend.values(batch, b).collect()}
        write(batch, b)
        at += n
    mean = lambda x: sum(x) / len(x)
    want = {_day(i): mean(values[max(0, i + 1 - k):i + 1]) - mean(values[:min(k, i + 1)]) for i in range(len(values))}
    assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-12 for d in want)
    state = trend.log.read()
    assert state.count() <= 2 * k + 1
    assert state.agg(F.sum("volume"), F.sum("days")).first() == (120, 12)
    fired = {r["window_start"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert fired == {d for d, v in want.items() if v < -0.05}


def test_customer_metrics(spark):
    active = spark.createDataFrame([(_day(0), 1, 3), (_day(0), 2, 1), (_day(1), 1, 1), (_day(1), 9, 1)], "day timestamp_ntz, customer_id long, n_events long")
    profiles = spark.createDataFrame([(1, 0.9, "Loyal Customers", 0.25), (2, 0.5, "Lost Customers", 0.25), (3, 1.0, "Loyal Customers", 0.1)], "customer_id long, churn_risk double, segment string, interest_diversity double")
    got = {(r["window_start"], r["metric"]): r["value"] for r in alerting.customer_metrics(active, profiles).collect()}
    assert got == {(_day(0), "avg_churn_risk"): 0.7, (_day(0), "opportunity_customers"): 1.0, (_day(1), "avg_churn_risk"): 0.9, (_day(1), "opportunity_customers"): 1.0}


def test_alert_metrics_leave_unknown_confidences_out(spark):
    """A log with missing confidences: the mean is over the known ones."""
    rows = [(i, _day(i // 4), "m", 1, None if i % 2 else 0.5 + i / 100, 1.0) for i in range(20)]
    log = spark.createDataFrame(rows, "prediction_id long, ts timestamp_ntz, model_name string, prediction int, confidence double, processing_time double")
    people = spark.createDataFrame([], "customer_id long, churn_risk double, segment string, interest_diversity double, monetary_total double, monetary_avg double")
    m = alerts.alert_metrics(people, monitor.daily_series(log, None), 2).first()
    assert abs(m["avg_confidence"] - sum(r[4] for r in rows if r[4] is not None) / 10) < 1e-12
    assert abs(m["volume_ratio"] - 1.0) < 1e-12 and abs(m["accuracy_trend"] - 0.12) < 1e-12


def test_every_rule_fires_on_the_stream(spark):
    import __spark_entry__ as e
    assert sorted(r["rule_no"] for r in e.queries()["stream_alerts"](spark, SF_SMALL).select("rule_no").distinct().collect()) == [1, 2, 3, 4, 5]
