"""Late data: rows older than the watermark are dropped, on-time windows equal batch."""
import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tessera.streaming import streams as st
from tests.conftest import SF_SMALL


def test_late_rows_dropped_on_time_windows_equal_batch(spark):
    base = tempfile.mkdtemp(prefix="late-", dir="/tmp")
    src, sink, ck = (os.path.join(base, x) for x in ("src", "sink", "ck"))
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    cut = dt.datetime(2024, 1, 15)
    first = ev.where(F.col("ts") < F.lit(cut))
    # second batch: everything after the cut, plus copies of day-2 events re-sent late (new ids)
    late = (ev.where(F.col("ts") < F.lit(dt.datetime(2024, 1, 3)))
            .withColumn("event_id", F.col("event_id") + F.lit(10_000_000)))
    second = ev.where(F.col("ts") >= F.lit(cut)).unionByName(late)
    first.coalesce(1).write.parquet(os.path.join(src, "part1"))
    stream = lambda: st.hourly_rollup_stream(st.prediction_log_stream(st.read_stream(spark, src + "/*", "events")))
    st.run_to_completion(stream(), sink, ck)
    second.coalesce(1).write.parquet(os.path.join(src, "part2"))
    st.run_to_completion(stream(), sink, ck)

    got = spark.read.parquet(sink).groupBy("window_start").agg(F.sum("predictions_count").alias("n"))
    got = {r.window_start: r.n for r in got.collect()}
    batch = (ev.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("w"))
             .agg(F.count(F.lit(1)).alias("n")))
    batch = {r.w: r.n for r in batch.collect()}
    # the late copies of Jan 1-2 were dropped: those windows keep their on-time counts
    early = [w for w in got if w < dt.datetime(2024, 1, 3)]
    assert early and all(got[w] == batch[w] for w in early)
    # every emitted window equals the batch count of the original rows
    assert all(got[w] == batch[w] for w in got)


def test_running_rfm_across_two_batches(spark):
    from tessera.sources.tables import transactions_from_orders
    base = tempfile.mkdtemp(prefix="rfm-", dir="/tmp")
    src, sink, ck = (os.path.join(base, x) for x in ("src", "sink", "ck"))
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    cut = dt.datetime(1998, 1, 1)
    orders.where(F.col("o_orderdate") < F.lit(cut)).coalesce(1).write.parquet(os.path.join(src, "p1"))
    run = lambda: st.run_to_completion(
        st.rfm_stream(transactions_from_orders(st.read_stream(spark, src + "/*", "orders"))),
        sink, ck, mode="update", foreach_batch=st.changes_sink(sink))
    run()
    orders.where(F.col("o_orderdate") >= F.lit(cut)).coalesce(1).write.parquet(os.path.join(src, "p2"))
    run()
    snap = {r["customer_id"]: (r["frequency"], round(r["monetary_total"], 2))
            for r in st.latest_snapshot(spark, sink).collect()}
    batch = {r["o_custkey"]: (r["n"], round(r["s"], 2)) for r in
             orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s")).collect()}
    assert snap == batch
    assert spark.read.parquet(sink).select("batch_id").distinct().count() == 2
