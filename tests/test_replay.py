"""A delivery is one micro-batch, however many partitions and files it comes from."""
import uuid

from pyspark.sql import functions as F

from tessera.session import files_in, scratch_path
from tessera.streaming import streams as st


def test_deliveries_of_many_files_are_batches_of_their_own(spark):
    rows = (spark.range(800).select(F.col("id").alias("event_id"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(mins=F.col("id").cast("int") * 15)).alias("ts"),
                                    F.lit(1).cast("long").alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("").alias("props"))
            .repartition(5, F.pmod(F.xxhash64("event_id"), F.lit(5))))
    base = scratch_path(spark, "streams", f"replay-{uuid.uuid4().hex[:8]}")
    files = st.replay(rows, f"{base}/src", rows_per_file=70, closing={"event_id": st.CLOSING_ID, "event_type": "heartbeat", "value": 0.0})
    assert files == 3 and files_in(spark, f"{base}/src") == 4 * files + 1
    sizes = {}
    stream = st.prediction_log_stream(st.read_stream(spark, f"{base}/src", "events", max_files_per_trigger=files))
    st.run_to_completion(stream, "", f"{base}/ck", foreach_batch=lambda b, i: sizes.update({i: b.count()}))
    assert [sizes[i] for i in sorted(sizes)] == [200] * 4 + [1]
    rollup = st.hourly_rollup_stream(st.prediction_log_stream(st.read_stream(spark, f"{base}/src", "events", max_files_per_trigger=files)))
    st.run_to_completion(rollup, f"{base}/sink", f"{base}/ck2")
    out = spark.read.parquet(f"{base}/sink")
    assert (out.count(), out.agg(F.sum("predictions_count")).first()[0]) == (200, 800)  # no row came too late


def test_a_delivery_without_rows_keeps_its_place(spark):
    base = scratch_path(spark, "streams", f"deliver-{uuid.uuid4().hex[:8]}")
    for df in (spark.range(0), spark.range(2), spark.range(100)):
        st.deliver(df, base, 4)
    assert files_in(spark, base) == 12 and spark.read.parquet(base).count() == 102
