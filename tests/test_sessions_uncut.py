"""Sessions of users that need no time cut: the same rows as with cuts, without the way over bucket rows."""
from pyspark.sql import functions as F

from tessera.operators.sessions import sessions


def test_uncut_sessions_equal_cut_ones_and_skip_the_bucket_rows(spark):
    minutes = F.pmod(F.xxhash64("id"), F.lit(6000)).cast("int")
    events = spark.range(900).select(F.col("id").alias("event_id"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("user_id"),
                                     (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(mins=minutes)).alias("ts"),
                                     F.when(F.col("id") % 3 == 0, "view").otherwise("click").alias("event_type"))
    how = dict(gap_seconds=30 * 60, sums={"views": F.when(F.col("event_type") == "view", 1).otherwise(0)}, sets={"types": F.col("event_type")})
    uncut, cut = sessions(events, **how), sessions(events, rows_per_part=20, **how)
    assert uncut.dtypes == cut.dtypes
    rows = lambda df: sorted(map(str, df.withColumn("types", F.sort_array("types")).collect()))
    assert rows(uncut) == rows(cut) and len(rows(cut)) > 100
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "explode" in plan(cut) and "explode" not in plan(uncut)
