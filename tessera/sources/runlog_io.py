"""Run-log sink / source and temp-view registration of the tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.tables import TABLE_NAMES, read_table

# The run-log record: ISO timestamps as strings on disk.
RUN_LOG_JSON = T.StructType([
    T.StructField("timestamp", T.StringType()), T.StructField("step", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("message", T.StringType()),
    T.StructField("execution_time", T.StringType())])


def write_run_log(log: DataFrame, path: str) -> None:
    """Write the run log as JSON lines (one file per task, no driver collection)."""
    (log.select(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "step", "status",
                F.coalesce(F.col("message"), F.lit("")).alias("message"),
                F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("execution_time"))
     .write.mode("overwrite").json(path))


def read_run_log(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Read a run log: JSON lines, or (``multiline=True``) one JSON array of records."""
    df = spark.read.schema(RUN_LOG_JSON).option("multiLine", multiline).json(path)
    return df.select(F.to_timestamp("timestamp").alias("timestamp"), "step", "status", "message",
                     F.to_timestamp("execution_time").alias("execution_time"))


def register_views(spark: SparkSession, sf_dir: str, names=TABLE_NAMES) -> list[str]:
    """Register every table as a temp view (lookup by name; unknown names raise in SQL)."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
    return list(names)
