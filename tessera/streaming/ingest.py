"""Exactly-once ingest of keyed rows with bounded state.

A repeat of a key is found in one of two places.  Recent ones meet the operator
state of ``dropDuplicatesWithinWatermark``, which forgets a key once the
watermark has passed it by the delay.  Older ones are looked up in the sink: a
log of the keys that came through (bucketed and compacted, see
``change_log``).  A micro-batch asks only the buckets that it touches, and of
those only the keys that it holds: the lookup is a semi join of the key log with
the batch, which Spark prunes by a runtime Bloom filter of the batch's keys where
the log is large, so what is shuffled follows the batch, not the history.

Rows whose event time is older than the watermark are dropped by the state
operator.  Without a delay there is no state and no row is too late: every key is
looked up.

Every batch is staged, written and logged in folders of its own number, so a
batch that is delivered again gives the same rows once.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tessera.session import remove
from tessera.streaming.change_log import BUCKETS, EVERY, ChangeLog


def key_log(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, every: int = EVERY) -> ChangeLog:
    """The keys that an ingest below ``path`` has taken."""
    schema = ", ".join(f"{k} {batch.schema[k].dataType.simpleString()}" for k in keys)
    return ChangeLog(spark, f"{path}/keys", schema, keys, lambda rows: rows.distinct(), buckets, every)


def known_keys(old: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bucket and key of the log rows that a batch asks for (equal nulls are equal keys)."""
    asked = rows.select("bucket", *keys).withColumnsRenamed({c: f"_{c}" for c in ("bucket", *keys)})
    same = F.col("bucket") == F.col("_bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return old.select("bucket", *keys).join(asked, same, "left_semi")


def unseen(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key isn't among the known ones."""
    known = known.withColumnsRenamed({c: f"_{c}" for c in ("bucket", *keys)})
    same = F.col("bucket") == F.col("_bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(known, same, "left_anti")


def ingest_sink(spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS, every: int = EVERY) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: rows of keys that no earlier batch held go to ``path/rows``, one folder a batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        log = key_log(spark, path, batch, keys, buckets, every)
        if batch_id <= log.compacted():
            return  # delivered again after its compaction: rows and keys are in place
        staged = f"{path}/staged/batch={batch_id}"
        batch.dropDuplicates(list(keys)).withColumn("bucket", log.bucket()).write.mode("overwrite").partitionBy("bucket").parquet(staged)
        rows = spark.read.schema(StructType([*batch.schema.fields, StructField("bucket", IntegerType())])).parquet(staged)
        touched = F.col("bucket").isin([r["bucket"] for r in rows.select("bucket").distinct().collect()])  # at most ``buckets``
        old = log.read(batch_id - 1, merged=False, only=touched)
        new = rows if old is None else unseen(rows, known_keys(old, rows.where(touched), keys), keys)
        taken = f"{path}/rows/batch={batch_id}"
        new.drop("bucket").write.mode("overwrite").parquet(taken)
        log.append(spark.read.schema(batch.schema).parquet(taken).select(*keys), batch_id)
        remove(spark, staged)
    return write


def ingested(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows taken so far."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/rows")
