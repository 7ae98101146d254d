"""A keyed table kept by micro-batches: a log of changes that is compacted into a bucketed snapshot.

A streaming query hands every micro-batch to :meth:`ChangeLog.append`, reduced to
one row per key.  The rows land in the batch's own folder, dealt to buckets of
the key; after ``every`` batches the snapshot and the changes since are merged
into a new snapshot, one file a bucket, and the folders that it replaces are
removed.  So the query needs no operator state, the log holds at most ``every``
change folders, and the snapshot one row per key.

Exactly once: a batch that is delivered again overwrites its own folder, or is
skipped if a snapshot already holds it; only folders whose writer finished are
read, a snapshot is used in place of what it merged as soon as it is complete,
and what it replaces is removed after that (a removal that was cut off is
finished by the next compaction, and never read meanwhile).
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import folders, remove

BUCKETS = 16
EVERY = 8


class ChangeLog:
    """``merge`` turns rows (several of a key) into one row per key and keeps the columns; it must not depend on the order
    or the grouping of merges."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], merge: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS, every: int = EVERY):
        self.spark, self.path, self.keys, self.merge, self.buckets, self.every = spark, path, list(keys), merge, buckets, every
        self.schema = f"{schema}, bucket int"

    def bucket(self) -> Column:
        """Bucket of a row's key."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _numbers(self, kind: str) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in folders(self.spark, f"{self.path}/{kind}"))

    def compacted(self) -> int:
        """The last batch that the snapshot holds (-1: none)."""
        return max(self._numbers("snapshots"), default=-1)

    def change_batches(self) -> list[int]:
        """Batches whose changes aren't in the snapshot yet."""
        upto = self.compacted()
        return [k for k in self._numbers("changes") if k > upto]

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Keep a micro-batch's rows (one per key); compact when enough batches wait."""
        if batch_id <= self.compacted():
            return
        rows = batch.withColumn("bucket", self.bucket())
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/changes/batch={batch_id}")
        if len(self.change_batches()) >= self.every:
            self.compact(batch_id)

    def compact(self, batch_id: int) -> None:
        """Merge everything up to ``batch_id`` into one snapshot and remove what it replaces."""
        rows = self.read(batch_id, merged=False)
        if rows is not None:
            merged = self.merge(rows.drop("bucket")).withColumn("bucket", self.bucket())
            merged.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", *self.keys).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/snapshots/upto={batch_id}")
        upto = self.compacted()
        for kind, stays in (("snapshots", lambda k: k >= upto), ("changes", lambda k: k > upto)):
            for k in self._numbers(kind):
                if not stays(k):
                    remove(self.spark, f"{self.path}/{kind}/{'upto' if kind == 'snapshots' else 'batch'}={k}")

    def read(self, before: int | None = None, merged: bool = True, only: Column | None = None) -> DataFrame | None:
        """The table (None if nothing was written): of batches up to ``before``, of the rows that meet ``only`` (a condition on bucket prunes folders)."""
        upto = self.compacted()
        if before is not None and upto > before:
            raise ValueError(f"batch {before} is older than the snapshot of {upto}")
        paths = [f"{self.path}/snapshots/upto={upto}"] if upto >= 0 else []
        paths += [f"{self.path}/changes/batch={k}" for k in self.change_batches() if before is None or k <= before]
        if not paths:
            return None
        rows = [self.spark.read.schema(self.schema).parquet(p) for p in paths]  # a batch without rows has a folder without files
        out = reduce(DataFrame.unionByName, rows[1:], rows[0])
        out = out if only is None else out.where(only)
        return self.merge(out.drop("bucket")) if merged else out
