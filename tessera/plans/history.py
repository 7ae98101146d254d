"""Tables that grow run by run and are found by name.

* :class:`RunHistory` appends the rows of a run under its run id.  A run that is
  retried replaces its own rows; rows count once their writer has finished, so a
  reader never sees part of a run.
* :func:`save_table` / :func:`lookup` keep a report under a name in Spark's catalog:
  any session of the catalog finds it, an unknown name raises.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import folders, scratch_path

BUCKETS = 4


class RunHistory:
    """Rows of all finished runs below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def runs(self) -> list[str]:
        """Ids of the finished runs, in order."""
        return [name.split("=", 1)[1] for name in folders(self.spark, self.path)]

    def append(self, rows: DataFrame, run_id: str) -> None:
        """Add a run's rows, or replace them if the run is retried.  Run ids may hold letters, digits, ``-``, ``_`` and ``.``."""
        if not run_id or not all(c.isalnum() or c in "-_." for c in run_id):
            raise ValueError(f"run id {run_id!r}")
        rows.write.mode("overwrite").parquet(f"{self.path}/run_id={run_id}")

    def read(self, before: str | None = None) -> DataFrame | None:
        """All finished runs with their ``run_id`` (those before one, if given); columns that a run lacks are NULL. None without runs."""
        ids = [r for r in self.runs() if before is None or r < before]
        if not ids:
            return None
        out = None
        for r in ids:
            rows = self.spark.read.parquet(f"{self.path}/run_id={r}").withColumn("run_id", F.lit(r))
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        return out


def save_table(report: DataFrame, name: str, kind: str | None = None, key: str | None = None) -> str:
    """Save a report in the catalog as ``name`` (an earlier one of that name is replaced), in folders by ``kind`` and
    buckets by ``key``; returns the name."""
    writer = report.write.mode("overwrite").format("parquet").option("path", scratch_path(report.sparkSession, "reports", name))
    if kind:
        writer = writer.partitionBy(kind)
    if key:
        writer = writer.bucketBy(BUCKETS, key).sortBy(key)
    writer.saveAsTable(name)
    return name


def lookup(spark: SparkSession, name: str, key: str, value) -> DataFrame:
    """Rows of a saved report with a key (the filter reaches the scan)."""
    return spark.table(name).where(F.col(key) == F.lit(value))
