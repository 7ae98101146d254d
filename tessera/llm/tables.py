"""Intermediate tables of the operators, in the shared folder of the session."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage (a lost executor costs a re-read) and lets later steps
    read only the columns they need.
    """
    path = scratch_path(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
