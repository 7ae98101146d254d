"""A training corpus from ``documents``: quality rules, line dedup, near-duplicate removal, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it works on
every row its predecessor kept.  All but the last return the columns of
``documents``; the last returns the packed pieces.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import line_dedup, ngram_join, packing, quality_rules, source_mix
from tessera.llm.tables import table, written

#: No SQL: the stages hash n-grams, draw random numbers and encode text.  Tests hold the stages against brute force.
ORACLE_SQL = None


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``documents``; the text's length is that of the text that is left."""
    if "n_chars" in like.columns:
        df = df.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return df.select(*like.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated line runs; those of which nothing is left go."""
    return _columns(line_dedup.deduplicated(docs), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix draws, as often as it draws them; a source's last one may be cut to its target."""
    return _columns(source_mix.mixed_documents(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, packed into sequences."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
