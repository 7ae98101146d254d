"""Text files read with a check of every record; what fails is kept beside the clean rows, with its reason."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import written

MALFORMED = "malformed"


def read_checked(spark: SparkSession, path: str, schema: str, fmt: str = "json", rules: dict[str, Column] | None = None,
                 **options: str) -> DataFrame:
    """Records of JSON or CSV files: the columns of ``schema``, then ``record`` and ``reason``.

    ``reason`` is ``malformed`` where the reader can't make the record fit the
    schema, else the first rule (name -> condition that a good row meets) that
    isn't met, NULL counting as not met, else NULL: a clean row.  ``record`` is
    the text as it stands in the file where it is malformed, else the row
    written anew in the format.  The table is written once: later steps may read
    any of its columns, where a pruned scan of the text would parse, and so
    reject, fewer of them.
    """
    raw = (spark.read.schema(f"{schema}, _corrupt string").options(**options)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").format(fmt).load(path))
    fields = F.struct(*[c for c in raw.columns if c != "_corrupt"])
    text = F.to_json(fields, options) if fmt == "json" else F.to_csv(fields, options)
    reason = F.when(F.col("_corrupt").isNotNull(), MALFORMED)
    for name, good in (rules or {}).items():
        reason = reason.when(~F.coalesce(good, F.lit(False)), name)
    return written(raw.select("*", F.coalesce("_corrupt", text).alias("record"), reason.alias("reason")).drop("_corrupt"), "checked")


def clean_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).drop("record", "reason")


def rejects(checked: DataFrame) -> DataFrame:
    """(record, reason) of what failed."""
    return checked.where(F.col("reason").isNotNull()).select("record", "reason")
