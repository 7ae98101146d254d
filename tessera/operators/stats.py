"""Fitted column transforms (scaling, label codes, one-hot) and histograms.

Each ``fit`` is one aggregate whose result is a small frame (one row, or one
row per category); ``apply`` joins it back with a broadcast of that bounded
frame, so no step gathers data rows anywhere.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize


# --- standard scaling (population std; zero std -> divisor 1) ----------------
def fit_standard_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row frame ``{c}__mean, {c}__std`` per column (``stddev_pop``)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std")]
    return df.agg(*aggs)


def apply_standard_scaler(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    out = df.crossJoin(F.broadcast(stats))
    for c in cols:
        std = F.col(f"{c}__std")
        div = F.when(std.isNull() | (std == 0), F.lit(1.0)).otherwise(std)
        out = out.withColumn(c, (F.col(c).cast("double") - F.col(f"{c}__mean")) / div)
    return out.drop(*[f"{c}__{s}" for c in cols for s in ("mean", "std")])


def standard_scale(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    stats = fit_standard_scaler(df, cols)
    return apply_standard_scaler(df, stats, cols), stats


# --- label encoding: code = rank of the value among sorted distinct values ---
def fit_label_encoder(df: DataFrame, col: str) -> DataFrame:
    """(value, code): alphabetical codes from 0 of the distinct non-NULL values.

    The values are dealt out by range, numbered inside their range, and each
    range starts where the one before ends; the vocabulary stays a table.
    """
    values = df.where(F.col(col).isNotNull()).select(F.col(col).alias("value")).distinct()
    ranged = materialize(values.repartitionByRange("value").withColumn("_part", F.spark_partition_id()))
    # one row per range
    starts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("value")) - 1
    return ranged.withColumn("_in", inside).join(starts, "_part").select(
        "value", (F.col("_start") + F.col("_in")).cast("int").alias("code"))


def label_encode(df: DataFrame, col: str, out_col: str | None = None,
                 codes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Add the code of ``col``. NULL gets the code after the last (as if it sorted last); a value
    that the given ``codes`` don't hold gets NULL."""
    codes = materialize(fit_label_encoder(df, col)) if codes is None else codes
    null_code = codes.agg(F.count(F.lit(1)).cast("int").alias("_null_code"))
    table = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    out = (df.join(table, F.col(col) == F.col("_value"), "left").crossJoin(F.broadcast(null_code))
           .withColumn(out_col or f"{col}_encoded", F.when(F.col(col).isNull(), F.col("_null_code")).otherwise(F.col("_code"))))
    return out.drop("_value", "_code", "_null_code"), codes


def label_encode_many(df: DataFrame, cols: dict[str, str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Several label encodings; ``cols`` maps an input column to its output column."""
    codes = {}
    for c, out_col in cols.items():
        df, codes[c] = label_encode(df, c, out_col)
    return df, codes


# --- one-hot over a fixed level list ----------------------------------------
def one_hot(df: DataFrame, col: str, prefix: str, levels: Sequence[str], drop: bool = True) -> DataFrame:
    """``{prefix}_{level}`` booleans; NULL -> all false; the level list fixes the schema."""
    out = df
    for lvl in levels:
        out = out.withColumn(f"{prefix}_{lvl}", F.coalesce(F.col(col) == F.lit(lvl), F.lit(False)))
    return out.drop(col) if drop else out


# --- equal-width histogram, last bin closed -----------------------------------
def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """(bin, bin_lo, bin_hi, count) over non-empty bins of ``bins`` equal-width bins."""
    x = F.col(col).cast("double")
    rng = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    idx = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / w), F.lit(bins - 1))).cast("int")
    tagged = df.where(x.isNotNull()).crossJoin(F.broadcast(rng)).withColumn("bin", idx)
    return (tagged.groupBy("bin").agg(F.count(F.lit(1)).alias("count"),
                                      F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
            .select("bin",
                    (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))).alias("bin_lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))).alias("bin_hi"),
                    "count"))


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Counts per non-NULL value."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
