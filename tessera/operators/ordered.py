"""Order-dependent operators that stay distributed.

A running total over a global order is the one thing a plain window cannot do
at scale: ``Window.orderBy(x)`` without ``partitionBy`` moves every row to one
task. Here the order domain is cut into value ranges first:

1. a count sizes the number of ranges, ``ceil(rows / rows_per_range)``, so small
   inputs use a single range and big ones spread over as many tasks as they
   need; only then does one ``percentile_approx`` aggregate return the cut
   points (one number per million rows);
2. ``Bucketizer`` (binary search, JVM-side) tags each row with its range;
3. range totals (one row per range) become range offsets through a window
   over that small table, joined back (AQE decides how, by its size);
4. the running total inside a range is a window partitioned by the range.

Equal order values always land in the same range, so ties are exact. Rows
whose order value is NULL have no place in the order and are left out, however
many ranges there are; NaN comes last, as in Spark's own ordering.
Callers pre-aggregate by the order value (``groupBy(v)``), which collapses a
value that holds a third of all rows into one row before any of this.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RANGE = 1_000_000
APPROX_ACCURACY = 10000


def plan_ranges(df: DataFrame, cols: Sequence[str], rows_per_range: int = ROWS_PER_RANGE,
                by: str | None = None, groups: int = 1) -> list[list[float]]:
    """Cut points of ``ceil(rows / rows_per_range)`` equi-depth ranges.

    Without ``by``: one cut list per column of ``cols``. With ``by`` (an int
    column 0..groups-1): one cut list per group value, for the single column
    ``cols[0]``. A count comes first; only inputs that need more than one
    range pay for the ``percentile_approx`` grid (one more aggregate). An
    empty cut list means a single range.
    """
    if by is None:
        n = df.count()
        exprs = [F.col(c).cast("double") for c in cols]
    else:
        per = {r[by]: r["n"] for r in df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}
        n = max(per.values(), default=0)
        exprs = [F.when(F.col(by) == g, F.col(cols[0]).cast("double")) for g in range(groups)]
    ranges = max(1, math.ceil(n / rows_per_range))
    if ranges == 1:
        return [[] for _ in exprs]
    grid = [i / ranges for i in range(1, ranges)]
    row = df.agg(*[F.percentile_approx(e, grid, max(APPROX_ACCURACY, 10 * ranges)).alias(f"_g{j}")
                   for j, e in enumerate(exprs)]).first()
    out = []
    for j in range(len(exprs)):
        cuts: list[float] = []
        for x in row[f"_g{j}"] or []:
            if x is not None and math.isfinite(x) and (not cuts or x > cuts[-1]):
                cuts.append(float(x))
        out.append(cuts)
    return out


def range_column(col: str, cuts: Sequence[float], out_col: str):
    """Return ``df -> df`` adding ``out_col`` = index of the value range of ``col``
    (0 when there are no cuts)."""
    def apply(df: DataFrame) -> DataFrame:
        if not cuts:
            return df.withColumn(out_col, F.lit(0))
        tmp = f"{out_col}__v"
        b = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol=tmp, outputCol=out_col,
                       handleInvalid="keep")
        return (b.transform(df.withColumn(tmp, F.col(col).cast("double")))
                .drop(tmp).withColumn(out_col, F.col(out_col).cast("int")))
    return apply


def ordered_prefix_sum(df: DataFrame, order_cols: Sequence[str], value_col: str,
                       out_col: str = "cum_before", partition_cols: Sequence[str] = (),
                       rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``out_col`` = sum of ``value_col`` over all rows strictly earlier in
    the order ``order_cols`` (first column numeric; the rest break ties),
    separately per ``partition_cols`` group. Exact; no task holds more than
    one value range of one group.
    """
    first = order_cols[0]
    parts = list(partition_cols)
    df = df.where(F.col(first).isNotNull())
    cuts = plan_ranges(df, [first], rows_per_range)[0]
    tagged = range_column(first, cuts, "_range")(df)
    totals = tagged.groupBy(*parts, "_range").agg(F.sum(value_col).alias("_range_total"))
    # One row per (group, range): without groups one row per rows_per_range rows.
    w = (Window.partitionBy(*parts) if parts else Window).orderBy("_range")
    offsets = totals.select(
        *parts, "_range",
        F.coalesce(F.sum("_range_total").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_range_offset"))
    within = Window.partitionBy(*parts, "_range").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    out = (tagged.join(offsets, [*parts, "_range"])
           .withColumn(out_col, F.col("_range_offset")
                       + F.coalesce(F.sum(value_col).over(within), F.lit(0))))
    return out.drop("_range", "_range_offset")
