"""Quantiles rolled forward: a sketch per period is kept, merged without reading old rows, and made exact on demand."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.history import RunHistory

K = 2048
#: Rank error taken on each side of a quantile; a bracket that proves too narrow is opened, so it decides time only.
ERROR = 0.005


class RollingQuantiles:
    """Sketches of some numeric columns per delivery and period, in a folder of their own.

    ``add`` reads the rows of one delivery; the same delivery added again (a
    retry) replaces itself, and late rows of an old period come as a sketch of
    their own.  A sketch holds some thousand values whatever its rows.
    """

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str]):
        self.history, self.columns = RunHistory(spark, path), list(columns)

    def add(self, rows: DataFrame, period: str, delivery: str) -> None:
        sketches = [x for c in self.columns for x in (F.kll_sketch_agg_double(F.col(c).cast("double"), K).alias(f"{c}_sketch"), F.count(c).alias(f"{c}_n"))]
        self.history.append(rows.groupBy(F.col(period).alias("period")).agg(*sketches), delivery)

    def quantiles(self, items: Sequence[tuple[str, float]], first=None, last=None) -> list[dict]:
        """Per (column, probability): value count ``n``, the sketch's quantile ``value``, and values ``lo`` / ``hi`` (None: open)
        a rank error below and above it, over the periods from ``first`` to ``last``."""
        kept = self.history.read()
        for bound, keep in ((first, lambda b: F.col("period") >= F.lit(b)), (last, lambda b: F.col("period") <= F.lit(b))):
            kept = kept if bound is None else kept.where(keep(bound))
        one = kept.agg(*[F.kll_merge_agg_double(F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_sketch"))).alias(c) for c in self.columns],
                       *[F.coalesce(F.sum(f"{c}_n"), F.lit(0)).alias(f"{c}_n") for c in self.columns])
        at = lambda c, p: F.when(F.col(f"{c}_n") > 0, F.kll_sketch_get_quantile_double(c, F.lit(min(max(p, 0.0), 1.0))))
        row = one.select(*[x.alias(f"{name}{k}") for k, (c, p) in enumerate(items) for name, x in (
            ("n", F.col(f"{c}_n")), ("v", at(c, p)), ("lo", at(c, p - ERROR)), ("hi", at(c, p + ERROR)))]).first()
        return [{"col": c, "p": p, "n": row[f"n{k}"], "value": row[f"v{k}"], "lo": row[f"lo{k}"] if p > ERROR else None,
                 "hi": row[f"hi{k}"] if p < 1 - ERROR else None} for k, (c, p) in enumerate(items)]
