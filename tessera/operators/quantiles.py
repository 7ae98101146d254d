"""Exact and approximate quantiles, quantile scores (qcut), threshold flags.

``exact_quantiles`` reproduces linear interpolation between order statistics
(the ``quantile_cont`` / numpy "linear" definition) without a shuffle of the
rows and without the per-group value->count map that Spark's ``percentile``
aggregate keeps in one buffer:

1. one scan sketches, for every probability, a bracket that holds the order
   statistics asked for (``percentile_approx`` a little below and above) and
   counts the values;
2. one scan counts what lies below and inside each bracket: numbers only,
   combined before they leave a task. A bracket that proves too narrow is
   opened to all values, so the result never rests on the sketch;
3. only the values inside the brackets (some ten-thousandths of the rows) are
   counted per distinct value and ranked, cut into value ranges (see
   ``tessera.operators.ordered``);
4. the (at most two per probability) rows that hold the needed ranks reach the
   final one-row aggregate, which interpolates.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordered import APPROX_ACCURACY, ROWS_PER_RANGE, plan_ranges, range_column
from tessera.session import materialize


def _edge_names(prefix: str, k: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(k)]


def _sketched(df: DataFrame, items: list[tuple[str, float]]) -> list[dict]:
    """Per (column, probability): bracket ``lo`` / ``hi`` (None: open) that should hold the quantile."""
    cols = list(dict.fromkeys(c for c, _ in items))
    value = {c: F.col(c).cast("double") for c in cols}
    delta = 2.0 / APPROX_ACCURACY
    grid = {c: sorted({min(max(p + d, 0.0), 1.0) for cc, p in items if cc == c for d in (-delta, delta)}) for c in cols}
    row = df.agg(*[F.percentile_approx(value[c], grid[c], APPROX_ACCURACY).alias(f"a{j}") for j, c in enumerate(cols)]).first()
    out = []
    for c, p in items:
        j = cols.index(c)
        at = dict(zip(grid[c], row[f"a{j}"] or []))
        out.append({"col": c, "p": p,
                    "lo": at.get(p - delta) if p > delta else None, "hi": at.get(p + delta) if p < 1 - delta else None})
    return out


def _brackets(df: DataFrame, found: list[dict]) -> list[dict]:
    """The brackets with the value count ``n`` and how many values lie ``below``; one that proves too narrow is opened."""
    value = {b["col"]: F.col(b["col"]).cast("double") for b in found}
    out = [{k: b[k] for k in ("col", "p", "lo", "hi")} for b in found]
    sides = df.agg(*[F.count(v).alias(f"n_{c}") for c, v in value.items()], *[x.alias(f"{name}{k}") for k, b in enumerate(out) for name, x in (
        ("below", F.count_if(value[b["col"]] < b["lo"]) if b["lo"] is not None else F.lit(0)),
        ("above", F.count_if(value[b["col"]] > b["hi"]) if b["hi"] is not None else F.lit(0)))]).first()
    for k, b in enumerate(out):
        b["n"] = sides[f"n_{b['col']}"]
        pos = b["p"] * max(b["n"] - 1, 0)
        b["pos"], b["below"] = pos, sides[f"below{k}"]
        if not b["below"] <= math.floor(pos) or not math.ceil(pos) < b["n"] - sides[f"above{k}"]:
            b.update(lo=None, hi=None, below=0)
    return out


def _inside(value: F.Column, b: dict) -> F.Column:
    cond = value.isNotNull()
    if b["lo"] is not None:
        cond = cond & (value >= b["lo"])
    if b["hi"] is not None:
        cond = cond & (value <= b["hi"])
    return cond


def exact_quantiles_multi(df: DataFrame, spec: dict[str, tuple[Sequence[float], str]],
                          rows_per_range: int = ROWS_PER_RANGE, around: list[dict] | None = None) -> DataFrame:
    """One-row frame of exact linear quantiles for several columns at once.

    ``spec`` maps a column to ``(probs, prefix)``; the output has columns
    ``{prefix}0..`` per column. NULLs are ignored; an all-NULL column gives NULLs.
    ``around``: brackets (col, p, lo, hi; in the order of ``spec``) from a sketch
    that is kept already, instead of a scan; they decide time, not the result.
    """
    items = [(c, float(p)) for c, (probs, _) in spec.items() for p in probs]
    names = [n for _, (probs, prefix) in spec.items() for n in _edge_names(prefix, len(probs))]
    brackets = _brackets(df, _sketched(df, items) if around is None else around)
    near = F.filter(F.array(*[
        F.when(_inside(F.col(b["col"]).cast("double"), b), F.struct(F.lit(k).alias("_k"), F.col(b["col"]).cast("double").alias("v")))
        for k, b in enumerate(brackets)]), lambda x: x.isNotNull())
    counts = materialize(df.select(F.explode(near).alias("e")).select("e.*")
                         .groupBy("_k", "v").agg(F.count(F.lit(1)).alias("cnt")))
    cuts = plan_ranges(counts, ["v"], rows_per_range, by="_k", groups=len(items))
    ranged = counts.withColumn("_range", F.lit(0))
    for k in range(len(items)):
        if cuts[k]:
            ranged = range_column("v", cuts[k], f"_r{k}")(ranged).withColumn(
                "_range", F.when(F.col("_k") == k, F.col(f"_r{k}")).otherwise(F.col("_range"))).drop(f"_r{k}")
    totals = ranged.groupBy("_k", "_range").agg(F.sum("cnt").alias("_tot"))
    # one row per range and bracket
    offsets = totals.select("_k", "_range", F.coalesce(F.sum("_tot").over(
        Window.partitionBy("_k").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_k", "_range").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (ranged.join(offsets, ["_k", "_range"])
              .withColumn("before", F.col("_off") + F.coalesce(F.sum("cnt").over(within), F.lit(0))))

    hits, aggs, outs = F.lit(False), [], []
    for k, (b, name) in enumerate(zip(brackets, names)):
        mine = F.col("_k") == F.lit(k)
        holds = lambda r: mine & (F.col("before") <= r) & (F.lit(r) < F.col("before") + F.col("cnt"))  # noqa: B023, E731
        lo_hit, hi_hit = holds(math.floor(b["pos"]) - b["below"]), holds(math.ceil(b["pos"]) - b["below"])
        hits = hits | lo_hit | hi_hit
        aggs += [F.max(F.when(lo_hit, F.col("v"))).alias(f"_lo{k}"), F.max(F.when(hi_hit, F.col("v"))).alias(f"_hi{k}")]
        lo, hi = F.col(f"_lo{k}"), F.col(f"_hi{k}")
        share = b["pos"] - math.floor(b["pos"])
        outs.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * F.lit(share)).alias(name))
    return ranked.where(hits).agg(*aggs).select(*outs)


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], prefix: str = "q") -> DataFrame:
    return exact_quantiles_multi(df, {col: (list(probs), prefix)})


def approx_quantiles_multi(df: DataFrame, spec: dict[str, tuple[Sequence[float], str]],
                           accuracy: int = APPROX_ACCURACY) -> DataFrame:
    """One-row frame of ``percentile_approx`` quantiles (bounded sketch per task)."""
    one = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(p), accuracy).alias(f"_a{j}")
                   for j, (c, (p, _)) in enumerate(spec.items())])
    outs = []
    for j, (c, (p, prefix)) in enumerate(spec.items()):
        outs += [F.col(f"_a{j}")[i].alias(n) for i, n in enumerate(_edge_names(prefix, len(p)))]
    return one.select(*outs)


def quantiles_multi(df: DataFrame, spec: dict[str, tuple[Sequence[float], str]],
                    method: str = "exact") -> DataFrame:
    if method == "exact":
        return exact_quantiles_multi(df, spec)
    if method == "approx":
        return approx_quantiles_multi(df, spec)
    raise ValueError(f"unknown quantile method {method!r}")


def quantiles(df: DataFrame, col: str, probs: Sequence[float], method: str = "exact",
              prefix: str = "q") -> DataFrame:
    return quantiles_multi(df, {col: (list(probs), prefix)}, method)


def quantile_scores(df: DataFrame, spec: dict[str, tuple[str, bool]], n: int = 5,
                    on_tie: str = "collapse", method: str = "exact") -> DataFrame:
    """Equal-frequency scores 1..n (pandas ``qcut`` with right-closed bins).

    ``spec`` maps a column to ``(out_col, descending)``. score = 1 + #{edges e :
    col > e}; descending gives ``n - #{...}``. ``on_tie='error'`` raises when two
    edges coincide (as qcut with fixed labels does); ``'collapse'`` keeps the
    formula, which then skips a score. Not ``ntile``: equal values always get
    equal scores and no single-partition window is needed.
    """
    probs = [i / n for i in range(1, n)]
    qspec = {c: (probs, f"_{out}_e") for c, (out, _) in spec.items()}
    edges = quantiles_multi(df, qspec, method)
    if on_tie == "error":
        row = edges.first()
        for c, (_, prefix) in qspec.items():
            vals = [row[e] for e in _edge_names(prefix, len(probs))]
            if len(set(vals)) < len(vals):
                raise ValueError(f"quantile edges of {c} collapse: {vals}")
    elif on_tie != "collapse":
        raise ValueError(on_tie)
    out = df.crossJoin(F.broadcast(edges))
    drop = []
    for c, (out_col, desc) in spec.items():
        names = _edge_names(qspec[c][1], len(probs))
        drop += names
        above = sum((F.col(c) > F.col(e)).cast("int") for e in names)
        score = (F.lit(n) - above) if desc else (F.lit(1) + above)
        out = out.withColumn(out_col, F.when(F.col(c).isNull(), F.lit(None)).otherwise(score).cast("double"))
    return out.drop(*drop)


def quantile_score(df: DataFrame, col: str, out_col: str, n: int = 5, descending: bool = False,
                   on_tie: str = "collapse", method: str = "exact") -> DataFrame:
    return quantile_scores(df, {col: (out_col, descending)}, n, on_tie, method)
