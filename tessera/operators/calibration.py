"""Scores to probabilities: a logistic curve per model, fitted by Newton steps on aggregated sums.

Targets are smoothed by the class counts ((n1 + 1) / (n1 + 2) and 1 / (n0 + 2)),
so the fit has a finite optimum on separable scores too.  A step is one
aggregate with six sums per model, combined before the shuffle; only those sums
reach the driver.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import written

STEPS = 50
CLOSE = 1e-10


def _by_model(values: dict[str, float]) -> Column:
    out = F.lit(None).cast("double")
    for name, v in values.items():
        out = F.when(F.col("model_name").eqNullSafe(F.lit(name)), F.lit(float(v))).otherwise(out)
    return out


def platt_fit(scored: DataFrame, score: str = "score", label: str = "label") -> dict[str, tuple[float, float]]:
    """``{model_name: (slope, intercept)}`` of P(label = 1) = 1 / (1 + exp(-(slope * score + intercept))).

    Rows without score or label take no part.  A constant score has slope 0.  A
    step that doesn't lower the loss is halved.
    """
    rows = written(scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
                   .select("model_name", F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y")), "margins")
    about = {r["model_name"]: r for r in rows.groupBy("model_name").agg(
        F.avg("s").alias("mean"), F.stddev_pop("s").alias("std"), F.sum("y").alias("n1"), F.count("y").alias("n")).collect()}
    scale = {m: r["std"] if r["std"] > 0 else 1.0 for m, r in about.items()}
    high = {m: (r["n1"] + 1) / (r["n1"] + 2) for m, r in about.items()}
    low = {m: 1 / (r["n"] - r["n1"] + 2) for m, r in about.items()}
    z = (F.col("s") - _by_model({m: r["mean"] for m, r in about.items()})) / _by_model(scale)
    rows = rows.select("model_name", z.alias("z"), F.when(F.col("y") == 1, _by_model(high)).otherwise(_by_model(low)).alias("t"))

    at, step = {m: (0.0, 0.0) for m in about}, dict.fromkeys(about, (0.0, 0.0))
    loss, active = dict.fromkeys(about, math.inf), set(about)
    for _ in range(STEPS):
        if not active:
            break
        x = _by_model({m: at[m][0] for m in active}) * F.col("z") + _by_model({m: at[m][1] for m in active})
        p = 1 / (1 + F.exp(-x))
        w = p * (1 - p)
        each = F.log1p(F.exp(-F.abs(x))) + F.greatest(x, F.lit(0.0)) - F.col("t") * x
        sums = rows.where(F.col("model_name").isin(list(active))).groupBy("model_name").agg(
            F.sum(each).alias("loss"), F.sum((p - F.col("t")) * F.col("z")).alias("ga"), F.sum(p - F.col("t")).alias("gb"),
            F.sum(w * F.col("z") * F.col("z")).alias("haa"), F.sum(w * F.col("z")).alias("hab"), F.sum(w).alias("hbb")).collect()
        for r in sums:
            m = r["model_name"]
            if r["loss"] > loss[m] + 1e-9 * abs(loss[m]):
                step[m] = (step[m][0] / 2, step[m][1] / 2)
                at[m] = (at[m][0] - step[m][0], at[m][1] - step[m][1])
            else:
                loss[m] = r["loss"]
                det = r["haa"] * r["hbb"] - r["hab"] ** 2
                flat = det <= 1e-12 * r["hbb"] ** 2
                da = 0.0 if flat else -(r["hbb"] * r["ga"] - r["hab"] * r["gb"]) / det
                db = -r["gb"] / r["hbb"] if flat else -(r["haa"] * r["gb"] - r["hab"] * r["ga"]) / det
                step[m] = (da, db)
                at[m] = (at[m][0] + da, at[m][1] + db)
            if max(map(abs, step[m])) < CLOSE:
                active.discard(m)
    return {m: (a / scale[m], b - a / scale[m] * about[m]["mean"]) for m, (a, b) in at.items()}


def calibrated(scored: DataFrame, fit: dict[str, tuple[float, float]], score: str = "score", out: str = "probability") -> DataFrame:
    """``scored`` with the calibrated probability; a model without a fit, or a row without score, has NULL."""
    x = _by_model({m: a for m, (a, _) in fit.items()}) * F.col(score) + _by_model({m: b for m, (_, b) in fit.items()})
    return scored.withColumn(out, 1 / (1 + F.exp(-x)))


def reliability(scored: DataFrame, probability: str = "probability", label: str = "label", bins: int = 10,
                by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Per model and bin of the probability: rows, mean probability, share of label 1, Brier score. Bins without rows are left out."""
    p, y = F.col(probability), F.col(label).cast("double")
    return (scored.where(p.isNotNull() & y.isNotNull()).withColumn("bin", F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int"))
            .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_probability"),
                                     F.avg(y).alias("observed_rate"), F.avg((p - y) * (p - y)).alias("brier")))
