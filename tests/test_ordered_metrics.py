import numpy as np
import pytest

from tessera.operators.metrics import binary_metrics, roc_auc
from tessera.operators.ordered import ordered_prefix_sum


def _brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    if not pos or not neg:
        return None
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("rows_per_range", [10_000_000, 3])
def test_prefix_sum_exact_across_ranges(spark, rows_per_range):
    rng = np.random.default_rng(1)
    v = rng.integers(0, 30, 200)
    df = spark.createDataFrame([(int(i), float(x), 1) for i, x in enumerate(v)], "id long, v double, w long")
    out = ordered_prefix_sum(df, ["v", "id"], "w", "before", rows_per_range=rows_per_range).toPandas()
    for _, r in out.iterrows():
        assert r["before"] == ((v < r["v"]) | ((v == r["v"]) & (np.arange(200) < r["id"]))).sum()


def test_auc_with_ties_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 300).tolist()
    s = rng.integers(0, 20, 300).astype(float).tolist()
    df = spark.createDataFrame([("m", a, b) for a, b in zip(y, s)], "model_name string, label int, score double")
    got = roc_auc(df).first()["roc_auc"]
    assert abs(got - _brute_auc(y, s)) < 1e-12
    flipped = spark.createDataFrame([("m", a, -b) for a, b in zip(y, s)], "model_name string, label int, score double")
    assert abs(roc_auc(flipped).first()["roc_auc"] - (1 - got)) < 1e-12


def test_degenerate_metrics(spark):
    df = spark.createDataFrame([("m", 1, 0), ("m", 1, 0)], "model_name string, label int, prediction int")
    r = binary_metrics(df).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)
    one_class = spark.createDataFrame([("m", 1, 0.3), ("m", 1, 0.7)], "model_name string, label int, score double")
    assert roc_auc(one_class).first()["roc_auc"] is None


def test_auc_is_the_same_for_any_number_of_ranges(spark, monkeypatch):
    """Rows without a score take no part, NaN ranks last, whether there is one range or many."""
    import random

    from tessera.operators import metrics
    r = random.Random(5)
    rows = [("m", r.choice([0, 1]), r.choice([None, float("nan"), round(r.random(), 2), round(r.random(), 2)])) for _ in range(400)]
    scored = spark.createDataFrame(rows, "model_name string, label int, score double")
    one = metrics.roc_auc(scored).first()["roc_auc"]
    cut = metrics.ordered_prefix_sum
    monkeypatch.setattr(metrics, "ordered_prefix_sum", lambda *a, **k: cut(*a, **k, rows_per_range=20))
    assert metrics.roc_auc(scored).first()["roc_auc"] == one
    key = lambda s: (s != s, s if s == s else 0)
    kept = [(y, key(s)) for _, y, s in rows if s is not None]
    pairs = [(p > n) + 0.5 * (p == n) for y, p in kept if y for z, n in kept if not z]
    assert abs(one - sum(pairs) / len(pairs)) < 1e-12
