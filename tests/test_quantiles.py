import numpy as np
import pandas as pd
import pytest

from tessera.operators.quantiles import exact_quantiles_multi, quantile_scores


def _frame(spark, x):
    return spark.createDataFrame([(None if v is None else float(v),) for v in x], "v double")


@pytest.mark.parametrize("rows_per_range", [10_000_000, 37])
def test_exact_quantiles_match_numpy(spark, rows_per_range):
    rng = np.random.default_rng(7)
    x = list(np.round(rng.lognormal(3, 1, 500), 2)) + [5.0] * 200 + [None] * 5  # hot value + NULLs
    probs = [0.0, 0.2, 0.4, 0.5, 0.6, 0.8, 0.95, 0.99, 1.0]
    q = exact_quantiles_multi(_frame(spark, x), {"v": (probs, "q")}, rows_per_range=rows_per_range).first()
    exp = np.percentile(np.array([v for v in x if v is not None]), [p * 100 for p in probs])
    assert np.allclose([q[f"q{i}"] for i in range(len(probs))], exp, rtol=0, atol=1e-9)


def test_quantiles_all_null(spark):
    q = exact_quantiles_multi(_frame(spark, [None, None]), {"v": ([0.5], "q")}).first()
    assert q["q0"] is None


def test_quantile_scores_equal_pandas_qcut(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(1, 40, 300).astype(float)
    df = _frame(spark, x)
    got = quantile_scores(df, {"v": ("s", False)}).toPandas().sort_values("v")
    pd_scores = pd.qcut(pd.Series(x), 5, labels=False, duplicates="drop") + 1
    exp = pd.DataFrame({"v": x, "s": pd_scores.astype(float)}).sort_values("v")
    assert list(got["s"]) == list(exp["s"])


def test_descending_scores(spark):
    x = [float(i) for i in range(1, 101)]
    got = quantile_scores(_frame(spark, x), {"v": ("s", True)}).toPandas().sort_values("v")
    assert list(got["s"])[:20] == [5.0] * 20 and list(got["s"])[-20:] == [1.0] * 20


def test_ties_error_or_collapse(spark):
    x = [1.0] * 6 + [2.0, 3.0, 4.0, 5.0]
    with pytest.raises(ValueError):
        quantile_scores(_frame(spark, x), {"v": ("s", False)}, on_tie="error")
    got = quantile_scores(_frame(spark, x), {"v": ("s", False)}).toPandas().sort_values("v")
    assert got["s"].iloc[0] == 1.0 and got["s"].iloc[-1] == 5.0
