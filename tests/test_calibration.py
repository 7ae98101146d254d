"""Calibration curves against a plain descent, and their edge cases."""
import math

import numpy as np
import pytest

from tessera.operators.calibration import calibrated, platt_fit, reliability

ROWS = "model_name string, score double, label int"


def _plain(s, y):
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    z, at = np.stack([(s - s.mean()) / s.std(), np.ones_like(s)]), np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-at @ z))
        at -= 0.5 * np.linalg.solve((z * p * (1 - p)) @ z.T, z @ (p - t))
    return at[0] / s.std(), at[1] - at[0] / s.std() * s.mean()


def test_equals_plain_descent_per_model(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for name, scale in (("near", 1.0), ("far", 300.0)):
        s = rng.normal(5.0, scale, 400)
        y = (rng.random(400) < 1 / (1 + np.exp(-(s - 5) / scale * 1.7 + 0.4))).astype(int)
        rows += [(name, float(a), int(b)) for a, b in zip(s, y)]
        want[name] = _plain(s, y)
    got = platt_fit(spark.createDataFrame([*rows, ("near", None, 1), ("near", 1.0, None)], ROWS).repartition(5))
    assert got.keys() == want.keys()
    for m in want:
        assert got[m] == pytest.approx(want[m], rel=1e-6, abs=1e-9)


def test_separable_constant_one_class_and_no_rows(spark):
    rows = [("apart", float(k), int(k >= 10)) for k in range(20)] + [("constant", 2.0, int(k < 5)) for k in range(20)]
    rows += [("positive", float(k), 1) for k in range(10)]
    fit = platt_fit(spark.createDataFrame(rows, ROWS))
    assert 0 < fit["apart"][0] < 100
    slope, intercept = fit["constant"]
    t = (5 * 6 / 7 + 15 / 17) / 20
    assert slope == 0 and intercept == pytest.approx(math.log(t / (1 - t)))
    assert abs(fit["positive"][0]) < 1e-6 and fit["positive"][1] == pytest.approx(math.log(11))
    assert platt_fit(spark.createDataFrame([], ROWS)) == {}


def test_reliability_and_missing_fits(spark):
    rows = [("a", 0.0, 1), ("a", 0.0, 0), ("a", 50.0, 1), ("a", None, 1), ("b", 1.0, 1)]
    out = calibrated(spark.createDataFrame(rows, ROWS), {"a": (1.0, 0.0)})
    assert out.where("probability IS NULL").count() == 2
    got = {r.bin: (r.n, r.mean_probability, r.observed_rate, r.brier) for r in reliability(out).collect()}
    assert got[5] == (2, 0.5, 0.5, 0.25) and got[9][0] == 1 and set(got) == {5, 9}


def test_margins_are_out_of_fold_and_calibration_lowers_the_brier_score(spark):
    from pyspark.sql import functions as F

    from tessera.plans import ml
    from tests.test_ml import _data
    data = _data(spark)
    margins = ml.out_of_fold_margins(data, folds=2, key="vec_id")
    assert margins.count() == data.where("split = 'train'").count() == margins.select("vec_id").distinct().count()
    fit = platt_fit(margins)
    brier = lambda f: calibrated(margins, f).agg(F.avg((F.col("probability") - F.col("label")) ** 2)).first()[0]
    assert brier(fit) <= brier({"svm": (1.0, 0.0)})
    assert ml.margin_curve(data, folds=2, key="vec_id") == pytest.approx(fit["svm"], rel=1e-6)
    est = ml.make_estimators(rows=100)["svm"].fit(data.where("split = 'train'"))
    scored = ml.scored_frame(est, data, "label", "svm", "vec_id", curve=fit["svm"])
    row = scored.first()
    p = 1 / (1 + math.exp(-(fit["svm"][0] * row.score + fit["svm"][1])))
    assert row.confidence == pytest.approx(max(p, 1 - p))
