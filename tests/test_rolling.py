"""Quantiles rolled forward by kept sketches."""
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators.quantiles import exact_quantiles_multi
from tessera.plans.rolling import ERROR, RollingQuantiles
from tessera.session import scratch_path

ITEMS = [("x", 0.1), ("x", 0.99), ("y", 0.5)]
SPEC = {"x": ([0.1, 0.99], "x"), "y": ([0.5], "y")}


def _rows(spark, n=20_000):
    rng = random.Random(8)
    rows = [(f"2024-0{1 + k % 3}", rng.gauss(0, 10), None if k % 4 else float(k % 7)) for k in range(n)]
    return spark.createDataFrame(rows, "month string, x double, y double").withColumn("k", F.monotonically_increasing_id())


def _rolled(spark, rows, parts):
    out = RollingQuantiles(spark, scratch_path(spark, "rolling-test", uuid.uuid4().hex), ["x", "y"])
    for p in parts:
        out.add(rows.where(F.pmod("k", F.lit(3)) == p), "month", f"d{p}")
    return out


def test_sketch_within_its_error_and_exact_on_demand(spark):
    rows = _rows(spark)
    rolled = _rolled(spark, rows, [1, 0, 2, 2])  # a delivery that comes again counts once
    found = rolled.quantiles(ITEMS)
    xs = sorted(r.x for r in rows.select("x").collect())
    assert [b["n"] for b in found] == [20_000, 20_000, 5_000]
    for b in found[:2]:
        rank = sum(v <= b["value"] for v in xs) / len(xs)
        assert abs(rank - b["p"]) < 2 * ERROR and b["lo"] <= b["value"] <= b["hi"]
    assert exact_quantiles_multi(rows, SPEC, around=found).first() == exact_quantiles_multi(rows, SPEC).first()


@pytest.mark.parametrize("lo,hi", [(1e6, 2e6), (-2e6, -1e6), (0.0, 0.0), (None, None)])
def test_wrong_brackets_do_not_change_the_result(spark, lo, hi):
    rows = _rows(spark, 3_000)
    wrong = [{"col": c, "p": p, "lo": lo, "hi": hi} for c, p in ITEMS]
    assert exact_quantiles_multi(rows, SPEC, around=wrong).first() == exact_quantiles_multi(rows, SPEC).first()


def test_periods_empty_deliveries_and_columns_without_values(spark):
    rows = _rows(spark, 3_000)
    rolled = _rolled(spark, rows, [0, 1, 2])
    one = rolled.quantiles([("x", 0.5)], first="2024-02", last="2024-02")
    assert one[0]["n"] == rows.where("month = '2024-02'").count()
    empty = _rolled(spark, rows.withColumn("x", F.lit(None).cast("double")).where("k < 0 OR y IS NULL"), [0])
    assert [(b["n"], b["value"]) for b in empty.quantiles(ITEMS)] == [(0, None)] * 3
