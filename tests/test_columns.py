import math

import pandas as pd
from pyspark.sql import functions as F

from tessera.functions import columns as C


def _col(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_age_bands_right_closed(spark):
    vals = [0, 25, 26, 35, 36, 50, 51, 65, 66, 100, 101, None]
    got = _col(spark, vals, "int", C.age_group)
    exp = pd.cut(pd.Series(vals, dtype="float"), bins=C.AGE_EDGES, labels=C.AGE_LABELS)
    assert got == [None if pd.isna(e) else str(e) for e in exp]


def test_day_part_hour_zero_is_null(spark):
    got = _col(spark, [0, 6, 7, 12, 13, 18, 19, 23], "int", C.day_part)
    assert got == [None, "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening"]


def test_segment_ladder_edges(spark):
    got = _col(spark, [4.5, 4.49, 3.5, 2.5, 1.5, 1.49, None], "double", C.rfm_segment)
    assert got == ["Champions", "Loyal Customers", "Loyal Customers", "Potential Loyalists", "At Risk",
                   "Lost Customers", "Lost Customers"]


def test_churn_label_truth_table(spark):
    rows = []
    for a in (0.7, 0.5, None):
        for b in (100, 80, None):
            for c in (1.0, 3.0, None):
                rows.append((a, b, c))
    df = spark.createDataFrame(rows, "risk double, rec int, rfm double")
    got = [r[0] for r in df.select(C.churn_label("risk", "rec", "rfm")).collect()]
    for (a, b, c), g in zip(rows, got):
        w = 0.4 * (a is not None and a > 0.6) + 0.3 * (b is not None and b > 90) + 0.3 * (c is not None and c < 2)
        assert g == int(w > 0.5)


def test_title_case_matches_python(spark):
    vals = ["o'neil-smith x2y", "SAINT louis", "rabat", None, "élan vital"]
    got = _col(spark, vals, "string", C.title_case)
    assert got == [None if v is None else v.title() for v in vals]


def test_round_half_up_like_sql_formula(spark):
    vals = [5.005, 2.675, 1.0049999, -1.5, 0.125]
    got = _col(spark, vals, "double", lambda c: C.round_half_up(c, 2))
    assert got == [math.floor(v * 1e2 + 0.5) / 1e2 for v in vals]


def test_satisfaction_keeps_null(spark):
    df = spark.createDataFrame([(None, 1), (1.0, 4), (3.0, 2)], "e double, t int")
    got = [r[0] for r in df.select(C.satisfaction_score(F.col("e"), "t")).collect()]
    assert got == [None, 0.0, 2.0]


def test_roi_grade_strict(spark):
    got = _col(spark, [250.0, 200.0, 100.0, 50.0, -5.0], "double", C.roi_grade)
    assert got == ["excellent", "good", "acceptable", "poor", "poor"]


def test_formats(spark):
    df = spark.createDataFrame([(1234.5, 0.7123, "model_retraining", 7)], "m double, r double, s string, n int")
    r = df.select(C.fmt_currency(F.col("m")).alias("a"), C.fmt_percent(F.col("r")).alias("b"),
                  C.title_from_snake("s").alias("c"), C.alert_id(F.col("n")).alias("d")).first()
    assert (r["a"], r["b"], r["c"], r["d"]) == ("€1,234.50", "71.2%", "Model Retraining", "ALERT_007")


def test_round_half_up_passes_what_has_no_such_decimals(spark):
    import math
    vals = [1e13, 1e17, -1e17, float("inf"), float("-inf"), None, -2.5, 1234567.891]
    got = _col(spark, vals, "double", lambda c: C.round_half_up(c, 6))
    assert got == [1e13, 1e17, -1e17, float("inf"), float("-inf"), None, -2.5, 1234567.891]
    assert math.isnan(_col(spark, [float("nan")], "double", lambda c: C.round_half_up(c, 2))[0])
