import datetime as dt

from tessera.plans.monitor import drift
from tessera.plans.roi import roi_projection, roi_summary


def _log(spark, n_hist, n_recent, hist_pos, recent_pos, conf=0.9):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n_hist + n_recent):
        recent = i >= n_hist
        p = recent_pos if recent else hist_pos
        k = i - n_hist if recent else i
        pred = 1 if (k % 100) < p * 100 else 0
        rows.append((i, base + dt.timedelta(minutes=i), "m", pred, conf))
    return spark.createDataFrame(rows, "prediction_id long, ts timestamp, model_name string, prediction int, "
                                       "confidence double")


def test_drift_warning_below_window(spark):
    r = drift(_log(spark, 0, 99, 0.5, 0.5)).first()
    assert r["status"] == "warning" and r["drift_detected"] is None


def test_drift_exactly_window_has_no_history(spark):
    r = drift(_log(spark, 0, 100, 0.5, 0.5)).first()
    assert r["status"] == "success" and r["historical_positive_rate"] is None
    assert r["drift_detected"] is False and r["drift_severity"] == "low"


def test_drift_medium_and_high(spark):
    r = drift(_log(spark, 200, 100, 0.30, 0.45)).first()
    assert abs(r["positive_rate_drift"] - 0.15) < 1e-9 and r["drift_severity"] == "medium"
    r = drift(_log(spark, 200, 100, 0.30, 0.55)).first()
    assert r["drift_severity"] == "high"
    r = drift(_log(spark, 200, 100, 0.30, 0.39)).first()  # below the 0.1 threshold
    assert r["drift_detected"] is False and r["drift_severity"] == "low"


def test_roi_without_benefits(spark):
    costs = spark.createDataFrame([("a", 100.0)], "category string, cost double")
    benefits = spark.createDataFrame([], "category string, units long, unit_value double")
    r = roi_summary(costs, benefits).first()
    assert r["payback_period_months"] is None and r["investment_grade"] == "poor"


def test_break_even_monotone(spark):
    costs = spark.createDataFrame([("a", 1000.0)], "category string, cost double")
    benefits = spark.createDataFrame([("b", 10, 60.0)], "category string, units long, unit_value double")
    rows = roi_projection(costs, benefits).orderBy("month").collect()
    flags = [r["break_even"] for r in rows]
    assert flags == sorted(flags) and len(rows) == 12


def test_drift_recommendations_when_detected(spark):
    from tessera.plans.monitor import DRIFT_RECOMMENDATIONS, LOW_CONFIDENCE_RECOMMENDATION, drift_recommendations
    recs = [r["recommendation"] for r in drift_recommendations(drift(_log(spark, 200, 100, 0.30, 0.55))).collect()]
    assert recs == DRIFT_RECOMMENDATIONS
    low = [r["recommendation"] for r in drift_recommendations(drift(_log(spark, 0, 100, 0.3, 0.3, conf=0.6))).collect()]
    assert low == [LOW_CONFIDENCE_RECOMMENDATION]


def test_drift_leaves_missing_confidences_out(spark):
    rows = spark.range(300).selectExpr("'m' AS model_name", "timestamp_seconds(id) AS ts", "id AS prediction_id",
                                       "1 AS prediction", "CASE WHEN id % 2 = 0 THEN 0.9D END AS confidence")
    r = drift(rows).first()
    assert abs(r["recent_avg_confidence"] - 0.9) < 1e-9 and abs(r["historical_avg_confidence"] - 0.9) < 1e-9
