"""Tables that grow run by run, reports found by name, rolled-up hours, report extras."""
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tessera.plans import dashboard, monitor
from tessera.plans.alerts import rules_frame
from tessera.plans.history import RunHistory, lookup, save_table
from tessera.sources.tables import prediction_log_from_events
from tessera.streaming import running
from tests.conftest import SF_SMALL


def test_runs_are_appended_once(spark, tmp_path):
    """A retried run replaces its rows, also when it has none; an unfinished writer isn't read; new columns are filled."""
    import os
    log = RunHistory(spark, str(tmp_path / "h"))
    assert log.read() is None and log.runs() == []
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, s string")
    log.append(a, "r1")
    log.append(a, "r1")
    log.append(spark.createDataFrame([(3, 0.5)], "id int, v double"), "r2")
    rows = sorted((r["run_id"], r["id"], r["s"], r["v"]) for r in log.read().collect())
    assert rows == [("r1", 1, "x", None), ("r1", 2, "y", None), ("r2", 3, None, 0.5)]
    log.append(a.limit(0), "r1")
    assert log.read().count() == 1 and log.read(before="r2").count() == 0
    a.write.parquet(str(tmp_path / "h" / "run_id=r3"))
    os.remove(tmp_path / "h" / "run_id=r3" / "_SUCCESS")
    assert log.runs() == ["r1", "r2"]
    with pytest.raises(ValueError):
        log.append(a, "../r4")


def test_saved_report_is_found_by_name_in_another_session(spark):
    report = spark.createDataFrame([(k, f"A{k}", "high" if k % 2 else "low") for k in range(50)], "n int, alert_id string, kind string")
    save_table(report.limit(3), "tessera_test_report", "kind", "alert_id")
    save_table(report, "tessera_test_report", "kind", "alert_id")
    other = spark.newSession()
    found = lookup(other, "tessera_test_report", "alert_id", "A7")
    assert [tuple(r) for r in found.select("n", "kind").collect()] == [(7, "high")]
    plan = found._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(alert_id), EqualTo(alert_id,A7)]" in plan
    with pytest.raises(AnalysisException):
        lookup(other, "tessera_no_such_report", "alert_id", "A7").collect()


def test_hourly_view_equals_the_batch_rollup(spark, tmp_path):
    """Deliveries out of order, one of them twice."""
    log = prediction_log_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    view = running.HourlyView(spark, str(tmp_path / "v"), buckets=4, every=2)
    assert view.read() is None
    for b, part in enumerate((3, 1, 0, 2)):
        for _ in range(2 if part == 1 else 1):
            view.append(log.where(F.col("prediction_id") % 4 == part), b)
    key = lambda df: sorted((r["hour_ts"], r["predictions_count"], r["positive_predictions"], r["negative_predictions"], r["avg_confidence"] and round(r["avg_confidence"], 9), r["processing_time"] and round(r["processing_time"], 9)) for r in df.collect())
    assert key(view.read()) == key(dashboard.hourly_rollup(log))


def test_efficiency_and_titles(spark):
    perf = spark.createDataFrame([("a", 0, 0.9, 20.0), ("b", 1, 0.8, 1.0), ("c", 2, 0.5, 0.0)], "model_name string, model_seq int, roc_auc double, training_time double")
    best = monitor.efficiency(perf).first()
    assert (best["model_name"], best["efficiency_score"]) == ("a", 0.45)
    assert monitor.efficiency(perf.where("model_name = 'c'")).first()["efficiency_score"] is None
    titles = {r["rule_no"]: r["title"] for r in rules_frame(spark).collect()}
    assert titles[5] == "Business Opportunity: Cross Sell" and titles[1] == "High Churn Risk Detected"


def test_save_falls_back_to_the_best_model(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    from tessera.plans import ml
    data = spark.createDataFrame([(float(k % 2), Vectors.dense([float(k % 2), 1.0])) for k in range(20)], ["label", "features"])
    models = {n: LogisticRegression(maxIter=2).fit(data) for n in ("one", "two")}
    perf = spark.createDataFrame([("one", 0, 0.7), ("two", 1, 0.9)], "model_name string, model_seq int, roc_auc double")
    saved = ml.save_trained(spark, models, perf, str(tmp_path))
    assert saved["model_name"] == "two" and saved["model_size"] > 100 and saved["performance"]["roc_auc"] == 0.9
    assert ml.load_model(spark, str(tmp_path / "two"))[1]["model_name"] == "two"
    assert ml.save_trained(spark, models, perf, str(tmp_path), "one")["model_name"] == "one"
    with pytest.raises(KeyError):
        ml.save_trained(spark, models, perf, str(tmp_path), "three")
    with pytest.raises(ValueError):
        ml.save_trained(spark, models, perf.limit(0), str(tmp_path))
