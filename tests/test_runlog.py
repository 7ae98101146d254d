import json
import os
import tempfile

from tessera.plans.alerts import append_history
from tessera.plans.runlog import log_families, success_rate
from tessera.sources.runlog_io import read_run_log


def test_read_json_array_run_log(spark):
    steps = [("data_collection_x", "success"), ("feature_engineering_y", "error"), ("roi_analysis", "success")]
    recs = [{"timestamp": f"2030-05-0{i + 1}T06:00:00", "step": step, "status": status, "message": f"m{i}",
             "execution_time": f"2030-05-0{i + 1}T06:00:01"} for i, (step, status) in enumerate(steps)]
    d = tempfile.mkdtemp(prefix="runlog-", dir="/tmp")
    path = os.path.join(d, "log.json")
    with open(path, "w") as f:
        json.dump(recs, f, indent=2)
    log = read_run_log(spark, path, multiline=True)
    r = success_rate(log).first()
    assert (r["total_steps"], r["successful_steps"]) == (3, 2)
    assert abs(r["success_rate"] - 200 / 3) < 1e-12
    fam = {x["family"]: (x["steps"], x["successes"]) for x in log_families(log).collect()}
    assert fam == {"data_collection": (1, 1), "feature_engineering": (1, 0), "business_intelligence": (1, 1)}


def test_empty_log_rate_is_zero(spark):
    empty = spark.createDataFrame([], "timestamp timestamp, step string, status string, message string")
    assert success_rate(empty).first()["success_rate"] == 0.0


def test_append_history_fills_missing_columns(spark):
    a = spark.createDataFrame([("ALERT_001", "high")], "alert_id string, severity string")
    b = spark.createDataFrame([("ALERT_002", 5)], "alert_id string, affected_customers int")
    out = append_history(append_history(None, a), b)
    rows = sorted(tuple(r) for r in out.select("alert_id", "severity", "affected_customers").collect())
    assert rows == [("ALERT_001", "high", None), ("ALERT_002", None, 5)]
