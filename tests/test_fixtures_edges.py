"""FIXTURES.md part C edge frames not covered elsewhere."""
import datetime as dt

from pyspark.sql import functions as F

from tessera.plans import dashboard, features, roi

TX = "transaction_id long, customer_id long, product_category string, amount double, transaction_date timestamp_ntz"


def _tx(spark, rows):
    return spark.createDataFrame(rows, TX)


def test_rfm_single_transaction_std_is_zero(spark):
    d = dt.datetime(2001, 12, 1)
    tx = _tx(spark, [(1, 1, "a", 10.0, d), (2, 2, "a", 20.0, d), (3, 2, "a", 30.0, d)])
    got = {r["customer_id"]: r["monetary_std"] for r in features.rfm_aggregate(tx, "2001-12-31").collect()}
    assert got[1] == 0.0 and abs(got[2] - 7.07) < 1e-9


def test_customers_without_transactions(spark):
    d = dt.datetime(2001, 1, 1)
    cust = spark.createDataFrame([(1, 30, "M", "Rabat", d), (2, 40, "F", "Nador", d)],
                                 "customer_id long, age int, gender string, city string, registration_date timestamp_ntz")
    tx = _tx(spark, [(i, 1, "a", float(10 + i), dt.datetime(2001, 6, 1) + dt.timedelta(days=i)) for i in range(10)])
    rfm = features.rfm_features(tx, "2001-12-31")
    beh = spark.createDataFrame([], "customer_id long, engagement_score double, satisfaction_score double, "
                                    "interest_diversity double, churn_risk_score double")
    cf = features.customer_features(cust, "2001-12-31")
    joined = features.with_churn_label(features.join_features(cf, rfm, beh)).where("customer_id = 2").first()
    assert joined["customer_segment"] is None and joined["rfm_score"] is None and joined["target_churn"] == 0
    ds, stats = features.ml_dataset(cf, rfm, beh)
    row = ds.where("customer_id = 2").first()
    assert all(row[f"segment_{s}"] is False for s in ("Champions", "Lost Customers"))
    # recency filled with 0 before scaling: (0 - mean) / pop-std over {recency_1, 0}
    r1 = rfm.first()["recency_days"]
    assert abs(row["recency_days"] - (0 - r1 / 2) / (r1 / 2)) < 1e-9


def test_empty_hour_has_null_rate(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 10)
    log = spark.createDataFrame([(1, t0, "m", 1, 0.9, 10.0), (2, t0 + dt.timedelta(hours=2), "m", 0, 0.8, 20.0)],
                                "prediction_id long, ts timestamp_ntz, model_name string, prediction int, "
                                "confidence double, processing_time double")
    rows = dashboard.hourly_rollup(log).orderBy("hour_ts").collect()
    assert [r["predictions_count"] for r in rows] == [1, 0, 1]
    assert rows[1]["positive_rate"] is None and rows[1]["negative_predictions"] == 0


def test_roi_without_costs_is_null(spark):
    costs = spark.createDataFrame([], "category string, cost double")
    benefits = spark.createDataFrame([("b", 10, 5.0)], "category string, units long, unit_value double")
    r = roi.roi_summary(costs, benefits).first()
    assert r["roi_percentage"] is None and r["benefit_cost_ratio"] is None


def test_empty_transactions_do_not_fail(spark):
    out = features.rfm_features(_tx(spark, []), "2001-12-31")
    assert out.count() == 0 and "customer_segment" in out.columns
