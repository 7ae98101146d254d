"""One key holding a third of all rows: results stay exact."""
import datetime as dt

import numpy as np
import pandas as pd

from tessera.operators.clean import dedupe_first
from tessera.plans.features import rfm_aggregate


def test_rfm_with_a_hot_customer(spark):
    rng = np.random.default_rng(9)
    n = 3000
    cust = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 200, n))
    amount = np.round(rng.lognormal(4, 1, n), 2)
    days = rng.integers(1, 365, n)
    base = dt.datetime(2001, 12, 31)
    pdf = pd.DataFrame({"transaction_id": np.arange(n), "customer_id": cust, "product_category": "a",
                        "amount": amount, "transaction_date": [base - dt.timedelta(days=int(d)) for d in days]})
    df = spark.createDataFrame(pdf).selectExpr(
        "transaction_id", "customer_id", "product_category", "amount",
        "CAST(transaction_date AS timestamp_ntz) AS transaction_date").repartition(8)
    got = rfm_aggregate(df, "2001-12-31").toPandas().set_index("customer_id").sort_index()
    g = pdf.groupby("customer_id")
    exp = pd.DataFrame({"recency_days": (base - g["transaction_date"].max()).dt.days,
                        "frequency": g.size(), "monetary_total": g["amount"].sum().round(2)}).sort_index()
    assert (got["recency_days"].values == exp["recency_days"].values).all()
    assert (got["frequency"].values == exp["frequency"].values).all()
    assert np.allclose(got["monetary_total"].values, exp["monetary_total"].values, atol=0.011)
    assert got.loc[0, "frequency"] == n // 3


def test_sessions_with_a_burst_inside_an_hour(spark):
    """One user holds a third of all events within one hour: that hour is cut where it is dense, and sessions stay exact."""
    from pyspark.sql import functions as F

    from tessera.operators import sessions as s
    from tests.test_sessions_clean import _brute_sessions
    rng = np.random.default_rng(5)
    n, rows = 9000, 300
    base = dt.datetime(2024, 1, 1)
    user = np.where(np.arange(n) < n // 3, 0, 1 + np.arange(n) % 20)
    second = np.where(user == 0, 36_000 + rng.beta(0.4, 4, n) * 3600, rng.integers(0, 30 * 86_400, n))
    pdf = pd.DataFrame({"event_id": np.arange(n), "ts": [base + dt.timedelta(seconds=float(x)) for x in second], "user_id": user})
    df = spark.createDataFrame(pdf).selectExpr("event_id", "CAST(ts AS timestamp_ntz) AS ts", "user_id", "'view' AS event_type")
    inner, _ = s._within_buckets(df, "user_id", "ts", "event_id", 60, rows)
    sizes = sorted(r["count"] for r in inner.groupBy("user_id", "_b").count().collect())
    assert sum(sizes) == n and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert inner.where("user_id = 0").select("_b").distinct().count() == 10
    got = s.sessions(df, gap_seconds=60, rows_per_part=rows).toPandas()
    got = sorted((r.user_id, r.session_start.to_pydatetime(), r.session_end.to_pydatetime(), r.n_events) for r in got.itertuples())
    assert got == _brute_sessions(pdf, 60)
    plain = df.withColumn("user_id", F.when(F.col("user_id") > 0, F.col("user_id")))  # the heavy user has no id
    assert s.sessions(plain, gap_seconds=60, rows_per_part=rows).where("user_id IS NULL").agg(F.sum("n_events")).first()[0] == n // 3


def test_keep_first_with_a_hot_key(spark):
    rows = [(0, i, f"p{i}") for i in range(1000, 0, -1)] + [(k, 1, "x") for k in range(1, 2000)]
    df = spark.createDataFrame(rows, "k int, o int, p string").repartition(8)
    got = {r["k"]: (r["o"], r["p"]) for r in dedupe_first(df, ["k"], ["o"]).collect()}
    assert len(got) == 2000 and got[0] == (1, "p1")
