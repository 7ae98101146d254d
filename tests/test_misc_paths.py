import numpy as np
from pyspark.sql import functions as F

from tessera.functions.columns import DAYPART_LABELS
from tessera.operators.quantiles import quantiles
from tessera.plans.catalog import Ctx
from tessera.plans.dashboard import confidence_heatmap, confidence_heatmap_wide
from tests.conftest import SF_SMALL


def test_wide_heatmap_equals_long_form(spark):
    hourly = Ctx(spark, SF_SMALL).hourly()
    long = {(r["day_of_week"], r["hour_group"]): r["avg_confidence"] for r in confidence_heatmap(hourly).collect()}
    wide = confidence_heatmap_wide(hourly).where(F.col("day_of_week").isNotNull()).collect()
    for r in wide:
        for part in DAYPART_LABELS:
            key = (r["day_of_week"], part)
            if key in long:
                assert abs(r[part] - long[key]) < 1e-12
            else:
                assert r[part] is None


def test_approx_quantiles_close_to_exact(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, 5000)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    probs = [0.1, 0.5, 0.9]
    exact = quantiles(df, "v", probs, "exact").first()
    approx = quantiles(df, "v", probs, "approx").first()
    for i in range(len(probs)):
        assert abs(exact[f"q{i}"] - np.percentile(x, probs[i] * 100)) < 1e-9
        assert abs(approx[f"q{i}"] - exact[f"q{i}"]) < 0.05


def test_label_codes_are_alphabetical_ranks(spark):
    from tessera.operators.stats import label_encode
    rows = spark.createDataFrame([(i, None if i % 11 == 0 else f"v{(i * 7) % 40:02d}") for i in range(300)], "id int, x string")
    out, codes = label_encode(rows, "x")
    values = sorted({r.x for r in rows.collect() if r.x is not None})
    assert {r.value: r.code for r in codes.collect()} == {v: k for k, v in enumerate(values)}
    assert all(r.x_encoded == (len(values) if r.x is None else values.index(r.x)) for r in out.collect())
    other = spark.createDataFrame([(1, "unseen")], "id int, x string")
    assert label_encode(other, "x", codes=codes)[0].first().x_encoded is None


def test_sessions_of_a_burst_equal_a_plain_scan(spark):
    """100,000 events of one user in one hour, and a user whose sessions cross buckets."""
    from pyspark.sql import functions as F

    from tessera.operators.sessions import behavior_from_events, sessions
    base = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    burst = spark.range(100_000).select(F.col("id").alias("event_id"), F.lit(1).cast("long").alias("user_id"),
                                        (base + F.expr("make_dt_interval(0, 0, 0, CAST(id * 0.03 AS DECIMAL(18, 6)))")).alias("ts"),
                                        F.lit("view").alias("event_type"))
    walk = spark.range(50).select((F.col("id") + 200_000).alias("event_id"), F.lit(2).cast("long").alias("user_id"),
                                  (base + F.expr("make_dt_interval(0, CAST(id * (1 + id % 3) * 2 AS INT), 0, 0)")).alias("ts"),
                                  F.lit("click").alias("event_type"))
    events = burst.unionByName(walk)
    got = {(r.user_id, r.session_start): (r.session_end, r.n_events) for r in sessions(events).collect()}
    want = {}
    for u in (1, 2):
        times = sorted(r.ts for r in events.where(F.col("user_id") == u).select("ts").collect())
        start = last = None
        for t in times:
            if last is None or (t - last).total_seconds() > 6 * 3600:
                start = t
            last = t
            want[u, start] = (t, want.get((u, start), (None, 0))[1] + 1)
    assert got == want
    b = {r.customer_id: r for r in behavior_from_events(events).collect()}
    assert b[1].n_events == 100_000 and b[1].n_sessions == 1 and b[2].n_sessions == len([k for k in want if k[0] == 2])
