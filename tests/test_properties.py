"""Property tests: random inputs against brute force, with tiny range / bucket
sizes so the multi-range and cross-bucket code paths run."""
import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.quantiles import exact_quantiles_multi
from tessera.operators.sessions import sessionize, sessions

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=60),
       st.lists(st.floats(0, 1), min_size=1, max_size=4), st.integers(1, 20))
def test_exact_quantiles_random(spark, values, probs, rows_per_range):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    got = exact_quantiles_multi(df, {"v": (probs, "q")}, rows_per_range=rows_per_range).first()
    clean = np.array([v for v in values if v is not None], dtype=float)
    for i, p in enumerate(probs):
        if clean.size == 0:
            assert got[f"q{i}"] is None
        else:
            assert abs(got[f"q{i}"] - np.percentile(clean, p * 100)) < 1e-9


@settings(SETTINGS, max_examples=5)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 600)), min_size=1, max_size=50),
       st.integers(1, 120), st.integers(1, 40))
def test_sessions_random(spark, events, gap_min, part_rows):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=m), u) for i, (u, m) in enumerate(events)]
    pdf = pd.DataFrame(rows, columns=["event_id", "ts", "user_id"])
    df = spark.createDataFrame(pdf).selectExpr("event_id", "CAST(ts AS timestamp_ntz) AS ts", "user_id")

    tagged = sessionize(df, gap_seconds=gap_min * 60, rows_per_part=part_rows)
    got = sorted(tagged.groupBy("user_id", "session_start_us").count().select("user_id", "count")
                 .toPandas().itertuples(index=False, name=None))
    exp = []
    for u, g in pdf.sort_values(["user_id", "ts", "event_id"]).groupby("user_id"):
        n, prev = 0, None
        for ts in g["ts"]:
            if prev is not None and (ts - prev).total_seconds() > gap_min * 60:
                exp.append((u, n))
                n = 0
            prev, n = ts, n + 1
        exp.append((u, n))
    assert got == sorted(exp)
    agg = sessions(df, gap_seconds=gap_min * 60, rows_per_part=part_rows)
    assert sorted((r["user_id"], r["n_events"]) for r in agg.collect()) == sorted(exp)
