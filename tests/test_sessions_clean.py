import datetime as dt

import numpy as np
import pandas as pd

from tessera.operators.clean import dedupe_first, fk_summary
from tessera.operators.sessions import sessions


def _brute_sessions(pdf, gap):
    out = []
    for u, g in pdf.sort_values(["user_id", "ts", "event_id"]).groupby("user_id"):
        start, prev, n = None, None, 0
        for ts in g["ts"]:
            if prev is None or (ts - prev).total_seconds() > gap:
                if start is not None:
                    out.append((u, start, prev, n))
                start, n = ts, 0
            prev, n = ts, n + 1
        out.append((u, start, prev, n))
    return sorted(out)


def test_sessions_match_brute_force_with_hot_user(spark):
    rng = np.random.default_rng(11)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        u = 0 if i < 300 else int(rng.integers(1, 6))  # user 0 holds half the rows
        rows.append((i, base + dt.timedelta(minutes=int(rng.integers(0, 5000))), u))
    rows.append((999, rows[0][1], 0))  # exact tie with another event of the same user
    pdf = pd.DataFrame(rows, columns=["event_id", "ts", "user_id"])
    df = spark.createDataFrame(pdf).selectExpr("event_id", "CAST(ts AS timestamp_ntz) AS ts", "user_id",
                                               "'view' AS event_type")
    gap = 45 * 60
    got = sessions(df, gap_seconds=gap).toPandas()
    got = sorted((r.user_id, r.session_start.to_pydatetime(), r.session_end.to_pydatetime(), r.n_events)
                 for r in got.itertuples())
    assert got == _brute_sessions(pdf, gap)


def test_dedupe_first_is_deterministic(spark):
    rows = [(1, 5, "b"), (1, 3, "a"), (2, 9, "z"), (1, 3, "a"), (2, 1, "y")]
    df = spark.createDataFrame(rows, "k int, o int, p string")
    for parts in (1, 4):
        got = sorted(tuple(r) for r in dedupe_first(df.repartition(parts), ["k"], ["o", "p"]).collect())
        assert got == [(1, 3, "a"), (2, 1, "y")]


def test_fk_summary(spark):
    child = spark.createDataFrame([(1,), (2,), (3,)], "c long")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "p long")
    r = fk_summary(child, parent, "c", "p").first()
    assert (r["total_rows"], r["orphan_rows"]) == (3, 1)
