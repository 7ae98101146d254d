"""Plan checks: no window over raw rows runs unpartitioned; results do not
depend on the number of shuffle partitions."""
import json

import pytest

from tests.conftest import SF_SMALL

# Keyless windows allowed only over the one-row-per-day prediction aggregate
# (first / last k days of the overall trend): bounded by the number of days.
DAILY_TREND_QUERIES = {"performance_report", "performance_recommendations"}


def _nodes(df):
    """Physical plan nodes (pre-order). Built with AQE off: the adaptive wrapper
    does not expose its children before execution."""
    return json.loads(df._jdf.queryExecution().executedPlan().toJSON())


def _keyless_windows(nodes):
    return [i for i, n in enumerate(nodes) if n["class"].endswith("WindowExec") and not n.get("partitionSpec")]


@pytest.fixture()
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_unpartitioned_window_over_rows(no_aqe):
    from tessera.plans.catalog import QUERIES
    offenders, windows = [], 0
    for key, q in QUERIES.items():
        nodes = _nodes(q(no_aqe, SF_SMALL))
        windows += sum(n["class"].endswith("WindowExec") for n in nodes)
        if _keyless_windows(nodes) and key not in DAILY_TREND_QUERIES:
            offenders.append(key)
    assert windows > 0 and offenders == []


def test_daily_trend_window_sits_on_day_aggregate(no_aqe):
    from tessera.plans.catalog import QUERIES
    assert not _keyless_windows(_nodes(QUERIES["business_alerts"](no_aqe, SF_SMALL)))
    nodes = _nodes(QUERIES["performance_report"](no_aqe, SF_SMALL))
    keyless = _keyless_windows(nodes)
    assert keyless
    for i in keyless:
        below = []
        for n in nodes[i + 1:]:
            if "Scan" in n["class"]:
                break
            below.append(n)
        # between the window and the scan there is an aggregate grouped by one date key (the day)
        assert any(n["class"].endswith("HashAggregateExec") and len(n.get("groupingExpressions") or []) == 1
                   and '"dataType": "date"' in json.dumps(n["groupingExpressions"]) for n in below)


def test_results_do_not_depend_on_partitioning(spark):
    from tessera.plans.catalog import QUERIES
    out = []
    for parts in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        rows = {}
        for key in ("rfm_features", "sessions", "clean_dedupe", "roc_auc", "drift"):
            rows[key] = sorted(tuple(str(v) for v in r) for r in QUERIES[key](spark, SF_SMALL).collect())
        out.append(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert out[0] == out[1]


def test_per_key_reductions_combine_before_shuffle(no_aqe):
    """Hot keys: keep-first and RFM reduce inside each task before the shuffle."""
    from tessera.plans.catalog import QUERIES
    dd = QUERIES["clean_dedupe"](no_aqe, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # top-1 per key on both sides of the shuffle (printed root-first: final, exchange, partial)
    ex = dd.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in dd[:ex] and "WindowGroupLimit" in dd[ex:]
    rfm = QUERIES["rfm_aggregate"](no_aqe, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in rfm and rfm.index("Exchange") < rfm.index("partial_count")
    drift = QUERIES["drift"](no_aqe, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in drift and "Partial" in drift
