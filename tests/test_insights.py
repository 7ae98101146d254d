from tessera.plans.insights import top_insights

SCHEMA = ("segment_order int, segment string, avg_monetary double, churn_risk double, avg_frequency double")


def test_top_insights_ties_and_empty_segments(spark):
    si = spark.createDataFrame([
        (0, "Champions", 100.0, 0.2, 5.0),
        (1, "Loyal Customers", 100.0, 0.7, 2.0),      # ties Champions on monetary -> earlier wins
        (2, "Potential Loyalists", None, None, None),  # empty segment never wins
        (3, "At Risk", 50.0, 0.7, 2.0),               # ties Loyal on risk and frequency -> earlier wins
        (4, "Lost Customers", 10.0, 0.1, 3.0)], SCHEMA)
    got = {r["insight_type"]: (r["segment"], r["value"]) for r in top_insights(si).collect()}
    assert got == {"revenue": ("Champions", 100.0), "risk": ("Loyal Customers", 0.7),
                   "opportunity": ("Loyal Customers", 2.0)}


def test_no_high_risk_segment_gives_two_insights(spark):
    si = spark.createDataFrame([(0, "Champions", 10.0, 0.6, 1.0), (1, "At Risk", 5.0, 0.1, 2.0)], SCHEMA)
    got = sorted(r["insight_type"] for r in top_insights(si).collect())
    assert got == ["opportunity", "revenue"]
