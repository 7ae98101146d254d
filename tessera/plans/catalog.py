"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every entry reads the whole test tables through the bindings in
``tessera.sources.tables`` and runs the library's own operators. Doubles that
the reference does not round are rounded to 6 decimals at the very end so a
result compares stably against another engine.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.functions.columns import round_half_up
from tessera.operators import calibration, clean, metrics, sessions, stats
from tessera.plans import alerts, dashboard, features, history, insights, monitor, roi, runlog
from tessera.plans.rolling import RollingQuantiles
from tessera.session import materialize, scratch_path, written
from tessera.sources import rejects
from tessera.sources import tables as S

AS_OF_ORDERS = "2001-12-31"
AS_OF_EVENTS = "2024-01-30"
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
DRIFT_WINDOW = 100
DRIFT_MEASURES = ["recent_positive_rate", "recent_avg_confidence", "historical_positive_rate",
                  "historical_avg_confidence", "positive_rate_drift", "confidence_drift"]


def r6(c):
    return round_half_up(c, 6)


class Ctx:
    """Per-call access to tables and shared intermediate plans (lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.t = spark, S.Tables(spark, sf_dir)

    def tx(self):
        return S.transactions_from_orders(self.t.orders)

    def rfm(self):
        return features.rfm_features(self.tx(), AS_OF_ORDERS)

    def behavior(self):
        return sessions.behavior_from_events(self.t.events)

    def beh(self):
        return features.behavioral_features(self.behavior())

    def customers(self):
        return S.customers_from_tables(self.t.customer, self.t.nation, self.t.orders)

    def cust_feat(self):
        return features.customer_features(self.customers(), AS_OF_ORDERS)

    def segment_customers(self):
        return features.segment_customers(self.rfm(), self.beh())

    def log(self):
        return S.prediction_log_from_events(self.t.events)

    def hourly(self):
        return dashboard.hourly_rollup(self.log())

    def scored(self):
        return S.scored_documents(self.t.documents, self.t.labels)

    def perf(self):
        seq = F.create_map(*[x for i, n in enumerate(S.DOCUMENT_SCORERS) for x in (F.lit(n), F.lit(i))])
        p = metrics.model_performance(self.scored())
        # one row per model, read by several consumers: written once
        return materialize(p.withColumn("model_seq", seq[F.col("model_name")]))

    def overall_trend(self):
        return monitor.accuracy_trend(monitor.daily_series(self.log(), None), model=None)

    def lines(self):
        return S.transaction_lines_from_lineitem(self.t.lineitem)


def _q(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Ctx(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# --- RFM -------------------------------------------------------------------------
@_q
def q_rfm_features(c: Ctx):
    """Flagship: RFM aggregate, quintile scores, combined score and segment per customer."""
    return c.rfm()


@_q
def q_rfm_aggregate(c: Ctx):
    return features.rfm_aggregate(c.tx(), AS_OF_ORDERS)


@_q
def q_rfm_scores(c: Ctx):
    return c.rfm().select("customer_id", "recency_score", "frequency_score", "monetary_score")


@_q
def q_rfm_segments(c: Ctx):
    return c.rfm().select("customer_id", "rfm_score", "customer_segment")


@_q
def q_segment_distribution(c: Ctx):
    return features.segment_distribution(c.rfm())


# --- cleaning / anomalies -------------------------------------------------------------
@_q
def q_clean_dedupe(c: Ctx):
    return clean.dedupe_first(c.lines(), LINE_KEYS, LINE_ORDER)


@_q
def q_clean_transactions(c: Ctx):
    return clean.clean_transactions(c.lines(), LINE_KEYS, LINE_ORDER, amount="l_extendedprice",
                                    quantity="l_quantity", ts="l_shipdate")


@_q
def q_clean_report(c: Ctx):
    lines = c.lines()
    tx = clean.clean_report("transactions", lines, clean.clean_transactions(
        lines, LINE_KEYS, LINE_ORDER, amount="l_extendedprice", quantity="l_quantity", ts="l_shipdate"))
    cust = c.customers()
    cu = clean.clean_report("customers", cust, clean.clean_customers(cust))
    return tx.unionByName(cu)


ANOMALY_SPEC = {"high_amount": ("l_extendedprice", 0.99), "high_quantity": ("l_quantity", 0.95)}


@_q
def q_anomaly_counts(c: Ctx):
    a = clean.anomaly_counts(c.lines(), ANOMALY_SPEC)
    return a.select("total_records", "high_amount_count", "high_quantity_count",
                    r6("high_amount_threshold").alias("high_amount_threshold"),
                    r6("high_quantity_threshold").alias("high_quantity_threshold"))


@_q
def q_rolling_thresholds(c: Ctx):
    """Anomaly counts after four deliveries (the third one twice), bracketed by the sketches kept of every month."""
    rolled = RollingQuantiles(c.spark, scratch_path(c.spark, "rolling", uuid.uuid4().hex), [col for col, _ in ANOMALY_SPEC.values()])
    lines = c.lines().withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    for part in (2, 0, 3, 3, 1):
        rolled.add(lines.where(F.pmod("l_orderkey", F.lit(4)) == part), "month", f"delivery-{part}")
    a = clean.anomaly_counts(lines, ANOMALY_SPEC, around=rolled.quantiles(list(ANOMALY_SPEC.values())))
    return a.select("total_records", "high_amount_count", "high_quantity_count",
                    r6("high_amount_threshold").alias("high_amount_threshold"),
                    r6("high_quantity_threshold").alias("high_quantity_threshold"))


@_q
def q_reject_table(c: Ctx):
    """JSON lines of the events read back with a check; rejects keep their text and reason, clean rows have none."""
    path = scratch_path(c.spark, "records", uuid.uuid4().hex)
    S.records_from_events(c.t.events).write.text(path)
    checked = rejects.read_checked(c.spark, path, "event_id bigint, ts timestamp_ntz, value bigint",
                                   rules={"value_below_one": F.col("value") >= 1}, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    return checked.select("record", "reason")


@_q
def q_score_calibration(c: Ctx):
    """Calibration curve of every document scorer and its reliability by tenths of the probability."""
    scored = written(c.scored(), "scored")
    fit = calibration.platt_fit(scored)
    bins = calibration.reliability(calibration.calibrated(scored, fit))
    return calibration_table(bins, fit)


def calibration_table(bins: DataFrame, fit: dict[str, tuple[float, float]]) -> DataFrame:
    curves = bins.sparkSession.createDataFrame([(m, *ab) for m, ab in fit.items()], "model_name string, slope double, intercept double")
    rounded = [r6(x).alias(x) for x in ("mean_probability", "observed_rate", "brier")]
    return bins.join(curves, "model_name").select(
        "model_name", "bin", "n", *rounded, *[round_half_up(x, 4).alias(x) for x in ("slope", "intercept")])


@_q
def q_anomaly_rows(c: Ctx):
    f = clean.with_anomaly_flags(c.lines(), {"l_extendedprice": 0.99, "l_quantity": 0.95})
    return (f.where(F.col("l_extendedprice_anomaly") | F.col("l_quantity_anomaly"))
            .select(*LINE_KEYS, "l_extendedprice", "l_quantity",
                    F.col("l_extendedprice_anomaly").alias("amount_anomaly"),
                    F.col("l_quantity_anomaly").alias("quantity_anomaly")))


@_q
def q_fk_orphans(c: Ctx):
    return clean.fk_summary(c.t.orders, c.t.customer, "o_custkey", "c_custkey")


# --- customers ----------------------------------------------------------------------
@_q
def q_tenure(c: Ctx):
    return c.customers().select("customer_id", "registration_date",
                                features.days_since("registration_date", AS_OF_ORDERS)
                                .alias("days_since_registration"))


@_q
def q_label_encode(c: Ctx):
    out, _ = stats.label_encode(c.customers(), "city", "city_encoded")
    return out.select("customer_id", "city", "city_encoded")


@_q
def q_customer_features(c: Ctx):
    return c.cust_feat().select("customer_id", "age", "gender", "city", "registration_date",
                                "days_since_registration", "age_group", "gender_encoded", "city_encoded",
                                r6("loyalty_score").alias("loyalty_score"))


@_q
def q_banding(c: Ctx):
    return c.t.part.select("p_partkey", "p_size", C.age_group("p_size").alias("size_band"))


# --- behaviour ------------------------------------------------------------------------
@_q
def q_sessions(c: Ctx):
    s = sessions.sessions(c.t.events)
    return s.select("user_id", "session_start", "session_end", "n_events")


@_q
def q_user_behavior(c: Ctx):
    b = c.behavior()
    return b.select("customer_id", "n_events", "n_sessions", r6("avg_session_duration").alias("avg_session_duration"),
                    r6("pages_per_session").alias("pages_per_session"), r6("bounce_rate").alias("bounce_rate"),
                    r6("cart_abandonment_rate").alias("cart_abandonment_rate"),
                    r6("email_open_rate").alias("email_open_rate"), "social_media_engagement",
                    "support_tickets", "product_categories_visited")


@_q
def q_behavioral_features(c: Ctx):
    b = c.beh()
    return b.select("customer_id", *[r6(x).alias(x) for x in
                                     ("engagement_score", "satisfaction_score", "interest_diversity",
                                      "churn_risk_score")])


@_q
def q_overall_metrics(c: Ctx):
    return insights.overall_metrics(c.segment_customers())


# --- ML dataset ---------------------------------------------------------------------------
@_q
def q_join_features(c: Ctx):
    j = features.join_features(c.cust_feat(), c.rfm(), c.beh())
    return j.select("customer_id", "days_since_registration", "recency_days", "frequency", "rfm_score",
                    "customer_segment", r6("engagement_score").alias("engagement_score"),
                    r6("churn_risk_score").alias("churn_risk_score"))


@_q
def q_churn_label(c: Ctx):
    j = features.with_churn_label(features.join_features(c.cust_feat(), c.rfm(), c.beh()))
    return j.select("customer_id", "target_churn")


def _ml(c: Ctx):
    ds, _ = features.ml_dataset(c.cust_feat(), c.rfm(), c.beh())
    return ds


@_q
def q_target_distribution(c: Ctx):
    return stats.value_counts(_ml(c), "target_churn")


@_q
def q_scaled_features(c: Ctx):
    return _ml(c).select("customer_id", *[r6(x).alias(x) for x in features.NUMERICAL_FEATURES])


@_q
def q_one_hot(c: Ctx):
    return _ml(c).select("customer_id", *[f"segment_{s}" for s in C.SEGMENTS])


@_q
def q_ml_dataset(c: Ctx):
    ds = _ml(c)
    return ds.select(*[r6(x).alias(x) if x in features.NUMERICAL_FEATURES else F.col(x) for x in ds.columns])


# --- insights ------------------------------------------------------------------------------
@_q
def q_segment_insights(c: Ctx):
    return insights.segment_insights(c.segment_customers()).drop("segment_order")


@_q
def q_top_insights(c: Ctx):
    return insights.top_insights(insights.segment_insights(c.segment_customers()))


# --- dashboard ------------------------------------------------------------------------------
@_q
def q_hourly_rollup(c: Ctx):
    h = c.hourly()
    return h.select("hour_ts", "predictions_count", "positive_predictions", "negative_predictions",
                    r6("avg_confidence").alias("avg_confidence"), r6("processing_time").alias("processing_time"),
                    r6("positive_rate").alias("positive_rate"))


@_q
def q_hourly_profile(c: Ctx):
    return dashboard.hourly_profile(c.hourly())


@_q
def q_current_stats(c: Ctx):
    return dashboard.current_stats(c.hourly(), AS_OF_EVENTS)


@_q
def q_confidence_heatmap(c: Ctx):
    h = dashboard.confidence_heatmap(c.hourly())
    return h.select("day_of_week", "hour_group", r6("avg_confidence").alias("avg_confidence"))


@_q
def q_confidence_histogram(c: Ctx):
    h = dashboard.confidence_histogram(c.hourly(), 20)
    return h.select("bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "count")


@_q
def q_confidence_heatmap_all_hours(c: Ctx):
    """The heatmap with midnight in the first day part."""
    h = dashboard.confidence_heatmap(c.hourly(), include_lowest=True)
    return h.withColumn("avg_confidence", r6("avg_confidence"))


@_q
def q_dashboard_summary(c: Ctx):
    return dashboard.dashboard_summary(c.hourly())


@_q
def q_dashboard_overview(c: Ctx):
    """The summary with the day's current stats inside, flattened."""
    return dashboard.dashboard_overview(c.hourly(), AS_OF_EVENTS).select("*", "current_stats.*").drop("current_stats")


# --- prediction log ---------------------------------------------------------------------------
@_q
def q_prediction_summary(c: Ctx):
    p = monitor.prediction_summary(c.log())
    return p.select("model_name", "total_samples", "positive_predictions", "negative_predictions",
                    r6("positive_rate").alias("positive_rate"), r6("avg_confidence").alias("avg_confidence"))


@_q
def q_realtime_summary(c: Ctx):
    return monitor.realtime_summary(c.log())


@_q
def q_sample_predictions(c: Ctx):
    s = monitor.sample_predictions(c.log(), 10)
    return s.select("model_name", "sample_rank", "prediction_id", "ts", "prediction",
                    r6("confidence").alias("confidence"))


@_q
def q_confidence(c: Ctx):
    p = F.least(F.col("value"), F.lit(100.0)) / F.lit(100.0)
    ev = c.t.events.select(F.col("event_id").alias("prediction_id"), F.col("event_type").alias("model_name"),
                           F.array(F.lit(1.0) - p, p).alias("proba"))
    return ev.select("prediction_id", "model_name", r6(F.col("proba")[1]).alias("prob_positive"),
                     r6(C.confidence(F.col("proba"))).alias("confidence"))


# --- model metrics -----------------------------------------------------------------------------
@_q
def q_binary_metrics(c: Ctx):
    return metrics.binary_metrics(c.scored())


@_q
def q_roc_auc(c: Ctx):
    return metrics.roc_auc(c.scored(), digits=6)


@_q
def q_confusion_matrix(c: Ctx):
    return metrics.confusion_matrix(c.scored())


@_q
def q_prediction_stats(c: Ctx):
    p = metrics.prediction_stats(c.scored())
    return p.select("model_name", "positive_predictions", "negative_predictions",
                    r6("positive_rate").alias("positive_rate"),
                    r6("actual_positive_rate").alias("actual_positive_rate"), "test_samples")


@_q
def q_select_best_model(c: Ctx):
    b = metrics.select_best(c.perf(), "roc_auc")
    return b.select("model_name", *[round_half_up(x, 4).alias(x)
                                    for x in ("accuracy", "precision", "recall", "f1", "roc_auc")])


@_q
def q_model_comparison(c: Ctx):
    return metrics.compare_models(c.perf(), "roc_auc")


@_q
def q_rule_label(c: Ctx):
    emb = c.t.embeddings.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(3)])
    scaled, _ = stats.standard_scale(emb, ["x0", "x1", "x2"])
    return scaled.select("vec_id", r6("x0").alias("x0"), r6("x1").alias("x1"), r6("x2").alias("x2"),
                         C.rule_label(F.col("x0"), F.col("x1"), F.col("x2")).alias("rule_label"))


# --- monitoring -----------------------------------------------------------------------------
@_q
def q_drift(c: Ctx):
    d = monitor.drift(c.log(), DRIFT_WINDOW)
    cols = ["recent_positive_rate", "recent_avg_confidence", "historical_positive_rate",
            "historical_avg_confidence", "positive_rate_drift", "confidence_drift"]
    return d.select("model_name", "n_predictions", "status", *[r6(x).alias(x) for x in cols],
                    "drift_detected", "drift_severity")


@_q
def q_accuracy_trend(c: Ctx):
    t = monitor.accuracy_trend(monitor.daily_series(c.log()))
    return t.select("model_name", "days", r6("first_mean").alias("first_mean"), r6("last_mean").alias("last_mean"),
                    r6("accuracy_trend").alias("accuracy_trend"), "trend_accuracy")


@_q
def q_kpis(c: Ctx):
    return monitor.kpis(monitor.daily_series(c.log()))


@_q
def q_performance_report(c: Ctx):
    return monitor.performance_report(c.perf(), c.overall_trend(), c.log())


@_q
def q_performance_recommendations(c: Ctx):
    return monitor.performance_recommendations(monitor.performance_report(c.perf(), c.overall_trend(), c.log()))


# --- alerts ---------------------------------------------------------------------------------
def _alerts(c: Ctx):
    m = alerts.alert_metrics(c.segment_customers(), monitor.daily_series(c.log(), None))
    return alerts.evaluate_rules(m, alerts.rules_frame(c.spark))


def _metrics_of_all_rules(c: Ctx):
    """A log whose confidence falls and whose volume jumps on the last day, and customers who only browse."""
    beh = features.behavioral_features(sessions.behavior_from_events(S.browsing_events(c.t.events)))
    log = S.bursting_log_from_events(c.t.events, AS_OF_EVENTS)
    return alerts.alert_metrics(features.segment_customers(c.rfm(), beh), monitor.daily_series(log, None)), log


def _alerts_of_all_rules(c: Ctx):
    m, log = _metrics_of_all_rules(c)
    return alerts.evaluate_rules(m, alerts.rules_frame(c.spark)), log


@_q
def q_alerts_all_rules(c: Ctx):
    """All five rules fire."""
    return _alerts_of_all_rules(c)[0]


@_q
def q_alert_texts_all_rules(c: Ctx):
    return alerts.alert_descriptions(_alerts_of_all_rules(c)[0]).select("alert_id", "type", "description")


@_q
def q_alert_actions_all_rules(c: Ctx):
    return alerts.alert_actions(_alerts_of_all_rules(c)[0])


@_q
def q_alert_measures_all_rules(c: Ctx):
    return alerts.alert_measures(*_alerts_of_all_rules(c))


@_q
def q_alert_summary_all_rules(c: Ctx):
    return alerts.alert_summary(_alerts_of_all_rules(c)[0])


@_q
def q_business_alerts(c: Ctx):
    return _alerts(c)


@_q
def q_alert_summary(c: Ctx):
    return alerts.alert_summary(_alerts(c))


# --- ROI --------------------------------------------------------------------------------------
def _cb(c: Ctx):
    li = c.t.lineitem
    return S.costs_from_lineitem(li), S.benefits_from_lineitem(li)


@_q
def q_roi_summary(c: Ctx):
    return roi.roi_summary(*_cb(c), period_days=90)


@_q
def q_roi_sensitivity(c: Ctx):
    return roi.roi_sensitivity(*_cb(c))


@_q
def q_roi_projection(c: Ctx):
    return roi.roi_projection(*_cb(c), period_days=90)


# --- run log ------------------------------------------------------------------------------------
@_q
def q_success_rate(c: Ctx):
    return runlog.success_rate(S.run_log_from_events(c.t.events))


@_q
def q_log_families(c: Ctx):
    return runlog.log_families(S.run_log_from_events(c.t.events))


@_q
def q_step_families(c: Ctx):
    """Step families over a log in which every family occurs."""
    return runlog.log_families(S.step_log_from_events(c.t.events))


@_q
def q_run_log_tail(c: Ctx):
    return runlog.tail(S.run_log_from_events(c.t.events), 5).select("timestamp", "step", "status")


def q_run_log_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the run log as JSON (sink), read it back (source), compute the success rate."""
    import uuid

    from tessera.session import scratch_path
    from tessera.sources.runlog_io import read_run_log, write_run_log
    path = scratch_path(spark, "runlog", uuid.uuid4().hex[:8])
    write_run_log(S.run_log_from_events(Ctx(spark, sf_dir).t.events), path)
    return runlog.success_rate(read_run_log(spark, path))


@_q
def q_drift_recommendations(c: Ctx):
    return monitor.drift_recommendations(monitor.drift(c.log(), DRIFT_WINDOW))


@_q
def q_drift_shifted(c: Ctx):
    """Drift where rates and confidences shift and some confidences are missing."""
    d = monitor.drift(S.shifting_log_from_events(c.t.events), DRIFT_WINDOW)
    return d.withColumns({k: r6(k) for k in DRIFT_MEASURES})


@_q
def q_drift_advice(c: Ctx):
    """Recommendations of a drift that fires."""
    return monitor.drift_recommendations(monitor.drift(S.shifting_log_from_events(c.t.events), DRIFT_WINDOW))


@_q
def q_clean_customers(c: Ctx):
    """Customers of legal age with their city title-cased."""
    return clean.clean_customers(S.account_holders(c.t.customer, c.t.nation), order_by=("customer_id",))


@_q
def q_positive_balances(c: Ctx):
    return clean.filter_positive(S.account_holders(c.t.customer, c.t.nation), ["amount"]).select("customer_id", "amount")


@_q
def q_parse_times(c: Ctx):
    """Timestamps from text; texts that are no time become NULL."""
    return clean.parse_ts(S.text_times_from_events(c.t.events), "transaction_date", "yyyy-MM-dd HH:mm:ss").withColumn(
        "transaction_date", F.col("transaction_date").cast("timestamp_ntz"))


@_q
def q_rejected_times(c: Ctx):
    return clean.rejected(S.text_times_from_events(c.t.events), "transaction_date", "yyyy-MM-dd HH:mm:ss")


@_q
def q_fk_orphans_of_positive(c: Ctx):
    """Orders whose customer is not among those with a positive balance."""
    held = clean.filter_positive(c.t.customer, ["c_acctbal"])
    return clean.fk_summary(c.t.orders, held, "o_custkey", "c_custkey")


@_q
def q_orphan_orders(c: Ctx):
    held = clean.filter_positive(c.t.customer, ["c_acctbal"])
    return clean.orphans(c.t.orders, held, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@_q
def q_clean_report_customers(c: Ctx):
    """Report of a cleaning that removes customers."""
    before = S.account_holders(c.t.customer, c.t.nation)
    return clean.clean_report("customers", before, clean.filter_positive(clean.clean_customers(before, order_by=("customer_id",)), ["amount"]))


@_q
def q_alert_texts(c: Ctx):
    return alerts.alert_descriptions(_alerts(c)).select("alert_id", "type", "description")


@_q
def q_alert_actions(c: Ctx):
    return alerts.alert_actions(_alerts(c))


@_q
def q_alert_measures(c: Ctx):
    return alerts.alert_measures(_alerts(c), c.log())


@_q
def q_insight_texts(c: Ctx):
    return insights.insight_texts(insights.top_insights(insights.segment_insights(c.segment_customers())))


@_q
def q_roi_drivers(c: Ctx):
    return roi.roi_benefits(_cb(c)[1])


@_q
def q_report_lookup(c: Ctx):
    """Save the alert table under a name, then look an alert up by that name from another session."""
    name = history.save_table(_alerts(c), "tessera_business_alerts", kind="type", key="alert_id")
    return history.lookup(c.spark.newSession(), name, "alert_id", "ALERT_001").select("alert_id", "type", "severity", "metric_value")


@_q
def q_alert_history(c: Ctx):
    """Alerts of two runs; the first is written twice (a retry), the second numbers its alerts after those of the first."""
    log = history.RunHistory(c.spark, scratch_path(c.spark, "alert-history", uuid.uuid4().hex))
    first = written(_alerts(c), "alerts")
    for _ in range(2):
        log.append(first, "2024-01-30")
    issued = log.read(before="2024-01-31").count()
    log.append(alerts.evaluate_rules(_metrics_of_all_rules(c)[0], alerts.rules_frame(c.spark), issued), "2024-01-31")
    return log.read().select("run_id", "alert_id", "rule_no", "type", "severity", "metric_value")


@_q
def q_alerts_of_severity(c: Ctx):
    return alerts.filter_alerts(_alerts(c), "high").select("alert_id", "type", "severity")


@_q
def q_roi_recommendations(c: Ctx):
    return roi.roi_recommendations(roi.roi_summary(*_cb(c), period_days=90))


QUERIES = {
    "rolling_thresholds": q_rolling_thresholds, "reject_table": q_reject_table, "score_calibration": q_score_calibration,
    "step_families": q_step_families, "drift_shifted": q_drift_shifted, "drift_advice": q_drift_advice,
    "clean_customers": q_clean_customers, "positive_balances": q_positive_balances, "parse_times": q_parse_times,
    "rejected_times": q_rejected_times, "fk_orphans_of_positive": q_fk_orphans_of_positive,
    "orphan_orders": q_orphan_orders, "clean_report_customers": q_clean_report_customers,
    "alert_actions": q_alert_actions, "alert_measures": q_alert_measures, "insight_texts": q_insight_texts,
    "roi_drivers": q_roi_drivers, "report_lookup": q_report_lookup,
    "alert_texts": q_alert_texts, "alerts_of_severity": q_alerts_of_severity,
    "run_log_tail": q_run_log_tail, "run_log_io": q_run_log_io,
    "drift_recommendations": q_drift_recommendations, "roi_recommendations": q_roi_recommendations,
    "rfm_features": q_rfm_features, "rfm_aggregate": q_rfm_aggregate, "rfm_scores": q_rfm_scores,
    "rfm_segments": q_rfm_segments, "segment_distribution": q_segment_distribution,
    "clean_dedupe": q_clean_dedupe, "clean_transactions": q_clean_transactions,
    "clean_report": q_clean_report, "anomaly_counts": q_anomaly_counts, "anomaly_rows": q_anomaly_rows,
    "fk_orphans": q_fk_orphans, "tenure": q_tenure, "label_encode": q_label_encode,
    "customer_features": q_customer_features, "banding": q_banding, "sessions": q_sessions,
    "user_behavior": q_user_behavior, "behavioral_features": q_behavioral_features,
    "overall_metrics": q_overall_metrics, "join_features": q_join_features, "churn_label": q_churn_label,
    "target_distribution": q_target_distribution, "scaled_features": q_scaled_features,
    "one_hot": q_one_hot, "ml_dataset": q_ml_dataset, "segment_insights": q_segment_insights,
    "top_insights": q_top_insights, "hourly_rollup": q_hourly_rollup, "hourly_profile": q_hourly_profile,
    "current_stats": q_current_stats, "confidence_heatmap": q_confidence_heatmap,
    "confidence_histogram": q_confidence_histogram, "dashboard_summary": q_dashboard_summary,
    "prediction_summary": q_prediction_summary, "realtime_summary": q_realtime_summary,
    "sample_predictions": q_sample_predictions, "confidence": q_confidence,
    "binary_metrics": q_binary_metrics, "roc_auc": q_roc_auc, "confusion_matrix": q_confusion_matrix,
    "prediction_stats": q_prediction_stats, "select_best_model": q_select_best_model,
    "model_comparison": q_model_comparison, "rule_label": q_rule_label, "drift": q_drift,
    "accuracy_trend": q_accuracy_trend, "kpis": q_kpis, "performance_report": q_performance_report,
    "performance_recommendations": q_performance_recommendations, "business_alerts": q_business_alerts,
    "alerts_all_rules": q_alerts_all_rules, "alert_texts_all_rules": q_alert_texts_all_rules,
    "alert_actions_all_rules": q_alert_actions_all_rules, "alert_measures_all_rules": q_alert_measures_all_rules,
    "alert_summary_all_rules": q_alert_summary_all_rules, "alert_history": q_alert_history,
    "confidence_heatmap_all_hours": q_confidence_heatmap_all_hours, "dashboard_overview": q_dashboard_overview,
    "alert_summary": q_alert_summary, "roi_summary": q_roi_summary, "roi_sensitivity": q_roi_sensitivity,
    "roi_projection": q_roi_projection, "success_rate": q_success_rate, "log_families": q_log_families,
}
