"""Model monitoring: drift (recent N vs history), daily trends, KPIs, performance report."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import epoch_micros, round_half_up, try_ratio
from tessera.operators.metrics import select_best

# FIXED VALUES: drift thresholds (strict >), report baselines, recommendation texts.
DRIFT_THRESHOLD = 0.1
DRIFT_HIGH = 0.2
DRIFT_LOW_CONFIDENCE = 0.7
BASELINE_AUC = 0.85
ENSEMBLE_CONFIDENCE = 0.8
DEPLOY_GAIN = 10
DRIFT_RECOMMENDATIONS = ["Model drift detected - consider retraining",
                         "Investigate data quality changes",
                         "Review feature distribution shifts"]
PERFORMANCE_TEXTS = {  # by type: description, impact
    "model_retraining": ("Model accuracy is declining - schedule retraining", "Prevents further performance degradation"),
    "model_ensemble": ("Consider ensemble methods to improve confidence", "Higher prediction reliability"),
    "deployment": ("Excellent model performance - ready for production scaling", "Business value realization"),
}
LOW_CONFIDENCE_RECOMMENDATION = "Low confidence scores - consider model ensemble"


def drift(log: DataFrame, window_size: int = 100, model: str = "model_name", ts: str = "ts",
          tie: str = "prediction_id") -> DataFrame:
    """Per model: recent-window vs historical positive rate and confidence.

    The newest ``window_size`` rows per model come from ``row_number() <= N``,
    which Spark turns into a per-task top-N before the shuffle (a model with a
    third of all rows sends at most N rows per task); the historical side is
    the plain total aggregate minus the recent one — no second pass over the
    rows of a model in one task.
    """
    w = Window.partitionBy(model).orderBy(F.col(ts).desc(), F.col(tie).desc())
    sums = [F.count(F.lit(1)).alias("n"), F.sum("prediction").alias("p"), F.sum("confidence").alias("c"),
            F.count("prediction").alias("np"), F.count("confidence").alias("nc")]
    recent = log.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= window_size).groupBy(model).agg(*sums)
    return drift_of(log.groupBy(model).agg(*sums), recent, window_size, model)


def drift_of(total: DataFrame, recent: DataFrame, window_size: int, model: str = "model_name") -> DataFrame:
    """Drift from two tables of sums per model (rows ``n``, predictions ``p``, confidences ``c`` and how many of
    these are known, ``np`` and ``nc``): all rows, and the newest ``window_size`` of them."""
    total = total.withColumnsRenamed({"n": "n_predictions"} | {c: f"_t_{c}" for c in ("p", "c", "np", "nc")})
    j = total.join(recent.withColumnsRenamed({c: f"_rn_{c}" for c in ("n", "p", "c", "np", "nc")}), model)
    enough = F.col("n_predictions") >= window_size
    has_hist = F.col("n_predictions") > window_size
    # NULL predictions and confidences are left out of their means (of sums and counts alike)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))  # noqa: E731 - the sum of no value
    r_pos = try_ratio(F.col("_rn_p"), F.col("_rn_np"))
    r_conf = try_ratio(F.col("_rn_c"), F.col("_rn_nc"))
    h_pos = F.when(has_hist, try_ratio(zero("_t_p") - zero("_rn_p"), F.col("_t_np") - F.col("_rn_np")))
    h_conf = F.when(has_hist, try_ratio(zero("_t_c") - zero("_rn_c"), F.col("_t_nc") - F.col("_rn_nc")))
    out = j.select(
        model, "n_predictions",
        F.when(enough, "success").otherwise("warning").alias("status"),
        F.when(enough, r_pos).alias("recent_positive_rate"),
        F.when(enough, r_conf).alias("recent_avg_confidence"),
        F.when(enough, h_pos).alias("historical_positive_rate"),
        F.when(enough, h_conf).alias("historical_avg_confidence"))
    out = (out.withColumn("positive_rate_drift", F.abs(F.col("recent_positive_rate") - F.col("historical_positive_rate")))
           .withColumn("confidence_drift", F.abs(F.col("recent_avg_confidence") - F.col("historical_avg_confidence"))))
    detected = F.coalesce((F.col("positive_rate_drift") > DRIFT_THRESHOLD)
                          | (F.col("confidence_drift") > DRIFT_THRESHOLD), F.lit(False))
    return (out.withColumn("drift_detected", F.when(enough, detected))
            .withColumn("drift_severity", F.when(~enough, F.lit(None).cast("string"))
                        .when(detected & (F.col("positive_rate_drift") > DRIFT_HIGH), "high")
                        .when(detected, "medium").otherwise("low")))


def drift_recommendations(dr: DataFrame, model: str = "model_name") -> DataFrame:
    """One row per recommendation (table-driven ``when``, exploded)."""
    recs = F.array(
        *[F.when(F.col("drift_detected"), F.lit(text)) for text in DRIFT_RECOMMENDATIONS],
        F.when(F.col("recent_avg_confidence") < DRIFT_LOW_CONFIDENCE, F.lit(LOW_CONFIDENCE_RECOMMENDATION)))
    return dr.select(model, F.explode(F.filter(recs, lambda x: x.isNotNull())).alias("recommendation"))


def daily_series(log: DataFrame, model: str | None = "model_name") -> DataFrame:
    """Per (model, day): daily_accuracy (mean confidence) and daily_volume."""
    keys = ([model] if model else []) + [F.to_date("ts").alias("day")]
    return log.groupBy(*keys).agg(F.avg("confidence").alias("daily_accuracy"),
                                  F.count(F.lit(1)).alias("daily_volume"),
                                  F.sum("confidence").alias("daily_confidence_sum"),
                                  F.count("confidence").alias("daily_confidence_count"))


def accuracy_trend(daily: DataFrame, k: int = 7, model: str | None = "model_name",
                   mode: str = "mean") -> DataFrame:
    """Last-k vs first-k days: means, difference, label ('declining' / 'stable').

    ``mode='first'`` compares like a lexicographic list comparison (first
    differing day pair), as the reference's list ``<`` does.
    The window runs over the per-day aggregate (one row per day).
    """
    parts = [model] if model else []
    w_first = (Window.partitionBy(*parts) if parts else Window).orderBy("day")
    w_last = (Window.partitionBy(*parts) if parts else Window).orderBy(F.col("day").desc())
    d = daily.withColumn("_a", F.row_number().over(w_first)).withColumn("_d", F.row_number().over(w_last))
    g = d.groupBy(*parts).agg(
        F.avg(F.when(F.col("_a") <= k, F.col("daily_accuracy"))).alias("first_mean"),
        F.avg(F.when(F.col("_d") <= k, F.col("daily_accuracy"))).alias("last_mean"),
        F.sort_array(F.collect_list(F.when(F.col("_a") <= k, F.struct("_a", "daily_accuracy")))).alias("_fs"),
        F.sort_array(F.collect_list(F.when(F.col("_d") <= k, F.struct(
            (F.lit(k + 1) - F.col("_d")).alias("_i"), "daily_accuracy")))).alias("_ls"),
        F.count(F.lit(1)).alias("days"))
    if mode == "mean":
        declining = F.col("last_mean") < F.col("first_mean")
    elif mode == "first":
        pairs = F.arrays_zip(F.transform("_ls", lambda s: s["daily_accuracy"]).alias("l"),
                             F.transform("_fs", lambda s: s["daily_accuracy"]).alias("f"))
        diff = F.filter(pairs, lambda p: p["l"] != p["f"])
        declining = F.when(F.size(diff) > 0, diff[0]["l"] < diff[0]["f"]).otherwise(
            F.size("_ls") < F.size("_fs"))
    else:
        raise ValueError(mode)
    return g.select(*parts, "days", "first_mean", "last_mean",
                    (F.col("last_mean") - F.col("first_mean")).alias("accuracy_trend"),
                    F.when(declining, "declining").otherwise("stable").alias("trend_accuracy"))


def kpis(daily: DataFrame, k: int = 7, model: str | None = "model_name") -> DataFrame:
    """model_reliability = mean of the last k daily accuracies (3 dp);
    throughput = mean daily volume truncated to an integer."""
    parts = [model] if model else []
    w_last = (Window.partitionBy(*parts) if parts else Window).orderBy(F.col("day").desc())
    d = daily.withColumn("_d", F.row_number().over(w_last))
    return d.groupBy(*parts).agg(
        round_half_up(F.avg(F.when(F.col("_d") <= k, F.col("daily_accuracy"))), 3).alias("model_reliability"),
        F.avg("daily_volume").cast("long").alias("throughput"))


def performance_report(perf: DataFrame, trend: DataFrame, log: DataFrame) -> DataFrame:
    """One-row summary: best model (by roc_auc), vs baseline / worst in AUC points,
    trend label, mean confidence, recommendation counts."""
    best = select_best(perf, "roc_auc").select(F.col("model_name").alias("best_model"),
                                               F.col("roc_auc").alias("best_roc_auc"))
    span = perf.agg(F.count(F.lit(1)).alias("models_compared"), F.min("roc_auc").alias("_worst"))
    conf = log.agg(F.avg("confidence").alias("avg_confidence"))
    j = best.crossJoin(span).crossJoin(trend.select("trend_accuracy")).crossJoin(conf)
    j = (j.withColumn("vs_baseline", round_half_up((F.col("best_roc_auc") - BASELINE_AUC) * 100, 2))
         .withColumn("vs_worst", round_half_up((F.col("best_roc_auc") - F.col("_worst")) * 100, 2)))
    recs = performance_recommendation_flags()
    n_recs = sum(F.coalesce(c, F.lit(False)).cast("int") for _, _, c in recs)
    n_high = sum(F.coalesce(c, F.lit(False)).cast("int") for p, _, c in recs if p == "high")
    return j.select("best_model", round_half_up("best_roc_auc", 4).alias("best_roc_auc"), "models_compared",
                    "vs_baseline", "vs_worst", "trend_accuracy",
                    round_half_up("avg_confidence", 3).alias("avg_confidence"),
                    n_recs.alias("recommendations_count"), n_high.alias("high_priority_issues"))


def efficiency(perf: DataFrame) -> DataFrame:
    """Best model (by roc_auc) with its efficiency score: AUC per ten seconds of training (3 dp; NULL without a time)."""
    best = select_best(perf, "roc_auc")
    score = F.try_divide(F.col("roc_auc"), F.col("training_time") / F.lit(10.0))
    return best.select("model_name", round_half_up("roc_auc", 4).alias("roc_auc"), "training_time", round_half_up(score, 3).alias("efficiency_score"))


def performance_recommendation_flags():
    """(priority, type, condition) — the report's recommendation rules; texts are in PERFORMANCE_TEXTS."""
    return [("high", "model_retraining", F.col("trend_accuracy") == "declining"),
            ("medium", "model_ensemble", F.col("avg_confidence") < ENSEMBLE_CONFIDENCE),
            ("low", "deployment", F.col("vs_baseline") > DEPLOY_GAIN)]


def performance_recommendations(report: DataFrame) -> DataFrame:
    """One row per triggered recommendation of a :func:`performance_report`: priority, type, description, impact."""
    items = F.array(*[F.when(c, F.struct(F.lit(p).alias("priority"), F.lit(t).alias("type"),
                                         F.lit(PERFORMANCE_TEXTS[t][0]).alias("description"), F.lit(PERFORMANCE_TEXTS[t][1]).alias("impact")))
                      for p, t, c in performance_recommendation_flags()])
    return report.select(F.explode(F.filter(items, lambda x: x.isNotNull())).alias("r")).select("r.*")


def realtime_summary(log: DataFrame, model: str = "model_name") -> DataFrame:
    """Per model: total, span seconds, rate per second (2 dp), positive rate and
    mean confidence (4 dp)."""
    us = epoch_micros(log, "ts")
    span_s = (F.max(us) - F.min(us)) / F.lit(1e6)
    g = log.groupBy(model).agg(F.count(F.lit(1)).alias("total_predictions"), span_s.alias("duration_seconds"),
                               F.avg(F.col("prediction").cast("double")).alias("_pr"),
                               F.avg("confidence").alias("_c"))
    return g.select(model, "total_predictions", "duration_seconds",
                    round_half_up(try_ratio(F.col("total_predictions"), F.col("duration_seconds")), 2)
                    .alias("predictions_per_second"),
                    round_half_up("_pr", 4).alias("positive_rate"), round_half_up("_c", 4).alias("avg_confidence"))


def prediction_summary(log: DataFrame, model: str = "model_name") -> DataFrame:
    """Batch summary per model: n, positives, negatives, positive rate, mean confidence."""
    return log.groupBy(model).agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(F.col("prediction") == 1).alias("positive_predictions"),
        F.count_if(F.col("prediction") != 1).alias("negative_predictions"),
        F.avg(F.col("prediction").cast("double")).alias("positive_rate"),
        F.avg("confidence").alias("avg_confidence"))


def sample_predictions(log: DataFrame, n: int = 10, model: str = "model_name") -> DataFrame:
    """First ``n`` scored rows per model (top-N pushed below the shuffle)."""
    w = Window.partitionBy(model).orderBy("ts", "prediction_id")
    return (log.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= n)
            .select(model, "sample_rank", "prediction_id", "ts", "prediction", "confidence"))
