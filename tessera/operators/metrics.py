"""Binary-classification metrics as aggregates (no row reaches the driver)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import round_half_up, safe_ratio0, try_ratio
from tessera.operators.ordered import ordered_prefix_sum
from tessera.session import materialize


def _counts(scored: DataFrame, label: str, pred: str, group: Sequence[str]) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return scored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((y == 1) & (p == 1)).alias("true_positive"),
        F.count_if((y == 0) & (p == 1)).alias("false_positive"),
        F.count_if((y == 1) & (p == 0)).alias("false_negative"),
        F.count_if((y == 0) & (p == 0)).alias("true_negative"))


def binary_metrics(scored: DataFrame, label: str = "label", pred: str = "prediction",
                   group: Sequence[str] = ("model_name",), digits: int | None = 4) -> DataFrame:
    """accuracy, precision, recall, f1 for positive class 1; empty denominators give 0."""
    c = _counts(scored, label, pred, group)
    tp, fp, fn, tn, n = (F.col(x) for x in ("true_positive", "false_positive", "false_negative",
                                              "true_negative", "n"))
    vals = {"accuracy": safe_ratio0(tp + tn, n), "precision": safe_ratio0(tp, tp + fp),
            "recall": safe_ratio0(tp, tp + fn), "f1": safe_ratio0(2 * tp, 2 * tp + fp + fn)}
    r = (lambda x: round_half_up(x, digits)) if digits is not None else (lambda x: x)
    return c.select(*group, "n", *[r(v).alias(k) for k, v in vals.items()])


def confusion_matrix(scored: DataFrame, label: str = "label", pred: str = "prediction",
                     group: Sequence[str] = ("model_name",)) -> DataFrame:
    return _counts(scored, label, pred, group).select(
        *group, "true_negative", "false_positive", "false_negative", "true_positive")


def prediction_stats(scored: DataFrame, label: str = "label", pred: str = "prediction",
                     group: Sequence[str] = ("model_name",)) -> DataFrame:
    return scored.groupBy(*group).agg(
        F.count_if(F.col(pred) == 1).alias("positive_predictions"),
        F.count_if(F.col(pred) == 0).alias("negative_predictions"),
        F.avg(F.col(pred).cast("double")).alias("positive_rate"),
        F.avg(F.col(label).cast("double")).alias("actual_positive_rate"),
        F.count(F.lit(1)).alias("test_samples"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score",
            group: Sequence[str] = ("model_name",), digits: int | None = None) -> DataFrame:
    """Area under the ROC curve with tied scores counted half (Mann-Whitney form).

    Rows are first collapsed per distinct score (partial aggregate), then the
    negatives below each score come from a range-cut ordered prefix sum, so
    no global sort runs in one task. Rows without a score are left out, of
    positives and negatives alike. NULL when a class is absent.
    """
    g = list(group)
    per_score = materialize(scored.where(F.col(score).isNotNull()).groupBy(*g, F.col(score).cast("double").alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n")))
    ranked = ordered_prefix_sum(per_score, ["_s"], "_n", "_neg_below", partition_cols=g)
    out = ranked.groupBy(*g).agg(
        F.sum(F.col("_p") * (F.col("_neg_below") + F.col("_n") / F.lit(2.0))).alias("_num"),
        F.sum("_p").alias("_P"), F.sum("_n").alias("_N"))
    auc = try_ratio(F.col("_num"), F.col("_P") * F.col("_N"))
    auc = round_half_up(auc, digits) if digits is not None else auc
    return out.select(*g, auc.alias("roc_auc"))


def model_performance(scored: DataFrame, label: str = "label", pred: str = "prediction",
                      score: str = "score", group: Sequence[str] = ("model_name",)) -> DataFrame:
    """Metrics table: one row per model with accuracy, precision, recall, f1, roc_auc."""
    m = binary_metrics(scored, label, pred, group, digits=None)
    a = roc_auc(scored, label, score, group)
    return m.join(a, list(group), "left")


def select_best(perf: DataFrame, metric: str = "roc_auc", order_col: str = "model_seq",
                name_col: str = "model_name") -> DataFrame:
    """Argmax row by ``metric`` (missing = 0); ties go to the first in ``order_col``."""
    return perf.orderBy(F.coalesce(F.col(metric), F.lit(0.0)).desc(), F.col(order_col).asc()).limit(1)


def compare_models(perf: DataFrame, metric: str = "roc_auc", order_col: str = "model_seq",
                   name_col: str = "model_name", digits: int = 4) -> DataFrame:
    """Comparison table (rounded) with an ``is_best`` flag from :func:`select_best`."""
    best = select_best(perf, metric, order_col, name_col).select(F.col(name_col).alias("_best"))
    r = lambda c: round_half_up(F.coalesce(F.col(c), F.lit(0.0)), digits).alias(c)
    return perf.crossJoin(F.broadcast(best)).select(
        name_col, r("accuracy"), r("f1"), r("roc_auc"), (F.col(name_col) == F.col("_best")).alias("is_best"))


def cv_summary(folds: DataFrame, metric: str = "roc_auc", group: Sequence[str] = ("model_name",)) -> DataFrame:
    """Mean and population std of per-fold scores."""
    return folds.groupBy(*group).agg(F.avg(metric).alias("cv_mean"), F.stddev_pop(metric).alias("cv_std"))
