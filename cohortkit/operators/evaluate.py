"""Evaluation of predictions.

Metrics are one aggregation over the prediction table; rank-based metrics
(AUC, ROC points) first collapse rows to one per distinct score and use the
skew-safe running sum over those.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import windows as Wn
from ..session import materialize
from .stats import kl_divergence


def _div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def binary_metrics(df: DataFrame, actual: str, pred: str, positive=1, group_cols: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 (zero division -> 0), one row a group."""
    a, p = F.col(actual) == positive, F.col(pred) == positive
    c = df.groupBy(*group_cols).agg(F.count_if(a & p).alias("tp"), F.count_if(~a & p).alias("fp"),
               F.count_if(a & ~p).alias("fn"), F.count_if(~a & ~p).alias("tn"))
    prec = _div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(*group_cols, "tp", "fp", "fn", "tn",
                    ((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    _div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def _score_counts(df: DataFrame, actual: str, score: str, positive=1, group_cols: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_cols, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(actual) == positive).alias("pos"), F.count_if(F.col(actual) != positive).alias("neg"))


def roc_auc(df: DataFrame, actual: str, score: str, positive=1, group_cols: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC with ties counted half (mid-rank), one row a group:
    ``sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)``."""
    sc = _score_counts(df, actual, score, positive, group_cols)
    r = Wn.running_sum(sc, list(group_cols), ["score"], {"__negbelow": F.col("neg")}, inclusive=False)
    return r.groupBy(*group_cols).agg((F.sum(F.col("pos") * (F.col("__negbelow") + F.col("neg") / 2.0))
                  / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"),
                 F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))


def roc_curve(df: DataFrame, actual: str, score: str, positive=1) -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score, highest first,
    plus the start point (threshold +inf, 0, 0).  Intermediate collinear
    points are kept."""
    sc = _score_counts(df, actual, score, positive)
    r = Wn.running_sum(sc, [], ["score"], {"__tp": F.col("pos"), "__fp": F.col("neg")}, descending=True)
    P = sc.agg(F.sum("pos")).scalar()
    N = sc.agg(F.sum("neg")).scalar()
    pts = r.select(F.col("score").alias("threshold"), (F.col("__fp") / N).alias("fpr"), (F.col("__tp") / P).alias("tpr"))
    start = sc.limit(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def confusion_matrix(df: DataFrame, actual: str, pred: str, labels: Sequence) -> DataFrame:
    """``(actual, predicted, count)`` over the full label grid (zeros
    included); rows outside ``labels`` are not counted."""
    lab = list(labels)
    c = df.where(F.col(actual).isin(lab) & F.col(pred).isin(lab)).groupBy(
        F.col(actual).alias("actual"), F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("count"))
    arr = F.array(*[F.lit(x) for x in lab])
    grid = df.sparkSession.range(1).select(F.explode(arr).alias("actual")).select(
        "actual", F.explode(arr).alias("predicted"))
    return grid.join(c, ["actual", "predicted"], "left").select("actual", "predicted",
                                                                F.coalesce("count", F.lit(0)).alias("count"))


def classification_report(df: DataFrame, actual: str, pred: str, labels: Sequence) -> DataFrame:
    """E5: per class precision, recall, F1, support; then ``macro avg`` and
    ``weighted avg`` rows (class as text)."""
    cm = materialize(confusion_matrix(df, actual, pred, labels))  # labels^2 rows, read three times
    tp = cm.where(F.col("actual") == F.col("predicted")).select(F.col("actual").alias("c"), F.col("count").alias("tp"))
    sup = cm.groupBy(F.col("actual").alias("c")).agg(F.sum("count").alias("support"))
    prd = cm.groupBy(F.col("predicted").alias("c")).agg(F.sum("count").alias("npred"))
    per = tp.join(sup, "c").join(prd, "c").select(
        F.col("c").cast("string").alias("class"), "support",
        _div(F.col("tp"), F.col("npred")).alias("precision"), _div(F.col("tp"), F.col("support")).alias("recall"),
        _div(2 * F.col("tp"), F.col("support") + F.col("npred")).alias("f1"))
    tot = per.agg(F.sum("support")).scalar()
    macro = per.agg(F.lit("macro avg").alias("class"), F.sum("support").alias("support"),
                    F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"))
    weighted = per.agg(F.lit("weighted avg").alias("class"), F.sum("support").alias("support"),
                       *[(F.sum(F.col(m) * F.col("support")) / tot).alias(m) for m in ("precision", "recall", "f1")])
    return per.unionByName(macro).unionByName(weighted)


def weighted_f1(df: DataFrame, actual: str, pred: str, labels: Sequence) -> DataFrame:
    """E6."""
    return classification_report(df, actual, pred, labels).where(F.col("class") == "weighted avg") \
        .select(F.col("f1").alias("weighted_f1"))


def ordinal_report(df: DataFrame, actual: str, pred: str, labels: Sequence = (1, 2, 3, 4, 5)) -> DataFrame:
    """Accuracy, total / mean absolute error, RMSE, KL, weighted F1 and
    counts of values outside the label range (the range warnings)."""
    lo, hi = min(labels), max(labels)
    d = F.col(pred) - F.col(actual)
    m = df.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(actual) == F.col(pred)).cast("double")).alias("accuracy"),
               F.sum(F.abs(d)).cast("double").alias("total_abs_error"), F.avg(F.abs(d)).alias("mae"),
               F.sqrt(F.avg(d * d)).alias("rmse"),
               F.count_if((F.col(actual) < lo) | (F.col(actual) > hi)).alias("actual_out_of_range"),
               F.count_if((F.col(pred) < lo) | (F.col(pred) > hi)).alias("pred_out_of_range"))
    kl = kl_divergence(df, actual, pred, labels).select("kl_divergence")
    wf = weighted_f1(df, actual, pred, labels)
    return m.withColumn("kl_divergence", kl.scalar()).withColumn("weighted_f1", wf.scalar())


def rmse(df: DataFrame, actual: str, raw: str) -> DataFrame:
    """RMSE on raw (unrounded) predictions."""
    return df.agg(F.sqrt(F.avg((F.col(raw) - F.col(actual)) ** 2)).alias("rmse"))


def compare_to_baseline(metrics: DataFrame, baseline: str, model_col: str = "model") -> DataFrame:
    """Long metrics ``(model, metric, value)`` with ``delta`` = value
    minus the baseline model's value for the same metric."""
    b = metrics.where(F.col(model_col) == baseline).select("metric", F.col("value").alias("__base"))
    return metrics.join(b, "metric", "left").withColumn("delta", F.col("value") - F.col("__base")).drop("__base")


def with_baseline(df: DataFrame, baseline_col: str) -> DataFrame:
    """Rows where the baseline prediction exists."""
    return df.where(F.col(baseline_col).isNotNull())
