"""Classifier metrics as distributed aggregates (AGG-7..AGG-11).

Nothing is collected to the driver: each metric is a Spark aggregate over
(label, prediction, score) rows, so it scales with the prediction set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.change import class_name
from tickflow.operators.index import MAX_GROUP_ROWS, running_totals


def confusion_matrix(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """AGG-7: counts per (actual, predicted) class, with class names."""
    g = df.groupBy(F.col(label).cast("int").alias("actual"),
                   F.col(prediction).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    return g.select("actual", "predicted", class_name(F.col("actual")).alias("actual_name"),
                    class_name(F.col("predicted")).alias("predicted_name"), "n")


def _ratio(num: Column, den: Column) -> Column:
    """0 when the denominator is 0 (the zero-division convention)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """AGG-8: accuracy, precision, recall and F1 for class 1 in one pass."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    c = df.agg(F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).cast("long").alias("tp"),
               F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).cast("long").alias("fp"),
               F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).cast("long").alias("tn"),
               F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).cast("long").alias("fn"))
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return c.select("tp", "fp", "tn", "fn",
                    _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                    precision.alias("precision"), recall.alias("recall"),
                    _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def score_counts(df: DataFrame, label: str = "target", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score (partial + final aggregate)."""
    y = F.col(label).cast("int")
    return df.filter(y.isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(y == 1, 0).otherwise(1)).cast("long").alias("neg"))


def auc_roc(df: DataFrame, label: str = "target", score: str = "score",
            max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """AGG-9, exact: Mann-Whitney U with average ranks for tied scores.

    AUC = sum over distinct scores s of pos(s) * (neg_below(s) + neg(s)/2)
    divided by P*N. ``neg_below`` is a global running total over the sorted
    distinct scores (``index.running_totals``: one window when the
    distinct-score table is measured to fit a task, quantile slices
    otherwise). The numerator is kept in integers (twice the value) so the
    result is exact. Null when one class is absent."""
    cum = running_totals(score_counts(df, label, score), ["score"], ["neg"],
                         max_group_rows=max_group_rows)
    wide = "decimal(19,0)"       # products of counts, beyond the range of long
    twice = F.col("pos").cast(wide) * (2 * (F.col("neg_cum") - F.col("neg"))
                                       + F.col("neg")).cast(wide)
    agg = cum.agg(F.sum(twice.cast("decimal(38,0)")).alias("_u2"), F.sum("pos").cast("long").alias("n_pos"),
                  F.sum("neg").cast("long").alias("n_neg"))
    return agg.select(F.try_divide(F.col("_u2").cast("double"),
                                   F.lit(2.0) * F.col("n_pos").cast("double")
                                   * F.col("n_neg").cast("double"))
                      .alias("auc"), "n_pos", "n_neg")


def log_loss(df: DataFrame, label: str = "target", prob: str = "score",
             eps: float = 1e-15) -> DataFrame:
    """AGG-10: mean binary cross-entropy, probabilities clipped to [eps, 1-eps]."""
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    term = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    return df.agg(F.avg(term).alias("log_loss"), F.count(F.lit(1)).alias("n"))


def _binned(df: DataFrame, label: str, score: str, bins: int) -> DataFrame:
    """Scores cut into ``bins`` equal-width bins on [0, 1]: the curve tables
    have at most bins + 1 rows, whatever the number of predictions."""
    clipped = F.least(F.greatest(F.col(score).cast("double"), F.lit(0.0)), F.lit(1.0))
    thr = (F.floor(clipped * bins) / F.lit(float(bins))).alias("threshold")
    y = F.col(label).cast("int")
    return df.filter(y.isNotNull()).groupBy(thr).agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("pos"),
                               F.sum(F.when(y == 1, 0).otherwise(1)).cast("long").alias("neg"))


def _cumulated(df: DataFrame, label: str, score: str, bins: int | None,
               max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """(threshold, tp, fp, pos, neg, p, n) per bin, or per distinct score with
    ``bins=None`` (global running totals, two totals read by the driver)."""
    if bins is None:
        counts = score_counts(df, label, score).filter(F.col("score").isNotNull())
        cum = running_totals(counts, ["score"], ["pos", "neg"], max_group_rows=max_group_rows)
        p, n = cum.agg(F.sum("pos"), F.sum("neg")).first()
        p, n = F.lit(p).cast("long"), F.lit(n).cast("long")
        return cum.select(F.col("score").alias("threshold"),
                          (p - F.col("pos_cum") + F.col("pos")).alias("tp"),
                          (n - F.col("neg_cum") + F.col("neg")).alias("fp"), "pos", "neg",
                          p.alias("p"), n.alias("n"))
    b = _binned(df, label, score, bins)
    down = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    alls = Window.partitionBy(F.lit(1))
    return b.select("threshold", F.sum("pos").over(down).alias("tp"),
                    F.sum("neg").over(down).alias("fp"), "pos", "neg",
                    F.sum("pos").over(alls).alias("p"), F.sum("neg").over(alls).alias("n"))


def roc_points(df: DataFrame, label: str = "target", score: str = "score",
               bins: int | None = 100) -> DataFrame:
    """AGG-11: (threshold, fpr, tpr) for 'predict 1 when score >= threshold';
    one point per distinct score with ``bins=None``."""
    c = _cumulated(df, label, score, bins)
    return c.select("threshold", F.try_divide(F.col("fp").cast("double"), F.col("n")).alias("fpr"),
                    F.try_divide(F.col("tp").cast("double"), F.col("p")).alias("tpr"))


def pr_points(df: DataFrame, label: str = "target", score: str = "score",
              bins: int | None = 100) -> DataFrame:
    """AGG-11: (threshold, precision, recall); one point per distinct score
    with ``bins=None``."""
    c = _cumulated(df, label, score, bins)
    return c.select("threshold",
                    F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
                    .alias("precision"),
                    F.try_divide(F.col("tp").cast("double"), F.col("p")).alias("recall"))


def auc_pr(df: DataFrame, label: str = "target", score: str = "score",
           max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """AGG-10, exact: area under the precision-recall points of all distinct
    scores, by trapezoids from recall 0 and precision 1. A point's
    predecessor follows from its own counts, so no ordered pass is needed."""
    c = _cumulated(df, label, score, None, max_group_rows)
    tp, fp = F.col("tp"), F.col("fp")
    here = F.try_divide(tp.cast("double"), tp + fp)
    was = F.coalesce(F.try_divide((tp - F.col("pos")).cast("double"),
                                  tp - F.col("pos") + fp - F.col("neg")), F.lit(1.0))
    part = F.try_divide(F.col("pos").cast("double"), F.col("p")) * (here + was) / 2
    return c.agg(F.sum(part).alias("area"))


def auc_from_curve(points: DataFrame, x: str = "fpr", y: str = "tpr",
                   start: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Trapezoid area under a curve table of at most bins + 1 points (binned
    AUC, or area under PR with x = recall, y = precision), starting from the
    point ``start``."""
    w = Window.orderBy(x, F.desc(y))
    seg = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        ((F.col(x) - F.lag(x, 1, start[0]).over(w))
         * (F.col(y) + F.lag(y, 1, start[1]).over(w)) / 2).alias("_a"))
    return seg.agg(F.sum("_a").alias("area"))
