"""Metric queries. The scored rows are the 5-minute feature table's true
forward label (``target``) against a transparent momentum rule: predict 1
when the last 15-minute change is positive, score = 0.5 + change clipped to
[0, 1]. The metric operators themselves are generic over any scored rows
(the model queries reuse them on GBT output)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.functions.change import direction
from tickflow.operators import metrics as M
from tickflow.operators.lags import REFERENCE_HORIZONS
from tickflow.operators.labels import feature_table
from tickflow.plans.registry import query
from tickflow.plans.series import _bars, _label_oracle

BINS = 100


def scored_rows(spark, sf_dir):
    f = feature_table(_bars(spark, sf_dir), "5 minutes", REFERENCE_HORIZONS)
    pc = F.col("percent_change_15m")
    return f.select("symbol", "timestamp", "target", direction(pc).alias("prediction"),
                    F.least(F.greatest(F.lit(0.5) + pc, F.lit(0.0)), F.lit(1.0)).alias("score"))


_S = f"""(SELECT symbol, timestamp, target,
        CASE WHEN percent_change_15m > 0 THEN 1 ELSE 0 END AS prediction,
        least(greatest(0.5 + percent_change_15m, 0.0), 1.0) AS score
 FROM ({_label_oracle('5 minutes', REFERENCE_HORIZONS, 3, '15m')}) l) s"""


@query("confusion_matrix", ("AGG-7", "SCL-13"), oracle=f"""
SELECT CAST(target AS INTEGER) AS actual, CAST(prediction AS INTEGER) AS predicted,
       CASE WHEN target = 0 THEN 'sell' WHEN target = 1 THEN 'buy' END AS actual_name,
       CASE WHEN prediction = 0 THEN 'sell' WHEN prediction = 1 THEN 'buy' END AS predicted_name,
       COUNT(*) AS n
FROM {_S} GROUP BY 1, 2, 3, 4""")
def confusion_matrix(spark, sf_dir):
    """Counts by (actual, predicted) class."""
    return M.confusion_matrix(scored_rows(spark, sf_dir))


@query("binary_metrics", ("AGG-8",), oracle=f"""
WITH c AS (SELECT
  CAST(SUM(CASE WHEN target = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(SUM(CASE WHEN target = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(SUM(CASE WHEN target = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(SUM(CASE WHEN target = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM {_S})
SELECT tp, fp, tn, fn,
  coalesce(CAST(tp + tn AS DOUBLE) / NULLIF(CAST(tp + fp + tn + fn AS DOUBLE), 0), 0.0) AS accuracy,
  coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
  coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall,
  coalesce(CAST(2 * tp AS DOUBLE) / NULLIF(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1
FROM c""")
def binary_metrics(spark, sf_dir):
    """Accuracy, precision, recall, F1 (class 1) in one aggregate."""
    return M.binary_metrics(scored_rows(spark, sf_dir))


_COUNTS = f"""SELECT score, SUM(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS pos,
       SUM(CASE WHEN target = 1 THEN 0 ELSE 1 END) AS neg FROM {_S} GROUP BY score"""


QUERIES_AUC_SQL = f"""
WITH r AS (SELECT *, SUM(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS neg_cum
           FROM ({_COUNTS}) c)
SELECT CAST(SUM(pos * (2 * (neg_cum - neg) + neg)) AS DOUBLE)
         / NULLIF(CAST(2 * SUM(pos) * SUM(neg) AS DOUBLE), 0) AS auc,
       CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg
FROM r"""


@query("auc_roc", ("AGG-9",), oracle=QUERIES_AUC_SQL)
def auc_roc(spark, sf_dir):
    """Exact area under ROC (Mann-Whitney, tied scores at average rank)."""
    return M.auc_roc(scored_rows(spark, sf_dir))


@query("auc_roc_sliced", ("AGG-9",), oracle=QUERIES_AUC_SQL)
def auc_roc_sliced(spark, sf_dir):
    """auc_roc always through the large-table plan: the running negative
    counts come from quantile slices of the distinct scores, per-slice
    totals and a bounded offset table (no size shortcut)."""
    return M.auc_roc(scored_rows(spark, sf_dir), max_group_rows=None)


@query("log_loss", ("AGG-10",), oracle=f"""
SELECT round(avg(-(target * ln(least(greatest(score, 1e-15), 1 - 1e-15))
            + (1 - target) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)))), 9) AS log_loss,
       COUNT(*) AS n
FROM {_S}""")
def log_loss(spark, sf_dir):
    """Mean cross-entropy of the scores (reported to 9 decimals)."""
    ll = M.log_loss(scored_rows(spark, sf_dir))
    return ll.select(F.round("log_loss", 9).alias("log_loss"), "n")


_CURVE = f"""
WITH b AS (SELECT floor(score * {BINS}) / {float(BINS)} AS threshold,
                  SUM(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS pos,
                  SUM(CASE WHEN target = 1 THEN 0 ELSE 1 END) AS neg
           FROM {_S} GROUP BY 1),
c AS (SELECT threshold,
             SUM(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp,
             SUM(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fp,
             SUM(pos) OVER () AS p, SUM(neg) OVER () AS n FROM b)"""


@query("roc_points", ("AGG-11",), oracle=_CURVE + """
SELECT threshold, CAST(fp AS DOUBLE) / NULLIF(n, 0) AS fpr, CAST(tp AS DOUBLE) / NULLIF(p, 0) AS tpr
FROM c""")
def roc_points(spark, sf_dir):
    """ROC curve over 100 score bins."""
    return M.roc_points(scored_rows(spark, sf_dir), bins=BINS)


@query("pr_points", ("AGG-11", "AGG-10"), oracle=_CURVE + """
SELECT threshold, CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) AS precision,
       CAST(tp AS DOUBLE) / NULLIF(p, 0) AS recall
FROM c""")
def pr_points(spark, sf_dir):
    """Precision-recall curve over 100 score bins."""
    return M.pr_points(scored_rows(spark, sf_dir), bins=BINS)


@query("auc_pr_binned", ("AGG-10", "AGG-11"), oracle=_CURVE + """,
pr AS (SELECT CAST(tp AS DOUBLE) / NULLIF(p, 0) AS recall,
              CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) AS precision FROM c),
s AS (SELECT (recall - lag(recall, 1, 0.0) OVER w) * (precision + lag(precision, 1, 1.0) OVER w) / 2 AS a
      FROM pr WHERE recall IS NOT NULL AND precision IS NOT NULL
      WINDOW w AS (ORDER BY recall, precision DESC))
SELECT round(SUM(a), 12) AS area FROM s""")
def auc_pr_binned(spark, sf_dir):
    """Area under the precision-recall curve (trapezoids over 100 score
    bins, starting at recall 0 / precision 1), reported to 12 decimals."""
    pts = M.pr_points(scored_rows(spark, sf_dir), bins=BINS)
    area = M.auc_from_curve(pts, x="recall", y="precision", start=(0.0, 1.0))
    return area.select(F.round("area", 12).alias("area"))


_EXACT = f"""
WITH k AS (SELECT score AS threshold, SUM(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS pos,
                  SUM(CASE WHEN target = 1 THEN 0 ELSE 1 END) AS neg FROM {_S} GROUP BY 1),
c AS (SELECT threshold,
             SUM(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp,
             SUM(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fp,
             SUM(pos) OVER () AS p, SUM(neg) OVER () AS n FROM k)"""


@query("roc_points_exact", ("AGG-11",), oracle=_EXACT + """
SELECT threshold, CAST(fp AS DOUBLE) / NULLIF(n, 0) AS fpr, CAST(tp AS DOUBLE) / NULLIF(p, 0) AS tpr
FROM c""")
def roc_points_exact(spark, sf_dir):
    """ROC curve with a point per distinct score."""
    return M.roc_points(scored_rows(spark, sf_dir), bins=None)


@query("pr_points_exact", ("AGG-11", "AGG-10"), oracle=_EXACT + """
SELECT threshold, CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) AS precision,
       CAST(tp AS DOUBLE) / NULLIF(p, 0) AS recall
FROM c""")
def pr_points_exact(spark, sf_dir):
    """Precision-recall curve with a point per distinct score."""
    return M.pr_points(scored_rows(spark, sf_dir), bins=None)


@query("auc_pr_exact", ("AGG-10", "AGG-11"), oracle=_EXACT + """,
s AS (SELECT (CAST(tp AS DOUBLE) / p - lag(CAST(tp AS DOUBLE) / p, 1, 0.0) OVER w)
             * (CAST(tp AS DOUBLE) / (tp + fp) + lag(CAST(tp AS DOUBLE) / (tp + fp), 1, 1.0) OVER w)
             / 2 AS a
      FROM c WINDOW w AS (ORDER BY threshold DESC))
SELECT round(SUM(a), 9) AS area FROM s""")
def auc_pr_exact(spark, sf_dir):
    """Exact area under the precision-recall curve, to 9 decimals."""
    return M.auc_pr(scored_rows(spark, sf_dir)).select(F.round("area", 9).alias("area"))
