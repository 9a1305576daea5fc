import random

import pytest

from tickflow.operators import metrics as M


def _scored(spark, rows):
    return spark.createDataFrame(rows, "target int, prediction int, score double")


def _brute_auc(rows):
    pos = [s for y, _, s in rows if y == 1]
    neg = [s for y, _, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("limit", [None, 1000])
def test_auc_matches_pairwise_count_with_ties(spark, limit):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 1), 0, round(rnd.random(), 2)) for _ in range(400)]
    got = M.auc_roc(_scored(spark, rows), max_group_rows=limit).first()
    assert got["auc"] == pytest.approx(_brute_auc(rows), abs=1e-12)
    assert got["n_pos"] + got["n_neg"] == 400


def test_auc_undefined_for_one_class(spark):
    got = M.auc_roc(_scored(spark, [(1, 1, 0.3), (1, 0, 0.6)])).first()
    assert got["auc"] is None


def test_auc_agrees_with_mllib_exact(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), 0, round(rnd.random(), 3)) for _ in range(500)]
    df = _scored(spark, rows)
    ev = BinaryClassificationEvaluator(labelCol="target", rawPredictionCol="score", numBins=0)
    assert M.auc_roc(df).first()["auc"] == pytest.approx(
        ev.evaluate(df.withColumn("target", df.target.cast("double"))), abs=1e-12)


def test_no_predicted_positive_gives_zero_precision(spark):
    m = M.binary_metrics(_scored(spark, [(1, 0, 0.1), (0, 0, 0.2)])).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["accuracy"] == 0.5


def test_confusion_matrix_counts(spark):
    cm = {(r["actual_name"], r["predicted_name"]): r["n"] for r in M.confusion_matrix(
        _scored(spark, [(1, 1, 0.0), (1, 0, 0.0), (0, 0, 0.0), (0, 0, 0.0)])).collect()}
    assert cm == {("buy", "buy"): 1, ("buy", "sell"): 1, ("sell", "sell"): 2}


def test_roc_curve_ends_at_one(spark):
    rnd = random.Random(2)
    rows = [(rnd.randint(0, 1), 0, rnd.random()) for _ in range(300)]
    pts = M.roc_points(_scored(spark, rows), bins=10).orderBy("threshold").collect()
    assert pts[0]["tpr"] == 1.0 and pts[0]["fpr"] == 1.0
    assert len(pts) <= 11


def test_log_loss_clips(spark):
    ll = M.log_loss(_scored(spark, [(1, 1, 1.0), (0, 0, 0.0)])).first()["log_loss"]
    assert ll == pytest.approx(0.0, abs=1e-12)


def test_binned_roc_area_close_to_exact_auc(spark):
    rnd = random.Random(9)
    rows = [(y, 0, min(max(rnd.gauss(0.4 + 0.2 * y, 0.15), 0.0), 0.999)) for y in
            (rnd.randint(0, 1) for _ in range(2000))]
    df = _scored(spark, rows)
    exact = M.auc_roc(df).first()["auc"]
    pts = M.roc_points(df, bins=1000)
    area = M.auc_from_curve(pts, "fpr", "tpr").first()["area"]
    assert area == pytest.approx(exact, abs=2e-3)
