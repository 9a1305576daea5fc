"""Model queries. SQL cannot fit trees, but what is fitted can be checked: the
trees are read as rows and walked by joins, and an oracle states which rows must
come back and that both ways agree.

Training rows: the 5-minute feature table per symbol; out-of-time split
(the last days are the test set, Q8), 80/20 hash validation flag (ML-1),
folds by week (ML-6)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickflow.ml import boosting as B
from tickflow.ml import model as ML
from tickflow.operators import metrics as M
from tickflow.operators import split as S
from tickflow.operators.joins import keyed_outer_join
from tickflow.operators.lags import REFERENCE_HORIZONS
from tickflow.operators.labels import feature_table
from tickflow.plans.registry import query
from tickflow.plans.series import _bars, _label_oracle
from tickflow.session import scratch_path, stage

TRAIN_SHARE = 0.8          # the first 80% of the time extent trains, the rest tests
GBT_ITER = 15
PATIENCE = 5               # rounds without improvement that end boosting


def training_sets(spark, sf_dir, share: float = TRAIN_SHARE):
    """(train, test) from one staged feature table: fitting, scoring and the
    evaluators all read it, so it is computed once. The cut lies at ``share``
    of the table's own time extent."""
    f = stage(feature_table(_bars(spark, sf_dir), "5 minutes", REFERENCE_HORIZONS))
    f = S.with_validation_flag(f, ML.ts_to_seconds(F.col("timestamp")))
    f = ML.week_folds(f, "timestamp", 3)
    lo, hi = f.agg(F.min("timestamp"), F.max("timestamp")).first()
    if lo is None:
        return f, f
    cut = F.lit(lo + (hi - lo) * share).cast("timestamp_ntz")
    return f.filter(F.col("timestamp") < cut), f.filter(F.col("timestamp") >= cut)


def fitted(spark, sf_dir, max_iter: int = GBT_ITER, max_depth: int = 4):
    """(model, feature names, train, test), all from one staged table: fit on the
    train rows outside the validation set, cut after the best round on it."""
    train, test = training_sets(spark, sf_dir)
    names = ML.feature_columns(train)
    with ML.training_rows(train) as data:
        model, _, _ = B.fit_by_rounds(ML.gbt_pipeline(
            names, max_iter=max_iter, max_depth=max_depth, validation_col=None), data,
            patience=PATIENCE)
    return model, names, train, test


@query("gbt_predictions", ("ML-2", "ML-3", "ML-4", "PRJ-12", "PRJ-13", "PRJ-14", "FLT-1"))
def gbt_predictions(spark, sf_dir):
    """Boosted trees fit on the train period (cut after the best round on the hash
    validation rows), test period scored; keys carried through."""
    model, _, _, test = fitted(spark, sf_dir)
    p = ML.predict(model, test)
    return p.select("symbol", "timestamp", "price", "target", "prediction", "prob_1")


_LABELLED = _label_oracle("5 minutes", REFERENCE_HORIZONS, 3, "15m")
TEST_ROWS_SQL = f"""
WITH l AS ({_LABELLED}),
c AS (SELECT min(timestamp) + to_microseconds(CAST(round((epoch_us(max(timestamp))
       - epoch_us(min(timestamp))) * {TRAIN_SHARE}) AS BIGINT)) AS cut FROM l)"""


@query("gbt_scored_rows", ("ML-4", "PRJ-13", "PRJ-14", "FLT-1"), oracle=TEST_ROWS_SQL + """
SELECT symbol, timestamp, price, target, true AS scored FROM l, c WHERE timestamp >= cut""")
def gbt_scored_rows(spark, sf_dir):
    """Every test row comes back from scoring with its keys, price and label,
    and with a class and probabilities that sum to one."""
    model, _, _, test = fitted(spark, sf_dir)
    p = ML.predict(model, test)
    scored = F.col("prediction").isin(0.0, 1.0) & (
        F.abs(F.col("prob_0") + F.col("prob_1") - 1) < 1e-9)
    return p.select("symbol", "timestamp", "price", "target", scored.alias("scored"))


# The feature columns of the reference's horizons.
FEATURES_SQL = ("'percent_change_15m', 'percent_change_30m', 'percent_change_1h', "
                "'percent_change_6h', 'percent_change_12h', 'percent_change_24h'")
KEY = ["symbol", "timestamp"]


def walked(model, rows):
    """Rows with MLlib's margin, the walked one, and whether they agree."""
    own = B.with_margin(model, rows).select(*KEY, "target", "own_margin", "prediction")
    return own.join(B.margins(model, rows, KEY), KEY, "left").withColumn("agrees", F.coalesce(
        F.abs(F.col("margin") - F.col("own_margin")) <= 1e-9, F.lit(False)))


@query("gbt_margins", ("ML-2", "ML-4", "SCL-15"), oracle=TEST_ROWS_SQL + """
SELECT symbol, timestamp, target, true AS agrees FROM l, c WHERE timestamp >= cut""")
def gbt_margins(spark, sf_dir):
    """Every test row, scored by MLlib and by walking the stored trees with joins:
    whether both margins agree to 1e-9."""
    model, _, _, test = fitted(spark, sf_dir)
    return walked(model, test).select(*KEY, "target", "agrees")


@query("gbt_confusion", ("AGG-7", "ML-8"), oracle=TEST_ROWS_SQL + """
SELECT CAST(target AS INTEGER) AS actual, COUNT(*) AS n, true AS cells_agree
FROM l, c WHERE timestamp >= cut GROUP BY 1""")
def gbt_confusion(spark, sf_dir):
    """The confusion matrix on the test rows by actual class, and whether each of
    its cells equals the count of rows whose walked margin says so."""
    model, _, _, test = fitted(spark, sf_dir)
    both = stage(walked(model, test))
    cells = M.confusion_matrix(both, label="target", prediction="prediction")
    own = both.groupBy(F.col("target").cast("int").alias("actual"),
                       (F.col("margin") > 0).cast("int").alias("predicted")).agg(
        F.count("*").alias("own"))
    return cells.select(F.col("actual").cast("int").alias("actual"),
                        F.col("predicted").cast("int").alias("predicted"), "n").join(
        own, ["actual", "predicted"], "full_outer").groupBy("actual").agg(
        F.sum("n").cast("long").alias("n"),
        F.min(F.coalesce("n", F.lit(0)) == F.coalesce("own", F.lit(0))).alias("cells_agree"))


ROUNDS = 12


def fitted_by_rounds(spark, sf_dir, rounds: int = ROUNDS, patience: int = PATIENCE):
    """(model of all rounds, its losses, rounds kept, validation rows)"""
    train, _ = training_sets(spark, sf_dir)
    names = ML.feature_columns(train)
    with ML.training_rows(train) as data:
        whole = ML.gbt_pipeline(names, max_iter=rounds, max_depth=4, step_size=0.3,
                                validation_col=None).fit(data.filter("not isVal"))
        held = stage(data.filter("isVal"))
    curve = B.losses(whole, held)
    return whole, curve, B.best_round(curve, patience), held


@query("boosting_curve", ("ML-3",))
def boosting_curve(spark, sf_dir):
    """Loss on the validation rows after each round; the best round before
    ``PATIENCE`` rounds without improvement is kept."""
    _, curve, kept, _ = fitted_by_rounds(spark, sf_dir)
    return spark.createDataFrame([(i, float(v), i == kept) for i, v in enumerate(curve, 1)],
                                 "round int, loss double, is_kept boolean")


@query("boosting_rounds", ("ML-3", "ML-2"), oracle=f"""
SELECT CAST(r AS INTEGER) AS round, true AS loss_agrees, true AS cut_agrees
FROM range(1, {ROUNDS + 1}) t(r)""")
def boosting_rounds(spark, sf_dir):
    """Per round: whether the loss recomputed from the walked trees is the curve's,
    and whether the model cut to the kept round scores the validation rows as
    the walked prefix of that many trees does."""
    whole, curve, kept, held = fitted_by_rounds(spark, sf_dir)
    own = B.losses_from_nodes(whole, held, KEY)
    short = B.with_margin(B.cut(whole, kept), held).select(*KEY, "own_margin")
    prefix = B.staged_margins(whole, held, KEY).filter(F.col("round") == kept)
    same = short.join(prefix, KEY, "left").agg(F.coalesce(F.min(F.coalesce(
        F.abs(F.col("margin") - F.col("own_margin")) <= 1e-9, F.lit(False))), F.lit(True)).alias(
            "cut_agrees"))
    losses = spark.createDataFrame(list(enumerate(map(float, curve), 1)), "round int, curve double")
    return losses.join(own, "round", "left").join(F.broadcast(same)).select(
        "round", F.coalesce(F.abs(F.col("loss") - F.col("curve")) <= 1e-9, F.lit(False)).alias(
            "loss_agrees"), "cut_agrees")


@query("cv_best", ("ML-5", "ML-6"))
def cv_best(spark, sf_dir, rounds=(2, 4, 6), grid=ML.small_grid):
    """3-fold (by week) cross-validation over ``grid`` times ``rounds`` with one fit
    a grid point and fold, by default 2x2 points of up to 6 trees: mean AUC per
    point, and the best model's AUC on the test period."""
    train, test = training_sets(spark, sf_dir)
    pipe = ML.gbt_pipeline(ML.feature_columns(train), validation_col=None)
    with ML.training_rows(train.drop("isVal")) as data:
        points, best = B.tune_by_rounds(pipe, grid(ML.gbt_of(pipe)), list(rounds), data,
                                        parallelism=4)
    return ML.cv_table(spark, pipe, points, best, test)


NET = {"reg": 0.01, "elastic_net": 0.5}


@query("elastic_net_optimum", ("ML-5",), oracle=f"""
SELECT unnest(['intercept', {FEATURES_SQL}]) AS feature, true AS holds""")
def elastic_net_optimum(spark, sf_dir):
    """Logistic regression with L1 and L2 penalties on the training rows: whether
    every coefficient meets the optimum's subgradient condition."""
    train, _ = training_sets(spark, sf_dir)
    names = ML.feature_columns(train)
    with ML.training_rows(train) as data:
        model = ML.fit(ML.logistic_pipeline(names, **NET), data)
        return stage(B.elastic_net_conditions(model, data, **NET).select("feature", "holds"))


@query("importance_from_gains", ("ML-7",), oracle=f"""
SELECT unnest([{FEATURES_SQL}]) AS feature, true AS agrees, true AS adds_up""")
def importance_from_gains(spark, sf_dir):
    """Per feature: whether the model's importance equals the share of its gains
    in the stored trees, and whether all shares add up to one."""
    model, names, _, _ = fitted(spark, sf_dir)
    own = B.importances_from_gains(model).withColumnRenamed("importance", "own")
    both = ML.feature_importances(spark, model, names).join(own, "feature", "full_outer")
    total = F.abs(F.sum("own").over(Window.partitionBy()) - 1) <= 1e-9
    return both.select("feature", F.coalesce(
        F.abs(F.col("importance") - F.col("own")) <= 1e-9, F.lit(False)).alias("agrees"),
        total.alias("adds_up"))


@query("score_report_check", ("ML-8", "AGG-8", "AGG-9"), oracle="""
SELECT unnest(['accuracy', 'f1', 'precision', 'recall', 'test_auc']) AS metric, true AS agrees""")
def score_report_check(spark, sf_dir):
    """Each value of the score report beside the same from the walked margins:
    counts for the rates, rank sums with average ties for the area under ROC."""
    model, _, train, test = fitted(spark, sf_dir)
    report = ML.score_report(spark, model, ML.predict(model, train), ML.predict(model, test))
    rows = stage(B.margins(model, test, KEY).join(test.select(*KEY, "target"), KEY))
    hit, yes = F.col("margin") > 0, F.col("target") == 1
    # Rows at or below each score, by a running sum over distinct scores.
    at = rows.groupBy("margin").agg(F.count("*").alias("m"), F.sum(yes.cast("long")).alias("p"))
    at = at.withColumn("upto", F.sum("m").over(Window.orderBy("margin"))).agg(
        F.sum(F.col("p") * (F.col("upto") - (F.col("m") - 1) / 2)).alias("s"),
        F.sum("p").alias("p"), F.sum(F.col("m") - F.col("p")).alias("q")).select(F.try_divide(
            F.col("s") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * F.col("q")).alias("test_auc"))
    n = rows.agg(F.count("*").alias("all"), *[F.sum(c.cast("long")).alias(k) for k, c in (
        ("tp", hit & yes), ("fp", hit & ~yes), ("fn", ~hit & yes))])

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    own = n.select(ratio(F.col("all") - fp - fn, F.col("all")).alias("accuracy"),
                   ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                   ratio(tp, tp + (fp + fn) / 2).alias("f1")).join(at)
    names = ["accuracy", "f1", "precision", "recall", "test_auc"]
    both = report.select(*[F.col(c).alias(f"r_{c}") for c in names]).join(own)
    same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) | F.coalesce(
        F.abs(F.col(c) - F.col(f"r_{c}")) <= 1e-9, F.lit(False)) for c in names]
    return both.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), s.alias("agrees"))
                                           for c, s in zip(names, same, strict=True)])).alias(
        "r")).select("r.*")


@query("feature_importance", ("ML-7",))
def feature_importance(spark, sf_dir):
    """Importance of each of the six change features."""
    model, names, _, _ = fitted(spark, sf_dir)
    return ML.feature_importances(spark, model, names)


@query("score_report", ("ML-8", "AGG-8", "AGG-9"))
def score_report(spark, sf_dir):
    """Train/test AUC, test accuracy/precision/recall/F1 and fitted params."""
    model, _, train, test = fitted(spark, sf_dir)
    return ML.score_report(spark, model, ML.predict(model, train), ML.predict(model, test))


@query("model_roundtrip", ("SNK-5", "SNK-6", "JON-2"))
def model_roundtrip(spark, sf_dir):
    """Save the fitted pipeline (time-stamped path), load it back, score the
    test period, and align with the original model's predictions by key."""
    model, _, _, test = fitted(spark, sf_dir)
    path = ML.save_model(model, scratch_path(spark, "model"))
    again = ML.load_model(path)
    a = ML.predict(model, test).select("symbol", "timestamp", F.col("prob_1").alias("prob_a"))
    b = ML.predict(again, test).select("symbol", "timestamp", F.col("prob_1").alias("prob_b"))
    return keyed_outer_join(a, b, ["symbol", "timestamp"]).withColumn(
        "same", F.col("prob_a") == F.col("prob_b"))
