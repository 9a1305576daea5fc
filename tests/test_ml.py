import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tickflow.ml import boosting as B
from tickflow.ml import model as ML
from tickflow.plans.models import training_sets
from tickflow.session import scratch_path


@pytest.fixture(scope="module")
def fitted(spark):
    train, test = training_sets(spark, SF01)
    names = ML.feature_columns(train)
    assert names == ["percent_change_15m", "percent_change_30m", "percent_change_1h",
                     "percent_change_6h", "percent_change_12h", "percent_change_24h"]
    pipe = ML.gbt_pipeline(names, max_iter=5, max_depth=3, validation_col=None)
    return ML.fit(pipe, train), names, train, test


def test_predict_keeps_keys_and_probabilities(fitted):
    model, _, _, test = fitted
    p = ML.predict(model, test)
    r = p.first()
    assert r["prob_0"] + r["prob_1"] == pytest.approx(1.0)
    assert p.count() == test.count()


def test_save_load_same_predictions(spark, fitted):
    model, _, _, test = fitted
    path = ML.save_model(model, scratch_path(spark, "test_model"))
    again = ML.load_model(path)
    a = ML.predict(model, test).select("symbol", "timestamp", F.col("prob_1").alias("a"))
    b = ML.predict(again, test).select("symbol", "timestamp", F.col("prob_1").alias("b"))
    assert a.join(b, ["symbol", "timestamp"]).filter("a != b").count() == 0


def test_save_without_model_fails():
    with pytest.raises(ValueError):
        ML.save_model(None, "/nonexistent")


def test_report_row(spark, fitted):
    model, names, train, test = fitted
    r = ML.score_report(spark, model, ML.predict(model, train), ML.predict(model, test)).first()
    assert 0.0 <= r["test_auc"] <= 1.0 and "maxIter" in r["params"]
    imp = ML.feature_importances(spark, model, names).collect()
    assert len(imp) == 6 and abs(sum(x["importance"] for x in imp) - 1.0) < 1e-6


def test_empty_training_set_fails_clearly(spark):
    from conftest import SF001
    train, _ = training_sets(spark, SF001)   # 24h lag inside weeks leaves no rows here
    with pytest.raises(ValueError, match="no training rows"):
        ML.training_rows(train).__enter__()


def test_rows_with_nulls_are_scored_without_a_prediction(spark, fitted):
    model, names, _, test = fitted
    two = test.limit(1).unionByName(test.limit(1).withColumn(names[0], F.lit(None).cast("double")))
    got = ML.predict(model, two).select("prediction", "prob_1").collect()
    assert len(got) == 2
    assert sorted(r["prediction"] is None for r in got) == [False, True]


def test_batch_and_stream_messages_score_alike(spark, fitted):
    from tickflow.plans.streams import scored_ticks, tick_messages
    model, _, _, test = fitted
    a = ML.predict(model, test).select("symbol", "timestamp", F.round("prob_1", 6).alias("a"))
    b = scored_ticks(tick_messages(test), model).select(
        "symbol", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.round("prob_1", 6).alias("b"))
    both = a.join(b, ["symbol", "timestamp"], "full_outer")
    assert both.count() == test.count() and both.filter("not (a <=> b)").count() <= 0.01 * both.count()


def test_default_grid_grows_trees_of_more_than_one_leaf():
    grid = ML.reference_grid(ML.gbt_of(ML.gbt_pipeline(["percent_change_1h"])))
    assert max(v for g in grid for p, v in g.items() if p.name == "minInfoGain") < 0.5


KEY = ["symbol", "timestamp"]


def test_training_rows_are_let_go(spark, fitted):
    _, _, train, _ = fitted
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with ML.training_rows(train) as data:
        assert data.count() and spark.sparkContext._jsc.getPersistentRDDs().size() > before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_walked_trees_score_as_the_model_does(fitted):
    model, _, _, test = fitted
    both = B.with_margin(model, test).join(B.margins(model, test, KEY), KEY)
    assert both.count() == test.count()
    assert both.filter("abs(margin - own_margin) > 1e-9").count() == 0


def test_a_cut_model_is_the_prefix_of_its_rounds(spark, fitted):
    model, _, _, test = fitted
    stages = B.staged_margins(model, test, KEY)
    for rounds in (1, 3, 5):
        short = B.cut(model, rounds)
        assert len(B.booster(short).trees) == rounds
        both = B.with_margin(short, test).join(stages.filter(f"round = {rounds}"), KEY)
        assert both.count() == test.count()
        assert both.filter("abs(margin - own_margin) > 1e-9").count() == 0
    path = ML.save_model(B.cut(model, 2), scratch_path(spark, "cut_model"))
    again = ML.predict(ML.load_model(path), test).select(*KEY, F.col("prob_1").alias("b"))
    now = ML.predict(B.cut(model, 2), test).select(*KEY, F.col("prob_1").alias("a"))
    assert now.join(again, KEY).filter("a <> b").count() == 0
    with pytest.raises(ValueError):
        B.cut(model, 6)


def test_losses_and_importances_follow_from_the_trees(fitted):
    model, names, train, _ = fitted
    held = train.filter("isVal")
    own = [r["loss"] for r in B.losses_from_nodes(model, held, KEY).orderBy("round").collect()]
    assert own == pytest.approx(B.losses(model, held), abs=1e-9)
    got = {r["feature"]: r["importance"] for r in B.importances_from_gains(model).collect()}
    want = B.booster(model).featureImportances.toArray()
    assert [got[n] for n in names] == pytest.approx(list(want), abs=1e-9)


@pytest.mark.parametrize("curve,patience,kept", [
    ([5, 4, 3, 2], 2, 4), ([5, 4, 6, 6, 1], 2, 2), ([5, 4, 6, 3, 6, 6], 2, 4), ([3, 3, 3], 1, 1),
    ([2], 5, 1), ([], 5, 1), ([float("nan")] * 3, 1, 1), ([4, float("nan"), 3], 2, 3)])
def test_best_round_waits_for_improvement(curve, patience, kept):
    assert B.best_round(curve, patience) == kept


def test_fit_by_rounds_keeps_the_best_prefix(fitted):
    _, names, train, _ = fitted
    pipe = ML.gbt_pipeline(names, max_iter=6, max_depth=3, step_size=0.5, validation_col=None)
    model, curve, kept = B.fit_by_rounds(pipe, train.dropna(subset=names), patience=2)
    assert len(curve) == 6 and len(B.booster(model).trees) == kept == B.best_round(curve, 2)


def test_one_fit_serves_all_numbers_of_trees(fitted):
    """The AUC of the cut fits is that of fits of so many trees."""
    _, names, train, _ = fitted
    pipe = ML.gbt_pipeline(names, max_depth=2, validation_col=None)
    gbt = ML.gbt_of(pipe)
    data = train.dropna(subset=names)
    points, best = B.tune_by_rounds(pipe, ML.small_grid(gbt, (2,), (0.3,)), [1, 3], data)
    assert [r for _, r, _ in points] == [1, 3]
    assert len(B.booster(best).trees) == max(points, key=lambda p: p[2])[1]
    alone, _ = B.tune_by_rounds(pipe, ML.small_grid(gbt, (2,), (0.3,)), [1], data)
    assert alone[0][2] == pytest.approx(points[0][2], abs=1e-9)


@pytest.mark.parametrize("reg,net", [(0.01, 0.5), (0.05, 1.0), (0.001, 0.0)])
def test_elastic_net_is_at_its_optimum_and_a_moved_one_is_not(fitted, reg, net):
    _, names, train, _ = fitted
    model = ML.logistic_pipeline(names, reg=reg, elastic_net=net).fit(train.dropna(subset=names))
    holds = lambda **p: [r["holds"] for r in B.elastic_net_conditions(model, train, **p).collect()]
    assert all(holds(reg=reg, elastic_net=net))
    assert reg > 0.001 or not all(holds(reg=0.05, elastic_net=0.0))
