"""A fitted booster as tables: its trees as rows, walked by joins; its rounds as
prefixes; its importances from gains; and the optimum of the linear estimator.

MLlib's writer stores a node per row, so the model that scores can be checked
by plain relational operators: a row goes down all trees at once, one join a
level. The node table has at most trees times 2^(depth + 1) rows.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickflow.session import scratch_path

BROADCAST_NODES = 1_000_000      # node rows sent to all tasks at most


def booster(model: PipelineModel) -> GBTClassificationModel:
    return [s for s in model.stages if isinstance(s, GBTClassificationModel)][0]


def node_table(model: PipelineModel) -> DataFrame:
    """tree, weight, node, prediction, gain, n (rows seen in fitting), left, right,
    feature, threshold; -1 stands for none. Continuous features only."""
    gbt = booster(model)
    spark = SparkSession.active()
    path = scratch_path(spark, "nodes")
    gbt.write().overwrite().save(path)
    weights = spark.createDataFrame(list(enumerate(map(float, gbt.treeWeights))),
                                    "tree int, weight double")
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), node["prediction"].alias("prediction"),
        node["gain"].alias("gain"), node["impurityStats"][0].alias("n"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold")).join(
            F.broadcast(weights), "tree")


def leaves(model: PipelineModel, rows: DataFrame, key: list[str]) -> DataFrame:
    """key, tree, weight, prediction: the leaf of every tree that each row falls
    into. ``key`` names a row; rows with a null feature are left out."""
    gbt = booster(model)
    features = model.stages[0].getInputCols()
    depth = max(t.depth for t in gbt.trees)
    nodes = node_table(model)
    if len(gbt.trees) * 2 ** (depth + 1) <= BROADCAST_NODES:
        nodes = F.broadcast(nodes)
    at = rows.dropna(subset=features).select(*key, F.array(*features).alias("x"), F.explode(
        F.sequence(F.lit(0), F.lit(len(gbt.trees) - 1))).alias("tree"), F.lit(0).alias("node"))
    for level in range(depth + 1):
        at = at.join(nodes, ["tree", "node"])
        if level < depth:
            after = F.when(F.col("left") < 0, F.col("node")).when(
                F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(
                F.col("right"))
            at = at.select(*key, "x", "tree", after.alias("node"))
    return at.select(*key, "tree", "weight", "prediction")


def margins(model: PipelineModel, rows: DataFrame, key: list[str]) -> DataFrame:
    """key, margin: the weighted sum of a row's leaves."""
    return leaves(model, rows, key).groupBy(*key).agg(
        F.sum(F.col("weight") * F.col("prediction")).alias("margin"))


def staged_margins(model: PipelineModel, rows: DataFrame, key: list[str]) -> DataFrame:
    """key, round (from 1), margin: the running sum over the first trees; a
    window's partition holds one row's trees."""
    w = Window.partitionBy(*key).orderBy("tree").rowsBetween(Window.unboundedPreceding, 0)
    return leaves(model, rows, key).select(
        *key, (F.col("tree") + 1).alias("round"),
        F.sum(F.col("weight") * F.col("prediction")).over(w).alias("margin"))


def with_margin(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """MLlib's own margin as column ``own_margin``."""
    return model.transform(rows).withColumn(
        "own_margin", vector_to_array(F.col("rawPrediction"))[1])


def log_loss_of(margin, target):
    """The booster's loss of a row: label as -1 or 1."""
    return 2 * F.log1p(F.exp(-2 * (2 * target - 1) * margin))


def losses(model: PipelineModel, rows: DataFrame) -> list[float]:
    """Mean loss after each round, of rows without nulls."""
    features = model.stages[0].getInputCols()
    return list(booster(model).evaluateEachIteration(
        model.stages[0].transform(rows.dropna(subset=features))))


def losses_from_nodes(model: PipelineModel, rows: DataFrame, key: list[str], label: str = "target"
                      ) -> DataFrame:
    """round, loss: the same from the walked trees."""
    staged = staged_margins(model, rows.select(*key, label, *model.stages[0].getInputCols()), key)
    return staged.join(rows.select(*key, label), key).groupBy("round").agg(
        F.avg(log_loss_of(F.col("margin"), F.col(label))).alias("loss"))


def best_round(curve: list[float], patience: int) -> int:
    """Rounds to keep: the best one before ``patience`` rounds bring no lower
    loss; of equal losses the first; NaN never improves."""
    best, at = math.inf, 0
    for i, loss in enumerate(curve):
        if loss < best:
            best, at = loss, i + 1
        elif i + 1 - at >= patience:
            break
    return max(at, 1)


def cut(model: PipelineModel, rounds: int) -> PipelineModel:
    """The model of the first ``rounds`` trees."""
    gbt = booster(model)
    if not 1 <= rounds <= len(gbt.trees):
        raise ValueError(f"rounds must be 1 to {len(gbt.trees)}")
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    java, trees = sc._jvm, gbt._java_obj.trees()
    kept = sc._gateway.new_array(java.org.apache.spark.ml.regression.DecisionTreeRegressionModel,
                                 rounds)
    weights = sc._gateway.new_array(java.double, rounds)
    for i in range(rounds):
        kept[i], weights[i] = trees[i], float(gbt.treeWeights[i])
    made = java.org.apache.spark.ml.classification.GBTClassificationModel(
        f"{gbt.uid}_{rounds}", kept, weights, gbt.numFeatures, 2)
    short = GBTClassificationModel(made)
    for p in gbt.params:                       # as fitted, but for the number of rounds
        if gbt.isSet(p) and p.name != "validationIndicatorCol":
            short._set(**{p.name: gbt.getOrDefault(p)})
    short._set(maxIter=rounds)
    short._transfer_params_to_java()
    return PipelineModel([*[s for s in model.stages if s is not gbt], short])


def fit_by_rounds(pipeline, rows: DataFrame, *, patience: int = 10, validation_col: str = "isVal"
                  ) -> tuple[PipelineModel, list[float], int]:
    """ML-3: fits all rounds on the rows outside the validation set, follows the
    loss on it and cuts the model after the best round that ``patience`` rounds
    do not beat. (model, losses, rounds kept)"""
    whole = pipeline.fit(rows.filter(~F.col(validation_col)))
    curve = losses(whole, rows.filter(F.col(validation_col)))
    kept = best_round(curve, patience)
    return cut(whole, kept), curve, kept


def importances_from_gains(model: PipelineModel) -> DataFrame:
    """feature, importance: gains times rows seen, over all trees, as shares."""
    names = model.stages[0].getInputCols()
    part = node_table(model).filter("left >= 0").groupBy("feature").agg(
        F.sum(F.col("gain") * F.col("n")).alias("total"))
    labels = F.array(*[F.lit(n) for n in names])
    every = part.sparkSession.range(len(names)).select(F.col("id").cast("int").alias("feature"))
    return every.join(part, "feature", "left").select(
        F.get(labels, F.col("feature")).alias("feature"),
        (F.coalesce("total", F.lit(0.0)) / F.sum(F.coalesce("total", F.lit(0.0))).over(
            Window.partitionBy())).alias("importance"))


def elastic_net_conditions(model: PipelineModel, rows: DataFrame, *, label: str = "target",
                           reg: float, elastic_net: float, tolerance: float = 1e-4) -> DataFrame:
    """feature, coefficient, slope, holds: whether each coefficient of a fitted
    logistic regression meets the optimum's subgradient condition. The penalty
    acts on features over their standard deviation, so slopes are taken there:
    a coefficient of 0 needs a slope within the L1 penalty, another one a slope
    that the penalties balance; the intercept needs none."""
    names, fitted = model.stages[0].getInputCols(), model.stages[-1]
    rows = rows.dropna(subset=[*names, label])
    w = [float(v) for v in fitted.coefficients]
    z = F.lit(float(fitted.intercept))
    for v, c in zip(w, names, strict=True):
        z = z + F.lit(v) * F.col(c)
    off = F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) - F.col(label)
    got = rows.agg(F.avg(off).alias("slope_0"), *[
        f(c).alias(f"{n}_{i}") for i, c in enumerate(names, 1) for n, f in (
            ("slope", lambda c: F.avg(off * F.col(c))), ("sd", F.stddev_samp))])
    l1, l2 = reg * elastic_net, reg * (1 - elastic_net)
    parts = []
    for i, (c, v) in enumerate([("intercept", float(fitted.intercept)),
                                *zip(names, w, strict=True)]):
        sd = F.col(f"sd_{i}") if i else F.lit(1.0)
        slope = F.col(f"slope_{i}") / F.when(sd > 0, sd)
        scaled = F.lit(v if i else 0.0) * sd           # no penalty on the intercept
        balance = slope + l2 * scaled + l1 * F.signum(scaled)
        holds = F.abs(F.when(scaled == 0, F.greatest(F.abs(slope) - (l1 if i else 0.0), F.lit(0.0)))
                      .otherwise(balance)) <= tolerance
        parts.append(F.struct(F.lit(c).alias("feature"), F.lit(v).alias("coefficient"),
                              slope.alias("slope"), F.coalesce(holds, scaled == 0).alias("holds")))
    return got.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def tune_by_rounds(pipeline, grid: list, rounds: list[int], train: DataFrame, *,
                   label: str = "target", fold_col: str = "fold", parallelism: int = 2
                   ) -> tuple[list[tuple[dict, int, float]], PipelineModel]:
    """ML-5 + ML-6: k-fold search over ``grid`` times ``rounds`` with one fit a grid
    point and fold: the fit of most rounds is cut to each number of rounds, as a
    boosted model's first trees are the model of that many rounds. Returns
    (parameters, rounds, mean area under ROC) per point and the best refitted."""
    from multiprocessing.pool import ThreadPool

    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    gbt = [s for s in pipeline.getStages() if hasattr(s, "maxIter")][0]
    auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                        metricName="areaUnderROC")
    folds = sorted(r[0] for r in train.select(fold_col).distinct().collect())

    def work(job):
        params, fold = job
        model = pipeline.fit(train.filter(F.col(fold_col) != fold), {**params, gbt.maxIter: max(rounds)})
        held = train.filter(F.col(fold_col) == fold)
        have = len(booster(model).trees)
        return [auc.evaluate(cut(model, min(r, have)).transform(held)) for r in rounds]

    jobs = [(p, f) for p in grid for f in folds]
    with ThreadPool(parallelism) as pool:
        scores = pool.map(work, jobs)
    points = []
    for i, p in enumerate(grid):
        part = scores[i * len(folds):(i + 1) * len(folds)]
        points += [({k.name: v for k, v in p.items()}, r, sum(s[j] for s in part) / len(folds))
                   for j, r in enumerate(rounds)]
    best = max(range(len(points)), key=lambda i: points[i][2])
    params = grid[best // len(rounds)]
    return points, pipeline.fit(train, {**params, gbt.maxIter: points[best][1]})
