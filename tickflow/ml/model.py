"""Model fitting, tuning, scoring and persistence on MLlib (ML-2..ML-8,
PRJ-12..14, SNK-5, SNK-6).

The boosted-tree classifier is MLlib's ``GBTClassifier``: each tree level is
a distributed aggregation over partitions of the training frame, so fitting
scales with the cluster. Predictions keep every input column (keys
included), so they join back to their rows exactly (Q19)."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.temporal import ts_to_seconds
from tickflow.operators.columns import matching

# Fixed value: features are every column whose name contains this pattern;
# it leaves out price_plus_* / price_change_* (no label leakage).
FEATURE_PATTERN = r"percent"
WEEK_SECONDS = 604800


def feature_columns(df: DataFrame, pattern: str = FEATURE_PATTERN) -> list[str]:
    """PRJ-10 for the model inputs."""
    return matching(df, pattern)


def assembler(features: list[str], handle_invalid: str = "keep") -> VectorAssembler:
    """PRJ-12: feature columns -> one vector. Every row stays: ``training_rows``
    leaves rows with nulls out of the fit, ``predict`` gives them no prediction."""
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid=handle_invalid)


def gbt_pipeline(features: list[str], *, label: str = "target", validation_col: str | None = "isVal",
                 max_iter: int = 20, max_depth: int = 5, step_size: float = 0.1,
                 subsampling_rate: float = 1.0, min_info_gain: float = 0.0,
                 min_weight_fraction: float = 0.0, validation_tol: float = 0.01,
                 seed: int = 42) -> Pipeline:
    """ML-2 + ML-3: assembler + boosted trees. With ``validation_col`` the
    fit stops early when the validation error stops improving by
    ``validation_tol`` (MLlib's tolerance rule, not a round count)."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter,
                        maxDepth=max_depth, stepSize=step_size,
                        subsamplingRate=subsampling_rate, minInfoGain=min_info_gain,
                        minWeightFractionPerNode=min_weight_fraction,
                        validationTol=validation_tol, seed=seed)
    if validation_col:
        gbt = gbt.setValidationIndicatorCol(validation_col)
    return Pipeline(stages=[assembler(features), gbt])


def logistic_pipeline(features: list[str], *, label: str = "target", reg: float = 0.0,
                      elastic_net: float = 0.0, max_iter: int = 100) -> Pipeline:
    """Second estimator: L1/L2-regularised logistic regression (the booster's
    reg_alpha/reg_lambda have no tree counterpart in MLlib)."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=reg,
                            elasticNetParam=elastic_net, maxIter=max_iter)
    return Pipeline(stages=[assembler(features), lr])


# Rows per partition for iterative fitting: each boosting round runs jobs over
# every partition, so tiny partitions cost scheduling time, not compute.
ROWS_PER_FIT_PARTITION = 20_000


@contextmanager
def training_rows(train: DataFrame):
    """The training rows without nulls, persisted while the block runs (boosting
    and cross-validation read them many times) in about ``ROWS_PER_FIT_PARTITION``
    rows per partition, at most the cluster's parallelism. Lost blocks are
    recomputed from lineage."""
    from pyspark import StorageLevel
    held = train.dropna(subset=[c for c in train.columns
                                if c in feature_columns(train) or c == "target"])
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = held.count()
        if n == 0:
            raise ValueError("no training rows: the feature table is empty for this input "
                             "(e.g. too few bars per week for the longest lag)")
        sc = train.sparkSession.sparkContext
        parts = max(1, min(sc.defaultParallelism, -(-n // ROWS_PER_FIT_PARTITION)))
        yield held.coalesce(parts) if parts < held.rdd.getNumPartitions() else held
    finally:
        held.unpersist()


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    return pipeline.fit(train)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """ML-4 + PRJ-13 + PRJ-14 + SCL-15: adds prediction, probability,
    rawPrediction and the class probabilities as plain doubles ``prob_0`` /
    ``prob_1`` (array elements of the probability vector). One row out per row
    in: a row with a null feature has null prediction and probabilities."""
    out = model.transform(df)
    arr = vector_to_array(F.col("probability"))
    whole = F.lit(True)
    for c in model.stages[0].getInputCols():
        whole = whole & F.col(c).isNotNull()
    return out.withColumns({"prediction": F.when(whole, F.col("prediction")),
                            "prob_0": F.when(whole, arr[0]), "prob_1": F.when(whole, arr[1])})


def auc(pred: DataFrame, label: str = "target", metric: str = "areaUnderROC") -> float | None:
    """AGG-9 / AGG-10 over all distinct scores (no binning); null when a class
    is absent."""
    from tickflow.operators import metrics as M
    scored = pred.filter(F.col("prob_1").isNotNull())
    if metric == "areaUnderPR":
        return M.auc_pr(scored, label, "prob_1").first()["area"]
    return M.auc_roc(scored, label, "prob_1").first()["auc"]


def week_folds(df: DataFrame, ts: str, k: int = 3, out: str = "fold") -> DataFrame:
    """ML-6 fold column: week number modulo k, so the overlapping lag windows
    of one week never straddle a train/validation boundary."""
    week = F.floor(ts_to_seconds(F.col(ts)) / F.lit(WEEK_SECONDS))
    return df.withColumn(out, (week % F.lit(k)).cast("int"))


def gbt_of(pipeline: Pipeline) -> GBTClassifier:
    return [s for s in pipeline.getStages() if isinstance(s, GBTClassifier)][0]


REFERENCE_ROUNDS = [150, 200, 250]      # fixed values of the tuned numbers of trees


def reference_grid(gbt: GBTClassifier) -> list:
    """ML-5: the tuning axes but for the number of trees (``REFERENCE_ROUNDS``) as
    MLlib parameters. minInfoGain is a gain in Gini impurity (at most 0.5), so its
    values are chosen on that scale; grow policy and L1/L2 have no tree
    counterpart."""
    return (ParamGridBuilder()
            .addGrid(gbt.maxDepth, [3, 5])
            .addGrid(gbt.stepSize, [0.05, 0.01])
            .addGrid(gbt.minWeightFractionPerNode, [0.0, 0.05, 0.1])
            .addGrid(gbt.minInfoGain, [0.0, 0.001, 0.01])
            .build())


def small_grid(gbt: GBTClassifier, depths=(3, 5), steps=(0.1, 0.05)) -> list:
    return ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).addGrid(
        gbt.stepSize, list(steps)).build()


def cv_table(spark: SparkSession, pipeline: Pipeline, points: list, best: PipelineModel,
             test: DataFrame | None = None) -> DataFrame:
    """Mean validation AUC per (parameters, rounds, AUC) point with every tuned
    parameter, and, with ``test``, the best model's AUC there."""
    rows = []
    top = max(range(len(points)), key=lambda i: points[i][2])
    fixed = gbt_of(pipeline)
    test_auc = auc(predict(best, test)) if test is not None else None
    for i, (params, rounds, mean) in enumerate(points):
        got = [params.get(n, fixed.getOrDefault(n)) for n in (
            "maxDepth", "stepSize", "minWeightFractionPerNode", "minInfoGain")]
        rows.append((int(got[0]), float(got[1]), rounds, float(got[2]), float(got[3]), float(mean),
                     i == top, test_auc if i == top else None))
    return spark.createDataFrame(
        rows, "max_depth int, step_size double, max_iter int, min_weight double, "
              "min_info_gain double, mean_auc double, is_best boolean, test_auc double")


def feature_importances(spark: SparkSession, model: PipelineModel, names: list[str]) -> DataFrame:
    """ML-7: importance per feature column (a table of len(names) rows)."""
    tree = model.stages[-1]
    imp = tree.featureImportances.toArray().tolist()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)],
                                 "feature string, importance double")


def fitted_params(model: PipelineModel) -> dict[str, str]:
    """Non-empty parameters of the fitted estimator, as text."""
    est = model.stages[-1]
    out = {}
    for p, v in est.extractParamMap().items():
        if v not in (None, "", False):
            out[p.name] = str(v)
    return out


def score_report(spark: SparkSession, model: PipelineModel, train_pred: DataFrame,
                 test_pred: DataFrame, label: str = "target") -> DataFrame:
    """ML-8: one row: train/test AUC, test area under PR, test accuracy,
    precision, recall, F1 and the fitted parameters. Counts come from one
    distributed aggregate."""
    from tickflow.operators.metrics import binary_metrics
    from tickflow.session import stage
    # Each metric reads the predictions again: score them once.
    train_pred, test_pred = (stage(p.select(label, "prediction", "prob_1"))
                             for p in (train_pred, test_pred))
    m = binary_metrics(test_pred, label=label, prediction="prediction")
    params = F.create_map(*[x for k, v in sorted(fitted_params(model).items())
                            for x in (F.lit(k), F.lit(v))])
    return m.select(F.lit(auc(train_pred, label)).alias("train_auc"),
                    F.lit(auc(test_pred, label)).alias("test_auc"),
                    F.lit(auc(test_pred, label, "areaUnderPR")).alias("test_aupr"),
                    "accuracy", "precision", "recall", "f1", params.alias("params"))


def stamped(path: str, now: dt.datetime | None = None) -> str:
    """SNK-5 naming: ``<path>_%Y-%m-%d_%H_%M_%S``."""
    return f"{path}_{(now or dt.datetime.now()).strftime('%Y-%m-%d_%H_%M_%S')}"


def save_model(model: PipelineModel | None, path: str, stamp: bool = True) -> str:
    """SNK-5: persist with MLlib's writer; error when there is no model."""
    if model is None:
        raise ValueError("there is no fitted model to save")
    target = stamped(path) if stamp else path
    model.write().overwrite().save(target)
    return target


def load_model(path: str) -> PipelineModel:
    """SNK-6: load a saved pipeline (Q20: the session stays up; scoring is
    whole-batch ``transform``, never one row per call)."""
    return PipelineModel.load(path)
