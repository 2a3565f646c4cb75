"""Classifiers fitted as one pipeline of encoding stages and an estimator."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataprop.functions.checks import (
    require_choice,
    require_columns,
    require_dataframe,
    require_unit_interval,
)
from strataprop.functions.expressions import at_least, column
from strataprop.operators.features import (
    FEATURES,
    MAX_LEVELS,
    check_features,
    encoding_stages,
    feature_columns,
)
from strataprop.operators.metrics import binary_metrics, metrics_long
from strataprop.operators.splitting import SPLIT

ESTIMATORS = ("logistic", "gbt")
# The number of trees and the learning rate of the boosted model by default.
GBT_TREES = 115
GBT_LEARNING_RATE = 0.03
# About as many leaves, rows per leaf and bins as histogram boosters use by default.
GBT_SHAPE = {"maxDepth": 5, "minInstancesPerNode": 20, "maxBins": 255}
# Tasks per core of each pass over the training rows of trees.
TASKS_PER_CORE = 3


def dealt_evenly(rows: DataFrame) -> DataFrame:
    """The rows in tasks of equal size, some for each core, for a fit that reads them hundreds of times.

    Files are cut into about one task per core, but rarely just as many and never of one size: every pass would wait for
    the few tasks that start late. A table of fewer tasks than cores is small and stays as it is.
    """
    cores, tasks = rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    if tasks < cores:
        return rows
    return rows.repartition(cores * max(TASKS_PER_CORE, -(-tasks // cores)))


def fit_classifier(
    train: DataFrame,
    *,
    estimator: str = "logistic",
    target: str,
    key: str,
    categoricals: list[str] | None = None,
    handle_invalid: str = "keep",
    seed: int = 123,
    max_levels: int = MAX_LEVELS,
    tree_categories: str = "nominal",
    params: dict | None = None,
) -> PipelineModel:
    """Fit encoders and classifier together on every column but the key and the target.

    ``logistic`` is a logistic regression on one-hot categoricals; ``gbt`` boosts trees on
    indexed categoricals. With ``tree_categories="nominal"`` a split takes any set of levels, which
    needs a bin for each level in every feature's histogram: more levels than ``maxBins`` are
    refused. ``"rank"`` splits a categorical by its levels' ranks by frequency and has no limit.
    ``params`` are passed on to the Spark estimator. Nulls are refused.

    The rows are read many times: pass a written table rather than an unmaterialised join.
    """
    require_dataframe(train, "train")
    require_choice(estimator, ESTIMATORS, "estimator")
    require_choice(handle_invalid, ("keep", "error"), "handle_invalid")
    require_choice(tree_categories, ("nominal", "rank"), "tree_categories")
    require_columns(train, [target, key], "train")
    numerics, categoricals = feature_columns(
        train, target=target, key=key, categoricals=categoricals)
    check_features(train, numerics, categoricals, target, max_levels)

    used = train.select(*[column(c) for c in [*numerics, *categoricals, target]])
    encoder = Pipeline(stages=encoding_stages(
        numerics, categoricals, one_hot=estimator == "logistic", handle_invalid=handle_invalid,
        ranked=tree_categories == "rank",
    )).fit(used)

    common = {"featuresCol": FEATURES, "labelCol": target}
    if estimator == "logistic":
        classifier = LogisticRegression(**common, **(params or {}))
    else:
        shape = dict(GBT_SHAPE, maxIter=GBT_TREES, stepSize=GBT_LEARNING_RATE, seed=seed)
        shape |= params or {}
        # A tree needs a bin for each level of a nominal feature, the unseen one included.
        levels = encoder.stages[0].labelsArray if categoricals and tree_categories == "nominal" else []
        most = max((len(known) + 1 for known in levels), default=0)
        if most > shape["maxBins"]:
            raise ValueError(f"a categorical has {most} levels: pass tree_categories='rank', "
                             f"or params with a larger maxBins than {shape['maxBins']}")
        classifier = GBTClassifier(**common, **shape)
    encoded = encoder.transform(used)
    if estimator == "gbt":
        encoded = dealt_evenly(encoded.select(FEATURES, column(target)))
    return PipelineModel([*encoder.stages, classifier.fit(encoded)])


def predict_labels(
    model: PipelineModel, df: DataFrame, target: str, threshold: float = 0.5,
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows ``y_true, y_pred`` (and ``keep``); the threshold itself predicts 1."""
    require_unit_interval(threshold, "threshold")
    require_columns(df, [target, *(keep or [])])
    probability = vector_to_array(F.col("probability"))[1]
    return model.transform(df).select(
        *[column(c) for c in keep or []],
        column(target).alias("y_true"), at_least(probability, threshold).alias("y_pred"))


def evaluate(
    model: PipelineModel, split: DataFrame, *, target: str, threshold: float = 0.5
) -> DataFrame:
    """Metrics of both parts of a split table, as rows ``sample, metric, value``, in one pass."""
    predictions = predict_labels(model, split, target, threshold, keep=[SPLIT])
    sample = F.concat(F.col(SPLIT), F.lit("_sample")).alias("sample")
    graded = predictions.select(sample, "y_true", "y_pred")
    return metrics_long(binary_metrics(graded, by="sample"), "sample")
