"""Classifiers whose category levels live in a table, for columns with any number of levels.

``logistic`` learns on sparse one-hot vectors; each level's coefficient then stands beside it in the
dictionary, and scoring is a join and a sum. ``gbt`` learns on ordered target statistics, one number per categorical, so a
split never needs a bin for each level; scoring joins in the statistics of all training rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataprop.functions.checks import require_choice, require_columns, require_dataframe
from strataprop.functions.expressions import at_least, column, numeric
from strataprop.functions.runtime import stage
from strataprop.operators.categories import (
    attach_levels, category_dictionary, level_offsets, ordered_target_statistics, sparse_features, target_statistics)
from strataprop.operators.features import FEATURES, asserted_no_nulls, check_features, feature_columns
from strataprop.operators.training import ESTIMATORS, GBT_LEARNING_RATE, GBT_SHAPE, GBT_TREES, dealt_evenly

ANY_LEVELS = 2**62


@dataclass(frozen=True)
class TableModel:
    """A fitted classifier: ``levels`` has ``column, level, n, value``; ``default`` stands for any other level.

    ``weights`` and ``intercept`` are those of a logistic regression, ``trees`` the pipeline of a boosted model.
    """

    numerics: list[str]
    categoricals: list[str]
    levels: DataFrame
    default: float
    weights: list[float] | None = None
    intercept: float = 0.0
    trees: PipelineModel | None = None

    def probability(self, df: DataFrame) -> tuple[DataFrame, Column]:
        """The rows with helper columns, and the probability of label 1."""
        wide = attach_levels(df, self.levels, self.categoricals, "value")
        values = [F.coalesce(F.col(f"`__{c}_value`"), F.lit(self.default)) for c in self.categoricals]
        if self.trees is None:
            total = F.lit(self.intercept)
            for c, weight in zip(self.numerics, self.weights):
                total = total + numeric(df, c) * F.lit(weight)
            for value in values:
                total = total + value
            return wide, F.lit(1.0) / (F.lit(1.0) + F.exp(-total))
        wide = wide.withColumns({f"__{c}_value": value for c, value in zip(self.categoricals, values)})
        return self.trees.transform(wide), vector_to_array(F.col("probability"))[1]


def fit_table_model(
    train: DataFrame, *, estimator: str = "logistic", target: str, key: str, categoricals: list[str],
    seed: int = 123, prior_weight: float = 1.0, params: dict | None = None,
) -> TableModel:
    """Fit on every column but the key and the target; categoricals may have any number of levels.

    A level that training did not have counts as no level (``logistic``) or as the mean of the target (``gbt``).
    The rows are read many times: pass a written table. Nulls are refused. What a logistic regression keeps on the
    driver is its coefficients, one number per level; the levels themselves stay in their table.
    """
    require_dataframe(train, "train")
    require_choice(estimator, ESTIMATORS, "estimator")
    require_columns(train, [target, key], "train")
    numerics, categoricals = feature_columns(train, target=target, key=key, categoricals=categoricals)
    check_features(train, numerics, categoricals, target, ANY_LEVELS)
    if not categoricals:
        raise ValueError("a model without categoricals needs no table: use fit_classifier")
    used = train.select(*[column(c) for c in dict.fromkeys([key, *numerics, *categoricals, target])])
    if estimator == "logistic":
        dictionary = category_dictionary(used, categoricals)
        vectors = sparse_features(used, dictionary, numerics, categoricals, keep=[target])
        model = LogisticRegression(featuresCol=FEATURES, labelCol=target, **(params or {})).fit(vectors)
        return TableModel(numerics, categoricals, _with_coefficients(dictionary, model.coefficients.toArray(), numerics, categoricals),
                          0.0, [float(w) for w in model.coefficients.toArray()[: len(numerics)]], float(model.intercept))
    statistics, prior = target_statistics(used, categoricals, target, prior_weight)
    rows = stage(ordered_target_statistics(used, categoricals, target, key, prior=prior, weight=prior_weight, seed=seed))
    assembler = VectorAssembler(inputCols=[*numerics, *[f"__{c}_value" for c in categoricals]], outputCol=FEATURES)
    shape = dict(GBT_SHAPE, maxIter=GBT_TREES, stepSize=GBT_LEARNING_RATE, seed=seed) | (params or {})
    encoded = dealt_evenly(assembler.transform(rows).select(FEATURES, column(target)))
    trees = GBTClassifier(featuresCol=FEATURES, labelCol=target, **shape).fit(encoded)
    return TableModel(numerics, categoricals, statistics, prior, trees=PipelineModel([assembler, trees]))


def _with_coefficients(dictionary: DataFrame, coefficients: np.ndarray, numerics: list[str], categoricals: list[str]) -> DataFrame:
    """The dictionary with each level's coefficient as its ``value``."""
    offsets, _ = level_offsets(dictionary, numerics, categoricals)
    slot = F.lit(None).cast("bigint")
    for c, offset in offsets.items():
        slot = F.when(F.col("column") == c, F.col("index") + F.lit(offset)).otherwise(slot)
    known = dictionary.sparkSession.createDataFrame(pd.DataFrame(
        {"slot": np.arange(len(numerics), len(coefficients)), "value": coefficients[len(numerics):]}), "slot long, value double")
    return stage(dictionary.withColumn("slot", slot).join(known, "slot").select("column", "level", "n", "value"))


def score_table_model(model: TableModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The kept columns, ``Probs_0`` and ``Probs_1``. A null in a feature stops the scan and is named."""
    from strataprop.operators.scoring import PROBABILITIES, refuse_taken

    refuse_taken(df)
    keep = df.columns if keep is None else keep
    require_columns(df, [*keep, *model.numerics, *model.categoricals])
    wide, p = model.probability(asserted_no_nulls(df, [*model.numerics, *model.categoricals]))
    return wide.select(*[column(c) for c in keep], (F.lit(1.0) - p).alias(PROBABILITIES[0]), p.alias(PROBABILITIES[1]))


def predict_table_labels(model: TableModel, df: DataFrame, target: str, threshold: float, keep: list[str]) -> DataFrame:
    """Rows ``y_true, y_pred`` (and ``keep``); the threshold itself predicts 1."""
    wide, p = model.probability(df)
    return wide.select(*[column(c) for c in keep], column(target).alias("y_true"), at_least(p, threshold).alias("y_pred"))


def save_table_model(model: TableModel, path: str, mode: str = "error") -> None:
    facts = {"numerics": model.numerics, "categoricals": model.categoricals, "default": model.default,
             "weights": model.weights, "intercept": model.intercept, "trees": model.trees is not None}
    path = path.rstrip("/")
    model.levels.sparkSession.createDataFrame([(json.dumps(facts),)], "facts string").write.mode(mode).parquet(f"{path}/facts")
    model.levels.write.mode(mode).parquet(f"{path}/levels")
    if model.trees is not None:
        writer = model.trees.write()
        (writer.overwrite() if mode == "overwrite" else writer).save(f"{path}/trees")


def load_table_model(spark: SparkSession, path: str) -> TableModel:
    path = path.rstrip("/")
    facts = json.loads(spark.read.schema("facts string").parquet(f"{path}/facts").first()[0])
    trees = PipelineModel.load(f"{path}/trees") if facts.pop("trees") else None
    return TableModel(levels=spark.read.parquet(f"{path}/levels"), trees=trees, **facts)
