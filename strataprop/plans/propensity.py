"""The three flows: build the feature table, train a classifier, score new rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataprop.functions.checks import require_choice
from strataprop.functions.runtime import stage
from strataprop.operators.features import MAX_LEVELS, asserted_no_nulls, check_no_nulls, feature_columns, input_columns
from strataprop.operators.imputation import Impute, apply_imputation, fit_imputation
from strataprop.operators.joins import feature_table
from strataprop.operators.scoring import score
from strataprop.operators.splitting import (
    SPLIT,
    TRAIN,
    given_split,
    split_by_hash,
    split_by_sampling,
)
from strataprop.operators.metrics import binary_metrics, metrics_long
from strataprop.operators.table_model import (
    TableModel,
    fit_table_model,
    load_table_model,
    predict_table_labels,
    save_table_model,
    score_table_model,
)
from strataprop.operators.training import evaluate, fit_classifier
from strataprop.sources.artifacts import load_params, load_pipeline, save_params, save_pipeline
from strataprop.sources.tables import read_table


@dataclass(frozen=True)
class TrainingResult:
    """A fitted pipeline or table model, the imputation parameters it needs, and ``sample, metric, value`` rows."""

    model: PipelineModel | TableModel
    params: DataFrame | None
    metrics: DataFrame


def build_features(
    spark: SparkSession, *, profile, performance, dimension, target=None, key: str, dim_key: str,
    on_duplicate: str = "keep", dim_order: list[str] | None = None, repeated: bool = False,
) -> DataFrame:
    """The feature table from table names, Parquet paths or DataFrames.

    Without ``target`` it is the table that new rows are scored from. The other arguments are
    those of ``feature_table``.
    """
    sources = [read_table(spark, s) for s in (profile, performance, dimension)]
    labels = None if target is None else read_table(spark, target)
    return feature_table(*sources, labels, key=key, dim_key=dim_key,
                         on_duplicate=on_duplicate, dim_order=dim_order, repeated=repeated)


def train(
    features: DataFrame, *, target: str, key: str, categoricals: list[str] | None = None,
    imputations: list[Impute] | None = None, estimator: str = "logistic", fraction: float = 0.7,
    seed: int = 123, threshold: float = 0.5, handle_invalid: str = "keep",
    max_levels: int = MAX_LEVELS, tree_categories: str = "nominal",
    estimator_params: dict | None = None, method: str = "hash", split_path: str | None = None,
    categories: str = "pipeline",
) -> TrainingResult:
    """Split, fit the imputation and the classifier on the training part, grade both parts.

    ``method`` splits by ``hash`` of the key, by a Bernoulli ``sample`` whose keys stay together, or takes
    the ``given`` column ``split`` of ``train`` and ``val``. The split table is written once, and so is the
    imputed one, to ``split_path`` or the shared folder, so that the joins behind them run once and
    a lost executor costs a file read; the fits read the files of the training part only. With
    ``categories="table"`` category levels stay in a table (``fit_table_model``), however many there are.
    """
    require_choice(method, ("hash", "sample", "given"), "method")
    require_choice(categories, ("pipeline", "table"), "categories")
    if method == "given":
        if SPLIT not in features.columns:
            raise ValueError(f"a given split needs a column {SPLIT!r}")
        split = given_split(
            stage(features, None if imputations else split_path, partition_by=SPLIT), key=key, target=target)
    else:
        by = split_by_hash if method == "hash" else partial(split_by_sampling, whole=True)
        split = by(features, key=key, target=target, fraction=fraction, seed=seed)
    if imputations:
        split = split if method == "given" else stage(split, partition_by=SPLIT)
        params = fit_imputation(split.filter(F.col(SPLIT) == TRAIN), imputations)
        filled = stage(apply_imputation(split, params), split_path, partition_by=SPLIT)
    else:
        params, filled = None, split if method == "given" else stage(split, split_path, partition_by=SPLIT)
    used = feature_columns(filled, target=target, key=key, categoricals=categoricals)
    if categories == "table":
        model = fit_table_model(
            filled.filter(F.col(SPLIT) == TRAIN).drop(SPLIT), estimator=estimator, target=target, key=key,
            categoricals=categoricals, seed=seed, params=estimator_params)
        check_no_nulls(filled.filter(F.col(SPLIT) != TRAIN), [*used[0], *used[1]])
        graded = predict_table_labels(model, filled, target, threshold, keep=[SPLIT]).select(
            F.concat(F.col(SPLIT), F.lit("_sample")).alias("sample"), "y_true", "y_pred")
        return TrainingResult(model, params, metrics_long(binary_metrics(graded, by="sample"), "sample"))
    model = fit_classifier(
        filled.filter(F.col(SPLIT) == TRAIN), estimator=estimator, target=target, key=key,
        categoricals=categoricals, handle_invalid=handle_invalid, seed=seed, max_levels=max_levels,
        tree_categories=tree_categories, params=estimator_params)
    check_no_nulls(filled.filter(F.col(SPLIT) != TRAIN), [*used[0], *used[1]])
    return TrainingResult(model, params, evaluate(model, filled, target=target, threshold=threshold))


def save_training(result: TrainingResult, folder: str, mode: str = "error") -> None:
    folder = folder.rstrip("/")
    if result.params is not None:
        save_params(result.params, f"{folder}/imputation", mode)
    if isinstance(result.model, TableModel):
        save_table_model(result.model, f"{folder}/table", mode)
    else:
        save_pipeline(result.model, f"{folder}/pipeline", mode)


def score_saved(
    features: DataFrame, folder: str, *, imputed: bool = True, keep: list[str] | None = None,
    categories: str = "pipeline",
) -> DataFrame:
    """Impute with the saved parameters and score with the saved model, in one pass over the rows.

    A null that the imputation left stops the scan with an error that names its column. ``categories`` says how
    the model was trained.
    """
    require_choice(categories, ("pipeline", "table"), "categories")
    folder = folder.rstrip("/")
    if imputed:
        features = apply_imputation(
            features, load_params(features.sparkSession, f"{folder}/imputation"))
    if categories == "table":
        return score_table_model(load_table_model(features.sparkSession, f"{folder}/table"), features, keep)
    model = load_pipeline(f"{folder}/pipeline")
    return score(model, asserted_no_nulls(features, input_columns(model)), keep)
