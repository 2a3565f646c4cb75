"""Probabilities for new rows: the input columns plus ``Probs_0`` and ``Probs_1``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataprop.functions.checks import require_columns, require_dataframe
from strataprop.functions.expressions import column
from strataprop.operators.model_files import ModelFile, load_model, save_model

# The names of the two output columns.
PROBABILITIES = ("Probs_0", "Probs_1")
PROBABILITY_STRUCT = "proba_0 double, proba_1 double"
# A larger Python model is refused unless the caller allows it: every worker process may hold all of it.
MAX_MODEL_BYTES = 2**30


def refuse_taken(df: DataFrame) -> None:
    require_dataframe(df, "input")
    taken = [c for c in PROBABILITIES if c in df.columns]
    if taken:
        raise ValueError(f"input already has {', '.join(taken)}")


def score(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Apply a fitted pipeline. The columns of its inner stages do not leave it."""
    refuse_taken(df)
    keep = df.columns if keep is None else keep
    require_columns(df, keep)
    probability = vector_to_array(F.col("probability"))
    return model.transform(df).select(
        *[column(c) for c in keep],
        *[probability[i].alias(name) for i, name in enumerate(PROBABILITIES)])


def score_python(
    df: DataFrame,
    model,
    features: list[str] | None = None,
    levels: dict[str, list] | None = None,
    keep: list[str] | None = None,
    max_bytes: int = MAX_MODEL_BYTES,
) -> DataFrame:
    """Apply any Python object with ``predict_proba`` to Arrow batches on the executors.

    Features go in the model's own order, ``model.feature_names_in_`` unless given. ``levels``
    fixes the categories of a categorical feature, so that its codes are the same in every
    batch. The model is a ``ModelFile``, or an object that is saved as one in the shared folder first (``save_model``);
    one of more than ``max_bytes`` is refused. Each worker process loads it once, arrays mapped from the file,
    and not again for later tasks and scorings. The file stays until ``remove_model``.
    """
    refuse_taken(df)
    if features is None:
        features = (load_model(model) if isinstance(model, ModelFile) else model).feature_names_in_
    features = list(features)
    levels = dict(levels or {})
    keep = df.columns if keep is None else keep
    require_columns(df, [*features, *keep])
    unknown = [c for c in levels if c not in features]
    if unknown:
        raise ValueError(f"levels given for columns that are no feature: {', '.join(unknown)}")
    if isinstance(model, ModelFile) and model.size > max_bytes:
        raise ValueError(f"the model has {model.size} bytes, more than the {max_bytes} allowed")
    saved = model if isinstance(model, ModelFile) else save_model(df.sparkSession, model, max_bytes=max_bytes)

    @F.pandas_udf(PROBABILITY_STRUCT)
    def probabilities(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = load_model(saved)
        for batch in batches:
            batch.columns = features
            for name, known in levels.items():
                batch[name] = pd.Categorical(batch[name], categories=known)
            yield pd.DataFrame(fitted.predict_proba(batch), columns=["proba_0", "proba_1"])

    inputs = F.struct(*[column(c) for c in features])
    scored = df.select(
        *[column(c) for c in dict.fromkeys(keep)], probabilities(inputs).alias("__probs"))
    return scored.select(
        *[column(c) for c in keep],
        F.col("__probs.proba_0").alias(PROBABILITIES[0]),
        F.col("__probs.proba_1").alias(PROBABILITIES[1]))
