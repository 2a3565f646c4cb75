"""Train / validation splits, the same fraction of each label."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataprop.functions.checks import (
    require_columns,
    require_dataframe,
    require_unit_interval,
)
from strataprop.functions.expressions import HASH_RANGE, column, key_hash
from strataprop.functions.runtime import stage
from strataprop.operators.joins import equi_join
from strataprop.operators.key_filter import can_filter, divide, key_filter

SPLIT = "split"
TRAIN, VALIDATION = "train", "val"
LABELS = (0, 1)


def _check(df: DataFrame, key: str, target: str, fraction: float) -> None:
    require_dataframe(df, "input")
    require_columns(df, [key, target])
    require_unit_interval(fraction, "fraction")
    if SPLIT in df.columns:
        raise ValueError(f"input already has a column {SPLIT!r}")


def split_by_hash(
    df: DataFrame, *, key: str, target: str, fraction: float = 0.7, seed: int = 123
) -> DataFrame:
    """Add a ``split`` column that depends on the key, the seed and the label alone.

    No job, no shuffle, and the same answer however the input is partitioned. Rows with the
    same key and a valid label fall on the same side. A label other than 0 or 1, or none, and
    a null key go to validation.
    """
    _check(df, key, target, fraction)
    limit = F.lit(math.ceil(fraction * HASH_RANGE)).cast("bigint")
    chosen = column(target).isin(*LABELS) & (key_hash(key, seed) < limit)
    split = F.when(chosen, F.lit(TRAIN)).otherwise(F.lit(VALIDATION))
    return df.withColumn(SPLIT, split)


def split_by_sampling(
    df: DataFrame, *, key: str, target: str, fraction: float = 0.7, seed: int = 123,
    path: str | None = None, whole: bool = False,
) -> DataFrame:
    """The same column from a Bernoulli sample per label and an anti-join.

    Which rows are drawn depends on the layout of the input, so the sample is written once, to
    ``path`` or the shared folder, and every later use reads that. Unsampled copies of a sampled key
    are in neither part; with ``whole`` they go to the training part too, but those with a label other than 0
    or 1, or none, which go to validation, so that the two parts are the whole table.
    """
    _check(df, key, target, fraction)
    fractions = {label: float(fraction) for label in LABELS}
    train = stage(df.sampleBy(column(target), fractions, seed), path)
    if whole:
        keys = train.select(column(key)).dropna().distinct().withColumn("__drawn", F.lit(True))
        chosen = F.col("__drawn") & column(target).isin(*LABELS)
        both = equi_join(df, keys, key, "left")
        part = F.when(chosen, F.lit(TRAIN)).otherwise(F.lit(VALIDATION))
        return both.withColumn(SPLIT, part).select(*[column(c) for c in df.columns], SPLIT)
    return train.withColumn(SPLIT, F.lit(TRAIN)).unionByName(
        validation_rows(df, train, key).withColumn(SPLIT, F.lit(VALIDATION)))


def given_split(df: DataFrame, *, key: str, target: str) -> DataFrame:
    """The table as it is, if its own ``split`` column has ``train`` and ``val`` and nothing else."""
    require_dataframe(df, "input")
    require_columns(df, [key, target, SPLIT])
    known = F.coalesce(F.col(SPLIT).isin(TRAIN, VALIDATION), F.lit(False))
    found = df.agg(F.count_if(~known).alias("others"),
                   F.count_if(F.col(SPLIT) == TRAIN).alias("train")).first()
    if found["others"] or not found["train"]:
        raise ValueError(f"column {SPLIT!r} must hold {TRAIN!r} and {VALIDATION!r} only, and some {TRAIN!r}")
    return df


def validation_rows(
    df: DataFrame, train: DataFrame, key: str, filter_bits: int | None = None
) -> DataFrame:
    """Rows whose key is not in the training sample. Rows without a key always stay.

    With ``filter_bits`` a Bloom filter of 2^filter_bits bits over the training keys is built and broadcast first
    (26: 8 MB). Rows that miss it are returned as they are read; only the others, and hardly more than have a
    training key, are shuffled for the anti-join. It pays where training keys are too many to broadcast, some
    eight bits for each are there, and ``df`` is cheap to read twice. Keys of floating or nested types, or of different types, are
    anti-joined without it. The rows are the same either way.
    """
    require_columns(df, [key])
    require_columns(train, [key], "train")
    if filter_bits is None or not can_filter(df.schema[key].dataType, train.schema[key].dataType):
        return equi_join(df, train, key, "left_anti")
    missing, others = divide(df, key_filter(train, key, filter_bits), key, filter_bits)
    return missing.union(equi_join(others, train, key, "left_anti").select(*[column(c) for c in df.columns]))


def train_validation(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    require_columns(split, [SPLIT])
    return tuple(split.filter(F.col(SPLIT) == part).drop(SPLIT) for part in (TRAIN, VALIDATION))


def split_counts(split: DataFrame, target: str) -> DataFrame:
    """Rows per part and label, in one job."""
    require_columns(split, [SPLIT, target])
    return split.groupBy(SPLIT, column(target)).agg(F.count(F.lit(1)).alias("n"))
