"""Category dictionaries as tables: levels are counted, ranked, joined in and scored on the executors.

A dictionary has a row per column and level. It is written beside the model and joined to the rows, so no
level is ever on the driver, and a column may have as many levels as it likes.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataprop.functions.checks import require_columns, require_numeric
from strataprop.functions.expressions import column, key_hash, numeric
from strataprop.functions.runtime import shared_folder, stage
from strataprop.operators.features import FEATURES
from strataprop.operators.joins import equi_join
from strataprop.operators.running import running_totals


def _levels(df: DataFrame, categoricals: list[str], *others: Column) -> DataFrame:
    """A row ``column, level`` (and the others) for each categorical of each row; null levels are left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), column(c).cast("string").alias("level")) for c in categoricals])
    return df.select(F.explode(cells).alias("cell"), *others).select("cell.*", "*").drop("cell").dropna(subset=["level"])


def category_dictionary(df: DataFrame, categoricals: list[str], path: str | None = None) -> DataFrame:
    """Rows ``column, level, n, index``: each column's levels from the most to the least frequent, ties by name.

    All columns come from one scan. The table is written to ``path`` or the shared folder. A null is no level.
    """
    require_columns(df, categoricals)
    if not categoricals:
        raise ValueError("there is no categorical column")
    counts = _levels(df, categoricals).groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    one = counts.withColumn("one", F.lit(1).cast("bigint"))
    ranked = running_totals(one, {"place": "one"}, [F.desc("n"), F.asc("level")], "column")
    return stage(ranked.select("column", "level", "n", (F.col("place") - 1).alias("index")), path)


def attach_levels(df: DataFrame, dictionary: DataFrame, categoricals: list[str], field: str) -> DataFrame:
    """Add ``__<categorical>_<field>`` from the dictionary: null for a level that it does not have, or no level.

    Hot levels are spread when the dictionary is too large to broadcast.
    """
    for c in categoricals:
        level = f"__{c}_level"
        own = dictionary.filter(F.col("column") == c).select(
            F.col("level").alias(level), F.col(field).alias(f"__{c}_{field}"))
        df = equi_join(df.withColumn(level, column(c).cast("string")), own, level, "left").drop(level)
    return df


def level_offsets(dictionary: DataFrame, numerics: list[str], categoricals: list[str]) -> tuple[dict[str, int], int]:
    """Where each categorical's slots start behind the numeric ones, and the number of all slots."""
    sizes = {r["column"]: r["levels"] for r in dictionary.groupBy("column").agg(
        (F.max("index") + 1).alias("levels")).collect()}  # one row per categorical
    offsets, size = {}, len(numerics)
    for c in categoricals:
        offsets[c] = size
        size += sizes.get(c, 0)
    if size >= 2**31:
        raise ValueError(f"{size} features are more than a vector can have")
    return offsets, size


def sparse_features(
    df: DataFrame, dictionary: DataFrame, numerics: list[str], categoricals: list[str], keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` and a sparse feature vector: the numeric columns, then one slot for each level.

    A level that the dictionary does not have leaves all its slots zero. The vectors are put together as their
    parts by column expressions and written once, as rows that are read many times should be; reading them
    back makes them vectors. No slot has a name, so a million levels cost no more than ten.
    """
    require_numeric(df, numerics)
    keep = list(keep or [])
    offsets, size = level_offsets(dictionary, numerics, categoricals)
    wide = attach_levels(df, dictionary, categoricals, "index")
    slots = [F.when(F.col(f"`__{c}_index`").isNotNull(), F.col(f"`__{c}_index`") + F.lit(offsets[c])).cast("int")
             for c in categoricals]
    hit = F.array_compact(F.array(*slots)) if slots else F.array().cast("array<int>")
    values = F.array(*[numeric(df, c) for c in numerics]) if numerics else F.array().cast("array<double>")
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
        F.concat(F.array(*[F.lit(i) for i in range(len(numerics))]).cast("array<int>"), hit).alias("indices"),
        F.concat(values, F.array_repeat(F.lit(1.0), F.size(hit))).alias("values"))
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/vectors-{uuid4().hex}"
    rows = wide.select(*[column(c) for c in keep], vector.alias(FEATURES))
    rows.write.parquet(path)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(FEATURES, VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)


def target_statistics(df: DataFrame, categoricals: list[str], target: str, weight: float = 1.0) -> tuple[DataFrame, float]:
    """Rows ``column, level, n, value`` and the mean of the target over all rows, the prior.

    ``value`` is the level's mean of the target, with the prior counted in like ``weight`` more rows.
    """
    require_columns(df, [*categoricals, target])
    prior = df.agg(F.avg(column(target).cast("double"))).first()[0]
    prior = 0.5 if prior is None else float(prior)
    sums = _levels(df, categoricals, column(target).cast("double").alias("__y")).groupBy("column", "level").agg(
        F.count("__y").alias("n"), F.sum("__y").alias("positives"))
    value = (F.coalesce("positives", F.lit(0.0)) + F.lit(weight * prior)) / (F.col("n") + F.lit(float(weight)))
    return stage(sums.select("column", "level", "n", value.alias("value"))), prior


def ordered_target_statistics(
    df: DataFrame, categoricals: list[str], target: str, key: str, *, prior: float, weight: float = 1.0, seed: int = 123,
) -> DataFrame:
    """Add ``__<categorical>_value``: the mean of the target over the rows of the level that come before the row.

    Rows are ordered by a hash of seed and key, so a row's own target, and those of rows with the same key,
    never enter its value. The prior counts like ``weight`` rows; the first row of a level, and a row without a
    level or key, has the prior alone or the rows before all keys. The rows before are running totals over ranges of all
    levels, so a level with a third of all rows needs no task of its own.
    """
    require_columns(df, [*categoricals, target, key])
    place = F.coalesce(key_hash(key, seed), F.lit(-1).cast("bigint"))
    cells = _levels(df, categoricals, place.alias("__place"), column(target).cast("double").alias("__y")).groupBy(
        "column", "level", "__place").agg(F.count("__y").alias("n"), F.coalesce(F.sum("__y"), F.lit(0.0)).alias("s"))
    grouped = cells.withColumn("grp", F.struct("column", "level"))
    upto = running_totals(grouped, {"all_n": "n", "all_s": "s"}, [F.asc("__place")], "grp")
    before_n, before_s = F.col("all_n") - F.col("n"), F.col("all_s") - F.col("s")
    known = stage(upto.select("column", "level", "__place", (
        (before_s + F.lit(weight * prior)) / (before_n + F.lit(float(weight)))).alias("value")))
    rows = df.withColumn("__place", place)
    for c in categoricals:
        level, value = f"__{c}_level", f"__{c}_value"
        own = known.filter(F.col("column") == c).select(F.col("level").alias(level), "__place", F.col("value").alias(value))
        rows = equi_join(rows.withColumn(level, column(c).cast("string")), own, [level, "__place"], "left").drop(level)
        rows = rows.withColumn(value, F.coalesce(F.col(f"`{value}`"), F.lit(prior)))
    return rows.drop("__place")
