"""From table columns to a feature vector."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from strataprop.functions.checks import require_columns, require_numeric
from strataprop.functions.expressions import column
from strataprop.operators.running import running_total
from strataprop.operators.splitting import SPLIT

FEATURES = "__features"
# StringIndexer keeps the levels of a column on the driver and in the saved model.
MAX_LEVELS = 10_000


def feature_columns(
    df: DataFrame, *, target: str, key: str, categoricals: list[str] | None = None
) -> tuple[list[str], list[str]]:
    """Numeric and categorical features: every column but the key, the target and the split."""
    categoricals = list(categoricals or [])
    require_columns(df, categoricals)
    taken = {target, key, SPLIT, *categoricals}
    numerics = [c for c in df.columns if c not in taken]
    require_numeric(df, numerics, "the feature list")
    return numerics, categoricals


def check_features(
    df: DataFrame, numerics: list[str], categoricals: list[str], target: str | None = None,
    max_levels: int = MAX_LEVELS,
) -> None:
    """Find nulls, unusable labels and categoricals with too many levels in one aggregate.

    Vector stages fail on a null only when a row is read, and without naming the column.
    """
    checks = []
    for c in numerics:
        checks.append(F.count_if(column(c).isNull() | F.isnan(column(c).cast("double"))))
    for c in categoricals:
        checks.append(F.count_if(column(c).isNull()))
    checks += [F.approx_count_distinct(column(c)) for c in categoricals]
    if target is not None:
        checks.append(F.count_if(~F.coalesce(column(target).isin(0, 1), F.lit(False))))
    if not checks:
        raise ValueError("there is no feature column")
    found = df.agg(*[c.alias(f"check_{i}") for i, c in enumerate(checks)]).first()
    names = [*numerics, *categoricals]
    nulls = [c for c, n in zip(names, found) if n]
    if nulls:
        raise ValueError(f"impute these columns first, they hold nulls: {', '.join(nulls)}")
    levels = dict(zip(categoricals, found[len(names):]))
    wide = [c for c, n in levels.items() if n > max_levels]
    if wide:
        raise ValueError(f"more than {max_levels} levels in: {', '.join(wide)}")
    if target is not None and found[-1]:
        raise ValueError(f"{found[-1]} rows have a label other than 0 or 1 in {target!r}")


def _hole(df: DataFrame, c: str) -> Column:
    """Whether the column is null or NaN."""
    null = column(c).isNull()
    return null | F.isnan(column(c).cast("double")) if isinstance(df.schema[c].dataType, NumericType) else null


def count_holes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``column, holes``: how many nulls and NaN each column has, from one aggregate."""
    require_columns(df, columns)
    counts = df.agg(*[F.count_if(_hole(df, c)).alias(f"holes_{i}") for i, c in enumerate(columns)])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"holes_{i}").alias("holes")) for i, c in enumerate(columns)]
    return counts.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def check_no_nulls(df: DataFrame, columns: list[str]) -> None:
    """Name the columns that hold a null or NaN, in one aggregate."""
    require_columns(df, columns)
    if not columns:
        return
    holes = {r["column"]: r["holes"] for r in count_holes(df, columns).collect()}  # one row per column
    nulls = [c for c in columns if holes[c]]
    if nulls:
        raise ValueError(f"impute these columns first, they hold nulls: {', '.join(nulls)}")


def asserted_no_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows as they are; reading a null or NaN in one of the columns fails and names the column.

    The check is part of the projection, so it costs no pass of its own.
    """
    require_columns(df, columns)
    checked = {c: F.when(_hole(df, c), F.raise_error(F.lit(
        f"impute these columns first, they hold nulls: {c}")).cast(df.schema[c].dataType)).otherwise(column(c)) for c in columns}
    return df.select(*[checked[c].alias(c) if c in checked else column(c) for c in df.columns])


def input_columns(model: PipelineModel) -> list[str]:
    """The columns of the input table that a pipeline's encoders read."""
    made, read = set(), []
    for stage in model.stages:
        if isinstance(stage, SQLTransformer):
            made |= {c for c in stage.getStatement().split("`") if c.endswith("_rank")}
            continue
        several = stage.hasParam("inputCols") and stage.isDefined("inputCols")
        outputs = stage.hasParam("outputCols") and stage.isDefined("outputCols")
        read += stage.getInputCols() if several else []
        made |= set(stage.getOutputCols() if outputs else [])
    return [c for c in dict.fromkeys(read) if c not in made]


def indexed(c: str) -> str:
    return f"__{c}_index"


def encoded(c: str) -> str:
    return f"__{c}_onehot"


def encoding_stages(
    numerics: list[str], categoricals: list[str], *, one_hot: bool, handle_invalid: str = "keep",
    ranked: bool = False,
) -> list:
    """Indexers, encoders and the assembler: numeric features first, then the categoricals.

    ``keep`` lets rows with an unseen level be scored; ``error`` refuses them. ``ranked`` gives a
    categorical as its rank by frequency, a number like any other, instead of as a nominal feature.
    """
    stages = []
    inputs = list(numerics)
    if categoricals:
        indexes = [indexed(c) for c in categoricals]
        stages.append(StringIndexer(
            inputCols=categoricals, outputCols=indexes, handleInvalid=handle_invalid,
            stringOrderType="frequencyDesc"))
        if one_hot:
            vectors = [encoded(c) for c in categoricals]
            stages.append(OneHotEncoder(inputCols=indexes, outputCols=vectors, dropLast=True))
            inputs += vectors
        elif ranked:
            # a computed column carries no level names, so trees split it as a number
            names = [f"{i}_rank" for i in indexes]
            listed = ", ".join(f"`{i}` + 0D AS `{name}`" for i, name in zip(indexes, names))
            stages.append(SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__"))
            inputs += names
        else:
            inputs += indexes
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="error"))
    return stages


def category_index(df: DataFrame, c: str) -> DataFrame:
    """Rows ``level, n, index``: levels from the most to the least frequent, ties by name.

    The levels stay on the executors, however many there are.
    """
    require_columns(df, [c])
    counts = df.groupBy(column(c).cast("string").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    one = counts.dropna(subset=["level"]).withColumn("one", F.lit(1).cast("bigint"))
    ranked = running_total(one, "one", [F.desc("n"), F.asc("level")], "place")
    return ranked.select("level", "n", (F.col("place") - 1).alias("index"))
