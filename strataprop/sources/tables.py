"""Where rows come from, and where scored rows go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strataprop.functions.checks import require_columns
from strataprop.functions.expressions import column


def read_table(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """A catalog table or view by name, a Parquet path, or a DataFrame as it is.

    Anything with a slash is a path; a catalog name has none.
    """
    if isinstance(source, DataFrame):
        return source
    if not isinstance(source, str):
        raise TypeError(f"source must be a name, a path or a DataFrame, not {type(source).__name__}")
    return spark.read.parquet(source) if "/" in source else spark.read.table(source)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A comma-separated file with a header line. The schema is given, not inferred.

    A header that names other columns, and a value that does not fit its type, are errors.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write rows as Parquet; an existing path is an error unless ``mode`` says otherwise."""
    df.write.mode(mode).parquet(path)


def write_entity_table(
    df: DataFrame, name: str, key: str, buckets: int, path: str | None = None, mode: str = "error"
) -> DataFrame:
    """Write a catalog table bucketed and sorted by its key, and read it back.

    Tables with as many buckets of one key join by it without a shuffle, however often they are joined.
    """
    require_columns(df, [key])
    if buckets < 1:
        raise ValueError("a table needs one bucket or more")
    writer = df.repartition(buckets, column(key)).write.mode(mode).bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.read.table(name)


def write_batch(df: DataFrame, path: str, batch: str) -> None:
    """Write rows by the values of their ``batch`` column; a batch that is written again replaces itself only."""
    require_columns(df, [batch])
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch).parquet(path)
