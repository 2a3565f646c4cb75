"""Facts about the running session that decide which plan an operator builds."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from strataprop.functions.expressions import column


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    A single-machine session without that setting gets a temporary folder. A cluster
    session without it is refused, since a folder of one machine would lose data there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="strataprop-"))
    return context.getCheckpointDir()


def stage(
    df: DataFrame, path: str | None = None, partition_by: str | None = None
) -> DataFrame:
    """Write a result once and read it back.

    This cuts the lineage, survives the loss of executors, and gives Catalyst the true
    size of the table, so that small lookups are broadcast by its own size check. A column of
    few values in ``partition_by`` lets later filters on it skip whole files.
    """
    path = path or f"{shared_folder(df.sparkSession).rstrip('/')}/staged-{uuid4().hex}"
    writer = df.write.mode("error")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    return staged.select(*[column(c) for c in df.columns])


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate lies under ``spark.sql.autoBroadcastJoinThreshold``."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= limit


def settled(df: DataFrame, factor: int = 8) -> DataFrame:
    """A result of small tables, written once so that its true size is known.

    Catalyst takes the size of a join for the product of its sides, so a small lookup made of two tables looks too
    large to broadcast. If all tables behind it are ``factor`` broadcast limits together at most, it is written
    and read back, and its own size decides. Anything else stays as it is.
    """
    session = df.sparkSession._jsparkSession.sessionState()
    limit = session.conf().autoBroadcastJoinThreshold()
    if limit <= 0 or fits_broadcast(df):
        return df
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    behind = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return stage(df) if leaves.size() > 1 and behind <= factor * limit else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
