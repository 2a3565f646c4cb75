"""Running totals over an order, without bringing a group or the table into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataprop.functions.runtime import shuffle_partitions, stage


def running_total(
    df: DataFrame, value: str, order: list, name: str, group: str | None = None
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows up to this one, within its group."""
    return running_totals(df, {name: value}, order, group)


def running_totals(
    df: DataFrame, values: dict[str, str], order: list, group: str | None = None
) -> DataFrame:
    """Add, for each name, the sum of its value over the rows up to this one, within its group.

    Rows are dealt out by ranges of group and ``order`` and written; each range adds up its own rows;
    the ranges' sums, at most one row per range and group, are added up in turn and carried over.
    The order must be unique within a group. Staging starts a job.
    """
    groups = [F.col(group)] if group else []
    ranges = stage(
        df.repartitionByRange(shuffle_partitions(df.sparkSession), *groups, *order)
        .withColumn("__range", F.spark_partition_id()))
    key = F.col(group).alias("__group") if group else F.lit(0).alias("__group")
    sums = ranges.groupBy(F.col("__range").alias("__of_range"), key).agg(
        *[F.sum(value).alias(f"__sum_{i}") for i, value in enumerate(values.values())])
    earlier = Window.partitionBy("__group").orderBy("__of_range").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = sums.select("__of_range", "__group", *[
        F.coalesce(F.sum(f"__sum_{i}").over(earlier), F.lit(0)).alias(f"__carried_{i}") for i in range(len(values))])
    same = (F.col(group) if group else F.lit(0)).eqNullSafe(F.col("__group"))
    inside = Window.partitionBy("__range", *groups).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    joined = ranges.join(carried, (F.col("__range") == F.col("__of_range")) & same)
    totals = {name: F.sum(value).over(inside) + F.col(f"__carried_{i}") for i, (name, value) in enumerate(values.items())}
    return joined.withColumns(totals).select(*df.columns, *values)
