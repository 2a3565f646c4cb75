"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataprop.functions.runtime import stage


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard whose draw for this key is best: number k of ``weights`` takes about its share.

    Each shard draws a number from the key and its own number alone, so another shard, or a larger
    weight, changes no other shard's draw: rows move only to the shard that grew. A null key is a
    key like any other. Equal draws go to the lower shard number.
    """
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("give one positive weight for each shard")
    draws = []
    for shard, weight in enumerate(weights):
        # 53 bits of the hash, as a number in (0, 1); the smallest -ln(u)/weight wins.
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard).cast("long")), 11)
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        draws.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("draw"),
                              F.lit(shard).alias("shard")))
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def number_within(df: DataFrame, group: str, name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, however large a group is.

    ``df`` is written once with the task that made each row. Rows are counted by task and group;
    running totals of those counts over the tasks give each task's first number; only rows of one
    task and group are sorted together. So no task needs all rows of a group.
    """
    numbered = stage(df.withColumn("__row", F.monotonically_increasing_id())
                     .withColumn("__task", F.shiftright("__row", 33)))
    counts = numbered.groupBy(group, "__task").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(group).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("__group"), F.col("__task").alias("__of_task"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__task", group).orderBy("__row"))
    placed = numbered.withColumn("__place", place)
    joined = placed.join(
        starts, placed[group].eqNullSafe(starts["__group"]) & (placed["__task"] == starts["__of_task"]))
    return joined.select(
        *[placed[c] for c in df.columns],
        (F.col("__start") + F.col("__place") - 1).cast("long").alias(name))


def shard_records(
    docs: DataFrame, key: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * 24,
    new_weight: float = 1.0,
) -> DataFrame:
    """Shard, place in the shard, size and checksum of every record.

    Columns: the key, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``shard``, ``slot``
    (from 0, gapless in each shard) and ``grown_shard`` (with one more shard of ``new_weight``).
    A null text counts as empty. Rows with equal keys, nulls too, share a shard; repeated rows keep
    a slot each. An empty table gives no rows. Other columns are not carried.
    """
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key), (F.octet_length(content) + 8).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, new_weight]).alias("grown_shard"))
    return number_within(rows, "shard", "slot")
