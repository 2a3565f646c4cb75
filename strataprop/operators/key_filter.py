"""A Bloom filter over the keys of a table, built on the executors and looked up in a broadcast join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataprop.functions.checks import require_columns
from strataprop.functions.expressions import column
from strataprop.functions.runtime import stage

# 2^26 bits are 8 MB, whatever the number of keys; they tell most keys apart up to some 10 million.
FILTER_BITS = 26
MOST_BITS = 30
# A key has four bits in one block of 64 words of 64 bits, so a row looks at one row of the filter.
BLOCK_BITS, WORD_BITS, PROBES = 12, 6, 4
BLOCK, WORDS = "__filter_block", "__filter_words"
# Types of which equal keys always have equal hashes, on both sides of a join.
HASHED = (T.IntegralType, T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.DecimalType)


def can_filter(left: T.DataType, right: T.DataType) -> bool:
    """Whether equal keys of the two types have the same bits."""
    if isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType):
        return True
    # a string with a collation of its own has another name
    plain = left.simpleString() == "string" or not isinstance(left, T.StringType)
    return left == right and isinstance(left, HASHED) and plain


def _widened(df: DataFrame, key: str) -> Column:
    integral = isinstance(df.schema[key].dataType, T.IntegralType)
    return column(key).cast("bigint") if integral else column(key)


def _block(df: DataFrame, key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(_widened(df, key)), F.lit(1 << (bits - BLOCK_BITS)).cast("bigint"))


def _places(df: DataFrame, key: str) -> list[Column]:
    """The key's bits in its block, from another hash."""
    other = F.xxhash64(F.lit("bits"), _widened(df, key))
    return [F.shiftrightunsigned(other, BLOCK_BITS * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
            for i in range(PROBES)]


def key_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """One row per block: its number and its words. 2^bits bits in all, written once.

    Bits are combined by word before and after the shuffle, so a task holds the filter's words at most. Null
    keys leave no bit. Starts the job that reads the keys.
    """
    require_columns(keys, [key])
    if not BLOCK_BITS <= bits <= MOST_BITS:
        raise ValueError(f"a filter has 2^{BLOCK_BITS} to 2^{MOST_BITS} bits, not 2^{bits}")
    words = 1 << (BLOCK_BITS - WORD_BITS)
    places = F.array(*[p.cast("int") for p in _places(keys, key)])
    held = keys.filter(column(key).isNotNull()).select(
        _block(keys, key, bits).alias(BLOCK), F.explode(places).alias("place")).select(
        BLOCK, F.shiftright("place", WORD_BITS).alias("word"),
        F.expr(f"shiftleft(1L, place & {(1 << WORD_BITS) - 1})").alias("set"))
    every = keys.sparkSession.range(1 << (bits - WORD_BITS)).select(
        F.expr(f"id div {words}").alias(BLOCK), F.expr(f"int(id % {words})").alias("word"),
        F.lit(0).cast("bigint").alias("set"))
    by_word = held.unionByName(every).groupBy(BLOCK, "word").agg(F.bit_or("set").alias("set"))
    return stage(by_word.groupBy(BLOCK).agg(
        F.sort_array(F.collect_list(F.struct("word", "set")))["set"].alias(WORDS)))


def divide(df: DataFrame, found: DataFrame, key: str, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is surely not in the filter (a null key among them), and rows whose key may be.

    The filter has a fixed size, so it is broadcast; the rows are not shuffled. Both parts read ``df``.
    """
    def is_set(place: Column) -> Column:
        word = F.element_at(WORDS, F.shiftright(place, WORD_BITS).cast("int") + 1)
        return F.getbit(word, place.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")) == 1

    may = column(key).isNotNull()
    for place in _places(df, key):
        may = may & is_set(place)
    looked_up = df.withColumn(BLOCK, _block(df, key, bits)).join(F.broadcast(found), BLOCK)
    columns = [column(c) for c in df.columns]
    return looked_up.filter(~may).select(*columns), looked_up.filter(may).select(*columns)
