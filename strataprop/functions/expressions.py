"""Column expressions used by more than one operator. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The split compares the first 32 bits of an md5 with a share of this range.
HASH_RANGE = 2**32


def column(name: str) -> Column:
    """Reference a top-level column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric(df: DataFrame, name: str) -> Column:
    """The column as double, with NaN read as null."""
    value = column(name).cast("double")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.nanvl(value, F.lit(None).cast("double"))
    return value


def at_least(value: Column, threshold: float) -> Column:
    """1 when the value reaches the threshold, the threshold itself included, else 0."""
    return F.when(value >= F.lit(float(threshold)), 1).otherwise(0)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def key_hash(key: str, seed: int) -> Column:
    """A number in [0, HASH_RANGE) fixed by the seed and the key; null for a null key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), column(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
