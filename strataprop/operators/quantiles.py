"""Exact quantiles per group without holding a group's values in one task.

Spark's ``percentile`` and ``percentile_disc`` keep every distinct value of a group in the memory
of one task. Here a bounded sketch first brackets each quantile, then the rows inside the
brackets are counted per value, which is a small share of a large group (6 / accuracy per
quantile), and the counts are added up range by range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataprop.functions.checks import require_choice, require_numeric, require_unit_interval
from strataprop.functions.expressions import column, numeric
from strataprop.functions.runtime import stage
from strataprop.operators.joins import equi_join
from strataprop.operators.running import running_total

SKETCH_ACCURACY = 50_000
# A group of up to this many rows keeps all its values as candidates.
SMALL_GROUP = 1_000
# Share of the ranks on either side of a quantile that is kept in a group smaller than the sketch.
WIDE_MARGIN = 0.01


def _rank(prob: float, kind: str) -> tuple[Column, Column, Column]:
    """Ranks, from 1, of the two values a quantile lies between, and its share of the way."""
    n = F.col("n")
    if kind == "disc":
        rank = F.greatest(F.ceil(n * F.lit(prob)), F.lit(1))
        return rank, rank, F.lit(0.0)
    position = (n - 1) * F.lit(prob)
    return F.floor(position) + 1, F.ceil(position) + 1, position - F.floor(position)


def with_group_values(rows: DataFrame, lookup: DataFrame, grouped: bool) -> DataFrame:
    """Attach the columns of ``lookup`` to the rows of its groups ``grp``.

    Without groups the lookup has a single row, whose values become literals.
    """
    if grouped:
        return equi_join(rows, lookup, "grp", "inner", spread_by=["v"])
    only = lookup.first()
    return rows.withColumns({
        f.name: F.lit(None if only is None else only[f.name]).cast(f.dataType)
        for f in lookup.schema if f.name != "grp"
    })


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    by: list[str] | None = None,
    *,
    kind: str = "disc",
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """One row per group: ``n`` non-null values, ``min``, ``max`` and an array ``quantiles``.

    ``disc`` returns an actual value, the lower of the two in the middle for an even median.
    ``cont`` interpolates linearly. Nulls and NaN are left out. Groups with no value are kept.
    """
    require_choice(kind, ("disc", "cont"), "kind")
    require_numeric(df, [value])
    if list(probs) != sorted(probs):
        raise ValueError("probs must be in ascending order")
    for prob in probs:
        require_unit_interval(prob, "a quantile")
    if accuracy < 1_000:
        raise ValueError("accuracy must be at least 1000")
    by = list(by or [])
    # A struct key compares null group values as equal, in the join as in the grouping.
    group = F.struct(*[column(c) for c in by]) if by else F.struct(F.lit(0))
    rows = df.select(group.alias("grp"), numeric(df, value).alias("v"))

    # The sketch is off by at most n / accuracy ranks, and interpolation needs one rank more. In
    # a group of more than ``accuracy`` rows the narrow margin covers both; below, the wide one.
    k = len(probs)
    bounds = [
        min(max(p + sign * margin, 0.0), 1.0)
        for margin in (3.0 / accuracy, WIDE_MARGIN) for sign in (-1, 1) for p in probs
    ]

    def bound(side: int, i: int, extreme: str) -> Column:
        narrow, wide = F.col("bounds")[side * k + i], F.col("bounds")[(2 + side) * k + i]
        return (F.when(F.col("n") <= SMALL_GROUP, F.col(extreme))
                .when(F.col("n") <= accuracy, wide).otherwise(narrow))

    brackets = stage(
        rows.groupBy("grp")
        .agg(F.count("v").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"),
             F.percentile_approx("v", bounds, accuracy).alias("bounds"))
        .select("grp", "n", "min", "max",
                *[bound(0, i, "min").alias(f"lo_{i}") for i in range(k)],
                *[bound(1, i, "max").alias(f"hi_{i}") for i in range(k)])
    )

    # Values outside the brackets only add to the cumulative count: they move down to the
    # nearest bracket's upper end, or to null when they lie below the first one.
    v = F.col("v")
    clipped = F.when(v < F.col("lo_0"), F.lit(None).cast("double"))
    for i in range(k):
        clipped = clipped.when(v <= F.col(f"hi_{i}"), v)
        if i + 1 < k:
            clipped = clipped.when(v < F.col(f"lo_{i + 1}"), F.col(f"hi_{i}"))
    clipped = clipped.otherwise(F.col(f"hi_{k - 1}"))
    candidates = (
        with_group_values(rows.filter(v.isNotNull()), brackets, bool(by))
        .groupBy("grp", clipped.alias("candidate"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.max("n").alias("n"))
    )
    ranked = running_total(candidates, "n_rows", [F.col("candidate")], "up_to", "grp")

    ranks = [_rank(p, kind) for p in probs]
    picks = []
    for i, (low, high, _) in enumerate(ranks):
        for side, rank in (("low", low), ("high", high)):
            picked = F.when((F.col("up_to") >= rank) & F.col("candidate").isNotNull(),
                            F.col("candidate"))
            picks.append(F.min(picked).alias(f"{side}_{i}"))
    below = F.coalesce(F.sum(F.when(F.col("candidate").isNull(), F.col("n_rows"))), F.lit(0))
    picked = ranked.groupBy("grp").agg(below.alias("below"), *picks)

    result = brackets.select("grp", "n", "min", "max").join(picked, "grp", "left")
    missed = (F.col("n") > 0) & (F.col("below") >= ranks[0][0])
    quantiles = []
    for i, (_, _, share) in enumerate(ranks):
        low, high = F.col(f"low_{i}"), F.col(f"high_{i}")
        missed = missed | ((F.col("n") > 0) & (low.isNull() | high.isNull()))
        quantiles.append(F.when(low == high, low).otherwise(low + (high - low) * share))
    checked = F.when(missed, F.raise_error(F.lit("the sketch bracket missed a quantile")))
    return result.select(
        *[F.col("grp")[name].alias(name) for name in by],
        "n", "min", "max",
        checked.otherwise(F.array(*quantiles)).cast("array<double>").alias("quantiles"),
    )
