"""Statistics behind the usual exploratory charts and tests, computed on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataprop.functions.checks import (
    require_choice,
    require_columns,
    require_numeric,
    require_unit_interval,
)
from strataprop.functions.chi_square_tail import chi_square_p_value
from strataprop.functions.expressions import column, numeric
from strataprop.functions.runtime import stage
from strataprop.operators.comoments import block_moments, column_counts, correlations
from strataprop.operators.joins import equi_join
from strataprop.operators.quantiles import exact_quantiles, with_group_values


def _finite(df: DataFrame, c: str) -> Column:
    """The column as double, null for null, NaN and the infinities."""
    return F.when(F.abs(numeric(df, c)) < F.lit(float("inf")), numeric(df, c))


def contingency(df: DataFrame, col_1: str, col_2: str) -> DataFrame:
    """Row count per pair of values, nulls included as values."""
    require_columns(df, [col_1, col_2])
    return df.groupBy(column(col_1), column(col_2)).count()


def chi_square(df: DataFrame, col_1: str, col_2: str) -> tuple[DataFrame, DataFrame]:
    """The contingency table, and one row ``statistic, dof, p_value`` of Pearson's test.

    The test works on the counted pairs, so it has no limit on the number of values. Rows with
    a null in either column take no part in the test.
    """
    if col_1 == col_2:
        raise ValueError("the test needs two different columns")
    counts = stage(contingency(df, col_1, col_2))
    cells = counts.dropna(subset=[col_1, col_2]).select(
        column(col_1).alias("a"), column(col_2).alias("b"), F.col("count").alias("observed"))
    by_a = cells.groupBy("a").agg(F.sum("observed").alias("a_total"))
    by_b = cells.groupBy("b").agg(F.sum("observed").alias("b_total"))
    rows = by_a.agg(F.count(F.lit(1)).alias("n_a"), F.sum("a_total").alias("total")).first()
    n_a, total = rows["n_a"], float(rows["total"] or 0)
    n_b = by_b.count()

    expected = F.col("a_total") * F.col("b_total") / F.lit(total or 1.0)
    joined = equi_join(equi_join(cells, by_a, "a", "left"), by_b, "b", "left")
    sums = joined.select("observed", expected.alias("expected")).agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.sum(F.pow(F.col("observed") - F.col("expected"), 2) / F.col("expected")).alias("seen"),
        F.sum("expected").alias("expected"),
    )
    # A pair that never occurs adds its expected count; together they add what is missing.
    unseen = F.when(F.col("n_cells") == F.lit(n_a * n_b), F.lit(0.0)).otherwise(
        F.lit(total) - F.col("expected"))
    dof = max(n_a - 1, 0) * max(n_b - 1, 0)
    result = sums.select(
        (F.col("seen") + unseen).alias("statistic"), F.lit(dof).cast("bigint").alias("dof"))
    return counts, result.withColumn(
        "p_value", chi_square_p_value(F.col("statistic"), F.col("dof")))


def correlation_matrix(df: DataFrame, columns: list[str], nulls: str = "error") -> DataFrame:
    """Pearson correlation of every pair as rows ``col_i, col_j, corr``, both orders included.

    Nulls and NaN are an error; with ``nulls="skip"`` their rows are left out as a whole, with ``"pairwise"`` each pair
    takes the rows that have both. A constant column has no correlation, not even with itself: null. One
    pass over the rows for some thousand columns; the pairs are made on the executors.
    """
    require_choice(nulls, ("error", "skip", "pairwise"), "nulls")
    require_numeric(df, columns)
    if len(set(columns)) < len(columns) or not columns:
        raise ValueError("columns must be a list of different names")
    values = df.select(*[numeric(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    if nulls == "skip":
        values = values.dropna()
    moments = block_moments(values, len(columns))
    if nulls == "error":
        rows, counts = column_counts(moments, len(columns))
        holed = [c for c, n in zip(columns, counts) if n < rows]
        if holed:
            raise ValueError(f"null values in {', '.join(map(repr, holed))}: impute them or pass nulls='skip'")
    made = correlations(moments, columns)
    if not moments.filter(F.col("block") >= 0).limit(1).count():  # not a row
        names = df.sparkSession.createDataFrame([(c,) for c in columns], "name string")
        return names.select(F.col("name").alias("col_i"), F.explode(F.array(*map(F.lit, columns))).alias("col_j"),
                            F.lit(None).cast("double").alias("corr"))
    return made


def box_stats(
    df: DataFrame, value: str, by: str | None = None, *, accuracy: int | None = None
) -> DataFrame:
    """The numbers of a box plot, overall or per category.

    Quartiles interpolate linearly. A whisker ends at the most extreme value within 1.5 times
    the interquartile range of the box; values beyond are outliers. Quartiles are exact unless
    ``accuracy`` asks for a sketch, which saves one pass. Infinite values have no place in the plot
    and are left out, like nulls and NaN.
    """
    require_numeric(df, [value])
    groups = [by] if by is not None else []
    require_columns(df, groups)
    probs = [0.25, 0.5, 0.75]
    df = df.withColumn(value, _finite(df, value))
    group = F.struct(*[column(c) for c in groups]) if groups else F.struct(F.lit(0))
    rows = df.select(group.alias("grp"), numeric(df, value).alias("v"))
    if accuracy is None:
        quartiles = exact_quantiles(df, value, probs, groups, kind="cont")
        boxes = quartiles.select(
            group.alias("grp"), "n", "min", "max", F.col("quantiles").alias("q"))
    else:
        boxes = rows.groupBy("grp").agg(
            F.count("v").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"),
            F.percentile_approx("v", probs, accuracy).alias("q"))
    reach = (F.col("q")[2] - F.col("q")[0]) * 1.5
    boxes = stage(boxes.select(
        "grp", "n", "min", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"), "max",
        (F.col("q")[0] - reach).alias("low_fence"), (F.col("q")[2] + reach).alias("high_fence"),
    ))
    inside = F.col("v").between(F.col("low_fence"), F.col("high_fence"))
    fences = boxes.select("grp", "low_fence", "high_fence")
    whiskers = (
        with_group_values(rows.filter(F.col("v").isNotNull()), fences, bool(groups))
        .groupBy("grp")
        .agg(F.min(F.when(inside, F.col("v"))).alias("lower_whisker"),
             F.max(F.when(inside, F.col("v"))).alias("upper_whisker"),
             F.count_if(~inside).alias("n_outliers"))
    )
    return boxes.drop("low_fence", "high_fence").join(whiskers, "grp", "left").select(
        *[F.col("grp")[name].alias(name) for name in groups],
        "n", "min", "q1", "median", "q3", "max", "lower_whisker", "upper_whisker",
        F.coalesce("n_outliers", F.lit(0)).alias("n_outliers"),
    )


def bin_2d(
    df: DataFrame, x: str, y: str, x_width: float, y_width: float, by: str | None = None
) -> DataFrame:
    """Number of points per rectangle of the plane: the density behind a scatter plot.

    Bin i covers [i * width, (i + 1) * width). Points without two finite coordinates are not drawn.
    """
    require_numeric(df, [x, y])
    require_columns(df, [by] if by else [])
    if x_width <= 0 or y_width <= 0:
        raise ValueError("bin widths must be positive")
    points = df.select(
        F.floor(_finite(df, x) / F.lit(float(x_width))).alias("x_bin"),
        F.floor(_finite(df, y) / F.lit(float(y_width))).alias("y_bin"),
        *([column(by)] if by else []),
    ).dropna(subset=["x_bin", "y_bin"])
    return points.groupBy("x_bin", "y_bin", *([column(by)] if by else [])).agg(
        F.count(F.lit(1)).alias("n"))


def sample_points(
    df: DataFrame, columns: list[str], fraction: float, seed: int = 123
) -> DataFrame:
    """A random share of the points of a scatter plot, for drawing them one by one."""
    require_unit_interval(fraction, "fraction")
    require_columns(df, columns)
    return df.select(*[column(c) for c in columns]).sample(fraction=fraction, seed=seed)
