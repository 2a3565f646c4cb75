"""Null imputation whose parameters are a table: fitted once, stored, and joined back.

The same ``apply_imputation`` serves the rows the parameters were fitted on and new rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataprop.functions.checks import (
    require_choice,
    require_columns,
    require_dataframe,
    require_numeric,
)
from strataprop.functions.expressions import column, numeric
from strataprop.functions.runtime import fits_broadcast, stage
from strataprop.operators.joins import equi_join, find_hot_keys_of
from strataprop.operators.quantiles import exact_quantiles

METHODS = ("mean", "median")
MEDIAN_ACCURACY = 10_000
# Size of the mergeable sketches: a median is off by about 0.1 % of the ranks.
SKETCH_K = 4096

PARAMS_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("stratum_column", T.StringType()),
    T.StructField("stratum_type", T.StringType()),
    T.StructField("stratum_value", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


# Facts of a fit that add up with those of other rows: counts, sums, and sketches of medians.
STATISTICS_KEYS = [*PARAMS_SCHEMA.fieldNames()[:-1], "rounds", "fallback"]
STATISTICS_SCHEMA = T.StructType([
    *PARAMS_SCHEMA.fields[:-1],
    T.StructField("rounds", T.BooleanType()),
    T.StructField("fallback", T.BooleanType()),
    T.StructField("n", T.LongType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("sketch", T.BinaryType()),
])


@dataclass(frozen=True)
class Impute:
    """What to put in place of the nulls of one column.

    A mean per stratum is rounded to an integer and a global mean is not, unless ``rounded``
    says otherwise. The median is the lower one for an even count; ``exact`` replaces its sketch
    by a second pass over the data. ``fallback`` also fits the value over all rows, for rows whose
    stratum is null or was not seen.
    """

    column: str
    method: str = "mean"
    stratum: str | None = None
    rounded: bool | None = None
    exact: bool = False
    accuracy: int = MEDIAN_ACCURACY
    fallback: bool = False

    @property
    def rounds(self) -> bool:
        if self.rounded is None:
            return self.method == "mean" and self.stratum is not None
        return self.rounded


def _check(df: DataFrame, specs: list[Impute]) -> list[Impute]:
    require_dataframe(df, "input")
    specs = [specs] if isinstance(specs, Impute) else list(specs)
    if not specs:
        raise ValueError("no imputation was asked for")
    for spec in specs:
        if not isinstance(spec, Impute):
            raise TypeError(f"expected Impute, not {type(spec).__name__}")
        require_choice(spec.method, METHODS, "method")
        require_numeric(df, [spec.column])
        if spec.stratum is not None:
            require_columns(df, [spec.stratum])
            if spec.stratum == spec.column:
                raise ValueError(f"{spec.column!r} cannot be its own stratum")
    names = [s.column for s in specs]
    if len(set(names)) < len(names):
        raise ValueError("each column can be imputed once")
    return specs


def _rounded(spec: Impute, value: Column) -> Column:
    return F.round(value) if spec.rounds else value


def _params_row(spec: Impute, df: DataFrame, stratum: Column, value: Column) -> Column:
    """One entry of the parameter table as a struct in the order of PARAMS_SCHEMA."""
    stratum_type = df.schema[spec.stratum].dataType.simpleString() if spec.stratum else None
    return F.struct(
        F.lit(spec.column).alias("column"),
        F.lit(spec.method).alias("method"),
        F.lit(spec.stratum).cast("string").alias("stratum_column"),
        F.lit(stratum_type).cast("string").alias("stratum_type"),
        stratum.cast("string").alias("stratum_value"),
        _rounded(spec, value).alias("value"),
    )


def _one_pass_params(df: DataFrame, specs: list[Impute]) -> DataFrame:
    """Every mean and sketched median from one scan, whatever the mix of strata.

    With several strata each row is repeated once per stratum column, and a value is fed only
    to the aggregates of its own stratum, so the repeats are combined before the shuffle.
    """
    strata = list(dict.fromkeys(s.stratum for s in specs))
    set_id = F.explode(F.array(*[F.lit(i) for i in range(len(strata))])) \
        if len(strata) > 1 else F.lit(0)
    used = list(dict.fromkeys([s.column for s in specs] + [s for s in strata if s]))
    rows = df.select(*[column(c) for c in used], set_id.alias("__set"))
    keys = [
        F.when(F.col("__set") == i, column(s)).alias(f"__stratum_{i}")
        for i, s in enumerate(strata) if s
    ]
    aggregates = []
    for j, spec in enumerate(specs):
        value = F.when(F.col("__set") == strata.index(spec.stratum), numeric(df, spec.column))
        if spec.method == "mean":
            aggregates.append(F.avg(value).alias(f"__value_{j}"))
        else:
            aggregates.append(
                F.percentile_approx(value, 0.5, spec.accuracy).alias(f"__value_{j}"))
    grouped = rows.groupBy("__set", *keys).agg(*aggregates)
    entries = []
    for j, spec in enumerate(specs):
        i = strata.index(spec.stratum)
        stratum = F.col(f"__stratum_{i}") if spec.stratum else F.lit(None)
        entry = _params_row(spec, df, stratum, F.col(f"__value_{j}"))
        entries.append(F.when(F.col("__set") == i, entry))
    entry = F.explode(F.array_compact(F.array(*entries)))
    return grouped.select(entry.alias("entry")).select("entry.*")


def _exact_params(df: DataFrame, specs: list[Impute]) -> DataFrame:
    """Exact medians for all their columns together, in two passes."""
    items = [
        F.struct(
            F.lit(j).alias("spec"),
            (column(s.stratum) if s.stratum else F.lit(None)).cast("string").alias("stratum"),
            numeric(df, s.column).alias("v"),
        )
        for j, s in enumerate(specs)
    ]
    long = df.select(F.explode(F.array(*items)).alias("item")).select("item.*")
    medians = exact_quantiles(long, "v", [0.5], ["spec", "stratum"])
    entry = F.when(F.lit(False), F.lit(None))
    for j, spec in enumerate(specs):
        row = _params_row(spec, df, F.col("stratum"), F.col("quantiles")[0])
        entry = F.when(F.col("spec") == j, row) if j == 0 else entry.when(F.col("spec") == j, row)
    return medians.select(entry.alias("entry")).select("entry.*")


def imputation_params(df: DataFrame, specs: list[Impute] | Impute) -> DataFrame:
    """The parameter table as a plan: a row per column, or per column and stratum value.

    Rows of a null stratum are left out, since a null stratum never matches. A stratum in
    which the column is always null has a null value. The value for all other strata, if asked
    for, is a row of its stratum column without a stratum value. Only exact medians start a job here.
    """
    specs = _check(df, specs)
    fallback = {s.column: s.stratum for s in specs if s.fallback and s.stratum is not None}
    fitted = [*specs, *[replace(s, stratum=None, rounded=s.rounds) for s in specs if s.column in fallback]]
    exact = [s for s in fitted if s.method == "median" and s.exact]
    sketched = [s for s in fitted if s not in exact]
    parts = []
    if sketched:
        parts.append(_one_pass_params(df, sketched))
    if exact:
        parts.append(_exact_params(df, exact))
    params = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    params = params.filter(F.col("stratum_column").isNull() | F.col("stratum_value").isNotNull())
    for name, stratum in fallback.items():
        overall = (F.col("column") == name) & F.col("stratum_column").isNull()
        kind = df.schema[stratum].dataType.simpleString()
        params = params.withColumns({
            "stratum_column": F.when(overall, F.lit(stratum)).otherwise(F.col("stratum_column")),
            "stratum_type": F.when(overall, F.lit(kind)).otherwise(F.col("stratum_type"))})
    return params.select(*[F.col(f.name).cast(f.dataType) for f in PARAMS_SCHEMA])


def fit_imputation(
    df: DataFrame, specs: list[Impute] | Impute, path: str | None = None
) -> DataFrame:
    """Compute the parameter table, write it to ``path`` or the shared folder, and read it back.

    A column with no value at all has nothing to impute from, which is an error when it is
    asked for over the whole table.
    """
    specs = _check(df, specs)
    params = stage(imputation_params(df, specs), path)
    wanted = {s.column for s in specs if s.stratum is None}
    if not wanted:
        return params
    found = {
        r["column"]
        for r in params.filter(F.col("stratum_column").isNull() & F.col("value").isNotNull())
        .select("column").collect()  # one row per imputed column
    }
    if wanted - found:
        raise ValueError(f"no value to impute from in: {', '.join(sorted(wanted - found))}")
    return params


def fit_statistics(df: DataFrame, specs: list[Impute] | Impute, path: str | None = None) -> DataFrame:
    """What the parameters are made of, as a table that later rows can be added to without a rescan.

    A row per column and stratum, the null stratum included: ``n`` values, their ``total``, and for a median a
    KLL sketch, whose size does not grow with the rows. Means and medians are aggregated apart, so that means stay a
    hash aggregate. Written to ``path`` or the shared folder. Exact medians do not add up and are refused.
    """
    specs = _check(df, specs)
    exact = [s.column for s in specs if s.method == "median" and s.exact]
    if exact:
        raise ValueError(f"exact medians cannot be added up: {', '.join(exact)}")
    parts = []
    for method in METHODS:
        chosen = [s for s in specs if s.method == method]
        if not chosen:
            continue
        cells = [F.struct(
            F.lit(s.column).alias("column"), F.lit(method).alias("method"),
            F.lit(s.stratum).cast("string").alias("stratum_column"),
            F.lit(df.schema[s.stratum].dataType.simpleString() if s.stratum else None).cast("string").alias("stratum_type"),
            (column(s.stratum) if s.stratum else F.lit(None)).cast("string").alias("stratum_value"),
            F.lit(s.rounds).alias("rounds"), F.lit(s.fallback and s.stratum is not None).alias("fallback"),
            numeric(df, s.column).alias("v")) for s in chosen]
        sketch = F.kll_sketch_agg_double("v", F.lit(SKETCH_K)) if method == "median" else F.lit(None).cast("binary")
        long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
        grouped = long.groupBy(*STATISTICS_KEYS).agg(
            F.count("v").alias("n"), F.sum("v").alias("total"), *([sketch.alias("sketch")] if method == "median" else []))
        parts.append(grouped if method == "median" else grouped.withColumn("sketch", sketch))
    statistics = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return stage(statistics.select(*[F.col(f.name).cast(f.dataType) for f in STATISTICS_SCHEMA]), path)


def _added(statistics: DataFrame, keys: list[str]) -> DataFrame:
    means = statistics.filter(F.col("method") == "mean").groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")).withColumn("sketch", F.lit(None).cast("binary"))
    medians = statistics.filter((F.col("method") == "median") & (F.col("n") > 0)).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.kll_merge_agg_double("sketch").alias("sketch"))
    empty = statistics.filter((F.col("method") == "median") & (F.col("n") == 0)).select(*keys).distinct()
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    condition = same[0]
    for other in same[1:]:
        condition = condition & other
    left = empty.alias("e").join(medians.select(*keys).alias("m"), condition, "left_anti")
    return means.unionByName(medians).unionByName(left.select(
        *keys, F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("total"),
        F.lit(None).cast("binary").alias("sketch")))


def merge_statistics(statistics: list[DataFrame], path: str | None = None) -> DataFrame:
    """The statistics of all the rows together, from those of their parts; written like those of a fit."""
    if not statistics:
        raise ValueError("there are no statistics to merge")
    whole = statistics[0]
    for part in statistics[1:]:
        whole = whole.unionByName(part)
    return stage(_added(whole, STATISTICS_KEYS).select(*STATISTICS_SCHEMA.fieldNames()), path)


def params_from_statistics(statistics: DataFrame) -> DataFrame:
    """The parameter table that ``apply_imputation`` takes, from fitted or merged statistics.

    Means are exact; a median is a value whose rank is within the sketch's error of the middle.
    """
    median = F.when((F.col("method") == "median") & (F.col("n") > 0), F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)))
    plain = F.coalesce(median, F.when(F.col("method") == "mean", F.try_divide("total", F.col("n"))))
    keys = [k for k in STATISTICS_KEYS if k != "stratum_value"]
    overall = _added(statistics.filter("fallback"), keys).withColumn("stratum_value", F.lit(None).cast("string"))
    known = statistics.filter(F.col("stratum_column").isNull() | F.col("stratum_value").isNotNull())
    rows = known.unionByName(overall.select(known.columns))
    return rows.withColumn("value", F.when(F.col("rounds"), F.round(plain)).otherwise(plain)).select(
        *[F.col(f.name).cast(f.dataType) for f in PARAMS_SCHEMA])


def params_from_values(
    df: DataFrame, values: dict[str, float | dict], strata: dict[str, str] | None = None
) -> DataFrame:
    """A parameter table for ``df`` from values that are already known.

    ``values`` maps a column to a number, or to ``{stratum value: number}``; ``strata`` names
    the stratum column of each nested entry.
    """
    strata = strata or {}
    entries = []
    for name, value in values.items():
        require_numeric(df, [name])
        nested = isinstance(value, dict)
        if nested != (name in strata):
            raise ValueError(f"{name!r} needs a stratum column exactly if its values are nested")
        if nested:
            require_columns(df, [strata[name]])
            stratum_type = df.schema[strata[name]].dataType.simpleString()
        for stratum, number in (value if nested else {None: value}).items():
            if isinstance(number, bool) or not isinstance(number, (int, float)):
                raise TypeError(f"{name!r} cannot be filled with {number!r}")
            if not nested:
                entries.append((name, "given", None, None, None, float(number)))
            elif stratum is not None:
                entries.append((name, "given", strata[name], stratum_type, str(stratum), float(number)))
    return df.sparkSession.createDataFrame(entries, PARAMS_SCHEMA)


def apply_imputation(df: DataFrame, params: DataFrame) -> DataFrame:
    """Fill nulls from a parameter table; filled columns become double.

    Columns that share a stratum are filled by one join. The parameters are cast to the type
    of the input's own stratum column. Rows whose stratum is null or unknown get the value for
    other strata, or stay null if there is none. Two rows for one column and stratum are an error.
    One job reads the parameters, and without a broadcast one pass counts the keys of all strata.
    """
    require_dataframe(df, "input")
    require_dataframe(params, "params")
    require_columns(params, PARAMS_SCHEMA.fieldNames(), "params")
    header = (
        params.groupBy("column", "stratum_column")
        .agg(F.max(F.when(F.col("stratum_column").isNull(), F.col("value"))).alias("value"),
             F.max(F.when(F.col("stratum_value").isNull(), F.col("value"))).alias("other"),
             F.count_distinct("method").alias("methods"), F.count(F.lit(1)).alias("rows"),
             (F.count_distinct("stratum_value") + F.max(F.col("stratum_value").isNull().cast("int"))
              ).alias("different"))
        .collect()  # one row per imputed column
    )
    names = [r["column"] for r in header]
    if len(set(names)) < len(names) or any(r["methods"] > 1 for r in header):
        raise ValueError("params hold more than one rule for a column")
    repeated = [r["column"] for r in header if r["rows"] > r["different"]]
    if repeated:
        raise ValueError(f"params hold two values for one stratum of: {', '.join(sorted(repeated))}")
    require_numeric(df, names)
    columns, filled = df.columns, {}
    other = {r["column"]: r["other"] for r in header}
    strata: dict[str, list[str]] = {}
    for row in header:
        if row["stratum_column"] is None:
            filled[row["column"]] = F.coalesce(numeric(df, row["column"]), F.lit(row["value"]))
        else:
            strata.setdefault(row["stratum_column"], []).append(row["column"])
    require_columns(df, strata)

    # Parameters small enough to broadcast are also small enough to pivot without a shuffle.
    small = fits_broadcast(params)
    rules = params.coalesce(1) if small else params
    hot = {} if small else find_hot_keys_of(df, list(strata))
    wide = df
    for i, (stratum, imputed) in enumerate(sorted(strata.items())):
        key = F.col("stratum_value").try_cast(df.schema[stratum].dataType)
        lookup = (
            rules.filter((F.col("stratum_column") == stratum) & F.col("stratum_value").isNotNull())
            .groupBy(key.alias(stratum))
            .agg(*[
                F.max(F.when(F.col("column") == name, F.col("value"))).alias(f"__fill_{i}_{j}")
                for j, name in enumerate(imputed)
            ])
        )
        wide = equi_join(wide, lookup, stratum, "left", hot=hot.get(stratum))
        for j, name in enumerate(imputed):
            filled[name] = F.coalesce(
                numeric(df, name), F.col(f"__fill_{i}_{j}"), F.lit(other[name]).cast("double"))
    return wide.select(*[
        filled[c].alias(c) if c in filled else column(c) for c in columns
    ])
