"""One query per operator over the given tables: name -> function of session and folder."""

from __future__ import annotations

from contextlib import contextmanager
from uuid import uuid4

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataprop.functions.expressions import at_least
from strataprop.functions.runtime import shared_folder, stage
from strataprop.operators import exploration, metrics, splitting
from strataprop.operators.categories import category_dictionary, ordered_target_statistics, sparse_features
from strataprop.operators.features import FEATURES, category_index, count_holes, encoding_stages
from strataprop.operators.imputation import (
    Impute,
    apply_imputation,
    fit_imputation,
    fit_statistics,
    merge_statistics,
    params_from_statistics,
    params_from_values,
)
from strataprop.operators.joins import equi_join, unique_dimension
from strataprop.operators.quantiles import exact_quantiles
from strataprop.operators.scoring import score, score_python
from strataprop.operators.training import fit_classifier
from strataprop.plans import fixtures as fx
from strataprop.plans import propensity
from strataprop.sources.artifacts import load_params, save_params
from strataprop.sources.tables import read_delimited, read_table, write_batch, write_entity_table, write_table


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/query-{uuid4().hex}"


# --- sources and joins ---------------------------------------------------------------------


def scan_table(spark, sf_dir) -> DataFrame:
    fx.table(spark, sf_dir, "orders").createOrReplaceTempView("strataprop_orders")
    return read_table(spark, "strataprop_orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


def delimited_dimension(spark, sf_dir) -> DataFrame:
    rows, path = fx.dimension(spark, sf_dir), _new_folder(spark)
    rows.write.option("header", True).csv(path)
    return read_delimited(spark, path, rows.schema)


def feature_table(spark, sf_dir) -> DataFrame:
    return fx.features(spark, sf_dir)


def feature_table_no_target(spark, sf_dir) -> DataFrame:
    return fx.features(spark, sf_dir, labelled=False)


def join_composite_key(spark, sf_dir) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem")
    key = ["l_partkey", "l_suppkey"]
    supplied = lines.groupBy(*key).agg(
        F.count(F.lit(1)).alias("pair_lines"), F.round(F.sum("l_quantity"), 2).alias("pair_qty"))
    return equi_join(lines.select("l_orderkey", "l_linenumber", *key), supplied, key)


def _repeated_nations(spark, sf_dir) -> DataFrame:
    nation = fx.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_id"), "n_name", F.lit(1).alias("version"))
    again = nation.filter(F.col("nation_id") == 1).withColumn("version", F.lit(2))
    return nation.unionByName(again)


def _customers(spark, sf_dir) -> DataFrame:
    return fx.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nation_id"))


def join_duplicate_dimension(spark, sf_dir) -> DataFrame:
    return equi_join(_customers(spark, sf_dir), _repeated_nations(spark, sf_dir), "nation_id")


def join_first_of_duplicates(spark, sf_dir) -> DataFrame:
    newest = _repeated_nations(spark, sf_dir).withColumn("age", -F.col("version"))
    nations = unique_dimension(newest, "nation_id", "first", ["age"]).drop("age")
    return equi_join(_customers(spark, sf_dir), nations, "nation_id")


def join_semi(spark, sf_dir) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return equi_join(fx.profile(spark, sf_dir), lines, "id", "left_semi")


@contextmanager
def _shuffled(spark):
    """Plan as for sides too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def join_hot_left(spark, sf_dir) -> DataFrame:
    """Every supplier has many lines: all keys of the left side are spread."""
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("supp_id"))
    suppliers = fx.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supp_id"), "s_name")
    with _shuffled(spark):
        return equi_join(lines, suppliers, "supp_id", hot_rows=20)


def join_hot_right(spark, sf_dir) -> DataFrame:
    nations = fx.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation_id"), "n_name")
    with _shuffled(spark):
        return equi_join(nations, _customers(spark, sf_dir), "nation_id", hot_rows=2, repeated_right=True)


def _suppliers(spark, sf_dir) -> DataFrame:
    return fx.table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.when(F.col("s_suppkey") % 9 > 0, F.col("s_nationkey")).alias("nation_id"))


def join_hot_both(spark, sf_dir) -> DataFrame:
    with _shuffled(spark):
        return equi_join(_suppliers(spark, sf_dir), _customers(spark, sf_dir), "nation_id",
                         hot_rows=2, repeated_right=True)


def _sparse_nations(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """All suppliers and customers, their nations renumbered so that either side has some of its own."""
    return (_suppliers(spark, sf_dir).withColumn("nation_id", F.col("nation_id") * 2),
            _customers(spark, sf_dir).withColumn("nation_id", F.col("nation_id") * 3))


def join_right(spark, sf_dir) -> DataFrame:
    with _shuffled(spark):
        return equi_join(*_sparse_nations(spark, sf_dir), "nation_id", "right", hot_rows=2)


def join_full(spark, sf_dir) -> DataFrame:
    with _shuffled(spark):
        return equi_join(*_sparse_nations(spark, sf_dir), "nation_id", "full", hot_rows=2)


def join_bucketed(spark, sf_dir) -> DataFrame:
    """Profile, performance and target as stored tables of one bucketing, joined without a shuffle."""
    folder, name = _new_folder(spark), f"strataprop_{uuid4().hex}"
    parts = {"profile": fx.profile, "performance": fx.performance, "target": fx.target}
    tables = [write_entity_table(make(spark, sf_dir), f"{name}_{part}", "id", 8, f"{folder}/{part}")
              for part, make in parts.items()]
    with _shuffled(spark):
        return equi_join(equi_join(tables[0], tables[1], "id", hot_rows=2**60), tables[2], "id", hot_rows=2**60)


# --- imputation ----------------------------------------------------------------------------


def _imputed(spark, sf_dir, spec: Impute) -> DataFrame:
    rows = fx.profile_with_nulls(spark, sf_dir)
    filled = apply_imputation(rows, fit_imputation(rows, spec))
    return filled.select("id", "priority", F.round("total_price", 4).alias("total_price"))


def impute_global_mean(spark, sf_dir) -> DataFrame:
    return _imputed(spark, sf_dir, Impute("total_price", "mean"))


def impute_global_median(spark, sf_dir) -> DataFrame:
    return _imputed(spark, sf_dir, Impute("total_price", "median", exact=True))


def impute_stratified_mean(spark, sf_dir) -> DataFrame:
    return _imputed(spark, sf_dir, Impute("total_price", "mean", "priority"))


def impute_stratified_median(spark, sf_dir) -> DataFrame:
    return _imputed(spark, sf_dir, Impute("total_price", "median", "priority", exact=True))


def impute_given_values(spark, sf_dir) -> DataFrame:
    rows = fx.profile_with_nulls(spark, sf_dir)
    params = params_from_values(
        rows, {"total_price": {"1-URGENT": 100.0, "5-LOW": 50}}, {"total_price": "priority"})
    return apply_imputation(rows, params).select("id", "priority", "total_price")


def median_sketch_error(spark, sf_dir) -> DataFrame:
    """The sketched median per stratum, with a sketch so fine that it has no error."""
    rows = fx.profile_with_nulls(spark, sf_dir)
    spec = Impute("total_price", "median", "priority", accuracy=1_000_000)
    params = fit_imputation(rows, spec).select(F.col("stratum_value").alias("priority"), "value")
    counted = rows.groupBy("priority").agg(F.count("total_price").alias("n"))
    return equi_join(counted, params, "priority").select(
        "priority", "n", F.round("value", 4).alias("median"))


def impute_global_sketch(spark, sf_dir) -> DataFrame:
    return _imputed(spark, sf_dir, Impute("total_price", "median", accuracy=1_000_000))


def impute_unknown_stratum(spark, sf_dir) -> DataFrame:
    """Fitted without one priority, whose rows get the value over all fitted rows."""
    rows = fx.profile_with_nulls(spark, sf_dir)
    params = fit_imputation(rows.filter("priority <> '1-URGENT'"),
                            Impute("total_price", "mean", "priority", fallback=True))
    return apply_imputation(rows, params).select(
        "id", "priority", F.round("total_price", 4).alias("total_price"))


def quantiles_narrow(spark, sf_dir) -> DataFrame:
    """Exact quantiles of groups larger than the sketch, whose brackets are narrow."""
    lines = fx.table(spark, sf_dir, "lineitem")
    found = exact_quantiles(lines, "l_extendedprice", [0.1, 0.5, 0.9], ["l_returnflag"], accuracy=1000)
    return found.select("l_returnflag", "n", *[
        F.round(F.col("quantiles")[i], 4).alias(name) for i, name in enumerate(("q10", "q50", "q90"))])


SPECS = [
    Impute("total_price", "mean", "priority"),
    Impute("sum_qty", "mean", "region_id"),
    Impute("n_lines", "mean"),
    Impute("avg_discount", "mean", "segment", rounded=False),
    Impute("max_price", "median", "segment", exact=True),
]


def imputation_params(spark, sf_dir) -> DataFrame:
    path = _new_folder(spark)
    params = fit_imputation(stage(fx.features(spark, sf_dir, nulls=True)), SPECS)
    save_params(params, path)
    return load_params(spark, path).withColumn("value", F.round("value", 4))


def _split_features(spark, sf_dir, nulls: bool = False) -> DataFrame:
    return splitting.split_by_hash(
        fx.features(spark, sf_dir, nulls=nulls), key="id", target="label")


def _filled(spark, sf_dir) -> DataFrame:
    """The feature table with its split, filled with what the training part says."""
    split = stage(_split_features(spark, sf_dir, nulls=True), partition_by="split")
    return apply_imputation(split, fit_imputation(split.filter(F.col("split") == "train"), SPECS))


def impute_out_of_sample(spark, sf_dir) -> DataFrame:
    return _filled(spark, sf_dir).select(
        "id", "split", *[F.round(s.column, 6).alias(s.column) for s in SPECS])


def merged_medians(spark, sf_dir) -> DataFrame:
    """Fitted on two halves, merged: the mean, and the median's rank among the values of its stratum."""
    rows = fx.profile_with_nulls(spark, sf_dir)
    specs = [Impute("total_price", "median", "priority")]
    halves = [fit_statistics(rows.filter(F.col("id") % 2 == k), specs) for k in (0, 1)]
    merged = merge_statistics(halves)
    medians = params_from_statistics(merged).select(F.col("stratum_value").alias("priority"), "value")
    ranked = equi_join(rows.filter("total_price is not null"), medians, "priority").groupBy("priority").agg(
        F.round(F.avg((F.col("total_price") <= F.col("value")).cast("int")), 2).alias("rank_share"))
    means = merged.select(F.col("stratum_value").alias("priority"), "n", F.round(F.col("total") / F.col("n"), 4).alias("mean"))
    return equi_join(means, ranked, "priority")


def null_checks(spark, sf_dir) -> DataFrame:
    rows = fx.features(spark, sf_dir, nulls=True)
    return count_holes(rows, rows.columns)


# --- splits --------------------------------------------------------------------------------


def _split(spark, sf_dir) -> DataFrame:
    return splitting.split_by_hash(fx.target(spark, sf_dir), key="id", target="label")


def split_hash(spark, sf_dir) -> DataFrame:
    return _split(spark, sf_dir)


def split_validation_anti(spark, sf_dir) -> DataFrame:
    train, _ = splitting.train_validation(_split(spark, sf_dir))
    return splitting.validation_rows(fx.target(spark, sf_dir), train, "id")


def split_validation_filtered(spark, sf_dir) -> DataFrame:
    """The anti-join behind a Bloom filter of the training keys."""
    train, _ = splitting.train_validation(_split(spark, sf_dir))
    return splitting.validation_rows(fx.target(spark, sf_dir), train, "id", filter_bits=22)


def split_union(spark, sf_dir) -> DataFrame:
    train, _ = splitting.train_validation(_split(spark, sf_dir))
    rest = splitting.validation_rows(fx.target(spark, sf_dir), train, "id")
    return train.withColumn("sample", F.lit("train")).unionByName(
        rest.withColumn("sample", F.lit("val")))


def split_counts(spark, sf_dir) -> DataFrame:
    return splitting.split_counts(_split(spark, sf_dir), "label")


def split_bernoulli(spark, sf_dir) -> DataFrame:
    return splitting.split_by_sampling(fx.target(spark, sf_dir), key="id", target="label")


def split_bernoulli_counts(spark, sf_dir) -> DataFrame:
    """Per label: rows in either part, keys in both, and the share drawn to one digit."""
    train, validation = splitting.train_validation(split_bernoulli(spark, sf_dir))
    parts = train.withColumn("drawn", F.lit(1)).unionByName(
        validation.withColumn("drawn", F.lit(0)))
    per_key = parts.groupBy("id", "label").agg(
        F.sum("drawn").alias("drawn"), F.count(F.lit(1)).alias("copies"))
    share = F.round(F.avg("drawn"), 1)
    return per_key.groupBy("label").agg(
        F.sum("copies").alias("n"),
        F.count_if(F.col("copies") > 1).alias("in_both"),
        share.alias("share"))


# --- exploration ---------------------------------------------------------------------------


def contingency(spark, sf_dir) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    counts = exploration.contingency(orders, "o_orderpriority", "o_orderstatus")
    return counts.withColumnRenamed("count", "n")


def chi_square(spark, sf_dir) -> DataFrame:
    label = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label")
    orders = fx.table(spark, sf_dir, "orders").select("o_orderpriority", label)
    _, result = exploration.chi_square(orders, "o_orderpriority", "label")
    return result.select(
        F.round("statistic", 6).alias("statistic"), "dof", F.round("p_value", 6).alias("p_value"))


def correlation_matrix(spark, sf_dir) -> DataFrame:
    columns = ["total_price", "n_lines", "sum_qty", "max_price", "acctbal"]
    pairs = exploration.correlation_matrix(fx.features(spark, sf_dir), columns, nulls="skip")
    return pairs.withColumn("corr", F.round("corr", 6))


def correlation_matrix_wide(spark, sf_dir) -> DataFrame:
    """Seventeen columns, one of them constant."""
    wide = fx.features(spark, sf_dir)
    more = [(F.col("total_price") * k + F.col("id") % (k + 2) * 1000).alias(f"x{k}") for k in range(11)]
    wide = wide.select("total_price", "n_lines", "sum_qty", "max_price", "acctbal", *more,
                       F.lit(7.0).alias("constant"))
    pairs = exploration.correlation_matrix(wide, wide.columns, nulls="skip")
    return pairs.withColumn("corr", F.round("corr", 6))


def correlation_pairwise(spark, sf_dir) -> DataFrame:
    columns = ["total_price", "n_lines", "sum_qty", "max_price", "acctbal"]
    pairs = exploration.correlation_matrix(fx.features(spark, sf_dir, nulls=True), columns, nulls="pairwise")
    return pairs.withColumn("corr", F.round("corr", 6))


def box_stats(spark, sf_dir) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity") / F.col("l_quantity"))
        .alias("price"))
    stats = exploration.box_stats(lines, "price", "l_returnflag")
    numbers = ["min", "q1", "median", "q3", "max", "lower_whisker", "upper_whisker"]
    return stats.select(
        "l_returnflag", "n", "n_outliers", *[F.round(c, 4).alias(c) for c in numbers])


def box_stats_overall(spark, sf_dir) -> DataFrame:
    stats = exploration.box_stats(fx.profile_with_nulls(spark, sf_dir), "total_price")
    numbers = ["min", "q1", "median", "q3", "max", "lower_whisker", "upper_whisker"]
    return stats.select("n", "n_outliers", *[F.round(c, 4).alias(c) for c in numbers])


def bin_2d(spark, sf_dir) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem")
    return exploration.bin_2d(lines, "l_quantity", "l_extendedprice", 5.0, 10_000.0, "l_returnflag")


def scatter_sample(spark, sf_dir) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem")
    return exploration.sample_points(
        lines, ["l_quantity", "l_extendedprice", "l_returnflag"], 0.01)


# --- features, training, scoring -----------------------------------------------------------


def category_levels(spark, sf_dir) -> DataFrame:
    return category_index(fx.profile(spark, sf_dir), "priority")


def one_hot(spark, sf_dir) -> DataFrame:
    rows = fx.profile(spark, sf_dir)
    stages = encoding_stages(["total_price"], ["priority"], one_hot=True, handle_invalid="error")
    vector = vector_to_array(F.col(FEATURES))
    names = ["total_price", "level_0", "level_1", "level_2", "level_3"]
    return Pipeline(stages=stages).fit(rows).transform(rows).select(
        "id", *[vector[i].alias(name) for i, name in enumerate(names)])


def one_hot_table(spark, sf_dir) -> DataFrame:
    """The same from a dictionary that is a table."""
    rows = fx.profile(spark, sf_dir)
    dictionary = category_dictionary(rows, ["priority"])
    vectors = sparse_features(rows, dictionary, ["total_price"], ["priority"], keep=["id"])
    names = ["total_price", "level_0", "level_1", "level_2", "level_3"]
    vector = vector_to_array(F.col(FEATURES))
    return vectors.select("id", *[vector[i].alias(name) for i, name in enumerate(names)])


def target_means_before(spark, sf_dir) -> DataFrame:
    """Ordered target statistics of a column with thousands of levels and one with five."""
    rows = fx.profile(spark, sf_dir).join(fx.target(spark, sf_dir), "id")
    found = ordered_target_statistics(rows, ["cust_id", "priority"], "label", "id", prior=0.25, weight=2.0)
    return found.select("id", F.round("__cust_id_value", 9).alias("by_customer"), F.round("__priority_value", 9).alias("by_priority"))


CATEGORICALS = ["priority", "segment"]


TRAINING_SPECS = [
    Impute("total_price", "mean", "priority"), Impute("sum_qty"), Impute("n_lines"),
    Impute("avg_discount", "mean", "segment", rounded=False),
    Impute("max_price", "median", "segment"),
]


def _trained(spark, sf_dir, estimator: str, params: dict | None = None):
    return propensity.train(
        fx.features(spark, sf_dir, nulls=True).drop("cust_id", "nation_id", "region_id"),
        target="label", key="id", categoricals=CATEGORICALS, estimator=estimator,
        imputations=TRAINING_SPECS, estimator_params=params, threshold=0.33)


def logistic_train_metrics(spark, sf_dir) -> DataFrame:
    return _trained(spark, sf_dir, "logistic").metrics


def gbt_train_metrics(spark, sf_dir) -> DataFrame:
    return _trained(spark, sf_dir, "gbt").metrics


def _by_level(spark, sf_dir, split: str = "hash") -> DataFrame:
    """Order, label and one categorical; a ``given`` split is by the order's date."""
    rows = fx.target(spark, sf_dir).join(fx.profile(spark, sf_dir).select("id", "priority"), "id")
    if split == "hash":
        return rows
    dates = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.dayofmonth("o_orderdate").alias("day"))
    part = F.when(F.col("day") <= 20, "train").otherwise("val").alias("split")
    return rows.join(dates.select("id", part), "id")


def _trained_by_level(rows: DataFrame, method: str = "hash", **more):
    return propensity.train(rows, target="label", key="id", categoricals=["priority"],
                            method=method, **more)


EXACT = {"tol": 1e-10, "maxIter": 300}


def train_metrics_by_level(spark, sf_dir) -> DataFrame:
    """With one categorical the fitted probability is the level's share of positives."""
    result = _trained_by_level(_by_level(spark, sf_dir), estimator_params=EXACT)
    return result.metrics.withColumn("value", F.round("value", 6))


def train_given_split(spark, sf_dir) -> DataFrame:
    result = _trained_by_level(_by_level(spark, sf_dir, "given"), "given", estimator_params=EXACT)
    return result.metrics.withColumn("value", F.round("value", 6))


def train_sampled_copies(spark, sf_dir) -> DataFrame:
    """All keys drawn; copies of some keys without a label, or with another, stay out of the training part."""
    rows = _by_level(spark, sf_dir)
    copies = rows.filter("id % 10 < 2").withColumn("label", F.when(F.col("id") % 10 == 0, 7))
    result = _trained_by_level(rows.unionByName(copies), "sample", fraction=1.0, threshold=0.33, estimator_params=EXACT)
    return result.metrics.filter("sample = 'train_sample'").withColumn("value", F.round("value", 6))


def _saved_scores(spark, sf_dir, categories: str = "pipeline", **more) -> DataFrame:
    """Trained, saved, loaded, and applied to all rows."""
    rows, folder = _by_level(spark, sf_dir), _new_folder(spark)
    propensity.save_training(_trained_by_level(rows, categories=categories, **more), folder)
    return propensity.score_saved(rows, folder, imputed=False, categories=categories)


def table_score_by_level(spark, sf_dir) -> DataFrame:
    """The same with the levels in a table."""
    return _saved_scores(spark, sf_dir, "table", estimator_params=EXACT).select(
        "id", "priority", F.round("Probs_1", 3).alias("share"))


def gbt_wide_train_metrics(spark, sf_dir) -> DataFrame:
    """115 boosted trees with the customer as a category of thousands of levels."""
    features = fx.features(spark, sf_dir).drop("nation_id", "region_id").fillna(0).withColumn(
        "cust_id", F.col("cust_id").cast("string"))
    return propensity.train(
        features, target="label", key="id", categoricals=["cust_id", *CATEGORICALS], estimator="gbt",
        categories="table", threshold=0.33).metrics


def scored_batches_written(spark, sf_dir) -> DataFrame:
    """Scores written by batch, one batch twice: the rerun replaces its own rows only."""
    path = _new_folder(spark)
    scores = stage(_saved_scores(spark, sf_dir, estimator_params=EXACT).withColumn("batch", F.col("id") % 3))
    write_batch(scores, path, "batch")
    write_batch(scores.filter("batch = 1").withColumn("Probs_1", F.lit(2.0)), path, "batch")
    return read_table(spark, path).groupBy(F.col("batch").cast("long").alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("Probs_1") == 2).alias("rerun"))


def pipeline_score_by_level(spark, sf_dir) -> DataFrame:
    return _saved_scores(spark, sf_dir, estimator_params=EXACT).select(
        "id", "priority", F.round("Probs_1", 3).alias("share"))


def gbt_one_tree(spark, sf_dir) -> DataFrame:
    """The first tree's leaf holds the mean of 2 * label - 1 of its level."""
    one = {"maxIter": 1, "minInstancesPerNode": 1}
    return _saved_scores(spark, sf_dir, estimator="gbt", estimator_params=one).select(
        "id", "priority", F.round("Probs_1", 4).alias("probability"))


def scored_rows_written(spark, sf_dir) -> DataFrame:
    path = _new_folder(spark)
    write_table(_saved_scores(spark, sf_dir, estimator_params=EXACT), path)
    written = read_table(spark, path)
    return written.groupBy("priority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("Probs_1"), 3).alias("share"))


def logistic_calibration(spark, sf_dir) -> DataFrame:
    """At the maximum of the likelihood, the mean probability of each level of a one-hot feature
    equals the share of positives among its training rows."""
    split = stage(_split_features(spark, sf_dir).filter(F.col("split") == "train").select(
        "id", "label", "total_price", "acctbal", *CATEGORICALS))
    model = fit_classifier(split, target="label", key="id", categoricals=CATEGORICALS,
                           params={"tol": 1e-9, "maxIter": 200})
    return score(model, split).groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"),
        F.round(F.avg("Probs_1"), 2).alias("share"))


def pipeline_score(spark, sf_dir) -> DataFrame:
    folder = _new_folder(spark)
    propensity.save_training(_trained(spark, sf_dir, "logistic"), folder)
    new_rows = fx.features(spark, sf_dir, labelled=False, nulls=True)
    return propensity.score_saved(new_rows, folder, keep=["id", *CATEGORICALS])


def _line_scores(spark, sf_dir, keep: list[str]) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem")
    return score_python(lines, fx.line_return_model(), levels=fx.LINE_LEVELS, keep=keep)


def python_model_score(spark, sf_dir) -> DataFrame:
    scored = _line_scores(spark, sf_dir, ["l_orderkey", "l_linenumber"])
    return scored.select(
        "l_orderkey", "l_linenumber",
        *[F.round(c, 6).alias(c) for c in ("Probs_0", "Probs_1")])


def threshold_metrics(spark, sf_dir) -> DataFrame:
    scored = _line_scores(spark, sf_dir, ["l_returnflag", "l_linestatus"])
    graded = scored.select(
        "l_linestatus",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y_true"),
        at_least(F.col("Probs_1"), 0.5).alias("y_pred"))
    return _rounded(metrics.binary_metrics(graded, by="l_linestatus"))


def binary_metrics(spark, sf_dir) -> DataFrame:
    labels = fx.table(spark, sf_dir, "labels")
    return _rounded(metrics.binary_metrics(labels, "quality", "toxic"))


def metrics_by_sample(spark, sf_dir) -> DataFrame:
    """Long metrics of a rule, with the training and the validation part as samples."""
    graded = _split_features(spark, sf_dir).select(
        F.concat("split", F.lit("_sample")).alias("sample"), F.col("label").alias("y_true"),
        at_least(F.coalesce("sum_qty", F.lit(0.0)), 100.0).alias("y_pred"))
    long = metrics.metrics_long(metrics.binary_metrics(graded, by="sample"), "sample")
    return long.withColumn("value", F.round("value", 6))


def _rounded(wide: DataFrame) -> DataFrame:
    return wide.withColumns({m: F.round(m, 6) for m in metrics.METRICS})


def flagship(spark, sf_dir) -> DataFrame:
    """Feature table, split, imputation fitted on the training part, summary per part and label."""
    return _filled(spark, sf_dir).groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("total_price").alias("n_price"),
        F.count("max_price").alias("n_max_price"),
        F.round(F.avg("total_price"), 2).alias("avg_price"),
        F.round(F.avg("n_lines"), 4).alias("avg_lines"))


QUERIES = {
    q.__name__: q
    for q in (
        scan_table, delimited_dimension, feature_table, feature_table_no_target,
        join_composite_key, join_duplicate_dimension, join_first_of_duplicates, join_semi,
        join_hot_left, join_hot_right, join_hot_both, join_right, join_full, join_bucketed, merged_medians, null_checks,
        impute_global_mean, impute_global_median, impute_stratified_mean,
        impute_stratified_median, impute_given_values, median_sketch_error, imputation_params,
        impute_global_sketch, impute_unknown_stratum, quantiles_narrow,
        impute_out_of_sample,
        split_hash, split_validation_anti, split_validation_filtered, split_union, split_counts, split_bernoulli,
        split_bernoulli_counts,
        contingency, chi_square, correlation_matrix, correlation_matrix_wide, correlation_pairwise, box_stats, box_stats_overall, bin_2d,
        scatter_sample, one_hot, one_hot_table, target_means_before, logistic_train_metrics, logistic_calibration, gbt_train_metrics,
        pipeline_score, train_metrics_by_level, train_given_split, pipeline_score_by_level,
        gbt_one_tree, scored_rows_written, scored_batches_written, table_score_by_level, train_sampled_copies,
        gbt_wide_train_metrics,
        python_model_score, threshold_metrics, binary_metrics, metrics_by_sample, flagship,
    )
} | {"category_index": category_levels}
