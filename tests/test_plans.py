"""What the physical plans must look like, for tables of any size."""

import re

import pytest
from conftest import SF_DIR
from helpers import plan, rows, shuffles
from pyspark.sql import functions as F

from strataprop.functions.runtime import stage
from strataprop.operators import exploration, joins, metrics, splitting
from strataprop.operators.features import category_index
from strataprop.operators.imputation import Impute, apply_imputation, fit_imputation
from strataprop.operators.quantiles import exact_quantiles
from strataprop.operators.scoring import score_python
from strataprop.plans import fixtures as fx
from strataprop.plans import propensity
from strataprop.plans.queries import QUERIES


def read_columns(df, table: str) -> set[str]:
    """Columns that the scans of a table read."""
    found = set()
    for line in plan(df).splitlines():
        if f"{table}.parquet" in line:
            found |= set(re.findall(r"(\w+):", line.split("ReadSchema: struct<")[1]))
    return found


@pytest.mark.parametrize("name", [
    "feature_table", "join_composite_key", "impute_stratified_median", "impute_out_of_sample",
    "split_validation_anti", "chi_square", "box_stats", "bin_2d", "metrics_by_sample"])
def test_no_cross_or_nested_loop_join(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_scans_read_only_what_is_used(spark):
    wide = fx.features(spark, SF_DIR)
    assert read_columns(wide, "lineitem") == {
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount"}
    assert read_columns(wide.select("id", "label"), "lineitem") <= {"l_orderkey"}
    line_scores = QUERIES["python_model_score"](spark, SF_DIR)
    assert read_columns(line_scores, "lineitem") == {
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_linestatus"}


def test_filters_reach_the_scan(spark):
    labelled = splitting.split_by_hash(
        fx.table(spark, SF_DIR, "labels"), key="doc_id", target="quality")
    assert "PushedFilters: [IsNotNull(toxic), EqualTo(toxic,1)]" in plan(labelled.filter("toxic = 1"))


def test_python_scoring_runs_one_arrow_stage_without_a_shuffle(spark):
    text = plan(QUERIES["python_model_score"](spark, SF_DIR))
    assert text.count("ArrowEvalPython") == 1 and "Exchange" not in text
    assert "BatchEvalPython" not in text


def test_metrics_take_one_scan_and_no_shuffle_of_rows(spark):
    text = plan(metrics.binary_metrics(fx.table(spark, SF_DIR, "labels"), "quality", "toxic"))
    assert text.count("FileScan") == 1 and "partial_count" in text and "Join" not in text


def test_evaluation_of_both_samples_takes_one_scan(spark):
    text = plan(QUERIES["metrics_by_sample"](spark, SF_DIR))
    assert text.count("lineitem.parquet") == 1


def test_imputing_columns_of_one_stratum_takes_one_join(spark):
    df = fx.features(spark, SF_DIR).drop("label")
    params = fit_imputation(df, [Impute(c, "mean", "priority") for c in ("sum_qty", "n_lines", "max_price")])
    before = plan(df).count("Join ")
    assert plan(apply_imputation(df, params)).count("Join ") == before + 1


def test_imputation_from_the_whole_table_is_a_projection(spark):
    df = fx.profile_with_nulls(spark, SF_DIR)
    filled = apply_imputation(df, fit_imputation(df, Impute("total_price")))
    assert "Join" not in plan(filled) and "Exchange" not in plan(filled)


def test_groups_are_combined_before_the_shuffle(spark):
    orders = fx.table(spark, SF_DIR, "orders")
    for df in (exploration.contingency(orders, "o_orderpriority", "o_orderstatus"),
               exploration.bin_2d(orders, "o_totalprice", "o_totalprice", 1e4, 1e4)):
        assert "partial_count" in plan(df) and shuffles(df) == 1


def test_anti_join_reads_distinct_keys(spark, no_broadcast):
    df = fx.target(spark, SF_DIR)
    train, _ = splitting.train_validation(splitting.split_by_hash(df, key="id", target="label"))
    text = plan(splitting.validation_rows(df, train, "id"))
    assert "LeftAnti" in text and shuffles(splitting.validation_rows(df, train, "id")) == 2


@pytest.fixture
def eager_salting(monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 100)


def test_hot_stratum_is_salted_when_params_are_too_large_to_broadcast(
        spark, no_broadcast, eager_salting):
    df = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 2000).alias("s"),
        F.when(F.col("id") % 4 > 0, F.col("id").cast("double")).alias("x"))
    filled = apply_imputation(df, fit_imputation(df, Impute("x", "mean", "s")))
    assert joins.SALT in plan(filled)
    means = df.groupBy("s").agg(F.round(F.avg("x")).alias("m"))
    assert rows(filled) == rows(df.join(means, "s").select("id", "s", F.coalesce("x", "m")))


def test_hot_group_is_salted_in_exact_quantiles(spark, no_broadcast, eager_salting, monkeypatch):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 40).alias("g"),
        F.hash("id").cast("double").alias("x"))
    salted = []
    monkeypatch.setattr(joins, "add_salt", lambda *a, f=joins.add_salt, **k: salted.append(1) or f(*a, **k))
    got = exact_quantiles(df, "x", [0.5], ["g"])
    assert salted and "SinglePartition" not in plan(got)
    want = df.groupBy("g").agg(F.expr("percentile_disc(0.5) within group (order by x)"))
    assert rows(got.select("g", F.col("quantiles")[0])) == rows(want)
    boxes = exploration.box_stats(df, "x", "g")
    assert boxes.count() == 41 and boxes.agg(F.sum("n")).first()[0] == 9000


def test_training_reads_only_the_files_of_its_part(spark):
    split = splitting.split_by_hash(fx.target(spark, SF_DIR), key="id", target="label")
    staged = stage(split, partition_by="split")
    assert rows(staged) == rows(split) and staged.columns == split.columns
    train = staged.filter("split = 'train'")
    assert "PartitionFilters: [isnotnull(split" in plan(train)


def test_overall_quantiles_need_no_join_with_the_rows(spark):
    quantiles = exact_quantiles(fx.profile(spark, SF_DIR), "total_price", [0.5])
    # The joins left are with tables of one row per group, and of one row per range of candidates.
    assert plan(quantiles).count("Join ") == 2
    assert "SinglePartition" not in plan(quantiles.select("quantiles")).split("Join ")[-1]


def test_category_index_keeps_the_levels_on_the_executors(spark, monkeypatch):
    from pyspark.ml.feature import StringIndexer
    monkeypatch.setattr(StringIndexer, "fit", None)
    df = spark.range(5000).select((F.col("id") % 997).cast("string").alias("c"))
    got = category_index(df, "c").collect()
    want = sorted(((-(5000 // 997 + (k < 5000 % 997)), str(k)) for k in range(997)))
    assert [(r["level"], r["index"]) for r in sorted(got, key=lambda r: r["index"])] == [
        (level, k) for k, (_, level) in enumerate(want)]


def test_fit_and_grades_read_the_written_table(spark, monkeypatch):
    seen = []

    def watched(name):
        before = getattr(propensity, name)
        monkeypatch.setattr(propensity, name, lambda *a, **k: seen.append((name, plan(next(
            x for x in a if hasattr(x, "_jdf"))))) or before(*a, **k))

    watched("fit_classifier")
    watched("evaluate")
    rows_in = fx.features(spark, SF_DIR, nulls=True).select("id", "label", "total_price", "sum_qty", "priority")
    propensity.train(rows_in, target="label", key="id", categoricals=["priority"],
                     imputations=[Impute("total_price", "mean", "priority"), Impute("sum_qty")])
    assert [name for name, _ in seen] == ["fit_classifier", "evaluate"]
    assert all("Join" not in p and "Scan parquet" in p for _, p in seen)


def test_three_hundred_hot_keys_are_all_found(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        df = spark.range(60_000).select((F.col("id") % 300).alias("k"))
        hot = joins.find_hot_keys(df, ["k"], hot_rows=50)
        assert len(hot.per_key) == 300 and set(hot.per_key.values()) == {4}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
