"""Category dictionaries, target statistics and models whose levels stay in a table."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from strataprop import Impute
from strataprop.operators.categories import (
    attach_levels, category_dictionary, ordered_target_statistics, sparse_features, target_statistics)
from strataprop.operators.features import FEATURES
from strataprop.operators.scoring import score
from strataprop.operators.table_model import fit_table_model, load_table_model, save_table_model, score_table_model
from strataprop.operators.training import fit_classifier
from strataprop.plans import propensity


def _made(spark, n=3000, levels=40, seed=1):
    rng = random.Random(seed)
    data = []
    for k in range(n):
        code, shade = f"c{int(rng.paretovariate(1.2)) % levels}", rng.choice(["red", "blue"])
        data.append((k, code, shade, rng.random(), int(rng.random() < 0.2 + 0.02 * (int(code[1:]) % 30))))
    return spark.createDataFrame(data, "id long, code string, shade string, x double, label int")


def test_dictionary_ranks_levels_by_frequency_then_name(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("b", None), (None, "y"), ("c", "x")], "p string, q string")
    assert rows(category_dictionary(df, ["p", "q"])) == [
        ("p", "a", 1, 1), ("p", "b", 2, 0), ("p", "c", 1, 2), ("q", "x", 3, 0), ("q", "y", 1, 1)]
    attached = attach_levels(df, category_dictionary(df.filter("p <> 'c'"), ["p"]), ["p"], "index")
    assert rows(attached.select("p", "__p_index")) == [(None, None), ("a", 1), ("b", 0), ("b", 0), ("c", None)]
    with pytest.raises(ValueError, match="no categorical"):
        category_dictionary(df, [])


def test_vectors_have_a_slot_for_each_level_and_none_for_others(spark):
    df = spark.createDataFrame([(1, 0.5, "a", "x"), (2, 1.5, "b", None), (3, 2.5, "new", "y")], "id int, n double, p string, q string")
    dictionary = category_dictionary(df.filter("id < 3"), ["p", "q"])
    found = {r["id"]: r[FEATURES] for r in sparse_features(df, dictionary, ["n"], ["p", "q"], keep=["id"]).collect()}
    assert {k: (v.size, v.toArray().tolist()) for k, v in found.items()} == {
        1: (4, [0.5, 1, 0, 1]), 2: (4, [1.5, 0, 1, 0]), 3: (4, [2.5, 0, 0, 0])}


def test_a_rows_own_target_and_its_copies_never_enter_its_value(spark):
    df = _made(spark)
    df = df.union(df.filter("id % 5 = 0"))
    flipped = df.withColumn("label", F.when(F.col("id") == 45, 1 - F.col("label")).otherwise(F.col("label")))
    found = [{(r["id"]): (r["__code_value"], r["__shade_value"]) for r in ordered_target_statistics(
        frame, ["code", "shade"], "label", "id", prior=0.3).collect()} for frame in (df, flipped)]
    assert found[0][45] == found[1][45] and found[0] != found[1]
    assert ordered_target_statistics(df, ["code"], "label", "id", prior=0.3).count() == df.count()


def test_target_statistics_shrink_to_the_prior(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), (None, 0)], "c string, y int")
    found, prior = target_statistics(df, ["c"], "y", weight=2.0)
    assert prior == 0.5 and rows(found) == [("c", "a", 2, 0.75), ("c", "b", 1, 1 / 3)]


def test_logistic_scores_equal_those_of_the_pipeline(spark, tmp_path):
    df = _made(spark)
    exact = {"tol": 1e-12, "maxIter": 300, "regParam": 0.01}
    model = fit_table_model(df, target="label", key="id", categoricals=["code", "shade"], params=exact)
    save_table_model(model, f"{tmp_path}/m")
    new = df.union(spark.createDataFrame([(9999, "unseen", "red", 0.5, 0)], df.schema))
    found = {r["id"]: r["Probs_1"] for r in score_table_model(load_table_model(spark, f"{tmp_path}/m"), new).collect()}
    plain = fit_classifier(df, target="label", key="id", categoricals=["code", "shade"], params=exact)
    expected = {r["id"]: r["Probs_1"] for r in score(plain, new).collect()}
    assert found.keys() == expected.keys() and max(abs(found[k] - expected[k]) for k in found) < 1e-4


def test_boosted_trees_take_more_levels_than_bins(spark, tmp_path):
    df = _made(spark, levels=1000).withColumn("code", F.concat("code", F.lit("-"), (F.col("id") % 400).cast("string")))
    result = propensity.train(df, target="label", key="id", categoricals=["code", "shade"], estimator="gbt",
                              categories="table", estimator_params={"maxIter": 3})
    assert result.metrics.count() == 8
    propensity.save_training(result, f"{tmp_path}/g")
    scored = propensity.score_saved(df, f"{tmp_path}/g", imputed=False, categories="table")
    assert scored.columns == [*df.columns, "Probs_0", "Probs_1"] and scored.count() == df.count()
    with pytest.raises(Exception, match="hold nulls: x"):
        propensity.score_saved(df.withColumn("x", F.lit(None).cast("double")), f"{tmp_path}/g", imputed=False,
                               categories="table").collect()
    with pytest.raises(ValueError, match="needs no table"):
        fit_table_model(df.drop("code", "shade"), target="label", key="id", categoricals=[])


def test_a_million_levels_train_and_score(spark):
    df = spark.range(1_000_000).select(
        "id", F.concat(F.lit("level"), F.col("id")).alias("code"), (F.col("id") % 2).cast("int").alias("label"),
        (F.col("id") % 7).cast("double").alias("x")).union(
        spark.range(1000).select(F.col("id") + 2_000_000, F.lit("level5"), F.lit(1), F.lit(1.0)))
    model = fit_table_model(df, target="label", key="id", categoricals=["code"], params={"maxIter": 2})
    assert model.levels.count() == 1_000_000
    assert model.levels.orderBy(F.desc("n")).first()["level"] == "level5"
    scored = score_table_model(model, df, keep=["id"])
    assert scored.filter("Probs_1 > 0 and Probs_1 < 1").count() == 1_001_000


def test_scoring_reads_new_rows_once(spark, tmp_path):
    df = _made(spark).drop("shade")
    df.write.parquet(f"{tmp_path}/rows")
    rows_in = spark.read.parquet(f"{tmp_path}/rows")
    propensity.save_training(propensity.train(
        rows_in, target="label", key="id", categoricals=["code"], imputations=[Impute("x")],
        estimator_params={"maxIter": 2}), f"{tmp_path}/p")
    scored = propensity.score_saved(rows_in, f"{tmp_path}/p")
    leaves = scored._jdf.queryExecution().optimizedPlan().collectLeaves().toString()
    assert leaves.count("label") == 1  # only the new rows have that column
    assert scored.count() == df.count()
