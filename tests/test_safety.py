"""Wrong or missing parameters, splits that are given or sampled, and nulls that are left."""

import pytest
from conftest import SF_DIR
from helpers import rows
from pyspark.sql import functions as F

from strataprop.operators import splitting
from strataprop.operators.imputation import Impute, apply_imputation, fit_imputation, params_from_values
from strataprop.operators.training import fit_classifier
from strataprop.plans import fixtures as fx
from strataprop.plans import propensity


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0), (2, "a", None), (3, "b", 5.0), (4, "c", None), (5, None, None)], "id long, s string, x double")


def test_two_values_for_one_stratum_are_refused(table):
    params = params_from_values(table, {"x": {"a": 3.0, "b": 4.0}}, {"x": "s"})
    assert rows(apply_imputation(table, params).select("id", "x"))[1] == (2, 3.0)
    with pytest.raises(ValueError, match="two values for one stratum of: x"):
        apply_imputation(table, params.union(params.filter("stratum_value = 'a'").withColumn("value", F.lit(99.0))))
    overall = params_from_values(table, {"x": 1.0})
    with pytest.raises(ValueError, match="two values"):
        apply_imputation(table, overall.union(overall))


def test_unknown_and_null_strata_get_the_value_over_all_rows(table, no_broadcast):
    known = table.filter("s in ('a', 'b')")
    for spec in (Impute("x", "mean", "s", fallback=True), Impute("x", "median", "s", exact=True, fallback=True)):
        filled = {r["id"]: r["x"] for r in apply_imputation(table, fit_imputation(known, spec)).collect()}
        other = 3.0 if spec.method == "mean" else 1.0
        assert filled == {1: 1.0, 2: 1.0, 3: 5.0, 4: other, 5: other}
    plain = {r["id"]: r["x"] for r in apply_imputation(table, fit_imputation(known, Impute("x", "mean", "s"))).collect()}
    assert plain[4] is None and plain[5] is None


def test_sampled_keys_stay_together_and_the_parts_are_the_table(spark):
    df = spark.range(900).select((F.col("id") % 300).alias("id"), (F.col("id") % 2).cast("int").alias("label")).union(
        spark.createDataFrame([(None, 1), (None, 0)], "id long, label int"))
    split = splitting.split_by_sampling(df, key="id", target="label", whole=True)
    assert rows(split.drop("split")) == rows(df)
    sides = split.dropna(subset=["id"]).groupBy("id").agg(F.count_distinct("split").alias("n"))
    assert sides.filter("n > 1").count() == 0
    assert {r["split"] for r in split.filter("id is null").collect()} == {"val"}


def _features(spark):
    return fx.profile(spark, SF_DIR).join(fx.target(spark, SF_DIR), "id").select("id", "label", "priority", "total_price")


def test_given_and_sampled_splits_train(spark):
    rows_in = _features(spark)
    given = rows_in.withColumn("split", F.when(F.col("id") % 3 > 0, "train").otherwise("val"))
    result = propensity.train(given, target="label", key="id", categoricals=["priority"], method="given")
    assert {r["sample"] for r in result.metrics.collect()} == {"train_sample", "val_sample"}
    assert "split" not in result.model.stages[-2].getInputCols()
    sampled = propensity.train(rows_in, target="label", key="id", categoricals=["priority"], method="sample")
    assert sampled.metrics.count() == 8
    with pytest.raises(ValueError, match="'train' and 'val' only"):
        propensity.train(given.withColumn("split", F.lit("test")), target="label", key="id", method="given",
                         categoricals=["priority"])


def test_nulls_left_at_scoring_are_named(spark, tmp_path):
    rows_in = _features(spark)
    propensity.save_training(
        propensity.train(rows_in, target="label", key="id", categoricals=["priority"]), f"{tmp_path}/m")
    new = rows_in.withColumn("total_price", F.when(F.col("id") > 5, F.col("total_price")))
    with pytest.raises(Exception, match="hold nulls: total_price"):
        propensity.score_saved(new, f"{tmp_path}/m", imputed=False).collect()
    assert propensity.score_saved(rows_in, f"{tmp_path}/m", imputed=False).count() == rows_in.count()


def test_wide_categoricals_leave_the_bins_of_other_features_alone(spark):
    wide = _features(spark).withColumn("code", (F.col("id") % 400).cast("string")).drop("priority")
    with pytest.raises(ValueError, match="tree_categories='rank'"):
        fit_classifier(wide, estimator="gbt", target="label", key="id", categoricals=["code"], params={"maxIter": 1})
    model = fit_classifier(wide, estimator="gbt", target="label", key="id", categoricals=["code"],
                           tree_categories="rank", params={"maxIter": 1})
    assert model.stages[-1].getMaxBins() == 255
    assert model.transform(wide).select("prediction").count() == wide.count()
    with pytest.raises(ValueError, match="handle_invalid"):
        fit_classifier(wide, target="label", key="id", categoricals=["code"], handle_invalid="skip")
