import numpy as np
import pandas as pd
import pytest
from conftest import SF_DIR
from helpers import rows
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from strataprop.operators import features as ft
from strataprop.operators.metrics import binary_metrics, metrics_dict
from strataprop.operators.model_files import load_model, open_model, remove_model, save_model
from strataprop.operators.scoring import score, score_python
from strataprop.operators.splitting import split_by_hash
from strataprop.operators.table_model import fit_table_model
from strataprop.operators.training import evaluate, fit_classifier, predict_labels
from strataprop.plans import fixtures as fx
from strataprop.plans import propensity
from strataprop.plans.queries import SPECS
from strataprop.sources.artifacts import load_pipeline, save_pipeline

CATEGORICALS = ["priority", "segment"]


@pytest.fixture(scope="module")
def table(spark):
    """A table with a learnable label: price, one segment and one priority decide."""
    score_ = (F.col("total_price") / 250_000 - 1 + F.when(F.col("segment") == "BUILDING", 0.8).otherwise(0)
              - F.when(F.col("priority") == "5-LOW", 0.6).otherwise(0) + (F.hash("id") % 100) / 150)
    df = fx.features(spark, SF_DIR).select("id", "priority", "segment", "total_price", "acctbal", score_.alias("z"))
    df = df.withColumn("label", (F.col("z") > 0).cast("int")).drop("z")
    df = split_by_hash(df, key="id", target="label").cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def logistic(table):
    return fit_classifier(table.filter("split = 'train'"), target="label", key="id",
                          categoricals=CATEGORICALS)


def test_metrics_of_each_sample_come_from_its_own_rows(table, logistic):
    by_sample = metrics_dict(evaluate(logistic, table, target="label"))
    assert set(by_sample) == {"train_sample", "val_sample"}
    for part in ("train", "val"):
        pdf = predict_labels(logistic, table.filter(F.col("split") == part), "label").toPandas()
        tp = int(((pdf.y_true == 1) & (pdf.y_pred == 1)).sum())
        want = {"accuracy": (pdf.y_true == pdf.y_pred).mean(), "precision": tp / pdf.y_pred.sum(),
                "recall": tp / pdf.y_true.sum(), "f1": 2 * tp / (pdf.y_true.sum() + pdf.y_pred.sum())}
        assert by_sample[f"{part}_sample"] == pytest.approx(want)
        assert want["accuracy"] > 0.8
    assert by_sample["train_sample"] != by_sample["val_sample"]


def test_threshold_is_inclusive_and_checked(table, logistic):
    assert predict_labels(logistic, table, "label", 0.0).filter("y_pred = 0").count() == 0
    for bad in (1.5, -0.1):
        with pytest.raises(ValueError):
            evaluate(logistic, table, target="label", threshold=bad)
    with pytest.raises(TypeError):
        evaluate(logistic, table, target="label", threshold=True)


def test_feature_list_drops_exact_names_only(spark):
    df = spark.createDataFrame([(1, 2, 3, 0, "x")], "id int, on int, R int, Response int, split string")
    assert ft.feature_columns(df, target="Response", key="id") == (["on", "R"], [])


def test_key_target_and_split_are_no_features(logistic):
    assembler = logistic.stages[2]
    assert assembler.getInputCols() == ["total_price", "acctbal", "__priority_onehot", "__segment_onehot"]


def test_unseen_level(table, logistic):
    strange = table.withColumn("segment", F.lit("NEW"))
    scored = score(logistic, strange.drop("label", "split"))
    assert scored.filter("Probs_1 is null").count() == 0 and scored.count() == table.count()
    strict = fit_classifier(table.filter("split = 'train'"), target="label", key="id",
                            categoricals=CATEGORICALS, handle_invalid="error", params={"maxIter": 2})
    with pytest.raises(Exception, match="(?i)unseen label"):
        score(strict, strange.drop("label", "split")).collect()


def test_keep_and_strict_encoders_give_the_same_probabilities(table, logistic):
    strict = fit_classifier(table.filter("split = 'train'"), target="label", key="id",
                            categoricals=CATEGORICALS, handle_invalid="error")
    inputs = table.drop("label", "split")
    a = score(logistic, inputs, ["id"]).toPandas().sort_values("id").Probs_1.to_numpy()
    b = score(strict, inputs, ["id"]).toPandas().sort_values("id").Probs_1.to_numpy()
    assert np.abs(a - b).max() < 2e-3


def test_score_output_is_the_input_and_two_probabilities(table, logistic, tmp_path):
    inputs = table.drop("label", "split")
    scored = score(logistic, inputs)
    assert scored.columns == [*inputs.columns, "Probs_0", "Probs_1"]
    assert scored.filter("abs(Probs_0 + Probs_1 - 1) > 1e-9").count() == 0
    path = str(tmp_path / "model")
    save_pipeline(logistic, path)
    with pytest.raises(Exception, match="(?i)exists"):
        save_pipeline(logistic, path)
    save_pipeline(logistic, path, "overwrite")
    assert rows(score(load_pipeline(path), inputs)) == rows(scored)
    with pytest.raises(ValueError, match="already has"):
        score(logistic, scored)


def test_nulls_and_labels_are_reported_by_column(table):
    holes = table.withColumn("acctbal", F.when(F.col("id") % 5 > 0, F.col("acctbal")))
    with pytest.raises(ValueError, match="hold nulls: acctbal"):
        fit_classifier(holes, target="label", key="id", categoricals=CATEGORICALS)
    with pytest.raises(ValueError, match="hold nulls: segment"):
        fit_classifier(table.withColumn("segment", F.lit(None).cast("string")), target="label", key="id",
                       categoricals=CATEGORICALS)
    with pytest.raises(ValueError, match="label other than 0 or 1"):
        fit_classifier(table.withColumn("label", F.lit(2)), target="label", key="id", categoricals=CATEGORICALS)
    with pytest.raises(ValueError, match="more than 3 levels in: priority, segment"):
        fit_classifier(table, target="label", key="id", categoricals=CATEGORICALS, max_levels=3)
    with pytest.raises(ValueError, match="not numeric: priority"):
        fit_classifier(table, target="label", key="id", categoricals=["segment"])
    with pytest.raises(ValueError, match="estimator"):
        fit_classifier(table, estimator="forest", target="label", key="id", categoricals=CATEGORICALS)
    with pytest.raises(ValueError, match="no column"):
        fit_classifier(table, target="nothing", key="id", categoricals=CATEGORICALS)


def test_boosted_trees(table):
    model = fit_classifier(table.filter("split = 'train'"), estimator="gbt", target="label", key="id",
                           categoricals=CATEGORICALS, params={"maxIter": 3, "stepSize": 0.3})
    trees = model.stages[-1]
    assert trees.getNumTrees == 3 and trees.getMaxBins() == 255
    assert metrics_dict(evaluate(model, table, target="label"))["val_sample"]["accuracy"] > 0.75
    # Indexed, not one-hot: one slot per feature.
    assert trees.numFeatures == 4


def test_boosted_trees_read_their_rows_in_even_tasks(spark, monkeypatch):
    """One task more than cores, one of them with half the rows, and then a single small task."""
    cores, read = spark.sparkContext.defaultParallelism, []
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, *more: (
        read.append([len(part) for part in df.rdd.glom().collect()]), fit(self, df, *more))[1])
    df = spark.range(0, 4000, 1, 1).union(spark.range(4000, 8000, 1, cores)).select(
        "id", (F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 3).cast("string").alias("c"),
        (F.col("id") % 97 > 40).cast("int").alias("label"))
    for rows_ in (df, df.coalesce(1)):
        how = {"target": "label", "key": "id", "categoricals": ["c"], "params": {"maxIter": 1}}
        model = fit_classifier(rows_, estimator="gbt", **how)
        fit_table_model(rows_, estimator="gbt", **how)
        assert metrics_dict(evaluate(model, rows_.withColumn("split", F.lit("train")), target="label"))[
            "train_sample"]["accuracy"] == 1.0
    # The rows of a table model are written first: their files are cut small here.
    cut = {"spark.sql.files.maxPartitionBytes": "6000", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in cut}
    try:
        for name, value in cut.items():
            spark.conf.set(name, value)
        fit_table_model(df, estimator="gbt", **how)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for dealt in (read[0], read[4]):
        assert len(dealt) % cores == 0 and max(dealt) <= 1.5 * sum(dealt) / len(dealt)
    assert all(sum(sizes) == 8000 for sizes in read) and len(read[2]) == 1


def test_training_flow_saves_and_scores(spark, tmp_path):
    labelled = fx.features(spark, SF_DIR, nulls=True).drop("cust_id", "nation_id")
    result = propensity.train(labelled, target="label", key="id", categoricals=CATEGORICALS,
                              imputations=SPECS, estimator_params={"maxIter": 3})
    assert result.metrics.count() == 8
    folder = str(tmp_path / "run")
    propensity.save_training(result, folder)
    fresh = fx.features(spark, SF_DIR, labelled=False, nulls=True)
    scored = propensity.score_saved(fresh, folder)
    assert scored.columns == [*fresh.columns, "Probs_0", "Probs_1"] and scored.count() == 1500
    assert scored.filter("Probs_1 is null or total_price is null").count() == 0


def test_build_features_from_views_and_paths(spark):
    for name in ("profile", "performance", "dimension", "target"):
        getattr(fx, name)(spark, SF_DIR).createOrReplaceTempView(f"v_{name}")
    names = {"profile": "v_profile", "performance": "v_performance", "dimension": "v_dimension"}
    built = propensity.build_features(spark, **names, target="v_target", key="id", dim_key="cust_id")
    assert rows(built) == rows(fx.features(spark, SF_DIR))
    assert "label" not in propensity.build_features(spark, **names, key="id", dim_key="cust_id").columns


def test_one_hot_layout(spark):
    df = spark.createDataFrame([("b", 1.0), ("b", 2.0), ("a", 3.0), ("c", 4.0)], "c string, x double")
    from pyspark.ml import Pipeline

    stages = ft.encoding_stages(["x"], ["c"], one_hot=True, handle_invalid="error")
    out = Pipeline(stages=stages).fit(df).transform(df)
    assert rows(out.select("c", vector_to_array(ft.FEATURES).alias("v"))) == [
        ("a", [3.0, 0.0, 1.0]), ("b", [1.0, 1.0, 0.0]), ("b", [2.0, 1.0, 0.0]), ("c", [4.0, 0.0, 0.0])]
    assert rows(ft.category_index(df, "c")) == [("a", 1, 1), ("b", 2, 0), ("c", 1, 2)]


# --- Python models ---------------------------------------------------------------------------


def codes_model():
    """Returns the category code as the probability, to see which code a batch was given.

    The class is local, as in a notebook: the executors cannot import it.
    """

    class Codes:
        feature_names_in_ = ["x", "c"]

        def predict_proba(self, df: pd.DataFrame):
            assert list(df.columns) == self.feature_names_in_
            p = df["c"].cat.codes.to_numpy() / 10 + df["x"].to_numpy()
            return np.column_stack([1 - p, p])

    return Codes()


def test_category_codes_are_the_same_in_every_batch(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        df = spark.createDataFrame([("c", 0.0, 1), ("a", 0.5, 2), ("z", 0.0, 3)], "c string, x double, id int")
        got = rows(score_python(df, codes_model(), levels={"c": ["a", "b", "c"]}, keep=["id"]))
    finally:
        spark.conf.set(name, before)
    assert got == [(1, 0.8, 0.2), (2, 0.5, 0.5), (3, 1.1, -0.1)]


def test_python_scoring_keeps_the_input_columns(spark):
    df = spark.createDataFrame([("a", 0.5, 2)], "c string, x double, id int")
    scored = score_python(df, codes_model(), levels={"c": ["a"]})
    assert scored.columns == ["c", "x", "id", "Probs_0", "Probs_1"]
    with pytest.raises(ValueError, match="no column 'x'"):
        score_python(df.drop("x"), codes_model())
    with pytest.raises(ValueError, match="no feature"):
        score_python(df, codes_model(), levels={"id": [1]})
    assert score_python(df.filter("id > 9"), codes_model(), levels={"c": ["a"]}).count() == 0


def counting_model(folder):
    class Counting:
        feature_names_in_ = ["x"]

        def __init__(self):
            self.weights = np.arange(100_000, dtype=np.float64)

        def __setstate__(self, state):
            import os
            self.__dict__.update(state)
            with open(f"{folder}/{os.getpid()}", "a") as out:
                out.write("loaded\n")

        def predict_proba(self, df: pd.DataFrame):
            assert not self.weights.flags.owndata and not self.weights.flags.writeable
            p = self.weights[df["x"].to_numpy()] / 100_000
            return np.column_stack([1 - p, p])

    return Counting()


def test_a_worker_loads_a_model_once_for_all_scorings(spark, tmp_path):
    loads = tmp_path / "loads"
    loads.mkdir()
    model = counting_model(str(loads))
    df = spark.range(64).select(F.col("id").alias("x")).repartition(16)
    want = [(k, 1 - k / 100_000, k / 100_000) for k in range(64)]
    saved = save_model(spark, model, f"{tmp_path}/models/first")
    assert saved.size > 800_000 and open_model(saved.path) == saved == save_model(spark, model, saved.path)
    for given in (saved, saved, saved, model):
        assert rows(score_python(df, given)) == [pytest.approx(w) for w in want]
    # 16 tasks in each of four scorings; the last model was pickled anew
    counts = [len(p.read_text().splitlines()) for p in loads.iterdir()]
    assert max(counts) <= 2 and sum(counts) <= 2 * 10
    with pytest.raises(ValueError, match=f"{saved.size} bytes"):
        score_python(df, saved, max_bytes=1000)
    with pytest.raises(ValueError, match=f"{saved.size} bytes"):
        score_python(df, model, max_bytes=1000)
    remove_model(saved)
    assert not (tmp_path / "models" / "first").exists()


def test_another_model_at_a_path_is_never_mistaken_for_the_first(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.25)], "c string, x double")
    first = save_model(spark, codes_model(), f"{tmp_path}/m")
    lazy = score_python(df, first, levels={"c": ["b", "a"]})
    second = save_model(spark, counting_model(str(tmp_path)), f"{tmp_path}/m")
    assert second.digest != first.digest
    load_model.cache_clear()
    with pytest.raises(Exception, match="another model"):
        load_model(first)
    assert lazy.columns[-2:] == ["Probs_0", "Probs_1"]
    (tmp_path / "text").write_text("no model")
    with pytest.raises(ValueError, match="not a saved model"):
        open_model(f"{tmp_path}/text")


# --- metrics ---------------------------------------------------------------------------------


def test_metrics_without_positives_are_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y_true int, y_pred int")
    r = binary_metrics(df).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (0.5, 0.0, 0.0, 0.0)
    r = binary_metrics(df.filter("y_true = 5")).first()
    assert (r["tp"], r["accuracy"], r["f1"]) == (0, 0.0, 0.0)


def test_rows_that_cannot_be_graded_are_counted(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (2, 0), (0, None)], "y_true int, y_pred int")
    r = binary_metrics(df).first()
    assert (r["tp"], r["n_ungraded"], r["accuracy"]) == (1, 3, 1.0)
    with pytest.raises(TypeError):
        binary_metrics(np.zeros((2, 2)))
