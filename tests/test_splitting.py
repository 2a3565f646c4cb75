import pytest
from conftest import SF_DIR
from helpers import plan, rows
from pyspark.sql import functions as F

from strataprop.operators import splitting
from strataprop.operators.key_filter import divide, key_filter
from strataprop.plans import fixtures as fx

ARGS = {"key": "id", "target": "label"}


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_hash_split_does_not_depend_on_the_layout(spark, partitions):
    df = fx.target(spark, SF_DIR)
    assert rows(splitting.split_by_hash(df, **ARGS)) == rows(
        splitting.split_by_hash(df.repartition(partitions), **ARGS))


def test_hash_split_is_a_projection(spark):
    assert "Exchange" not in plan(splitting.split_by_hash(fx.target(spark, SF_DIR), **ARGS))


def test_fraction_and_seed(spark):
    df = fx.target(spark, SF_DIR)
    for label, n in df.groupBy("label").count().collect():
        part = splitting.split_by_hash(df, fraction=0.7, **ARGS).filter(F.col("label") == label)
        assert part.filter("split = 'train'").count() == pytest.approx(0.7 * n, rel=0.1)
    assert splitting.split_by_hash(df, fraction=1, **ARGS).filter("split = 'val'").count() == 0
    assert splitting.split_by_hash(df, fraction=0.0, **ARGS).filter("split = 'train'").count() == 0
    assert rows(splitting.split_by_hash(df, seed=1, **ARGS)) != rows(
        splitting.split_by_hash(df, seed=2, **ARGS))


ODD = [(i, v) for i in range(40) for v in (0, 1)] + [(100, 2), (101, None), (None, 1)]


def test_other_labels_and_null_keys_go_to_validation(spark):
    df = spark.createDataFrame(ODD, "id int, label int")
    for split in (splitting.split_by_hash(df, fraction=1.0, **ARGS),
                  splitting.split_by_sampling(df, fraction=1.0, **ARGS)):
        train, validation = splitting.train_validation(split)
        found = rows(validation)
        assert (100, 2) in found and (101, None) in found
        assert train.filter("label is null or label = 2").count() == 0
    assert (None, 1) in rows(splitting.train_validation(
        splitting.split_by_hash(df, fraction=1.0, **ARGS))[1])


def test_copies_of_a_key_stay_together(spark):
    df = spark.createDataFrame(ODD, "id int, label int").filter("label in (0, 1)")
    for split in (splitting.split_by_hash(df, **ARGS), splitting.split_by_sampling(df, **ARGS)):
        sides = split.dropna().groupBy("id").agg(F.count_distinct("split").alias("n"))
        assert sides.filter("n > 1").count() == 0


def test_sampling_split_is_fixed_once_drawn(spark, tmp_path):
    df = fx.target(spark, SF_DIR).repartition(7)
    split = splitting.split_by_sampling(df, path=str(tmp_path / "train"), **ARGS)
    first, second = rows(split), rows(split)
    assert first == second and len(first) == df.count()
    train, validation = splitting.train_validation(split)
    assert train.join(validation, "id", "left_semi").count() == 0
    assert rows(splitting.validation_rows(df, train, "id")) == rows(validation)


@pytest.mark.parametrize("kind", ["bigint", "int", "string", "binary", "decimal(20,3)", "date", "double"])
def test_filtered_anti_join_has_the_same_rows(spark, no_broadcast, kind):
    day = F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")) if kind == "date" else F.col("id").cast("string").cast(kind)
    df = spark.range(3000).select(F.when(F.col("id") % 50 > 0, day).alias("k.ey"), (F.col("id") % 7).alias("x"))
    df = df.union(df.limit(200))
    train = df.filter("x < 3")
    got = splitting.validation_rows(df, train, "k.ey", filter_bits=18)
    assert got.columns == df.columns
    assert rows(got) == rows(splitting.validation_rows(df, train, "k.ey"))
    assert rows(splitting.validation_rows(df, train.limit(0), "k.ey", filter_bits=12)) == rows(df)
    assert splitting.validation_rows(df.limit(0), train, "k.ey", filter_bits=12).count() == 0


def test_a_full_filter_and_other_key_types_change_nothing(spark, no_broadcast):
    df = spark.range(20_000).select("id", (F.col("id") % 3).alias("x"))
    train = df.filter("x = 0").select(F.col("id").cast("int"))
    want = rows(df.filter("x > 0"))
    assert rows(splitting.validation_rows(df, train, "id", filter_bits=12)) == want
    assert rows(splitting.validation_rows(df, train.select(F.col("id").cast("string")), "id", filter_bits=20)) == want
    with pytest.raises(ValueError, match="a filter has"):
        splitting.validation_rows(df, train, "id", filter_bits=40)


def test_only_rows_of_the_filter_are_shuffled(spark, no_broadcast):
    df = spark.range(100_000).select("id", F.hash("id").alias("x"))
    train = df.filter("id % 10 = 0")
    missing, others = divide(df, key_filter(train, "id", 20), "id", 20)
    assert "Exchange hashpartitioning" not in plan(missing) and "BroadcastExchange" in plan(missing)
    # 100 bits a key: next to no other key is taken for one of them
    assert others.count() < 10_000 * 1.05 and others.count() + missing.count() == 100_000
    whole = splitting.validation_rows(df, train, "id", filter_bits=20)
    assert "LeftAnti" in plan(whole) and whole.count() == 90_000


def test_counts(spark):
    split = splitting.split_by_hash(fx.target(spark, SF_DIR), **ARGS)
    counts = splitting.split_counts(split, "label")
    assert sum(r["n"] for r in counts.collect()) == 1500 and counts.count() == 4


def test_argument_checks(spark):
    df = spark.createDataFrame([(1, 0)], "id int, label int")
    with pytest.raises(TypeError):
        splitting.split_by_hash([(1, 0)], **ARGS)
    with pytest.raises(ValueError, match="no column 'id'"):
        splitting.split_by_hash(df.drop("id"), **ARGS)
    with pytest.raises(ValueError, match="between 0 and 1"):
        splitting.split_by_hash(df, fraction=1.2, **ARGS)
    with pytest.raises(ValueError, match="already has"):
        splitting.split_by_hash(df.withColumn("split", F.lit(1)), **ARGS)
