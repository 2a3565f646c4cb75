from dataclasses import replace

import pytest
from conftest import SF_DIR
from helpers import plan, rows, shuffles
from pyspark.sql import functions as F

from strataprop.operators import joins
from strataprop.plans import fixtures as fx


def skewed(spark, n=6000):
    """A third of the rows on key 7, a sixth without a key, the rest spread."""
    key = (F.when(F.col("i") % 3 == 0, 7).when(F.col("i") % 6 == 1, None)
           .otherwise(F.col("i") % 500))
    return spark.range(n).withColumnRenamed("id", "i").withColumn("k", key)


def lookup(spark):
    return spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, no_broadcast, how):
    left, right = skewed(spark), lookup(spark)
    hot = joins.find_hot_keys(left, ["k"], hot_rows=300)
    assert hot.hashes and hot.salts > 1 and hot.null_salts > 1
    spread = joins.equi_join(left, right, "k", how, hot_rows=300)
    assert joins.SALT in plan(spread) and joins.SALT not in spread.columns
    plain = left.join(right, "k", how)
    assert rows(spread.select(plain.columns)) == rows(plain)


def test_spread_join_repeats_rows_for_repeated_right_keys(spark, no_broadcast):
    left = skewed(spark)
    right = lookup(spark).unionByName(lookup(spark).filter("k in (7, 8)").withColumn("v", -F.col("v")))
    spread = joins.equi_join(left, right, ["k"], hot_rows=300)
    assert rows(spread) == rows(left.join(right, ["k"], "left"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("left_is_hot", [False, True])
def test_hot_keys_on_the_right_are_spread(spark, no_broadcast, how, left_is_hot):
    right = skewed(spark, 2400).withColumnRenamed("i", "v")
    left = spark.range(600).withColumnRenamed("id", "i").withColumn("k", F.col("i") % 600)
    if left_is_hot:
        left = left.withColumn("k", F.when(F.col("i") < 200, 9).when(F.col("i") < 300, None).otherwise(F.col("i")))
        right = right.withColumn("k", F.when(F.col("k") == 9, 10).otherwise(F.col("k")))
        right = right.unionByName(spark.createDataFrame([(-1, 9), (-2, 9)], "v bigint, k bigint").select("v", "k"))
    spread = joins.equi_join(left, right, "k", how, hot_rows=80, repeated_right=True)
    assert joins.RIGHT_SALT in plan(spread)
    plain = left.join(right, "k", how)
    assert set(spread.columns) == set(plain.columns)
    assert rows(spread.select(plain.columns)) == rows(plain)


def many_pairs(spark):
    """Eight even keys on both sides, not hot in rows: 50,000 pairs each; a null and an own key on either side."""
    even = (F.col("i") % 8).cast("int")
    left = spark.range(1602).withColumnRenamed("id", "i").withColumn(
        "k", F.when(F.col("i") == 1600, None).when(F.col("i") == 1601, -1).otherwise(even))
    right = spark.range(2002).withColumnRenamed("id", "i").select(F.col("i").alias("v"), F.when(
        F.col("i") == 2000, None).when(F.col("i") == 2001, -2).otherwise(even).alias("k"))
    return left, right


def spread_over(joined):
    """The number of tasks that make rows, and the rows of the largest."""
    made = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    return len(made), max(made)


def spread_as(monkeypatch, pairs):
    monkeypatch.setattr(joins, "PAIRS_PER_PIECE", pairs)


@pytest.mark.parametrize("pairs", [5_000, 60_000])
def test_right_join_of_many_pairs_is_cut_into_small_tasks(spark, no_broadcast, monkeypatch, pairs):
    spread_as(monkeypatch, pairs)
    left, right = many_pairs(spark)
    joined, plain = joins.equi_join(left, right, "k", "right"), left.join(right, "k", "right")
    assert rows(joined.select(plain.columns)) == rows(plain)
    tasks, most = spread_over(joined)
    assert tasks >= (24 if pairs < 50_000 else 4) and most <= (50_000 if pairs < 50_000 else 200_000)


def test_many_pairs_are_not_gathered_by_the_planner_once_tables_look_small(spark, monkeypatch):
    """The join is planned for large tables, then run with broadcasts allowed and partitions joined by size."""
    spread_as(monkeypatch, 5_000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    left, right = many_pairs(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.equi_join(left, right, "k", "inner", repeated_right=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tasks, most = spread_over(joined)
    assert tasks >= 24 and most <= 50_000
    plain = left.join(right, "k")
    assert rows(joined.select(plain.columns)) == rows(plain)


def test_full_join_of_many_pairs_is_cut_into_small_tasks(spark, no_broadcast, monkeypatch):
    spread_as(monkeypatch, 5_000)
    left, right = many_pairs(spark)
    joined, plain = joins.equi_join(left, right, "k", "full"), left.join(right, "k", "full")
    assert rows(joined.select(plain.columns)) == rows(plain)
    tasks, most = spread_over(joined)
    assert tasks >= 24 and most <= 50_000


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_copies_of_a_table_of_one_part_are_made_by_many_tasks(spark, no_broadcast, monkeypatch, how):
    spread_as(monkeypatch, 1_000)
    monkeypatch.setattr(joins, "HOT_ROWS", 1_000)
    copied, add_all_salts = [], joins.add_all_salts

    def spied(df, on, hot, name=joins.SALT):
        copied.append(add_all_salts(df, on, hot, name))
        return copied[-1]

    monkeypatch.setattr(joins, "add_all_salts", spied)
    left, right = (df.coalesce(1) for df in many_pairs(spark))
    joined, plain = joins.equi_join(left, right, "k", how, repeated_right=True), left.join(right, "k", how)
    assert rows(joined.select(plain.columns)) == rows(plain)
    # of right rows for the left salts and of left rows for the right salts, more than 10,000 each
    for tasks, most in (spread_over(df) for df in copied[:2]):
        assert tasks >= 8 and most <= 2_000


@pytest.mark.parametrize("how", ["left", "inner"])
def test_many_pairs_of_integers_of_different_width(spark, no_broadcast, monkeypatch, how):
    spread_as(monkeypatch, 5_000)
    left, right = many_pairs(spark)
    right = right.withColumn("k", F.col("k").cast("bigint"))
    joined, plain = joins.equi_join(left, right, "k", how, repeated_right=True), left.join(right, "k", how)
    assert rows(joined.select(plain.columns)) == rows(plain)
    assert dict(joined.dtypes) == dict(plain.dtypes)
    tasks, most = spread_over(joined)
    assert tasks >= 24 and most <= 50_000


def test_pieces_are_bounded_in_number(spark, no_broadcast, monkeypatch):
    spread_as(monkeypatch, 10)
    monkeypatch.setattr(joins, "MOST_PIECES", 64)
    left, right = many_pairs(spark)
    a, b = (joins.find_hot_keys(df, ["k"]) for df in (left, right))
    of_left, of_right, pieces = joins.cut_pairs(left, right, ["k"], a, b)
    assert 64 <= pieces <= 128 and of_left.per_key and of_right.per_key
    unique = spark.range(2000).withColumnRenamed("id", "k")
    c = joins.find_hot_keys(unique, ["k"])
    assert joins.cut_pairs(unique, unique, ["k"], c, c) == (c, c, 0)


def test_feature_table_over_a_performance_table_with_a_hot_key(spark, no_broadcast):
    profile = fx.profile(spark, SF_DIR)
    lines = fx.table(spark, SF_DIR, "lineitem").select(
        F.when(F.col("l_linenumber") == 1, 11).otherwise(F.col("l_orderkey")).alias("id"),
        "l_quantity", F.monotonically_increasing_id().alias("n"))
    wide = joins.feature_table(
        profile, lines, fx.dimension(spark, SF_DIR), fx.target(spark, SF_DIR), key="id",
        dim_key="cust_id", hot_rows=200, repeated=True)
    assert joins.RIGHT_SALT in plan(wide)
    plain = (profile.join(lines, "id", "left").join(fx.dimension(spark, SF_DIR), "cust_id", "left")
             .join(fx.target(spark, SF_DIR), "id", "left").select(wide.columns))
    assert rows(wide) == rows(plain)


def test_hot_key_reaches_many_tasks(spark, no_broadcast):
    left = skewed(spark, 60_000)
    hot = joins.find_hot_keys(left, ["k"], hot_rows=500)
    salted = joins.add_salt(left, ["k"], replace(hot, per_key=dict.fromkeys(hot.hashes, 64))).filter("k = 7")
    per_salt = [r["count"] for r in salted.groupBy(joins.SALT).count().collect()]
    assert len(per_salt) > 4 and max(per_salt) < sum(per_salt) / 2


def test_salt_of_identical_rows_in_one_partition_uses_the_given_columns(spark, no_broadcast):
    left = skewed(spark).repartition(1)
    hot = joins.find_hot_keys(left, ["k"], hot_rows=300)
    salted = joins.add_salt(left, ["k"], hot, spread_by=["i"]).filter("k = 7")
    assert salted.select(joins.SALT).distinct().count() == hot.salts


def test_evenly_spread_keys_are_not_salted(spark, no_broadcast):
    left = spark.range(5000).withColumnRenamed("id", "k")
    assert not joins.find_hot_keys(left, ["k"], hot_rows=10)
    assert joins.SALT not in plan(joins.equi_join(left, lookup(spark), "k", hot_rows=10))


def test_integer_keys_of_different_width_are_spread_alike(spark, no_broadcast):
    left = skewed(spark).withColumn("k", F.col("k").cast("int"))
    spread = joins.equi_join(left, lookup(spark), "k", hot_rows=300)
    assert joins.SALT in plan(spread)
    assert rows(spread) == rows(left.join(lookup(spark), "k", "left"))


def test_keys_of_different_kinds_are_left_to_spark(spark, no_broadcast):
    left = skewed(spark).withColumn("k", F.col("k").cast("string"))
    assert joins.SALT not in plan(joins.equi_join(left, lookup(spark), "k", hot_rows=300))


def test_small_right_side_is_broadcast_without_looking_for_hot_keys(spark):
    joined = joins.equi_join(skewed(spark), lookup(spark), "k", hot_rows=1)
    assert "BroadcastHashJoin" in plan(joined) and joins.SALT not in plan(joined)


def test_composite_key_with_one_null_part(spark, no_broadcast):
    left = skewed(spark).withColumn("b", F.col("i") % 2)
    right = lookup(spark).withColumn("b", F.col("k") % 2)
    spread = joins.equi_join(left, right, ["k", "b"], hot_rows=300)
    assert rows(spread) == rows(left.join(right, ["k", "b"], "left"))


def test_null_keys_survive_the_anti_join(spark):
    left = spark.createDataFrame([(1,), (None,), (2,)], "id int")
    right = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(joins.equi_join(left, right, "id", "left_anti")) == [(None,), (2,)]


def test_duplicate_dimension_keys(spark):
    entity = spark.createDataFrame([(9, 1)], "id int, d int")
    dim = spark.createDataFrame([(1, 1.0), (1, 2.0)], "d int, x double")
    performance = spark.createDataFrame([(9, 5)], "id int, p int")

    def build(**how):
        return joins.feature_table(entity, performance, dim, key="id", dim_key="d", **how)

    assert rows(build()) == [(9, 1, 5, 1.0), (9, 1, 5, 2.0)]
    assert rows(build(on_duplicate="first", dim_order=["x"])) == [(9, 1, 5, 1.0)]
    with pytest.raises(ValueError, match="repeats values"):
        build(on_duplicate="error")
    with pytest.raises(ValueError, match="on_duplicate"):
        build(on_duplicate="drop")
    with pytest.raises(ValueError, match="order by"):
        build(on_duplicate="first")
    unique = dim.filter("x = 1")
    assert rows(joins.feature_table(
        entity, performance, unique, key="id", dim_key="d", on_duplicate="error")
    ) == [(9, 1, 5, 1.0)]


def hot_inputs(spark):
    """A third of the entities under one id, and another third in one dimension value."""
    profile = fx.profile(spark, SF_DIR).withColumn(
        "id", F.when(F.col("id") % 3 == 0, 11).when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id"))
    ).withColumn("cust_id", F.when(F.col("total_price") > 300_000, 5).otherwise(F.col("cust_id")))
    return profile, fx.performance(spark, SF_DIR), fx.dimension(spark, SF_DIR), fx.target(spark, SF_DIR)


def test_feature_table_with_hot_entity_and_dimension_keys(spark, no_broadcast):
    profile, performance, dimension, target = hot_inputs(spark)
    wide = joins.feature_table(profile, performance, dimension, target, key="id",
                               dim_key="cust_id", hot_rows=50)
    assert plan(wide).count(joins.SALT) > 2
    plain = (profile.join(performance, "id", "left").join(dimension, "cust_id", "left")
             .join(target, "id", "left").select(wide.columns))
    assert rows(wide) == rows(plain)


def test_feature_table_with_dimension_key_on_the_performance_side(spark, no_broadcast):
    profile, performance, dimension, target = hot_inputs(spark)
    performance = performance.withColumn("cust_id", F.col("id") % 3)
    wide = joins.feature_table(profile.drop("cust_id"), performance, dimension, target,
                               key="id", dim_key="cust_id", hot_rows=50)
    plain = (profile.drop("cust_id").join(performance, "id", "left")
             .join(dimension, "cust_id", "left").join(target, "id", "left").select(wide.columns))
    assert rows(wide) == rows(plain)


def test_entity_joins_share_one_shuffle_of_the_profile(spark, no_broadcast):
    wide = joins.feature_table(
        fx.profile(spark, SF_DIR), fx.performance(spark, SF_DIR),
        fx.table(spark, SF_DIR, "customer").select(F.col("c_custkey").alias("cust_id"), "c_acctbal"),
        fx.target(spark, SF_DIR), key="id", dim_key="cust_id")
    # profile, lineitem and target by id; then the joined rows and the dimension by cust_id.
    assert shuffles(wide) == 5


def test_bucketed_tables_join_without_a_shuffle(spark, no_broadcast):
    fx.profile(spark, SF_DIR).write.bucketBy(8, "id").sortBy("id").mode("overwrite").saveAsTable("b_profile")
    fx.performance(spark, SF_DIR).write.bucketBy(8, "id").sortBy("id").mode("overwrite").saveAsTable("b_performance")
    joined = joins.equi_join(spark.read.table("b_profile"), spark.read.table("b_performance"), "id")
    assert shuffles(joined) == 0 and joined.count() == 1500
    spark.sql("DROP TABLE b_profile")
    spark.sql("DROP TABLE b_performance")


def test_argument_checks(spark):
    a = spark.createDataFrame([(1, 2)], "id int, x int")
    with pytest.raises(TypeError):
        joins.equi_join([1], a, "id")
    with pytest.raises(ValueError, match="no column 'y'"):
        joins.equi_join(a, a, "y")
    dim = spark.createDataFrame([(2, 3)], "x int, z int")
    with pytest.raises(ValueError, match="repeats columns"):
        joins.feature_table(a, a, dim, key="id", dim_key="x")
    with pytest.raises(ValueError, match="no column"):
        joins.feature_table(a.drop("x"), a.drop("x"), dim, key="id", dim_key="x")
