"""The given tables in the roles of the engine's inputs; the entity is an order."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataprop.operators.joins import equi_join, feature_table
from strataprop.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust_id"),
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("total_price"))


def profile_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile with the price of every seventh order unknown."""
    known = F.when(F.col("id") % 7 != 0, F.col("total_price"))
    return profile(spark, sf_dir).withColumn("total_price", known)


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has lines; other orders have no performance."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.avg("l_discount"), 6).alias("avg_discount"),
        F.max("l_extendedprice").alias("max_price"))


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cust_id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nation_id"))
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_id"), F.col("n_regionkey").alias("region_id"))
    return equi_join(customer, nation, "nation_id").select(
        "cust_id", "segment", "acctbal", "nation_id", "region_id")


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), label.alias("label"))


def features(
    spark: SparkSession, sf_dir: str, *, labelled: bool = True, nulls: bool = False
) -> DataFrame:
    rows = profile_with_nulls if nulls else profile
    return feature_table(
        rows(spark, sf_dir), performance(spark, sf_dir), dimension(spark, sf_dir),
        target(spark, sf_dir) if labelled else None, key="id", dim_key="cust_id")


LINE_LEVELS = {"l_linestatus": ["F", "O"]}


def line_return_model():
    """A stand-in for a model trained elsewhere: a logistic function with fixed coefficients."""

    class LineReturnModel:
        feature_names_in_ = ["l_quantity", "l_discount", "l_linestatus"]

        def predict_proba(self, rows: pd.DataFrame) -> np.ndarray:
            z = (0.04 * rows["l_quantity"] - 9.0 * rows["l_discount"]
                 - 0.6 * rows["l_linestatus"].cat.codes.astype("float64") - 0.2)
            p = 1.0 / (1.0 + np.exp(-z.to_numpy()))
            return np.column_stack([1.0 - p, p])

    return LineReturnModel()
