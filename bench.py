"""Time the headline queries, and each operator against the plainer way to write it.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_RUNS (the best run counts).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.ml.functions import vector_to_array  # noqa: F401  (loads the ML classes up front)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataprop.operators import metrics, splitting
from strataprop.operators.imputation import Impute, apply_imputation, fit_imputation
from strataprop.operators.quantiles import exact_quantiles
from strataprop.plans import fixtures as fx
from strataprop.plans.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINES = (
    "feature_table", "join_composite_key", "impute_stratified_mean",
    "impute_stratified_median", "impute_out_of_sample", "split_hash", "split_validation_anti",
    "split_counts", "contingency", "chi_square", "correlation_matrix", "box_stats", "bin_2d",
    "category_index", "one_hot", "logistic_train_metrics",
    "python_model_score", "binary_metrics", "flagship", "correlation_matrix_wide",
    "quantiles_narrow", "train_metrics_by_level", "join_hot_both", "gbt_train_metrics",
    "one_hot_table", "target_means_before", "merged_medians", "join_bucketed",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


# --- pairs: the engine's formulation, and the plain one it replaces -------------------------


def split_pair(spark):
    rows = fx.features(spark, SF_DIR)

    def ours():
        run(splitting.split_counts(splitting.split_by_hash(rows, key="id", target="label"), "label"))

    def plain():
        drawn = [rows.filter(F.col("label") == v).sample(fraction=0.7, seed=123) for v in (0, 1)]
        train = drawn[0].unionByName(drawn[1])
        run(train.groupBy("label").count())
        run(rows.join(train, "id", "left_anti").groupBy("label").count())

    return ours, plain


def apply_pair(spark):
    rows = fx.profile_with_nulls(spark, SF_DIR).withColumn("stratum", F.col("cust_id") % 100)
    params = fit_imputation(rows, Impute("total_price", "mean", "stratum"))
    values = {int(r["stratum_value"]): r["value"] for r in params.collect()}

    def ours():
        run(apply_imputation(rows, params))

    def plain():
        price = F.col("total_price")
        for stratum, value in values.items():
            price = F.when((F.col("stratum") == stratum) & F.col("total_price").isNull(), value
                           ).otherwise(price)
        run(rows.withColumn("total_price", price))

    return ours, plain


def metrics_pair(spark):
    graded = fx.table(spark, SF_DIR, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y_true"),
        F.when(F.col("l_quantity") >= 25, 1).otherwise(0).alias("y_pred"))

    def ours():
        metrics.binary_metrics(graded).collect()

    def plain():
        pdf = graded.toPandas()
        tp = ((pdf.y_true == 1) & (pdf.y_pred == 1)).sum()
        return (pdf.y_true == pdf.y_pred).mean(), tp / pdf.y_pred.sum(), tp / pdf.y_true.sum()

    return ours, plain


def fit_pair(spark):
    rows = fx.features(spark, SF_DIR, nulls=True)
    columns = ["total_price", "n_lines", "sum_qty", "avg_discount", "max_price"]

    def ours():
        fit_imputation(rows, [Impute(c, "mean", "priority") for c in columns])

    def plain():
        for c in columns:
            rows.groupBy("priority").agg(F.round(F.avg(c))).collect()

    return ours, plain


def feature_pair(spark):
    def ours():
        run(fx.features(spark, SF_DIR))

    def plain():
        customer = fx.table(spark, SF_DIR, "customer").join(
            fx.table(spark, SF_DIR, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        wide = fx.profile(spark, SF_DIR).join(fx.performance(spark, SF_DIR), "id", "left").join(
            customer, F.col("cust_id") == F.col("c_custkey"), "left").join(fx.target(spark, SF_DIR), "id", "left")
        run(wide)

    return ours, plain


def quantile_pair(spark):
    lines = fx.table(spark, SF_DIR, "lineitem")

    def ours():
        run(exact_quantiles(lines, "l_extendedprice", [0.1, 0.5, 0.9], ["l_returnflag"]))

    def plain():
        run(lines.groupBy("l_returnflag").agg(F.expr("percentile(l_extendedprice, array(0.1, 0.5, 0.9))")))

    return ours, plain


PAIRS = {"split": split_pair, "apply_imputation": apply_pair, "metrics": metrics_pair,
         "fit_imputation": fit_pair, "feature_table": feature_pair, "exact_quantiles": quantile_pair}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: best(lambda q=QUERIES[name]: run(q(spark, SF_DIR))) for name in HEADLINES}
    pairs = {}
    for name, build in PAIRS.items():
        ours, plain = build(spark)
        pairs[name] = {"ours": best(ours), "plain": best(plain)}
    scale = re.search(r"sf([\d.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total_seconds_best_run", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "pairs": pairs,
        "sf": float(scale.group(1)) if scale else None, "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
