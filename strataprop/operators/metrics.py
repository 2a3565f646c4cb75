"""Binary classification metrics from one aggregation pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataprop.functions.checks import require_columns, require_dataframe
from strataprop.functions.expressions import column, ratio

METRICS = ("accuracy", "precision", "recall", "f1")


def binary_metrics(
    df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", by: str | None = None
) -> DataFrame:
    """Confusion counts and accuracy, precision, recall and F1 of class 1, one row per group.

    A metric with nothing to divide by is 0. Rows where either value is not 0 or 1 cannot be
    graded; they are counted in ``n_ungraded`` and take no part in the metrics.
    """
    require_dataframe(df, "predictions")
    groups = [by] if by is not None else []
    require_columns(df, [y_true, y_pred, *groups], "predictions")
    true, pred = column(y_true), column(y_pred)

    def cells(t: int, p: int):
        return F.count_if((true == t) & (pred == p))

    counts = df.groupBy(*[column(c) for c in groups]).agg(
        F.count(F.lit(1)).alias("n_rows"),
        cells(1, 1).alias("tp"), cells(0, 1).alias("fp"),
        cells(1, 0).alias("fn"), cells(0, 0).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    graded = tp + fp + fn + tn
    return counts.select(
        *[column(c) for c in groups],
        "tp", "fp", "fn", "tn", (F.col("n_rows") - graded).alias("n_ungraded"),
        ratio(tp + tn, graded).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def metrics_long(metrics: DataFrame, sample: str) -> DataFrame:
    """Rows ``sample, metric, value`` from metrics grouped by the column ``sample``."""
    require_columns(metrics, [sample, *METRICS], "metrics")
    return metrics.unpivot(
        [column(sample)], [column(m) for m in METRICS], "metric", "value"
    ).withColumnRenamed(sample, "sample")


def metrics_dict(long: DataFrame) -> dict[str, dict[str, float]]:
    """The long table as ``{sample: {metric: value}}``; it has four rows per sample."""
    require_columns(long, ["sample", "metric", "value"], "metrics")
    result: dict[str, dict[str, float]] = {}
    for row in long.collect():
        result.setdefault(row["sample"], {})[row["metric"]] = row["value"]
    return result
