import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from strataprop.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def frame(spark):
    """60,000 rows: one group with half of them, ties, nulls, NaN, a null group, tiny groups."""
    i = F.col("id")
    group = (F.when(i % 2 == 0, "hot").when(i % 40 == 1, None).when(i < 20, F.concat(F.lit("t"), i))
             .otherwise("other"))
    value = (F.when(i % 11 == 0, None).when(i % 97 == 0, float("nan"))
             .when(i % 5 == 0, 1000.0).otherwise(F.hash("id") / 1000.0))
    return spark.range(60_000).select(group.alias("g"), value.alias("x")).cache()


def expected(frame, method, probs):
    pdf = frame.toPandas().dropna(subset=["x"])
    return {
        g: np.quantile(part["x"], probs, method=method)
        for g, part in pdf.groupby("g", dropna=False)
    }


@pytest.mark.parametrize("kind,method", [("disc", "inverted_cdf"), ("cont", "linear")])
@pytest.mark.parametrize("accuracy", [1_000, 20_000, 50_000])
def test_equals_numpy(spark, frame, kind, method, accuracy):
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(frame, "x", probs, ["g"], kind=kind, accuracy=accuracy).collect()
    want = {g if isinstance(g, str) else None: q for g, q in expected(frame, method, probs).items()}
    assert {r["g"] for r in got} >= set(want)
    for r in got:
        if r["n"]:
            assert np.allclose(r["quantiles"], want[r["g"]], rtol=1e-12, atol=0), r["g"]


def test_plan_for_large_lookups_gives_the_same(spark, frame, no_broadcast):
    got = exact_quantiles(frame, "x", [0.5], ["g"], accuracy=1_000)
    want = expected(frame, "inverted_cdf", [0.5])
    assert {r["quantiles"][0] for r in got.collect() if r["n"]} == {q[0] for q in want.values()}


def test_overall_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert exact_quantiles(df, "x", [0.5]).first()["quantiles"] == [2.0]
    assert exact_quantiles(df, "x", [0.5], kind="cont").first()["quantiles"] == [2.5]
    none = spark.createDataFrame([("a", None)], "g string, x double")
    assert rows(exact_quantiles(none, "x", [0.5], ["g"])) == [("a", 0, None, None, [None])]


def test_argument_checks(spark):
    df = spark.createDataFrame([("a", 1.0)], "g string, x double")
    for bad in ({"probs": [0.5, 0.1]}, {"probs": [1.5]}, {"probs": [0.5], "kind": "near"},
                {"probs": [0.5], "accuracy": 10}):
        with pytest.raises(ValueError):
            exact_quantiles(df, "x", **bad)
    with pytest.raises(ValueError, match="numeric"):
        exact_quantiles(df, "g", [0.5])
