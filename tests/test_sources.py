import pytest
from conftest import SF_DIR
from helpers import rows

from strataprop.functions import runtime
from strataprop.sources import tables

SCHEMA = "code int, income int, share double, quality string, rate double"


def test_table_by_name_path_or_frame(spark):
    path = f"{SF_DIR}/nation.parquet"
    frame = tables.read_table(spark, path)
    frame.createOrReplaceTempView("nations_view")
    assert rows(tables.read_table(spark, "nations_view")) == rows(frame)
    assert tables.read_table(spark, frame) is frame
    with pytest.raises(TypeError):
        tables.read_table(spark, 5)


def test_delimited_file(spark, tmp_path):
    path = tmp_path / "dim.txt"
    path.write_text("code,income,share,quality,rate\n1,10,1.5,High,2.0\n2,20,,Low,4.5\n")
    df = tables.read_delimited(spark, str(path), SCHEMA)
    assert rows(df) == [(1, 10, 1.5, "High", 2.0), (2, 20, None, "Low", 4.5)]
    path.write_text("code,earnings,share,quality,rate\n1,10,1.5,High,2.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_delimited(spark, str(path), SCHEMA).collect()
    path.write_text("code,income,share,quality,rate\n1,ten,1.5,High,2.0\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_delimited(spark, str(path), SCHEMA).collect()


def test_write_table_refuses_an_existing_path(spark, tmp_path):
    df = spark.range(3)
    tables.write_table(df, str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)exists"):
        tables.write_table(df, str(tmp_path / "t"))
    tables.write_table(df, str(tmp_path / "t"), "overwrite")
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 3


def test_staged_table_is_in_the_shared_folder_and_has_its_own_size(spark):
    big = spark.range(1_000_000).selectExpr("id % 3 as k", "id as v").groupBy("k").count()
    staged = runtime.stage(big)
    assert rows(staged) == rows(big) and runtime.fits_broadcast(staged)
    folder = runtime.shared_folder(spark)
    assert all(folder.removeprefix("file:") in f for f in staged.inputFiles())
