"""Run queries on Spark and their oracle SQL on DuckDB, and compare rows without order."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir) -> str | None:
    df = query(spark, sf_dir)
    mine = rows_by_name(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_by_name(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    session = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        if name in oracles:
            problem = compare(session, con, name, query, oracles[name], sf_dir)
            outcome = problem or "equal"
        else:
            outcome = f"{query(session, sf_dir).count()} rows, no oracle"
        print(f"{name:28s} {time.time() - start:6.2f}s  {outcome}", flush=True)
