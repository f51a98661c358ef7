"""Every query with SQL gives the same rows as DuckDB, over the smallest tables."""

import os

import duckdb
import pytest

from holdfast.plans import REGISTRIES

DATA = "/root/testdata/sf0.001"
SQL = {name: sql for registry in REGISTRIES for name, sql in registry.sql.items()}
QUERIES = {name: q for registry in REGISTRIES for name, q in registry.queries.items()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for file in os.listdir(DATA):
        con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return value


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    mine = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted((tuple(map(plain, r)) for r in duck.sql(f"SELECT {quoted} FROM ({SQL[name]})").fetchall()), key=repr)
    assert mine == theirs


def test_chunks_join_again(spark):
    from pyspark.sql import functions as F

    from holdfast.functions import text
    from holdfast.plans.roles import table

    parts = QUERIES["text_chunks"](spark, DATA).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("part", "value"))).alias("p"), F.max(F.length("value")).alias("n"))
    joined = parts.select("id", F.array_join(F.transform("p", lambda x: x["value"]), "").alias("whole"), "n").join(table(spark, DATA, "documents").withColumnRenamed("doc_id", "id"), "id")
    assert joined.where(F.col("n") > 1500).count() == 0
    assert joined.where(F.col("whole") != text.statement_value(F.col("text"))).count() == 0
    assert joined.count() == 200
