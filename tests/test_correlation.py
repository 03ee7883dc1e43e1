"""Sums over pairs of blocks against a SQL engine's own aggregates."""

import math
import random

import duckdb
import pytest

from yearloom.operators import correlation

SCHEMA = "o long, v string, a double"


def told(rows):
    return {(r["x"], r["y"]): (r["n"], *(None if r[c] is None else round(r[c], 6) for c in ("corr", "slope", "intercept"))) for r in rows}


def expected(data):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (o BIGINT, v VARCHAR, a DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", data)
    found = con.sql("""WITH m AS (SELECT o, v, avg(a) AS a FROM t WHERE o IS NOT NULL AND v IS NOT NULL AND NOT isnan(a) GROUP BY 1, 2)
      SELECT x.v, y.v, count(*), corr(y.a, x.a), regr_slope(y.a, x.a), regr_intercept(y.a, x.a) FROM m x JOIN m y ON x.o = y.o AND x.v < y.v GROUP BY 1, 2""").fetchall()
    return {(x, y): (n, *(None if c is None or math.isnan(c) else round(c, 6) for c in rest)) for x, y, n, *rest in found}


@pytest.mark.parametrize("block", [1, 3, 128])
def test_pairs_with_missing_values(spark, block):
    r = random.Random(4)
    data = [(o, f"v{k}", r.choice([None, float("nan"), r.gauss(1e6, 3), r.gauss(k, 1) + o % 5])) for o in range(120) for k in range(9) if r.random() < 0.7]
    data += [(1, "v1", 5.0), (1, "v1", 7.0), (None, "v1", 1.0), (2, None, 1.0), (3, "alone", 2.0), (7000, "apart", 2.0)]
    data += [(o, "same", 4.0) for o in range(50)]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got, want = told(correlation.pairwise(df, "o", "v", "a", block).collect()), expected(data)
    assert set(got) == set(want)
    for key, (n, *rest) in want.items():
        assert got[key][0] == n
        for a, b in zip(got[key][1:], rest):
            assert (a is None) == (b is None) and (a is None or abs(a - b) <= 1e-6 * max(1, abs(b))), (key, got[key], want[key])


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert correlation.pairwise(df, "o", "v", "a").collect() == []


def test_no_join_of_rows(spark, sf_dir):
    from pyspark.sql import functions as F

    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey", "l_returnflag", F.col("l_quantity").cast("double").alias("a"))
    plan = correlation.pairwise(rows, "l_partkey", "l_returnflag", "a")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
