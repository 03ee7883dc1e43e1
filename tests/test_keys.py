"""Keys and ranks of a whole table, against sorting it in one place."""

import random

import pytest
from pyspark.sql import functions as F

from yearloom.operators import keys


def test_numbers_of_any_keys(spark):
    r = random.Random(1)
    texts = [(i, r.choice([None, "", "b", "Ä", "a" * 50]), (1 << 60) + r.randrange(5)) for i in range(700)]
    df = spark.createDataFrame(texts, "id long, name string, big long").repartition(7)
    order = lambda x: (x[1] is not None, (x[1] or "").encode(), x[2], x[0])
    got = keys.numbered(df, ["name", "big", "id"], "N")
    assert got.columns == ["id", "name", "big", "N"]
    assert [(r["id"], r["N"]) for r in got.orderBy("N").collect()] == [(x[0], k + 1) for k, x in enumerate(sorted(texts, key=order))]
    down = keys.numbered(df, [F.col("id").desc()], "ID")
    assert down.columns == ["name", "big", "ID"] and sorted(r["ID"] for r in down.collect()) == list(range(1, 701))
    assert keys.numbered(df.limit(0), ["id"], "n").count() == 0
    same = keys.numbered(df.withColumn("one", F.lit(1)), ["one"], "n")
    assert sorted(r["n"] for r in same.collect()) == list(range(1, 701))


@pytest.mark.parametrize("kind", ["few", "half", "nulls", "different", "one", "floats"])
def test_ranks_of_values_that_span_ranges(spark, kind):
    r = random.Random(kind)
    make = {
        "few": lambda i: r.randrange(3), "half": lambda i: 5 if i % 2 else r.randrange(1000), "nulls": lambda i: r.choice([None, None, 1, 2]),
        "different": lambda i: i, "one": lambda i: 7, "floats": lambda i: r.choice([0.5, -1.0, float("nan"), None]),
    }[kind]
    rows = [(i, make(i)) for i in range(601)]
    df = spark.createDataFrame(rows, f"id long, v {'double' if kind == 'floats' else 'long'}").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 13)
    try:
        got = {x["id"]: x for x in keys.ranked(df, F.col("v"), tiles=7).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    df.createOrReplaceTempView("ranked_rows")
    want = spark.sql("SELECT id, v, rank() OVER (ORDER BY v) AS rank, dense_rank() OVER (ORDER BY v) AS dense FROM ranked_rows").collect()
    assert len(got) == 601
    for x in want:
        assert (got[x["id"]]["rank"], got[x["id"]]["dense_rank"]) == (x["rank"], x["dense"]), x
    sizes = [sum(x["tile"] == t for x in got.values()) for t in range(1, 8)]
    assert sizes == [86] * 6 + [85]
    order = sorted(got.values(), key=lambda x: x["tile"])
    assert all(a["rank"] <= b["rank"] or a["tile"] == b["tile"] for a, b in zip(order, order[1:]) if a["tile"] < b["tile"])


def test_no_window_over_the_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_returnflag")
    plan = keys.ranked(df, F.col("l_returnflag"))._jdf.queryExecution().executedPlan().toString()
    # What is not partitioned are the windows over a row for each range.
    assert plan.count("Exchange SinglePartition") <= plan.count("Window")
    assert all("_range" in w for w in plan.split("\n") if "Window [" in w)


def test_a_value_of_many_rows_is_cut(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = keys.dealt(df, [F.col("v")]).where("v = -1").groupBy("_range").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) > 1 and sum(r["count"] for r in rows) == df.where("v = -1").count()
    maps = df.select(F.create_map("id", "v").alias("m"), "id")
    assert keys.numbered(maps, ["id"], "n").where("n <> id + 1").count() == 0


@pytest.mark.parametrize("ascending", [True, False])
def test_ranks_within_groups(spark, ascending):
    r = random.Random(8)
    rows = [(i, r.choice(["hot", "hot", "hot", "b", None]), r.choice([1, 2]), r.choice([None, 0.5, 1.5, r.random()])) for i in range(900)] + [(900, "alone", 1, None)]
    df = spark.createDataFrame(rows, "id long, g string, h int, v double").repartition(5)
    got = {x["id"]: (x["rank"], x["dense_rank"]) for x in keys.ranked_within(df, ["g", "h"], F.col("v"), ascending).collect()}
    df.createOrReplaceTempView("grouped_rows")
    order = "v" if ascending else "v DESC"
    want = spark.sql(f"SELECT id, rank() OVER w AS a, dense_rank() OVER w AS b FROM grouped_rows WINDOW w AS (PARTITION BY g, h ORDER BY {order})").collect()
    assert got == {x["id"]: (x["a"], x["b"]) for x in want} and len(got) == 901
    named = df.withColumnRenamed("v", "_by").withColumn("rank", F.lit("old"))
    assert keys.ranked_within(named, ["g"], F.col("_by")).columns == ["id", "g", "h", "_by", "rank", "dense_rank"]
    assert keys.ranked_within(df.limit(0), ["g"], F.col("v")).count() == 0
