"""Containment by automata against comparing all pairs."""

import random

import pytest
from pyspark.sql import functions as F

import yearloom.plans.catalog  # noqa: F401  registers the queries
from yearloom.operators import matching
from yearloom.plans.registry import QUERIES


def pairs(texts, names, both):
    return sorted((i, n) for i, t in texts for n, name in names if t and name and (name in t or both and t in name))


@pytest.mark.parametrize("limit", [matching.NAMES_BYTES, 60])
@pytest.mark.parametrize("both", [True, False])
def test_all_pairs(spark, both, limit, monkeypatch):
    monkeypatch.setattr(matching, "PORTION", 37)
    r = random.Random(2)
    say = lambda n: "".join(r.choice("abé ") for _ in range(r.randrange(n)))
    texts = [(i, say(9)) for i in range(150)] + [(200, None), (201, "a" * 5000), (202, "a"), (202, "a")]
    names = [(i, say(5)) for i in range(60)] + [(100, None), (101, ""), (102, "ab"), (103, "ab")]
    left = spark.createDataFrame(texts, "id long, text string").repartition(3)
    right = spark.createDataFrame(names, "name_id long, name string")
    hits = matching.containing(left, "text", right, "name", both, limit)
    assert hits.columns == ["id", "text", "name_id", "name"]
    assert sorted((x["id"], x["name_id"]) for x in hits.collect()) == pairs(texts, names, both)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert matching.containing(left.limit(0), "text", right, "name", both, limit).count() == 0
    assert matching.containing(left, "text", right.limit(0), "name", both, limit).count() == 0


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    with pytest.raises(ValueError, match="name"):
        matching.containing(df, "name", df.select(F.col("id").alias("other"), F.col("name").alias("Name")), "Name")


def test_tiers_and_aliases(spark):
    masters = spark.createDataFrame([(1, "Burma"), (2, "Gambia"), (3, "Gambia, The"), (4, "Niger"), (5, "Nigeria")], "master_id int, name string")
    aliases = spark.createDataFrame([("Myanmar", 1), ("Gold Coast", 9)], "alias string, master_id int")
    asked = spark.createDataFrame([("Myanmar",), ("the Gambia",), ("Gambia",), ("Nigeria",), ("Niger",), ("Union of Myanmar",), ("Gam",), ("x",), (None,), ("Gold",)], "said string")
    got = {r["q"]: (r["master_id"], r["tier"]) for r in matching.best(asked, "said", masters, aliases).collect()}
    assert got == {
        "Myanmar": (1, 1), "the Gambia": (2, 2), "Gambia": (2, 1), "Nigeria": (5, 1), "Niger": (4, 1), "Union of Myanmar": (1, 3), "Gam": (2, 3), "Gold": (9, 3),
    }
    assert "Myanmar" not in {r["q"] for r in matching.best(asked, "said", masters).collect()}


@pytest.mark.parametrize("name", ["fuzzy_contains", "tiered_match", "alias_match", "resolve_entity", "cli_country"])
def test_no_nested_loops(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
