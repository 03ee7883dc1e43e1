"""Ranks against dense linear algebra, cores against peeling."""

import random

import numpy as np
import pytest

from yearloom.operators import network


def graph(seed, n=30, p=0.12):
    r = random.Random(seed)
    return [(i, j, float(r.randrange(1, 9))) for i in range(n) for j in range(n) if i != j and r.random() < (0.9 if j == 0 or i == 1 else p) and i != 7]


def dense(rows, damping=0.85):
    names = sorted({x for a, b, _ in rows for x in (a, b)})
    at, n = {x: i for i, x in enumerate(names)}, len(names)
    m = np.zeros((n, n))
    for a, b, w in rows:
        m[at[b], at[a]] += w
    total = m.sum(0)
    m = np.where(total > 0, m / np.where(total > 0, total, 1), 1 / n)
    x = np.linalg.solve(np.eye(n) - damping * m, np.full(n, (1 - damping) / n))
    return dict(zip(names, x))


@pytest.mark.parametrize("hub", [network.HUB, 5])
def test_ranks(spark, hub):
    rows = graph(1)
    links = network.edges(spark.createDataFrame(rows, "a long, b long, w double").repartition(3), "a", "b", "w")
    got = {r["node"]: r["rank"] for r in network.ranks(links, hub=hub).collect()}
    want = dense(rows)
    assert set(got) == set(want) and abs(sum(got.values()) - 1) < 1e-9
    assert max(abs(got[k] - want[k]) for k in want) < 1e-8


def test_edges_without_wholes(spark):
    rows = [("A", "B", 1.0), ("A", "B", 2.0), ("A", "World", 9.0), ("European Union", "B", 9.0), ("A", "A", 5.0), (None, "B", 1.0), ("B", "A", None), ("B", "A", 0.0), ("B", "C", 4.0)]
    df = spark.createDataFrame(rows, "s string, t string, w double")
    assert sorted(map(tuple, network.edges(df, "s", "t", "w").collect())) == [("A", "B", 3.0), ("B", "C", 4.0)]
    none = network.edges(df.limit(0), "s", "t", "w")
    assert network.ranks(none).count() == 0 and network.cores(none).count() == 0


def test_cores(spark):
    rows = graph(2, 24, 0.2)
    near = {}
    for a, b, _ in rows:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want, left, k = {}, {x: set(v) for x, v in near.items()}, 0
    while left:
        low = [x for x, v in left.items() if len(v) <= k]
        if not low:
            k += 1
        for x in low:
            want[x] = k
            for y in left.pop(x):
                if y in left:
                    left[y].discard(x)
    links = network.edges(spark.createDataFrame(rows, "a long, b long, w double"), "a", "b", "w")
    assert {r["node"]: r["core"] for r in network.cores(links).collect()} == want
