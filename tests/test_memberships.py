"""Memberships by hand and against plain Python."""

import random

from yearloom.operators import memberships as M, network


def test_listed(spark):
    rows = [
        (1, 2000, "ACP, AfDB (nonregional member), UN,  World\n Bank; WTO (Observer) note: left ABC, DEF"), (1, 2000, "UN (observer), Club (of A, B), , (suspended)"),
        (2, 2000, None), (2, 2001, " "), (None, 2000, "UN"), (3, 2000, "Note: none"), (4, 2000, "X (b), X (a)"), (5, None, "UN"),
    ]
    got = {tuple(r) for r in M.listed(spark.createDataFrame(rows, "master_id long, year int, content string")).collect()}
    assert got == {
        (1, 2000, "ACP", "member"), (1, 2000, "AfDB", "nonregional member"), (1, 2000, "UN", "member"), (1, 2000, "World Bank", "member"), (1, 2000, "WTO", "observer"),
        (1, 2000, "Club", "of a, b"), (4, 2000, "X", "a"),
    }


def test_moves(spark):
    r = random.Random(4)
    editions = {m: sorted(r.sample(range(1990, 2010), r.randrange(1, 15))) for m in range(12)}
    has = {(m, o, y) for m, ys in editions.items() for o in "abcd" for y in ys if r.random() < 0.6}
    want = set()
    for m, ys in editions.items():
        for o in "abcd":
            for a, b in zip(ys, ys[1:]):
                if ((m, o, a) in has) != ((m, o, b) in has):
                    want.add((m, o, b, "joined" if (m, o, b) in has else "left"))
    memberships = spark.createDataFrame([(m, y, o, r.choice(["member", "observer"])) for m, o, y in has], "master_id long, year int, organisation string, standing string")
    own = spark.createDataFrame([(m, y) for m, ys in editions.items() for y in ys] * 2 + [(None, 2000)], "master_id long, year int")
    moves = M.moves(memberships, own)
    got = [tuple(x) for x in moves.collect()]
    assert set(got) == want and len(got) == len(want)
    sizes = {(x["organisation"], x["year"]): x for x in M.sizes(memberships, moves).collect()}
    for (o, y), x in sizes.items():
        assert x["members"] + x["others"] == sum(h[1:] == (o, y) for h in has)
        assert (x["joined"], x["left"]) == tuple(sum(w[1:] == (o, y, k) for w in want) for k in ("joined", "left"))
    assert set(sizes) == {h[1:] for h in has} | {w[1:3] for w in want}
    assert M.moves(memberships.limit(0), own).count() == 0 and M.moves(memberships, own.limit(0)).count() == 0


def test_ties(spark):
    rows = [(m, 2000, o, "member") for m in (1, 2, 3) for o in ("UN", "WTO")] + [(4, 2000, "UN", "observer"), (1, 1999, "X", "member")]
    ties = M.ties(spark.createDataFrame(rows, "master_id long, year int, organisation string, standing string"), 2000)
    assert {(r["source"], r["target"]): r["weight"] for r in ties.collect()}[("organisation:UN", "entity:4")] == 0.5 and ties.count() == 14
    cores = {r["node"]: r["core"] for r in network.cores(ties).collect()}
    assert cores == {**{f"entity:{m}": 2 for m in (1, 2, 3)}, "organisation:UN": 2, "organisation:WTO": 2, "entity:4": 1}
    # Ties both ways make a walk that is where weights are.
    ranks = {r["node"]: r["rank"] for r in network.ranks(ties, near=0.05).collect()}
    assert abs(sum(ranks.values()) - 1) < 1e-6 and max(ranks, key=ranks.get) == "organisation:UN" and min(ranks, key=ranks.get) == "entity:4"
