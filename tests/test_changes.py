"""Edit scripts against tables of all distances, and texts rebuilt from them."""

import random
import re

from pyspark.sql import functions as F

from yearloom.operators import changes


def least(a, b):
    """Steps of a shortest script, by the table of all distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(last[j] if x == y else 1 + min(last[j + 1], row[j]))
    return row[-1]


def test_shortest_scripts():
    r = random.Random(6)
    for k in range(3000):
        a, b = ([r.choice("abcd"[: 2 + k % 3]) for _ in range(r.randrange(14))] for _ in range(2))
        found = changes.blocks(a, b)
        i = j = kept = 0
        for x, y, n in found:
            assert n > 0 and x >= i and y >= j and a[x : x + n] == b[y : y + n]
            i, j, kept = x + n, y + n, kept + n
        assert len(a) + len(b) - 2 * kept == least(a, b), (a, b)


def test_texts_are_rebuilt(spark):
    r = random.Random(7)
    say = lambda: "".join(r.choice(["km ", "area", " ", "\n", "12", "é", " | "]) for _ in range(r.randrange(30)))
    rows = [(i, say(), say()) for i in range(400)] + [(500, None, "new text"), (501, "old text", None), (502, None, None), (503, "same\n text ", "same\n text ")]
    long = [f"w{r.randrange(500)}" for _ in range(5000)]
    rows.append((504, " ".join(long), " ".join(x for i, x in enumerate(long) if i % 97) + " end"))
    df = changes.compared(spark.createDataFrame(rows, "id long, old string, new string"), "old", "new")
    df = df.withColumns({"again": changes.rebuilt(F.col("old"), F.col("script")), "changed": changes.tokens_of(F.col("script"), "-", "+")})
    for x in df.collect():
        old, new = x["old"] or "", x["new"] or ""
        assert x["again"] == new
        assert all(s["op"] != t["op"] for s, t in zip(x["script"], x["script"][1:]))
        if len(old) < 500:
            assert x["changed"] == least(*(re.findall(changes.TOKEN, t) for t in (old, new)))
        else:
            assert x["changed"] <= 2 * 5000 // 97 * 2 + 10


def test_consecutive_editions(spark):
    rows = [("a", 1990, 1, "x"), ("a", 1992, 2, None), ("a", 1991, 3, "y"), ("b", 1990, 4, "z"), (None, 1990, 5, "n"), (None, 1991, 6, "m")]
    df = spark.createDataFrame(rows, "who string, year int, id long, text string")
    got = sorted(map(tuple, changes.consecutive(df, ["who"], ["year", "id"], "id", "text").collect()))
    assert got == [(1, 3, "x", "y"), (3, 2, "y", None), (5, 6, "n", "m")]
    assert changes.compared(changes.consecutive(df.limit(0), ["who"], ["year"], "id", "text"), "old", "new").count() == 0


def test_a_text_is_cut_once(spark):
    """However many steps a script has, the earlier text is cut into tokens once a row, outside of the step."""
    from pyspark.sql import functions as F

    old, new = "a b c d e f g", "a x c y e z g"
    rows = spark.createDataFrame([(old, new), (None, "x"), ("y", None)], "old string, new string")
    told = changes.compared(rows, "old", "new")
    out = told.select("new", changes.rebuilt(F.col("old"), F.col("script")).alias("again"))
    assert all(r["again"] == (r["new"] or "") for r in out.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.index("regexp_extract_all") < plan.index("aggregate(")


def test_paths_are_sought_among_common_tokens(monkeypatch):
    """Tokens of one side only need no search, and scripts stay shortest."""
    a, b = list("a1b2c3d4e"), list("a5b6c7d8e9")
    rng = random.Random(3)
    for _ in range(300):
        x, y = ([rng.choice("abcdefgh"[k:][:5]) for _ in range(rng.randrange(14))] for k in (0, 3))
        runs = changes.blocks(x, y)
        assert all(x[i : i + n] == y[j : j + n] for i, j, n in runs)
        assert all(p[0] + p[2] <= q[0] and p[1] + p[2] <= q[1] for p, q in zip(runs, runs[1:]))
        assert len(x) + len(y) - 2 * sum(n for *_, n in runs) == least(x, y)
    monkeypatch.setattr(changes, "_middle", None)
    assert changes.blocks(a, b) == [(i, i, 1) for i in (0, 2, 4, 6, 8)]
