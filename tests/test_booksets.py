"""What books share: exactly, and by sketches within their deviation."""

from yearloom.operators import booksets


def test_exact_and_sketched(spark):
    data = {1990: range(0, 30_000), 1991: range(5_000, 33_000), 1993: range(40_000, 40_010), 1994: range(40_000, 40_010)}
    rows = [(book, f"word {i}") for book, words in data.items() for i in words]
    df = spark.createDataFrame([*rows, *rows[:100], (None, "x"), (1990, None)], "b int, w string").repartition(5)
    words = booksets.sets(df, "b", "w")
    pairs = booksets.followers(words)
    want = {(a, b): (len(set(data[a]) & set(data[b])), len(set(data[a]) - set(data[b])), len(set(data[b]) - set(data[a]))) for a, b in ((1990, 1991), (1991, 1993), (1993, 1994))}
    got = {(r["book"], r["next_book"]): (r["shared"], r["gone"], r["came"]) for r in booksets.exact(words, pairs).collect()}
    assert got == want
    for log_k in (9, 12):
        told = booksets.sketched(words, pairs, log_k).collect()
        assert len(told) == 3
        for r in told:
            for c, true in zip(("shared", "gone", "came"), want[r["book"], r["next_book"]]):
                assert abs(r[c] - true) <= 5 * r["deviation"] + 1, (log_k, r, c, true)
    assert max(r["deviation"] for r in told) < 600
    none = booksets.sets(df.limit(0), "b", "w")
    assert booksets.exact(none, booksets.followers(none)).count() == 0
