"""Importance resampling against counting every feature by itself."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

pytest.importorskip("yearloom.llm.queries")

from pyspark.sql import functions as F  # noqa: E402

from yearloom.llm import importance  # noqa: E402

SCHEMA = "doc_id long, text string, RANK int, weight string, _bytes int"
UPPER = {i: i + 32 for i in range(65, 91)}


def features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def expected(docs, target, buckets=10_000, percent=25, least=20):
    """Rows by tables of all features."""
    s, t = Counter(), Counter()
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            counts.update(bucket(f, buckets) for f in features(x)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * all_s) / ((s[b] + 1) * all_t)))
    rows = []
    for i, x in docs:
        words, found = features(x)
        weight = sum(gain(bucket(f, buckets)) for f in found) // len(found) if found else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(words), len(found), weight, score, None])
    able = sorted((r for r in rows if r[0] is not None and r[1] >= least), key=lambda r: (-r[4], r[0], r[2], r[1]))
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_whole_table(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs = [(r["doc_id"], r["text"]) for r in read("documents").collect()]
    target = [r["text"] for r in read("benchmark").collect()]
    assert got(importance.resample(read("documents"), read("benchmark"))) == expected(docs, target)


def test_small_parts_walks_and_tries(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(importance, "WALK", 7)
    texts = ["A b. c-d É a1 a b", "", "x" * 600, " ".join("word%d" % (i % 50) for i in range(400)), "\x00a\x7fb c", "one"]
    for part in (1, 5, 64, 1 << 18):
        for x in texts:
            data = x.encode()
            assert [w for p in importance.words_of(data, part) for w in p] == [w.encode() for w in features(x)[0]]
    for most in (1, 3, 1000):
        trie, counted = importance.Trie(), 0
        for words, docs, last in importance.walks(((i, x.encode()) for i, x in enumerate(texts)), most):
            own, children, where, _ = trie.walk(words, docs, last)
            counted = counted + trie.counts(own, children, where, 97)
        sums = Counter(bucket(f, 97) for x in texts for f in features(x)[1])
        assert counted.tolist() == [sums[b] for b in range(97)]


def test_tries_that_start_anew(spark):
    texts = [(i, " ".join(f"w{(i * k) % 61}" for k in range(40))) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    whole = {r["bucket"]: r["n"] for r in importance.bucket_totals(df, "text", 101).collect()}
    assert {r["bucket"]: r["n"] for r in importance.bucket_totals(df, "text", 101, most=10).collect()} == whole
    gain = importance.gains(importance.bucket_totals(df, "text", 101), importance.bucket_totals(df.limit(3), "text", 101), 101)
    small, large = (sorted(map(tuple, importance.weighed(df, "text", gain, most).collect())) for most in (10, 1 << 19))
    assert small == large


def test_odd_rows_ties_and_clashing_names(spark):
    long = "lorem ipsum 7 " * 30_000
    rows = [(1, None), (2, ""), (3, " \t"), (None, "a null id " * 20), (4, long), (5, "twenty words " * 10), (5, "twenty words " * 10), (6, "twenty words " * 10), (7, "Ünïcode wörds " * 12)]
    df = spark.createDataFrame([(i, x, 1, "a", 2) for i, x in rows], SCHEMA)
    target = spark.createDataFrame([(1, "twenty lorem words"), (2, None)], "item_id long, text string")
    assert got(importance.resample(df, target)) == expected(rows, ["twenty lorem words", None])
    empty = importance.resample(df.limit(0), target)
    assert empty.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"] and empty.count() == 0
    assert got(importance.resample(df, target.limit(0))) == expected(rows, [])
    nothing = importance.resample(df.withColumn("text", F.lit(None).cast("string")), target)
    assert {(r["weight"], r["rank"]) for r in nothing.collect()} == {(0, None)}
