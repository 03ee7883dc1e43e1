"""The stored index against scanning every text."""

import random
import re
from collections import Counter, defaultdict

import pytest

from yearloom.operators import inverted
from yearloom.operators.inverted import All, Any, Index, Not, Phrase, Prefix, Term
from yearloom.plans.extraction import index as index_of
from yearloom.sources import storage

WORDS = ["oil", "gas", "oils", "o", "coal", "cöal", "a1", "the", "of", "thé"]
PLAIN = str.maketrans("öé", "oe")
QUERIES = [
    Term("oil"), Term("none"), Prefix("oi"), Prefix("o"), Prefix(""), Phrase(("oil", "of")), Phrase(("the", "the")), Phrase(("gas",)), Phrase(("of", "the", "oil")),
    All((Term("oil"), Not(Term("gas")))), Any((Phrase(("coal", "oil")), Prefix("a"))), All((Any((Term("gas"), Term("coal"))), Not(Any((Prefix("th"), Phrase(("oil", "oil"))))))),
]


def terms_of(text):
    return [t.translate(PLAIN) for t in re.findall(r"\w+", (text or "").lower())]


def fits(x, terms):
    match x:
        case Term(word):
            return word in terms
        case Prefix(start):
            return any(t.startswith(start) for t in terms)
        case Phrase(words):
            return any(tuple(terms[i : i + len(words)]) == words for i in range(len(terms)))
        case All(parts):
            return all(fits(p, terms) for p in parts)
        case Any(parts):
            return any(fits(p, terms) for p in parts)
        case Not(part):
            return not fits(part, terms)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(7)
    found = {i: " ".join(r.choice(WORDS) + r.choice(["", ",", " -", "\n"]) for _ in range(r.randrange(1, 15))) for i in range(120)}
    return found | {500: None, 501: "", 502: "... !", 503: "oil " * 3000 + "of"}


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "id long, text string")


def held(index):
    return sorted(map(tuple, index.postings().collect())), sorted(map(tuple, index.lengths().collect()))


@pytest.mark.parametrize("query", QUERIES, ids=str)
def test_search(spark, texts, tmp_path_factory, query):
    folder = str(tmp_path_factory.getbasetemp() / "index")
    index = Index(spark, folder) if storage.exists(spark, folder) else Index.build(frame(spark, texts), "id", "text", folder)
    got = sorted(r["doc"] for r in index.search(query).collect())
    assert got == sorted(i for i, t in texts.items() if fits(query, terms_of(t)))


def test_only_the_buckets_of_the_words_are_read(spark, sf_dir):
    index = index_of(spark, sf_dir)

    def buckets(df):
        """Of the files that a search reads, the buckets; and its plan."""
        read = {re.search(r"bucket=(\d+)", f)[1] for f in df.select("_metadata.file_path").distinct().toPandas()["file_path"]}
        return read

    hits = index.hits(["license", "lice"])
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan) and "PushedFilters: [" in plan and "term" in plan.split("PushedFilters: [")[1].split("]")[0]
    for words, starts, most in ((["license"], [], 1), (["license", "the"], [], 2), ([], ["licen"], 1), (["the"], ["licen"], 2)):
        rows = index.hits(words, starts)
        assert rows.count() and rows.select("bucket").distinct().count() <= most
        scans = rows._jdf.queryExecution().executedPlan().collectLeaves()
        files = sum(scans.apply(i).selectedPartitions().totalNumberOfFiles() for i in range(scans.size()))
        assert files <= most
    assert index.hits([]).count() == 0


def test_segments_and_merge_equal_a_rebuild(spark, texts, tmp_path):
    r = random.Random(8)
    first = {i: t for i, t in texts.items() if i < 90}
    second = {i: t for i, t in texts.items() if i >= 60}
    changed = {i: " ".join(r.choice(WORDS) for _ in range(6)) for i in range(50, 70)} | {0: None}
    index = Index.build(frame(spark, first), "id", "text", str(tmp_path / "a"))
    index.add(frame(spark, second), "id", "text")
    index.add(frame(spark, changed), "id", "text")
    final = texts | changed
    whole = Index.build(frame(spark, final), "id", "text", str(tmp_path / "b"))
    assert len(index.segments()) == 3 and held(index) == held(whole)
    for query in QUERIES:
        assert sorted(r["doc"] for r in index.search(query).collect()) == sorted(i for i, t in final.items() if fits(query, terms_of(t)))
    score = lambda x: {r["doc"]: round(r["score"], 9) for r in x.bm25(["oil", "gas", "none"]).collect()}
    before = score(index)
    index.merge()
    assert len(index.segments()) == 1 and held(index) == held(whole) and before == score(index) == score(whole)


def test_terms_and_empty_tables(spark, texts, tmp_path):
    index = Index.build(frame(spark, texts), "id", "text", str(tmp_path / "a"))
    times, docs = Counter(), defaultdict(set)
    for i, t in texts.items():
        times.update(terms_of(t))
        for x in terms_of(t):
            docs[x].add(i)
    assert {r["term"]: (r["times"], r["docs"]) for r in index.terms().collect()} == {t: (n, len(docs[t])) for t, n in times.items()}
    none = Index.build(frame(spark, texts).limit(0), "id", "text", str(tmp_path / "b"))
    assert none.search(Term("oil")).count() == 0 and none.bm25(["oil"]).count() == 0 and none.terms().count() == 0
    none.add(frame(spark, texts), "id", "text")
    assert held(none) == held(index)


def test_a_failed_run_leaves_the_index(spark, texts, tmp_path):
    index = Index.build(frame(spark, texts), "id", "text", str(tmp_path / "a"))
    before = held(index)
    broken = frame(spark, texts).selectExpr("id", "CASE WHEN id = 77 THEN raise_error('lost') ELSE text END AS text")
    with pytest.raises(Exception, match="lost"):
        index.add(broken, "id", "text")
    assert index.segments() == [0] and held(index) == before
    index.add(frame(spark, {1: "gas"}), "id", "text")
    assert index.segments() == [0, 1] and held(index) != before


def test_postings_are_gathered_in_their_row(spark):
    """No aggregation or shuffle before the postings are dealt to buckets, and positions as they stand."""
    docs = spark.createDataFrame([(i, f"a b a {'c ' * i}") for i in range(70)] + [(70, None), (71, "")], "id long, text string")
    rows, lengths = inverted._postings(docs, "id", "text")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    got = {(r["term"], r["doc"]): (r["length"], r["positions"]) for r in rows.collect()}
    assert got["a", 69] == (72, [0, 2]) and got["c", 69] == (72, list(range(3, 72))) and ("c", 0) not in got and len(got) == 209
    assert {r["length"] for r in lengths.where("doc > 69").collect()} == {0}


def test_positions_are_read_for_phrases_only():
    asked = All((Term("a"), Not(Phrase(("b", "c"))), Any((Prefix("d"), Term("b")))))
    assert inverted._phrased(asked) == {"b", "c"} and inverted._phrased(All((Term("a"), Not(Term("b"))))) == set()
