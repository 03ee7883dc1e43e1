"""Dictionary files: written, read back whole and in parts, and by the letter of their format."""

import gzip
import random
import struct

import pytest

from yearloom.sources import sinks, stardict

BOOKS = [
    ("de/1990 é", ["Zebra", "zz"], "one\nline"), ("de/1990 é", ["apple", "Äpfel", "AA"], "two é"), ("en1990", ["only"], ""), ("en1990", ["beta", "only too"], "x" * 200_000),
    ("en1990", ["Beta", "only"], None), ("en1990", ["beta"], "again"), ("en1990", [], "lost"), ("en1990", None, "lost"),
]
SCHEMA = "book string, headwords array<string>, body string"


def held(df):
    return sorted((r["book"], r["headwords"][0], tuple(sorted(r["headwords"][1:])), r["body"]) for r in df.collect())


def want(rows):
    return sorted((b, w[0], tuple(sorted(w[1:])), t or "") for b, w, t in rows if w)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(BOOKS, SCHEMA)
    told = {r["book"]: r["entries"] for r in sinks.dictionary(df, str(tmp_path)).collect()}
    assert told == {"de/1990 é": 2, "en1990": 4}
    back = stardict.read(spark, str(tmp_path))
    assert held(back) == want(BOOKS)
    assert held(stardict.read(spark, str(tmp_path), "en1990")) == want([b for b in BOOKS if b[0] == "en1990"])
    words = [r["headwords"][0] for r in back.where("book = 'en1990'").orderBy("n").collect()]
    assert words == ["Beta", "beta", "beta", "only"]
    expected = spark.createDataFrame([("de/1990 é",), ("en1990",), ("fr1990",)], "book string")
    assert [r["book"] for r in sinks.missing_books(expected, str(tmp_path)).collect()] == ["fr1990"]


def test_files_by_their_format(spark, tmp_path):
    stardict.write(spark.createDataFrame(BOOKS[:2], SCHEMA), str(tmp_path))
    stem = str(tmp_path / "de%2F1990%20%C3%A9")
    ifo = open(stem + ".ifo", encoding="utf-8").read().split("\n")
    assert ifo[0] == "StarDict's dict ifo file" and {"bookname=de/1990 é", "wordcount=2", "synwordcount=3", "idxfilesize=28"} <= set(ifo)
    bodies = gzip.open(stem + ".dict.dz").read()
    assert bodies == "two é".encode() + b"one\nline"
    assert open(stem + ".idx", "rb").read() == b"apple\0" + struct.pack(">II", 0, 6) + b"Zebra\0" + struct.pack(">II", 6, 8)
    assert open(stem + ".syn", "rb").read() == b"AA\0" + struct.pack(">I", 0) + b"zz\0" + struct.pack(">I", 1) + "Äpfel\0".encode() + struct.pack(">I", 0)


def test_a_book_splits_over_tasks(spark, tmp_path):
    r = random.Random(3)
    rows = [("big", [f"w{i:05}", f"also {i}"], "".join(r.choice("abcdefgh ") for _ in range(r.randrange(3000)))) for i in range(900)]
    stardict.write(spark.createDataFrame(rows, SCHEMA), str(tmp_path))
    parts = stardict.read(spark, str(tmp_path), split=100_000)
    assert parts.rdd.getNumPartitions() > 8 and held(parts) == want(rows)
    text, chunks = stardict.body_at(str(tmp_path), "big", 450)
    assert text == rows[450][2] and chunks <= 2
    assert gzip.open(tmp_path / "big.dict.dz").read() == "".join(x[2] for x in rows).encode()


def test_commits(spark, tmp_path):
    folder = str(tmp_path / "books")
    stardict.write(spark.createDataFrame(BOOKS, SCHEMA), folder)
    before = held(stardict.read(spark, folder))
    broken = spark.createDataFrame(BOOKS, SCHEMA).selectExpr("book", "headwords", "CASE WHEN body = 'again' THEN raise_error('lost') ELSE body END AS body")
    with pytest.raises(Exception):
        stardict.write(broken, folder)
    assert held(stardict.read(spark, folder)) == before and not [p for p in (tmp_path / "books").iterdir() if p.name.startswith("_new")]
    more = [("fr1990", ["un"], "deux"), ("en1990", ["new"], "book")]
    stardict.write(spark.createDataFrame(more, SCHEMA), folder, mode="append")
    assert held(stardict.read(spark, folder)) == want([b for b in BOOKS if b[0] != "en1990"] + more)
    stardict.write(spark.createDataFrame(more[:1], SCHEMA), folder)
    assert held(stardict.read(spark, folder)) == want(more[:1]) and len(list((tmp_path / "books").iterdir())) == 4


def test_no_books(spark, tmp_path):
    stardict.write(spark.createDataFrame([], SCHEMA), str(tmp_path))
    assert stardict.read(spark, str(tmp_path)).count() == 0 and stardict.books(spark, str(tmp_path)).count() == 0


def test_from_another_thread(spark, tmp_path):
    """A thread of the caller's own has no active session, by which formats are looked up."""
    from concurrent.futures import ThreadPoolExecutor

    def turn(k):
        stardict.write(spark.createDataFrame(BOOKS, SCHEMA), str(tmp_path / str(k)))
        return held(stardict.read(spark, str(tmp_path / str(k))))

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(turn, range(2))) == [want(BOOKS)] * 2
