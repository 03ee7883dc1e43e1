"""Fill-in-the-middle against cutting lists of lines, and exact round trips."""

import hashlib
import random
import re

import pytest

pytest.importorskip("yearloom.llm.queries")

from pyspark.sql import functions as F  # noqa: E402

from yearloom.llm import fill_middle  # noqa: E402
from yearloom.llm.queries import QUERIES  # noqa: E402

UNIT = re.compile("[^\n]*\n|[^\n]+")


def expected(doc_id, text, fim=100, spm=50):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def made(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = fill_middle.fill_in_middle(df, **options)
    df = df.withColumn("again", fill_middle.restored(F.col("output"), F.col("form")))
    return [tuple(r) for r in df.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "again").collect()]


def random_texts(n, seed):
    r = random.Random(seed)
    return [(i, "".join(r.choice("a\n\nbé\U0001f600\r<>PSM ") for _ in range(r.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64, fill_middle.CHUNK])
def test_chunks_of_any_size(spark, chunk):
    rows = random_texts(300, chunk)
    for doc_id, text, *out, again in made(spark, rows, chunk=chunk):
        assert tuple(out) == expected(doc_id, text) and again == text


def test_forms_by_share(spark):
    rows = [(i, f"line {i}\nand\nmore") for i in range(400)]
    for fim, spm in ((0, 50), (40, 0), (90, 100)):
        for doc_id, text, *out, again in made(spark, rows, fim_percent=fim, spm_percent=spm):
            assert tuple(out) == expected(doc_id, text, fim, spm) and again == text


def test_odd_rows(spark):
    long = "".join(f"é{i % 7}\n" * (i % 3) for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "no break"), (6, "a <P> b\nc"), (7, "<S>"), (8, "x<M>"), (9, "a<\nP>\n<S\n>"), (None, "null id\nb\n"), (10, long), (10, long), (11, "<\n<\n>\nP>"), (12, "x" * 200_000 + "\n" + "y" * 200_000)]
    for doc_id, text, *out, again in made(spark, rows):
        assert tuple(out) == expected(doc_id, text) and again == (text or "")


def test_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a\nb", 5, "x", 7)], "doc_id long, text string, N int, form string, _data int")
    got = fill_middle.fill_in_middle(df)
    assert got.columns == ["doc_id", "text", "_data", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert got.first()["n"] == 2
    assert fill_middle.fill_in_middle(df.limit(0)).count() == 0


def test_query_restores_every_text(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op12_fill_middle"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, form, p, m, out = expected(r["doc_id"], docs[r["doc_id"]])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, p, m)
        assert r["output_sha256"] == hashlib.sha256(out.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()
