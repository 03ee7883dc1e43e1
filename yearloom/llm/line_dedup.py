"""Line dedup: templates of lines from a fixed-depth tree; those that recur across documents are dropped.

A line's leaf is its number of tokens and its first DEPTH tokens, tokens with digits counting as variable; a shorter line
is its leaf.  A leaf holds as many templates as it has kinds of lines.  The support of a token at its place is the number
of the leaf's distinct lines that have it there; a line keeps its best supported tokens, MIN_CONSTANT % of all at least
(and all as well supported as the last of these), and its other places are variable.  Lines that keep the same share a
template: of N lines that differ in few places, each keeps what all N have, whatever other kinds lie in the leaf.

A template recurs if lines of it stand in MIN_DOCS documents that aren't copies of one another, however many copies there
are.  Documents are told apart by what they hold beside the lines of the leaf in question: SKETCHES least hashes of its
32-byte windows, at least one of which copies and near copies almost surely share.  A document counts if it shares none
with a holder of lower doc_id; so a group of copies counts once, and doesn't lose its text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import appended, checkpoint, named_back, numbered, place

DEPTH, MIN_DOCS = 3, 5
#: Of a hundred tokens of a template so many at least are constant.
MIN_CONSTANT = 70
WINDOW, SKETCHES = 32, 4
_MIXERS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
DIGIT = re.compile(r"\d")
FIELD = re.compile(r"\S*\d\S*")
VARIABLE = "<*>"


def _long(data: bytes | str) -> int:
    return xxhash.xxh64_intdigest(data) - (1 << 63)


def sketches(lines: list[str]) -> np.ndarray:
    """Per line, SKETCHES least hashes of its windows of WINDOW bytes; of the whole line if it is shorter."""
    parts = [x.encode("utf-8", "replace").ljust(WINDOW, b"\n") for x in lines]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    h, step, base = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64), 1, 0x9E3779B97F4A7C15
    while step < WINDOW:
        h = h[:-step] * np.uint64(base) + h[step:]
        base, step = base * base % (1 << 64), step * 2
    h ^= h >> np.uint64(29)
    starts = np.cumsum(sizes) - sizes
    # Windows that run over a line's end belong to none.
    bounds = np.stack([starts, starts + sizes - WINDOW + 1], 1).ravel()
    least = []
    for m in _MIXERS:
        x = h * m
        x ^= x >> np.uint64(32)
        least.append(np.minimum.reduceat(np.append(x, np.uint64(0)), bounds)[::2])
    return np.stack(least, 1)


def beside(lines: list[str], leaves: list[int | None]) -> dict[int, list[int]]:
    """Per leaf, the sketches of the lines that aren't of it; of all lines if there are no others."""
    own = sketches(lines)
    codes: dict[int | None, int] = {}
    at = np.array([codes.setdefault(x, len(codes)) for x in leaves])
    least = np.full((len(codes), SKETCHES), np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, at, own)
    if len(codes) == 1:
        return {x: least[0].view(np.int64).tolist() for x in codes if x is not None}
    first = least.argmin(0)
    two = np.partition(least, 1, 0)[:2]
    rest = np.where(np.arange(len(codes))[:, None] == first, two[1], two[0]).view(np.int64).tolist()
    return {x: rest[k] for x, k in codes.items() if x is not None}


def parse(line: str) -> tuple[int, int, list[str]] | None:
    """Leaf, line and tokens, variable ones masked; None for a line without tokens."""
    if DIGIT.search(line):
        line = FIELD.sub(VARIABLE, line)
    tokens = line.split()
    if not tokens:
        return None
    return _long(f"{len(tokens)} {' '.join(tokens[:DEPTH])}"), _long(" ".join(tokens)), tokens


def recurring(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, line) of each line whose template recurs; line is the hash that parse() gives."""
    rows = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                out: list[tuple[int, int]] = []
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    found = {p[0] for line in set(t.split("\n")) if (p := parse(line))}
                    out += [(i, leaf) for leaf in found]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "leaf"])

    pairs = checkpoint(rows.mapInArrow(leaves, "doc_id long, leaf long"))
    often = checkpoint(pairs.groupBy("leaf").count().where(F.col("count") >= min_docs).select("leaf"))
    asked = pairs.join(often, "leaf", "left_semi").groupBy("doc_id").agg(F.collect_set("leaf").alias("leaves"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                out = []
                for i, wanted, t in zip(*(c.to_pylist() for c in batch.columns)):
                    wanted = set(wanted)
                    own = list(set(t.split("\n")))
                    parsed = [parse(line) for line in own]
                    apart = beside(own, [p and p[0] for p in parsed])
                    seen = {p[1]: p for p in parsed if p and p[0] in wanted}
                    out += [(i, apart[leaf], leaf, line, [xxhash.xxh32_intdigest(x) for x in tokens]) for leaf, line, tokens in seen.values()]
                if out:
                    kinds = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "apart", "leaf", "line", "tokens"])

    joined = asked.join(rows, "doc_id").select("doc_id", "leaves", "text")
    found = checkpoint(joined.mapInArrow(lines, "doc_id long, apart array<long>, leaf long, line long, tokens array<long>"))
    distinct = checkpoint(found.groupBy("leaf", "line").agg(F.first("tokens").alias("tokens")))
    # The first DEPTH tokens are the leaf's.
    spots = distinct.select("leaf", "line", F.posexplode("tokens").alias("place", "token")).where(F.col("place") >= DEPTH)
    support = spots.groupBy("leaf", "place", "token").agg(F.count(F.lit(1)).alias("support")).where("support > 1")
    # Copies of their own, here and below, so that the joins are free to split a common token, line or template.
    support = checkpoint(support)
    spots = spots.join(support, ["leaf", "place", "token"], "left").select("leaf", "line", F.struct("place", "token", F.coalesce("support", F.lit(1)).alias("support")).alias("spot"))
    kept = spots.groupBy("leaf", "line").agg(F.collect_list("spot").alias("spots"))
    n = F.size("spots") + DEPTH
    most = F.sort_array(F.transform("spots", lambda x: x["support"]), asc=False)
    # A line of few tokens may need none beyond its leaf's.
    bar = F.coalesce(F.get(most, F.ceil(n * MIN_CONSTANT / 100).cast("int") - DEPTH - 1), F.lit(1 << 62))
    constant = F.array_sort(F.transform(F.filter("spots", lambda x: x["support"] >= F.col("bar")), lambda x: F.struct(x["place"], x["token"])))
    kept = kept.withColumn("bar", bar).select("leaf", "line", F.xxhash64("leaf", constant).alias("template"))
    short = distinct.where(F.size("tokens") <= DEPTH).select("leaf", "line", F.col("leaf").alias("template"))
    named = checkpoint(kept.union(short))
    placed = checkpoint(found.select("doc_id", "apart", "leaf", "line").join(named, ["leaf", "line"]).select("doc_id", "apart", "line", "template"))
    least = placed.select("template", "doc_id", F.posexplode("apart").alias("k", "sketch")).groupBy("template", "k", "sketch").agg(F.min("doc_id").alias("doc_id"))
    # Of a document that shares no sketch with one of lower doc_id, each sketch is its own.
    heads = least.groupBy("template", "doc_id").agg(F.count_distinct("k").alias("n")).where(F.col("n") == SKETCHES)
    spread = checkpoint(heads.groupBy("template").count().where(F.col("count") >= min_docs).select("template"))
    return placed.join(spread, "template", "left_semi").select("doc_id", "line").distinct()


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with the lines of recurring templates taken out of text, n_lines and n_dropped.

    Lines end at a line feed.  A blank line stays, as do texts of rows with a null doc_id and null texts.  A document all of
    whose lines recur keeps an empty text.  Rows that share a doc_id, repeated ones among them, count as one document and
    lose what recurs in either.  An empty table gives an empty one; a text may be of any length and number of lines.
    Columns n_lines and n_dropped of docs are replaced; others keep their names, whatever they are.
    """
    inner, own_id, own_text = numbered(docs), place(docs, doc_id), place(docs, text)
    dropped = recurring(inner, own_id, own_text, min_docs).groupBy("doc_id").agg(F.collect_set("line").alias("_dropped"))
    joined = inner.join(dropped, F.col(own_id).cast("long") == F.col("doc_id"), "left").drop("doc_id")

    def start():
        def call(texts, drops):
            kept, lines, gone = [], [], []
            for t, d in zip(texts, drops):
                parts = [] if t is None else t.split("\n")
                if d:
                    d = set(d)
                    left = [x for x in parts if not ((p := parse(x)) and p[1] in d)]
                    t = "\n".join(left)
                else:
                    left = parts
                kept.append(t)
                lines.append(len(parts))
                gone.append(len(parts) - len(left))
            return [kept, lines, gone]

        return call

    out = appended(joined, f"{own_text} string, n_lines long, n_dropped long", start, own_text, "_dropped")
    return named_back(out, docs.columns, ("n_lines", "n_dropped"))
