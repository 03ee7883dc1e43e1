"""MinHash near-dedup: an LSH forest proposes, full shingle sets decide.

A document is its set of distinct 5-word shingles; equal sets are one node.  Each of TREES trees sorts the nodes by a path
of DEPTH min-hash labels, and a node's neighbours in that order that share MIN_DEPTH labels at least are its candidates:
in a crowded region the nearest ones share longer prefixes, so depth adapts to the region.  The order is range-partitioned,
which splits crowded regions over tasks, and the seams are paired in a second small pass.

Candidates whose whole signatures agree in less than CLOSE are left out (the deviation is 0.04).  Those nearest are
confirmed on full sets first, then those that still lie in different components.

A region (the nodes that share MIN_DEPTH labels in a tree) of more nodes than the order pairs is crowded.  If it holds
several components then, its nodes are joined exactly: a pair alike enough shares one of the rarest shingles of either,
and the first they share stands early enough in both for the rest to make up the overlap that their sizes ask for.  So
texts with a passage in common that is too short to link them aren't paired through it.  Shingles of many nodes are
joined in blocks of some BLOCK nodes, and blocks of one component aren't held against each other.  Nodes that differ
only in which parts of one pool they hold have no rare shingles; their pairs are all made, which is exact but quadratic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .common import checkpoint
from .components import components

SHINGLE, PERCENT = 5, 75
TREES, DEPTH, MIN_DEPTH, REACH, CLOSE, NEAREST = 16, 8, 3, 2, 0.6, 3
WORDS_KEPT = 50_000
#: Nodes of a block, and counters of shingles by which rare ones are told from common ones (any order of them is exact).
BLOCK, COUNTERS = 256, 1 << 20
#: Pairs that a task gathers before it passes them on.
PAIRS = 1 << 17
_U = np.uint64
_RANDOM = np.random.default_rng(20240501)
_PLACES = (_RANDOM.integers(0, 1 << 63, SHINGLE, dtype=_U) << _U(1)) | _U(1)
_SHUFFLES = ((_RANDOM.integers(0, 1 << 63, TREES * DEPTH, dtype=_U) << _U(1)) | _U(1))[:, None]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(31))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(29))


class Shingler:
    """Sorted 64-bit hashes of a text's distinct shingles: A-Z lower-cased words between blanks."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), _U, len(words))
        if len(known) > WORDS_KEPT:
            known.clear()
        if not len(h):
            return h
        if len(h) < SHINGLE:
            return _mixed((h * _PLACES[: len(h)]).sum(keepdims=True, dtype=_U) + _U(len(h)))
        n = len(h) - SHINGLE + 1
        total = np.zeros(n, _U)
        for k in range(SHINGLE):
            total += h[k : k + n] * _PLACES[k]
        return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> bytes:
    """TREES * DEPTH labels of 16 bits, in an order that compares as bytes."""
    least = np.full(TREES * DEPTH, np.iinfo(_U).max, _U)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[None, at : at + 4096] * _SHUFFLES).min(1))
    return (_mixed(least) >> _U(48)).astype(">u2").tobytes()


def _signed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sets = [shingles(t) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([signature(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "same", "signature"],
                )

    rows = docs.select(F.col(doc_id).cast("long"), text)
    return rows.mapInArrow(run, "doc_id long, n_shingles long, same binary, signature binary")


def _neighbours(nodes: DataFrame) -> DataFrame:
    """(a, b), a < b, of nodes(node, signature) that are REACH apart at most in some tree and share MIN_DEPTH labels."""
    paths = [F.struct(F.lit(t).alias("tree"), F.substring("signature", 2 * DEPTH * t + 1, 2 * DEPTH).alias("path")) for t in range(TREES)]
    order = ["tree", "path", "node"]
    rows = nodes.select("node", F.explode(F.array(*paths)).alias("p")).select("p.tree", "p.path", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs inside a partition, and its first and last rows (where b is null)."""
        last: list[tuple] = []
        first = 0
        for batch in batches:
            own = list(zip(*(c.to_pylist() for c in batch.columns)))
            got = []
            for row in own:
                for other in last[-REACH:]:
                    if other[0] == row[0] and other[2] != row[2] and other[1][: 2 * MIN_DEPTH] == row[1][: 2 * MIN_DEPTH]:
                        got.append((min(row[2], other[2]), max(row[2], other[2]), None, None))
                if first < REACH:
                    got.append((row[2], None, row[0], row[1]))
                    first += 1
                last = [*last[-REACH + 1 :], row]
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got), kinds)], names=names)
        if last:
            got = [(r[2], None, r[0], r[1]) for r in last]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got), kinds)], names=names)

    kinds, names = [pa.int64(), pa.int64(), pa.int32(), pa.binary()], ["a", "b", "tree", "path"]
    found = checkpoint(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long, tree int, path binary")
    )
    # A few rows per partition of the sorted order.
    seams = found.where("b IS NULL").select("tree", "path", F.col("a").alias("node")).distinct()
    w = Window.partitionBy("tree", F.substring("path", 1, 2 * MIN_DEPTH)).orderBy("path", "node")
    near = F.array(*(F.lead("node", k).over(w) for k in range(1, REACH + 1)))
    seams = seams.withColumn("near", near).select("node", F.explode("near").alias("other")).where("node <> other")
    pairs = seams.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    return found.where("b IS NOT NULL").select("a", "b").union(pairs).distinct()


def _estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """pairs(a, b) with the share of equal labels, where it is CLOSE at least."""
    left, right = (nodes.select(F.col("node").alias(c), F.col("signature").alias(f"_{c}")) for c in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), ">u2").reshape(batch.num_rows, -1) for i in (2, 3))
                share = (x == y).mean(1)
                out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(share, pa.float64())], names=["a", "b", "share"])
                yield out.filter(pa.array(share >= CLOSE))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "_a", "_b")
    return joined.mapInArrow(run, "a long, b long, share double")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs(a, b) whose full sets(node, shingles) are similar enough."""
    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"_{c}")) for c in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                keep = []
                for x, y in zip(batch.column(2), batch.column(3)):
                    x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                    both = np.concatenate([x, y])
                    both.sort()
                    shared = int((both[1:] == both[:-1]).sum())
                    keep.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "_a", "_b")
    return joined.mapInArrow(run, "a long, b long")


def _placed(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """(region, node, label) for each region of nodes(node, signature); a node without links is a component of its own."""
    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    regions = [F.struct(F.lit(t).alias("tree"), F.substring("signature", 2 * DEPTH * t + 1, 2 * MIN_DEPTH).alias("path")) for t in range(TREES)]
    return named.select("node", "label", F.explode(F.array(*regions)).alias("region"))


def _in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of rows of one group, sorted by (token, left, right), that may be alike enough by their sizes."""

    def told(found: list[np.ndarray]) -> pa.RecordBatch:
        both = np.concatenate(found, 1) if found else np.zeros((2, 0), np.int64)
        both = both[:, np.lexsort(both)]
        new = np.ones(both.shape[1], bool)
        new[1:] = (both[:, 1:] != both[:, :-1]).any(0)
        return pa.RecordBatch.from_arrays([pa.array(c[new], pa.int64()) for c in both], names=["a", "b"])

    def pairs(columns: list[np.ndarray], starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """In parts of some PAIRS, so that crowded groups take no more memory than others."""
        node, label, size, most = columns[3:]
        group, at, d, got, n = np.cumsum(starts), np.arange(len(node)), 1, [], 0
        while True:
            at = at[at + d < len(node)]
            at = at[group[at] == group[at + d]]
            if not len(at):
                break
            to = at + d
            fits = (label[at] != label[to]) & (size[to] <= most[at]) & (size[at] <= most[to])
            got.append(np.stack([np.minimum(node[at], node[to])[fits], np.maximum(node[at], node[to])[fits]]))
            n += got[-1].shape[1]
            if n >= PAIRS:
                yield told(got)
                got, n = [], 0
            d += 1
        yield told(got)

    held = [np.zeros(0, np.int64)] * 7
    for batch in batches:
        if batch.num_rows:
            rows = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns)]
            starts = np.ones(len(rows[0]), bool)
            starts[1:] = np.any([c[1:] != c[:-1] for c in rows[:3]], axis=0)
            end = int(np.flatnonzero(starts)[-1])
            yield from pairs([c[:end] for c in rows], starts[:end])
            held = [c[end:] for c in rows]
    starts = np.zeros(len(held[0]), bool)
    yield from pairs(held, starts)


def _joined(sets: DataFrame) -> DataFrame:
    """Candidates (a, b) among sets(node, label, shingles): all pairs of different labels that are alike enough, and others."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for x in batch.column(0):
                np.add.at(counts, np.frombuffer(x.as_buffer(), _U) % _U(COUNTERS), 1)
        at = np.flatnonzero(counts)
        for k in range(0, len(at), 65536):
            part = at[k : k + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(counts[part], pa.int64())], names=["at", "n"])

    counts = np.zeros(COUNTERS, np.int64)
    # A row per counter at most, whatever the input.
    found = sets.select("shingles").mapInArrow(tally, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts[found.column("at").to_numpy()] = found.column("n").to_numpy()

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shingles, from the rarest on, that may be the first a node shares; most: the size of such a partner."""
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                out = []
                for node, label, x in zip(*whole.slice(start, 256).columns):
                    x = np.frombuffer(x.as_buffer(), _U)
                    n = len(x)
                    x = x[np.lexsort((x, counts[x % _U(COUNTERS)]))[: n * (100 - PERCENT) // 100 + 1]]
                    # Overlap in sizes n and m is PERCENT / (100 + PERCENT) * (n + m) at least, and n - i at most.
                    most = ((100 + PERCENT) * (n - np.arange(len(x))) - PERCENT * n) // PERCENT
                    same = np.ones(len(x), np.int64)
                    out.append((x.view(np.int64), node.as_py() * same, label.as_py() * same, n * same, most))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], names=["token", "node", "label", "size", "most"])

    rows = checkpoint(sets.mapInArrow(rarest, "token long, node long, label long, size long, most long"))
    # The smaller one of a pair has room for one of its own size.
    tokens = rows.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.max(F.col("most") >= F.col("size")).alias("open")
    )
    tokens = tokens.where("lo <> hi AND open").select("token", "n")
    rows = checkpoint(rows.join(tokens, "token"))
    few = rows.where(F.col("n") <= BLOCK).withColumns({"left": F.lit(0).cast("long"), "right": F.lit(0).cast("long")})
    many = rows.where(F.col("n") > BLOCK)
    own = many.groupBy("token", "label").agg(F.count(F.lit(1)).alias("own"))
    large = F.col("own") > BLOCK
    salt = F.when(large, F.pmod(F.xxhash64("node"), F.ceil(F.col("own") / BLOCK))).otherwise(F.pmod(F.xxhash64("label"), F.ceil(F.col("n") / BLOCK)))
    many = many.join(own, ["token", "label"]).withColumn("only", F.when(large, F.col("label")))
    many = checkpoint(many.withColumn("block", F.xxhash64(large, F.coalesce("only", F.lit(0).cast("long")), salt)))
    blocks = many.select("token", "block", "only").distinct()
    left, right = (blocks.select("token", F.col("block").alias(c), F.col("only").alias(f"_{c}")) for c in ("left", "right"))
    cells = left.join(right, "token").where("left <= right AND NOT coalesce(_left = _right, false)").select("token", "left", "right")
    ends = cells.withColumn("block", F.explode(F.array_distinct(F.array("left", "right"))))
    many = many.join(ends, ["token", "block"])
    columns = ["token", "left", "right", "node", "label", "size", "most"]
    placed = few.select(columns).union(many.select(columns)).repartition("token", "left", "right").sortWithinPartitions("token", "left", "right")
    return placed.mapInArrow(_in_groups, "a long, b long").distinct()


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs.

    A text of fewer words than a shingle has one shingle, the whole sequence; one without words (or null) has none and is
    linked with nothing.  Rows that share a doc_id, repeated ones among them, may be linked through either's text.  A row
    with a null doc_id keeps a null component and is kept.  A text may be of any length, an empty table gives an empty one.
    Other columns of docs are left out.
    """
    rows = checkpoint(_signed(docs, doc_id, text))
    usable = rows.where("doc_id IS NOT NULL AND same IS NOT NULL")
    nodes = checkpoint(usable.groupBy("same").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")))
    pairs = checkpoint(_estimated(_neighbours(nodes), nodes))
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sets = [shingles(t).tobytes() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    def shingled(wanted: DataFrame) -> DataFrame:
        texts = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text")).join(wanted, "node", "left_semi")
        return texts.mapInArrow(run, "node long, shingles binary")

    sets = checkpoint(shingled(asked))

    ends = pairs.select("a", "b", "share", F.col("a").alias("node")).union(pairs.select("a", "b", "share", "b"))
    # A node has no more candidates than TREES * REACH * 2.
    best = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("share"), "a", "b"))
    first = ends.withColumn("_n", best).where(F.col("_n") <= NEAREST).select("a", "b").distinct()
    links = checkpoint(_confirmed(first, sets))
    labels = components(links)
    tried = checkpoint(first)

    def apart(candidates: DataFrame) -> DataFrame:
        la, lb = (labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in "ab")
        named = candidates.join(la, "a", "left").join(lb, "b", "left")
        return named.withColumns({"la": F.coalesce("la", "a"), "lb": F.coalesce("lb", "b")}).where("la <> lb")

    def joined(new: DataFrame) -> DataFrame:
        """labels after new links between components."""
        merged = components(apart(new).select(F.col("la").alias("a"), F.col("lb").alias("b")))
        merged = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
        moved = labels.join(merged, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        # Labels, and nodes so far without links, have no row in labels.
        return checkpoint(moved.union(merged.select("label", "to")))

    rest = checkpoint(apart(pairs.select("a", "b")).select("a", "b"))
    new = checkpoint(_confirmed(rest, sets))
    tried = tried.union(rest)
    labels = joined(new)
    placed = _placed(nodes, labels)
    wide = placed.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    wide = wide.where((F.col("n") > REACH + 1) & (F.col("lo") != F.col("hi"))).select("region")
    crowd = checkpoint(placed.join(wide, "region", "left_semi").select("node", "label").distinct())
    if not crowd.isEmpty():
        sets = checkpoint(shingled(crowd))
        rest = checkpoint(_joined(sets.join(crowd, "node").select("node", "label", "shingles")).join(tried, ["a", "b"], "left_anti"))
        labels = joined(checkpoint(_confirmed(rest, sets)))

    result = rows.select("doc_id", "n_shingles", "same").join(nodes.select("same", "node"), "same", "left")
    result = result.join(labels, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "node", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
