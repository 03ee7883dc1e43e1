"""Substring dedup: suffix automata of reference shards find every passage that occurs anywhere else.

Holding each document against every shard of the corpus would cost the square of the input, so both are dealt by content:
of the 18-word grams in a window of 35 words, the one of least hash is its seed, and equal windows have equal seeds.  The
documents' stretches with one seed that occurs at least twice form a reference shard.  Its suffix automaton, with the
number of places of each state, is built where the shard lies, the stretches are streamed through it, and the windows
whose match has two places or more form the spans to remove.

A seed of over HOT places, a passage so common that its shard has no bound, is dealt on by all grams of a window instead
of the least one: each shard is then one window, whose number of places is a count that Spark adds up before it shuffles;
stretches that are the same throughout are counted as one.  Both ways give the same windows, for any HOT.

Documents with equal texts are settled by a count of texts; only one of them serves as reference.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, functions as F

from .common import appended, checkpoint, named_back, numbered, place

WINDOW, GRAM, HOT = 35, 18, 1000
WORDS_KEPT = 50_000
_U = np.uint64
_RANDOM = np.random.default_rng(20240502)
_PLACES = (_RANDOM.integers(0, 1 << 63, WINDOW, dtype=_U) << _U(1)) | _U(1)


def _hashes(words: np.ndarray, size: int) -> np.ndarray:
    n = len(words) - size + 1
    total = np.zeros(n, _U)
    for k in range(size):
        total += words[k : k + n] * _PLACES[k]
    total ^= total >> _U(31)
    total *= _U(0x94D049BB133111EB)
    return total ^ (total >> _U(29))


class Reader:
    """64-bit hashes of a text's words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words, known = (text or "").encode("utf-8", "surrogatepass").split(), self.known
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        out = np.fromiter(map(known.__getitem__, words), _U, len(words))
        if len(known) > WORDS_KEPT:
            known.clear()
        return out


def runs(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Seed, its place, and first and last window of each run of windows that share it (leftmost on ties)."""
    grams = _hashes(words, gram)
    place = sliding_window_view(grams, window - gram + 1).argmin(1) + np.arange(len(words) - window + 1)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    return grams[place[first]].astype(np.int64), place[first], first, last


def repeats(stretches: list[bytes], window: int) -> list[np.ndarray]:
    """For each of several different stretches (64-bit words), which of its windows also occur in another.

    One suffix automaton of all, in which each state counts its places.
    """
    following: list[dict[int, int]] = [{}]
    link, length, places = [-1], [0], [0]

    def split(p: int, c: int, q: int) -> int:
        clone = len(link)
        following.append(following[q].copy())
        link.append(link[q])
        length.append(length[p] + 1)
        places.append(0)
        link[q] = clone
        while p >= 0 and following[p].get(c) == q:
            following[p][c] = clone
            p = link[p]
        return clone

    texts = [np.frombuffer(s, np.uint64).tolist() for s in stretches]
    for text in texts:
        last = 0
        for c in text:
            q = following[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else split(last, c, q)
            else:
                new, p = len(link), last
                following.append({})
                link.append(0)
                length.append(length[last] + 1)
                places.append(0)
                while p >= 0 and c not in following[p]:
                    following[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = following[p][c]
                    link[new] = q if length[q] == length[p] + 1 else split(p, c, q)
                last = new
            places[last] += 1
    for v in sorted(range(1, len(link)), key=length.__getitem__, reverse=True):
        if link[v] > 0:
            places[link[v]] += places[v]
    out = []
    for text in texts:
        state, hits = 0, np.zeros(max(0, len(text) - window + 1), bool)
        for at, c in enumerate(text):
            state = following[state][c]
            while length[link[state]] >= window if state else False:
                state = link[state]
            if at >= window - 1:
                hits[at - window + 1] = places[state] > 1
        out.append(hits)
    return out


def digest(text: Column) -> Column:
    """16 bytes that stand for a text; never null, so that joins on it put no filter below the shuffle."""
    return F.coalesce(F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))), F.lit(bytearray(b"")))


def spans(docs: DataFrame, key: str, text: str, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(key, copied, spans): word spans of each row's text that occur elsewhere in another text or place; copied if the
    whole text does.  key identifies equal rows; equal texts may have several."""
    keys = docs.select(key, digest(F.col(text)).alias("same"))
    groups = keys.groupBy("same").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n"))
    flags = checkpoint(keys.distinct().join(groups, "same").select(key, (F.col("n") > 1).alias("copied"), (F.col("first") == F.col(key)).alias("serves")))

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found_keys, found_seeds, found_places = [], [], []
                for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words = read(t)
                    if len(words) >= window:
                        s, p, *_ = runs(words, window, gram)
                        twin = xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"))
                        found_keys += [k] * len(s)
                        found_seeds.append(s)
                        place = p.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(twin)
                        found_places.append((place * _U(0xD6E8FEB86659FD93)).astype(np.int64))
                if found_keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found_keys, pa.binary()), pa.array(np.concatenate(found_seeds)), pa.array(np.concatenate(found_places))], names=["key", "seed", "place"]
                    )

    marks = checkpoint(docs.select(key, text).mapInArrow(seeds, "key binary, seed long, place long"))
    shared = marks.groupBy("seed").agg(F.min("place").alias("a"), F.max("place").alias("b"), F.count(F.lit(1)).alias("n")).where("a <> b")
    # A copy of its own, so that the join below is free to split a common seed.
    shared = checkpoint(shared.select("seed", (F.col("n") > hot).alias("hot")))
    lists = marks.select("key", "seed").join(shared, "seed").groupBy("key").agg(F.collect_set(F.struct("seed", "hot")).alias("seeds"))
    lists = checkpoint(lists.join(flags.where("serves").select(F.col(key).alias("key")), "key", "left_semi"))

    # All columns go along, so that these joins and the caller's share one shuffle of the texts.
    spots = [docs.columns.index(key), docs.columns.index(text), len(docs.columns) + 1]

    def wanted(batches: Iterator[pa.RecordBatch], hot: bool) -> Iterator[tuple[bytes, np.ndarray, int, int, int, int]]:
        """Key, words, seed, its place, first and last window of the runs with a shared seed, hot or not."""
        read = Reader()
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                for k, t, asked in zip(*(batch.column(i).to_pylist() for i in spots)):
                    own = {x["seed"] for x in asked if x["hot"] == hot}
                    if own:
                        words = read(t)
                        for run in zip(*(x.tolist() for x in runs(words, window, gram))):
                            if run[0] in own:
                                yield (k, words, *run)

    def tables(rows: Iterator[tuple], names: tuple[str, ...], kinds: tuple, size: int) -> Iterator[pa.RecordBatch]:
        while part := list(islice(rows, size)):
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*part), kinds)], names=list(names))

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of a stretch without those of its seed, which are the same all over the shard, and where these stood."""

        def of() -> Iterator[tuple]:
            for k, words, s, p, a, b in wanted(batches, False):
                yield s, k, a, p - a, np.concatenate([words[a:p], words[p + gram : b + window]]).tobytes()

        return tables(of(), ("route", "key", "start", "lead", "words"), (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary()), 5000)

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of() -> Iterator[tuple]:
            last, hashes = None, None
            for k, words, _, _, a, b in wanted(batches, True):
                if last is not words:
                    last, hashes = words, _hashes(words, window).astype(np.int64)
                yield k, a, hashes[a : b + 1]

        return tables(of(), ("key", "start", "windows"), (pa.binary(), pa.int32(), pa.list_(pa.int64())), 5000)

    def dealt(only_hot: bool) -> DataFrame:
        of = lists.where(F.exists("seeds", lambda x: x["hot"] == F.lit(only_hot)))
        return docs.join(of, F.col(key) == F.col("key"))

    shards = dealt(False).mapInArrow(stretches, "route long, key binary, start int, lead int, words binary")
    shards = shards.repartition("route").sortWithinPartitions("route", "lead", "words")
    # No two words hash to these but by chance, as to any other.
    middle = np.arange(gram, dtype=_U) + _U(0xFFFFFFFFFFFF0000)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(shard: dict[bytes, list[tuple[bytes, int]]]) -> Iterator[tuple]:
            hits = repeats(list(shard), window) if len(shard) > 1 else [None]
            for (words, where), hit in zip(shard.items(), hits):
                if len(where) > 1:
                    for k, start in where:
                        yield k, start, start + len(words) // 8
                elif hit is not None:
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]]).astype(np.int8)))
                    for k, start in where:
                        for a, b in zip(edges[::2], edges[1::2]):
                            yield k, start + int(a), start + int(b) - 1 + window

        def of() -> Iterator[tuple]:
            route, shard = None, {}
            for batch in batches:
                for r, k, start, lead, words in zip(*(c.to_pylist() for c in batch.columns)):
                    if r != route:
                        yield from settled(shard)
                        route, shard = r, {}
                    whole = words[: 8 * lead] + middle.tobytes() + words[8 * lead :]
                    shard.setdefault(whole, []).append((k, start))
            yield from settled(shard)

        return tables(of(), ("key", "a", "b"), (pa.binary(), pa.int32(), pa.int32()), 20_000)

    told = shards.mapInArrow(matched, "key binary, a int, b int")
    if not shared.where("hot").isEmpty():
        # Stretches that are the same throughout count at once; only the others are looked at window by window.
        placed = dealt(True).mapInArrow(passages, "key binary, start int, windows array<long>").withColumn("same_run", F.xxhash64("windows"))
        placed = checkpoint(placed)
        kinds = checkpoint(placed.groupBy("same_run").agg(F.count(F.lit(1)).alias("n"), F.first("windows").alias("windows")))
        often = kinds.select("n", F.explode("windows").alias("w")).groupBy("w").agg(F.sum("n").alias("n")).where("n > 1").select("w")
        again = checkpoint(kinds.where("n > 1").select("same_run"))
        whole = placed.join(again, "same_run").select("key", F.col("start").alias("a"), (F.col("start") + F.size("windows") - 1 + window).alias("b"))
        lone = placed.join(again, "same_run", "left_anti").select("key", "start", F.posexplode("windows").alias("at", "w"))
        found = lone.join(checkpoint(often), "w").select("key", (F.col("start") + F.col("at")).alias("a"), (F.col("start") + F.col("at") + window).alias("b"))
        told = told.union(whole).union(found)
    told = told.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    return flags.select(F.col(key).alias("key"), "copied").join(told, "key", "left")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """docs with n_words, n_removed and kept_text: the words outside all removed spans, joined by one space.

    A word is removed if some window of consecutive words that holds it also starts anywhere else, in the same document or
    another; windows are judged on the input.  A null text has no words; a text shorter than a window keeps all its words;
    rows equal throughout count as copies of one another.  A text may be of any length; an empty table gives an empty one.
    Columns of these names are replaced, others keep theirs.
    """
    key, inner, own_text = "_key", numbered(docs), place(docs, text)
    given = F.concat(F.coalesce(F.col(place(docs, doc_id)).cast("string"), F.lit("-")), F.lit(" "), F.coalesce(F.col(own_text), F.lit("")))
    keyed = inner.withColumn(key, digest(given))
    found = spans(keyed, key, own_text, window, gram, hot)
    joined = keyed.join(found.select(F.col("key").alias("_found"), F.struct("copied", "spans").alias("_cuts")), F.col(key) == F.col("_found"), "left")

    def start():
        def call(texts, cuts):
            sizes, gone, kept = [], [], []
            for t, cut in zip(texts, cuts):
                words = (t or "").encode("utf-8", "surrogatepass").split()
                sizes.append(len(words))
                if cut["copied"] and len(words) >= window:
                    left = []
                else:
                    left, at = [], 0
                    for a, b in sorted((c["a"], c["b"]) for c in cut["spans"] or ()):
                        if a > at:
                            left += words[at:a]
                        at = max(at, b)
                    left += words[at:]
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
            return [sizes, gone, kept]

        return call

    out = appended(joined, "n_words long, n_removed long, kept_text string", start, own_text, "_cuts")
    return named_back(out, docs.columns, ("n_words", "n_removed", "kept_text"))
