"""Importance resampling towards a target distribution by hashed word features.

A task keeps a trie of the words it meets: a node of depth one is a word, its children are the words that follow it.  A
node holds how often it was walked and the CRC of its words so far; that of a child follows from its parent's, since
appending n bytes is a linear map of the state that depends on n alone.  Children are laid out as arrays sorted by path
and given up after a walk of some WALK words, words when there are WORDS of them; counts go to the totals of their
buckets, and partitions' totals are merged by Spark.  What reaches the driver is a count for each bucket.  The second pass
walks the same paths with a gain attached to each node, and a document's weight is the floored mean along its paths.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpoint, fresh, ranked

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Words that a trie keeps, words of one walk, and bytes of a text that are parted at a time.
WORDS, WALK, PART = 1 << 19, 1 << 17, 1 << 18
#: Bytes of words: digits, a-z (A-Z are lower-cased) and all beyond ASCII; others part words.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes, part: int = PART) -> Iterator[list[bytes]]:
    """The words of a text, in lists of some part bytes each."""
    at = 0
    while at < len(text):
        end = at + part
        if end < len(text):
            # On to the end of a word.
            piece = text[at:end].translate(LETTERS)
            while end < len(text) and piece[-1:] != b" ":
                more = text[end : end + 256].translate(LETTERS)
                stop = more.find(b" ") + 1 or len(more)
                piece, end = piece + more[:stop], end + stop
        else:
            piece = text[at:].translate(LETTERS)
        yield piece.split()
        at = end


def _appending() -> np.ndarray:
    """For k = 0, 1, ... what appending 2**k bytes of zero makes of each byte of a state."""
    states = np.arange(256, dtype=np.int64)[None] << 8 * np.arange(4)[:, None]
    table = np.array([[zlib.crc32(b"\0", x) ^ zlib.crc32(b"\0", 0) for x in row] for row in states.tolist()])
    tables = [table]
    for _ in range(31):
        tables.append(_mapped(tables[-1], tables[-1]))
    return np.array(tables)


def _mapped(table: np.ndarray, states: np.ndarray) -> np.ndarray:
    return table[0][states & 255] ^ table[1][states >> 8 & 255] ^ table[2][states >> 16 & 255] ^ table[3][states >> 24]


class Trie:
    """Words, numbered as they come, and the pairs of a walk."""

    def __init__(self):
        trie = self

        class Roots(dict):
            def __missing__(self, word: bytes) -> int:
                self[word] = number = len(self)
                trie.new.append((zlib.crc32(word), zlib.crc32(b" " + word), len(word) + 1))
                return number

        self.roots, self.appending = Roots(), _appending()
        self.new: list[tuple[int, int, int]] = []
        #: Of each word the CRC, that of a blank and the word, and the bytes of these.
        self.state, self.spaced, self.size = (np.zeros(0, np.int64) for _ in range(3))

    def _kept(self) -> None:
        if self.new:
            new = np.array(self.new, np.int64).T
            self.state, self.spaced, self.size = (np.concatenate([a, b]) for a, b in zip((self.state, self.spaced, self.size), new))
            self.new = []

    def walk(self, words: list[bytes], docs: np.ndarray, last: tuple[bytes, int] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(own, children, where, at): the numbers of the words, the states of the distinct pairs, and for each pair of the
        walk which of these it is and the place of its second word.  docs has each word's document, last the word before
        these and its document."""
        own = np.fromiter(map(self.roots.__getitem__, words), np.int64, len(words))
        before = np.empty_like(own)
        before[1:] = own[:-1]
        same = np.zeros(len(own), bool)
        same[1:] = docs[1:] == docs[:-1]
        if last is not None and last[1] == docs[0]:
            before[0], same[0] = self.roots[last[0]], True
        self._kept()
        at = np.flatnonzero(same)
        paths, where = np.unique(before[at] << 32 | own[at], return_inverse=True)
        parents, ends = paths >> 32, paths & 0xFFFFFFFF
        children, size = self.state[parents], self.size[ends]
        for k in range(int(size.max(initial=0)).bit_length()):
            due = size >> k & 1 == 1
            children[due] = _mapped(self.appending[k], children[due])
        return own, children ^ self.spaced[ends], where, at

    def counts(self, own: np.ndarray, children: np.ndarray, where: np.ndarray, buckets: int) -> np.ndarray:
        """How often nodes of each bucket were walked."""
        out = np.zeros(buckets, np.int64)
        np.add.at(out, self.state % buckets, np.bincount(own, minlength=len(self.state)))
        np.add.at(out, children % buckets, np.bincount(where, minlength=len(children)))
        return out


def walks(texts: Iterator[tuple[int, bytes]], most: int = WALK) -> Iterator[tuple[list[bytes], np.ndarray, tuple[bytes, int] | None]]:
    """(words, their documents, what stands before) of some WALK words each, whatever the length of a text."""
    words: list[bytes] = []
    docs: list[np.ndarray] = []
    last = None
    for doc, text in texts:
        for part in words_of(text):
            words += part
            docs.append(np.full(len(part), doc))
            if len(words) >= most:
                yield words, np.concatenate(docs), last
                last, words, docs = (words[-1], doc), [], []
    if words:
        yield words, np.concatenate(docs), last


def bucket_totals(df: DataFrame, text: str, buckets: int = BUCKETS, most: int = WORDS) -> DataFrame:
    """(bucket, n): how many features of all texts fall in a bucket, buckets without any left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, sums = Trie(), np.zeros(buckets, np.int64)
        for batch in batches:
            for words, docs, last in walks(enumerate(batch.column(0).to_pylist())):
                own, children, where, _ = trie.walk(words, docs, last)
                sums += trie.counts(own, children, where, buckets)
                if len(trie.roots) >= most:
                    trie = Trie()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["bucket", "n"])

    told = df.where(F.col(text).isNotNull()).select(F.col(text).cast("binary")).mapInArrow(run, "bucket long, n long")
    return told.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain: 1000 times the logarithm of its share in target over that in source, one added to each count."""

    def counts(totals: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for r in totals.collect():  # a row per bucket at most
            out[r["bucket"]] = r["n"]
        return out

    s, t = counts(source), counts(target)
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((float(b + 1) * all_s) / (float(a + 1) * all_t))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def weighed(df: DataFrame, text: str, gain: np.ndarray, most: int = WORDS) -> DataFrame:
    """df, its text left out, with n_words, n_features and weight."""
    buckets = len(gain)
    kept = [c for c in df.columns if c != text]
    spot = fresh(df, "_bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for batch in batches:
            n = batch.num_rows
            n_words, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
            texts = ((i, t) for i, t in enumerate(batch.column(len(kept)).to_pylist()) if t)
            for words, docs, last in walks(texts):
                own, children, where, at = trie.walk(words, docs, last)
                along = gain[trie.state % buckets][own]
                along[at] += gain[children % buckets][where]
                starts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
                total[docs[starts]] += np.add.reduceat(along, starts)
                n_words[docs[starts]] += np.diff(np.r_[starts, len(docs)])
                if len(trie.roots) >= most:
                    trie = Trie()
            features = np.maximum(2 * n_words - 1, 0)
            weight = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(n_words), pa.array(features), pa.array(weight)], names=[*kept, "n_words", "n_features", "weight"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text)
    return df.select(*kept, F.col(text).cast("binary").alias(spot)).mapInArrow(run, f"{ddl}, n_words long, n_features long, weight long")


def draw_key(doc_id: str, seed: int = SEED) -> Column:
    """A number below 2**32 that seed and id choose."""
    said = F.concat(F.lit(f"{seed}:"), F.col(doc_id).cast("string"))
    return F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1, 8), 16, 10).cast("long")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = BUCKETS,
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document: percent of those with least_words words are
    drawn without replacement, by weights perturbed with Gumbel noise of the id; rank is null for the others.

    A null or empty text has no features and weight 0.  A null doc_id has no score and is never drawn, nor counted among
    those to draw from.  Ties of score go to the smaller doc_id; rows that share a doc_id are told apart by their weights
    and may both be drawn, equal rows stand in any order.  Texts may be of any length.  An empty table has no rows, an
    empty target leaves its counts at 0.  Other columns of docs are left out.
    """
    gain = gains(bucket_totals(docs, text, buckets), bucket_totals(target, target_text, buckets), buckets)
    rows = weighed(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "text", gain)
    noise = F.floor(-1000 * F.log(-F.log((draw_key("doc_id", seed) + 0.5) / 4294967296)))
    # Ranges are sampled, so the texts are walked before the rows are placed.
    rows = checkpoint(rows.withColumn("score", F.col("weight") + noise))
    able = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    placed, _ = ranked(rows, [able.desc(), F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("n_words")], "rank")
    drawn = placed.where(able).count() * percent // 100
    return placed.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
