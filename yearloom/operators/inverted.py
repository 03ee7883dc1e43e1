"""A stored inverted index: postings with positions, bucketed by the start of the term, in segments that grow and merge.

A folder holds segments; a segment is three Parquet tables: postings (bucket, term, doc, length, positions) partitioned by
bucket, lengths (doc, length), and nothing else has to be read to answer a query.  The bucket is a hash of a term's first
LEAD letters, so that a word and all words with its beginning lie in one bucket, and a search reads only the buckets of
its words; within a file rows are sorted by term, so row groups of other terms are skipped by their statistics.  A
posting knows the length of its document, hence scoring joins nothing.

New documents make a segment of their own.  Where a document is in several segments the last one holds; merging rewrites
all of them as one, which equals an index built at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from yearloom.sources import storage

from .search import tokens

#: Letters of a term that choose its bucket, and how many buckets there are.
LEAD, BUCKETS = 2, 64
#: Documents whose postings of one bucket lie in one file; a frequent word is spread over as many tasks as that takes.
DOCS_PER_FILE = 500_000


@dataclass(frozen=True)
class Term:
    """A word."""

    word: str


@dataclass(frozen=True)
class Prefix:
    """Any word with this beginning."""

    start: str


@dataclass(frozen=True)
class Phrase:
    """Words one after another."""

    words: tuple[str, ...]


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Any:
    parts: tuple


@dataclass(frozen=True)
class Not:
    """Documents without part; it stands inside All beside something that is asked for."""

    part: object


def bucket_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(F.substring(term, 1, LEAD)), F.lit(BUCKETS)).cast("int")


def _write(rows: DataFrame, lengths: DataFrame, folder: str) -> None:
    """Postings (term, doc, length, positions) and lengths (doc, length) as a segment."""
    salts = lengths.count() // DOCS_PER_FILE + 1
    rows = rows.withColumns({"bucket": bucket_of(F.col("term")), "_salt": F.pmod(F.xxhash64("doc"), F.lit(salts))})
    # Rows of a bucket and salt meet in one task, and are sorted, and so skipped, by term.
    dealt = rows.repartition(BUCKETS * salts, "bucket", "_salt").sortWithinPartitions("bucket", "term", "doc").drop("_salt")
    dealt.write.partitionBy("bucket").parquet(f"{folder}/postings")
    lengths.select("doc", "length").write.parquet(f"{folder}/lengths")


def _gathered(batches: Iterator) -> Iterator:
    """(term, doc, length, positions) of documents (doc, length, terms), a document at a time."""
    import pyarrow as pa

    for whole in batches:
        for start in range(0, whole.num_rows, 64):
            batch = whole.slice(start, 64)
            of, words, places, ends = [], [], [], [0]
            for i, terms in enumerate(batch.column(2).to_pylist()):
                found: dict[str, list[int]] = {}
                for at, t in enumerate(terms):
                    found.setdefault(t, []).append(at)
                for t, at in found.items():
                    of.append(i)
                    words.append(t)
                    places += at
                    ends.append(len(places))
            positions = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places, pa.int32()))
            doc, length = (batch.column(k).take(pa.array(of, pa.int64())) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), doc, length, positions], names=["term", "doc", "length", "positions"])


def _postings(docs: DataFrame, doc: str, text: str) -> tuple[DataFrame, DataFrame]:
    sized = docs.select(F.col(doc).alias("doc"), tokens(F.col(text)).alias("terms")).select("doc", F.size("terms").alias("length"), "terms")
    # Positions are gathered in the document's own row: an aggregation of exploded terms would sort and spill them all.
    rows = sized.mapInArrow(_gathered, f"term string, doc {sized.schema['doc'].dataType.simpleString()}, length int, positions array<int>")
    return rows, sized.select("doc", "length")


class Index:
    """An index in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @staticmethod
    def build(docs: DataFrame, doc: str, text: str, folder: str) -> "Index":
        """The index of docs; doc must tell documents apart.  A null text has no terms."""
        index = Index(docs.sparkSession, folder)
        index.add(docs, doc, text)
        return index

    def segments(self) -> list[int]:
        if not storage.exists(self.spark, self.folder):
            return []
        path, store = storage.path_of(self.spark, self.folder)
        names = [x.getPath().getName() for x in store.listStatus(path)]
        done = [int(x.split("=")[1]) for x in names if x.startswith("segment=")]
        return sorted(done)

    def add(self, docs: DataFrame, doc: str, text: str) -> None:
        """Documents as a new segment; those that the index has already are replaced."""
        self._commit(*_postings(docs, doc, text), (self.segments() or [-1])[-1] + 1)

    def _commit(self, rows: DataFrame, lengths: DataFrame, segment: int) -> None:
        """Written beside the segments, then renamed in one step: a run that fails leaves the index as it was."""
        beside = f"{self.folder}/_new-{segment}"
        storage.drop_folder(self.spark, beside)
        _write(rows, lengths, beside)
        path, store = storage.path_of(self.spark, beside)
        if not store.rename(path, storage.path_of(self.spark, f"{self.folder}/segment={segment}")[0]):
            raise OSError(f"segment {segment} of {self.folder} exists")

    def merge(self) -> None:
        """All segments as one; readers of the old ones should be done."""
        old = self.segments()
        self._commit(self.postings().drop("bucket"), self.lengths(), old[-1] + 1)
        for s in old:
            storage.drop_folder(self.spark, f"{self.folder}/segment={s}")

    def _read(self, table: str) -> list[DataFrame]:
        found = []
        for s in self.segments():
            rows = self.spark.read.parquet(f"{self.folder}/segment={s}/lengths")
            if table == "postings":  # a segment without postings has no file to tell their schema
                kind = rows.schema["doc"].dataType.simpleString()
                schema = f"term string, doc {kind}, length int, positions array<int>, bucket int"
                rows = self.spark.read.schema(schema).parquet(f"{self.folder}/segment={s}/postings")
            found.append(rows.withColumn("segment", F.lit(s)))
        return found

    def _last(self) -> DataFrame:
        """(doc, segment) that holds of each document."""
        return reduce(DataFrame.unionByName, self._read("lengths")).groupBy("doc").agg(F.max_by("length", "segment").alias("length"), F.max("segment").alias("segment"))

    def lengths(self) -> DataFrame:
        """(doc, length) of all documents."""
        parts = self._read("lengths")
        return (parts[0] if len(parts) == 1 else self._last()).select("doc", "length")

    def postings(self, condition: Column | None = None) -> DataFrame:
        """(bucket, term, doc, length, positions); a condition reaches the files."""
        parts = self._read("postings")
        if condition is not None:
            parts = [p.where(condition) for p in parts]
        if len(parts) > 1:
            parts = [reduce(DataFrame.unionByName, parts).join(self._last().select("doc", "segment"), ["doc", "segment"])]
        return parts[0].select("bucket", "term", "doc", "length", "positions")

    def hits(self, terms: list[str], starts: list[str] = []) -> DataFrame:
        """The postings of these words and beginnings, from the buckets where they are."""
        wanted = [F.col("term").startswith(p) for p in starts] + ([F.col("term").isin(terms)] if terms else [])
        condition = reduce(Column.__or__, wanted, F.lit(False))
        if all(len(p) >= LEAD for p in starts):
            leads = sorted({x[:LEAD] for x in [*terms, *starts]})
            condition = reduce(Column.__or__, [F.col("bucket") == bucket_of(F.lit(x)) for x in leads], F.lit(False)) & condition
        return self.postings(condition)

    def search(self, wanted) -> DataFrame:
        """(doc) of the documents that a tree of Term, Prefix, Phrase, All, Any and Not asks for, in one pass over the
        postings of its words."""
        terms, starts = sorted(_words(wanted)), sorted(_starts(wanted))
        rows = self.hits(terms, starts).groupBy("doc")
        # Positions are read and moved for words of phrases only; of others it is enough that they stand there.
        placed = _phrased(wanted)
        at = {t: F.max(F.when(F.col("term") == t, F.col("positions") if t in placed else F.lit(True))).alias(f"t{i}") for i, t in enumerate(terms)}
        begun = {p: F.max(F.col("term").startswith(p)).alias(f"p{i}") for i, p in enumerate(starts)}
        found = rows.agg(*at.values(), *begun.values())
        names = {t: F.col(f"t{i}") for i, t in enumerate(terms)} | {("p", p): F.col(f"p{i}") for i, p in enumerate(starts)}
        return found.where(_true(wanted, names)).select("doc")

    def bm25(self, terms: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
        """(doc, score) of the documents with any of the words."""
        rows = self.hits(sorted(set(terms)))
        counts = self.lengths().agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean")).alias("t"))
        spread = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        # A row for each word asked for.
        hits = rows.join(F.broadcast(spread), "term").withColumn("t", counts.scalar())
        tf, n = F.size("positions"), F.col("t.n")
        idf = F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
        weight = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("length") / F.col("t.mean")))
        return hits.groupBy("doc").agg(F.sum(weight).alias("score"))

    def terms(self) -> DataFrame:
        """(term, times, docs) of the whole index."""
        return self.postings().groupBy("term").agg(F.sum(F.size("positions")).alias("times"), F.count(F.lit(1)).alias("docs"))


def _words(x) -> set[str]:
    match x:
        case Term(word):
            return {word}
        case Phrase(words):
            return set(words)
        case All(parts) | Any(parts):
            return set().union(*map(_words, parts))
        case Not(part):
            return _words(part)
    return set()


def _phrased(x) -> set[str]:
    match x:
        case Phrase(words):
            return set(words)
        case All(parts) | Any(parts):
            return set().union(*map(_phrased, parts))
        case Not(part):
            return _phrased(part)
    return set()


def _starts(x) -> set[str]:
    match x:
        case Prefix(start):
            return {start}
        case All(parts) | Any(parts):
            return set().union(*map(_starts, parts))
        case Not(part):
            return _starts(part)
    return set()


def _shifted(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda p: p - by)


def _true(x, names: dict) -> Column:
    """Whether a document with these positions is asked for; each column is null where it has none."""
    match x:
        case Term(word):
            return names[word].isNotNull()
        case Prefix(start):
            return F.coalesce(names["p", start], F.lit(False))
        case Phrase(words):
            # Positions moved back to the phrase's start meet there.
            moved = [_shifted(names[w], i) for i, w in enumerate(words)]
            return F.coalesce(F.size(reduce(F.array_intersect, moved)) > 0, F.lit(False))
        case All(parts):
            return reduce(Column.__and__, [_true(p, names) for p in parts])
        case Any(parts):
            return reduce(Column.__or__, [_true(p, names) for p in parts])
        case Not(part):
            return ~_true(part, names)
    raise TypeError(f"no query: {x!r}")


_KEPT: dict[tuple[str, str], Index] = {}


def of_table(spark: SparkSession, path: str, doc: str, text: str) -> Index:
    """The index of a Parquet table, built when it is first asked for in a session."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _KEPT:
        _KEPT[key] = Index.build(spark.read.parquet(path), doc, text, storage.new_folder(spark, "index"))
    return _KEPT[key]
