"""Document fingerprints: every word-shingle hash below a fixed share of the hash range is kept.

Such sketches merge by union, and as both sides keep the same share of the same hash range, the share of one sketch that
lies in another estimates containment however unequal the documents are.  A text of FEW shingles at most (repeated ones
counted) keeps them all,
as a share of so few tells little: two such sketches are compared whole, any others on the share that both keep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import BLANK_RUN, ranked

SHINGLE = 5
#: One hash in SCALE is kept, and every hash of a text of FEW shingles at most, repeated ones counted.
SCALE, FEW = 4, 64


def ceiling(scale: int = SCALE) -> Column:
    """The hash below which all sketches keep."""
    return F.lit(-(1 << 63) + (1 << 64) // scale)


def sketch(text: Column, shingle: int = SHINGLE, scale: int = SCALE) -> Column:
    """array<long>: the kept hashes of the distinct shingles of lower-cased words, in order.

    A text with fewer words than a shingle has one shingle, the whole sequence; a text without words (or null) has none.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BLANK_RUN), lambda w: w != "")

    def kept(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(hashes) - (shingle - 1), F.lit(1)))
        shingles = F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, shingle)))
        few = F.size(hashes) < FEW + shingle
        found = F.array_sort(F.array_distinct(F.filter(shingles, lambda h: few | (h < ceiling(scale)))))
        return F.when(F.size(hashes) > 0, found).otherwise(F.array().cast("array<bigint>"))

    # The outer transform binds the word hashes to a variable; as a plain expression they'd be made anew for each shingle.
    return F.get(F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), kept), F.lit(0))


def fingerprint(text: Column, kept: Column) -> Column:
    """A string: the text's own hash, then the kept ones; equal texts have equal fingerprints."""
    head = F.hex(F.xxhash64(F.coalesce(text, F.lit(""))))
    return F.lower(F.concat_ws(".", head, F.array_join(F.transform(kept, lambda h: F.hex(h)), ".")))


def alike(a: Column, b: Column, scale: int = SCALE) -> Column:
    """A struct of a and b as they may be compared: whole if both are, else the share that both keep."""
    whole = lambda x: F.size(x) > F.size(F.filter(x, lambda h: h < ceiling(scale)))
    low = lambda x: F.filter(x, lambda h: h < ceiling(scale))
    return F.when(whole(a) & whole(b), F.struct(a.alias("a"), b.alias("b"))).otherwise(F.struct(low(a).alias("a"), low(b).alias("b")))


def _bound(value: Column, use) -> Column:
    """use(value) with value made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def resemblance(a: Column, b: Column, same: Column, scale: int = SCALE) -> Column:
    """Jaccard similarity of two sketches; same says whether the texts are equal, which alone settles two empty ones."""

    def told(x: Column) -> Column:
        both, either = F.size(F.array_intersect(x["a"], x["b"])), F.size(F.array_union(x["a"], x["b"]))
        return F.when(either == 0, 0.0).otherwise(both / either)

    return F.when(same, 1.0).otherwise(_bound(alike(a, b, scale), told))


def containment(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The estimated share of a's shingles that b has too; null where the sketch of a tells nothing."""
    return _bound(alike(a, b, scale), lambda x: F.when(F.size(x["a"]) > 0, F.size(F.array_intersect(x["a"], x["b"])) / F.size(x["a"])))


def merge(sketches: Column, scale: int = SCALE) -> Column:
    """An aggregate: the sketch of all the texts together, of the share that all sketches keep."""
    low = F.filter(F.flatten(F.collect_list(sketches)), lambda h: h < ceiling(scale))
    return F.array_sort(F.array_distinct(low))


def with_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scale: int = SCALE) -> DataFrame:
    """Fingerprints of all documents and of their edited texts.

    The edit replaces the last floor(n_chars / 3) code points by the first as many (or all) of the next document, in
    descending doc_id; after the last comes the first.  A null text counts as empty.  Documents that share a doc_id follow
    one another by the hash of their texts; rows equal in both are one document, returned as often as they come.  A sole
    document is its own next one.  Texts move once, by key; the order is settled on keys alone.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = base.withColumn("h", F.xxhash64("text")).withColumn("k", F.xxhash64("doc_id", F.col("doc_id").isNull(), "h"))
    order, total = ranked(
        base.select("doc_id", "k", "h", F.length("text").alias("n")).distinct(), [F.col("doc_id").desc_nulls_last(), F.col("h")]
    )
    asking = order.select((F.col("rank") + 1).alias("rank"), F.col("doc_id").alias("to_id"), F.col("k").alias("to_k"), F.col("h").alias("to_h"), F.col("n").alias("to_n"))
    asking = asking.withColumn("rank", F.when(F.col("rank") == total, 0).otherwise(F.col("rank")))
    asks = order.join(asking, "rank").select("k", "h", "to_id", "to_k", "to_h", F.floor(F.col("to_n") / 3).cast("int").alias("take"))

    # Both joins read these very columns by the same key, so that the texts are shuffled once.  Sketches are made behind
    # the shuffle, a text's own one twice: that takes less than moving it along, as hashes don't compress.
    full = base.select("k", "h", "text")
    own = sketch(F.col("text"), scale=scale)
    head = F.expr("substring(text, 1, take)").alias("head")
    sent = full.join(asks, ["k", "h"]).select(
        F.col("to_id").alias("doc_id"), F.col("to_k").alias("k"), F.col("to_h").alias("h"), head, own.alias("next_kept"), F.col("h").alias("next_h")
    )
    sent = sent.dropDuplicates(["k", "h"])
    edited = F.expr("concat(substring(text, 1, length(text) - cast(floor(length(text) / 3) as int)), head)")
    got = full.join(sent, ["k", "h"]).withColumn("n", F.length("text")).withColumn("edited", edited)
    got = got.withColumns({"kept": own, "edited_kept": sketch(F.col("edited"), scale=scale)})
    return got.select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), F.col("kept")).alias("fingerprint"),
        fingerprint(F.col("edited"), F.col("edited_kept")).alias("edited_fingerprint"),
        resemblance(F.col("kept"), F.col("edited_kept"), F.col("text") == F.col("edited"), scale).alias("near_edited"),
        resemblance(F.col("kept"), F.col("next_kept"), F.col("h") == F.col("next_h"), scale).alias("near_next"),
    )
