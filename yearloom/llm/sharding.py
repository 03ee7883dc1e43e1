"""Sharding: a keyed permutation of global row numbers deals rows to shards.

The rows are numbered 0..n-1 by key.  A Feistel network over pairs of digits in base ceil(sqrt(n)) permutes a range that
is barely larger than n, and cycle walking (permute again while the image is n or more) restricts it to 0..n-1.  Shard
and slot then follow by division, so either can be computed for a row number without looking at any other row, and the
row counts of two shards differ by one at most.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, ranked

ROUNDS = 6
#: Walks beyond the first that are written out; raise_error guards the rest.  A range of up to 961 rows never needs more,
#: and beyond that each walk leaves less than 7 of 100 rows, so 64 walks leave one in 10**74.
WALKS = 64


def _round(left: Column, right: Column, key: int, base: int) -> tuple[Column, Column]:
    return right, (left + F.pmod(F.xxhash64(right, F.lit(key)), F.lit(base))) % F.lit(base)


def _permuted(x: Column, base: int, seed: int) -> Column:
    left, right = F.floor(x / F.lit(base)).cast("long"), x % F.lit(base)
    for k in range(ROUNDS):
        left, right = _round(left, right, seed * ROUNDS + k, base)
    return left * F.lit(base) + right


def permute(df: DataFrame, row: str, n: int, out: str, seed: int = 0) -> DataFrame:
    """Adds out, the image of row (0..n-1) under the permutation of 0..n-1 that n and seed choose."""
    if n <= 1:
        return df.withColumn(out, F.col(row).cast("long"))
    base = isqrt(n - 1) + 1
    left, right = fresh(df, "_left"), fresh(df, "_right")
    df = df.withColumns({left: F.expr(f"`{row}` div {base}L"), right: F.col(row) % F.lit(base)})
    for k in range(ROUNDS):  # a projection a round: the expression doesn't double with each
        a, b = _round(F.col(left), F.col(right), seed * ROUNDS + k, base)
        df = df.withColumns({left: a, right: b})
    first = F.col(left) * F.lit(base) + F.col(right)
    df = df.withColumn(out, first).drop(left, right)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        F.col(out),
        lambda x, _: F.when(x < n, x).otherwise(_permuted(x, base, seed)),
    )
    walked = F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))
    return df.withColumn(out, F.when(F.col(out) < n, F.col(out)).otherwise(walked))


def shard(df: DataFrame, key: str, shards: int, seed: int = 0, ties: list[str] | None = None) -> DataFrame:
    """df with shard int (0..shards-1) and slot long (gapless from 0 in each shard).

    Rows are numbered by key, nulls first, then by ties; rows equal in all of these are interchangeable.  Pass only the
    columns that should move: the text of a document isn't needed to place it.  An empty table gives an empty result, and
    fewer rows than shards leave the last shards empty.  Columns shard and slot of df are replaced.
    """
    df = df.drop(*(c for c in df.columns if c.lower() in ("shard", "slot")))
    row = fresh(df, "_row")
    numbered, n = ranked(df, [F.col(key).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in ties or [])], row)
    dealt = permute(numbered, row, n, row, seed)
    return dealt.withColumns(
        {"shard": (F.col(row) % shards).cast("int"), "slot": F.expr(f"`{row}` div {shards}L")}
    ).drop(row)
