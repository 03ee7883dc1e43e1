"""Sets of words by book: what two books share, exactly and by sketches that merge.

A theta sketch keeps the hashes below a threshold that falls as a set grows, so sketches made anywhere unite, and meet, to
estimates of how many words two books have in common.  They cost a few KB a book where the exact answer shuffles all
words; with K kept hashes the deviation of a set's size is below 1 / sqrt(K - 2) of it, and that of what is shared or left
is below the same share of both sets together.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

#: Binary logarithm of the hashes that a sketch keeps.
LOG_K = 12


def sets(df: DataFrame, book: str, word: str) -> DataFrame:
    """(book, word) without repetition; null words and books are left out."""
    return df.select(F.col(book).alias("book"), F.col(word).alias("word")).where("book IS NOT NULL AND word IS NOT NULL").distinct()


def followers(words: DataFrame) -> DataFrame:
    """(book, next_book) in the order of books; a row for each book."""
    books = words.select("book").distinct()
    return books.withColumn("next_book", F.lead("book").over(W.orderBy("book"))).where("next_book IS NOT NULL")


def exact(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(book, next_book, shared, gone, came) for pairs of books: words of both, of the first only, of the second only."""
    sizes = words.groupBy("book").agg(F.count(F.lit(1)).alias("n"))
    wanted = words.join(pairs, "book").select("book", "next_book", "word")
    shared = wanted.join(words.select(F.col("book").alias("next_book"), "word"), ["next_book", "word"]).groupBy("book", "next_book").agg(F.count(F.lit(1)).alias("shared"))
    rows = pairs.join(sizes, "book").join(sizes.select(F.col("book").alias("next_book"), F.col("n").alias("next_n")), "next_book").join(shared, ["book", "next_book"], "left")
    both = F.coalesce("shared", F.lit(0))
    return rows.select("book", "next_book", both.alias("shared"), (F.col("n") - both).alias("gone"), (F.col("next_n") - both).alias("came"))


def sketched(words: DataFrame, pairs: DataFrame, log_k: int = LOG_K) -> DataFrame:
    """(book, next_book, shared, gone, came, deviation): the same by sketches of the books, a row each, and the deviation
    that each of the three may have."""
    made = words.groupBy("book").agg(F.theta_sketch_agg("word", log_k).alias("sketch"))
    rows = pairs.join(made, "book").join(made.select(F.col("book").alias("next_book"), F.col("sketch").alias("other")), "next_book")
    size = lambda c: F.theta_sketch_estimate(c)
    a, b = F.col("sketch"), F.col("other")
    return rows.select(
        "book", "next_book", size(F.theta_intersection(a, b)).alias("shared"), size(F.theta_difference(a, b)).alias("gone"), size(F.theta_difference(b, a)).alias("came"),
        (size(F.theta_union(a, b, log_k)) / sqrt((1 << log_k) - 2)).alias("deviation"),
    )


def within(told: Column, true: Column, deviation: Column, times: int = 5) -> Column:
    """Whether an estimate is as near as so many deviations (and one, for rounding)."""
    return F.abs(told - true) <= deviation * times + 1
