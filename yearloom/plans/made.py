"""Texts made from a table's keys, in columns and in SQL alike, with the rows that a parser has to find in them.

A template's {name} stands for a value of PARTS.  What is found is told by expressions over the same values, not by
patterns, so that the SQL forms are independent of the parsers.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Values of a row with key k: whole numbers, three digits t, a number x of one decimal, and a year y.
PARTS = {"k": "k", "a": "k % 900 + 100", "b": "k % 97 + 1", "c": "k % 53 + 1", "e": "k % 10", "t": "k % 1000", "y": "1990 + k % 36"}
BASE = (
    "WITH base AS (SELECT *, CAST(c || '.' || e AS DOUBLE) AS x FROM (SELECT c_custkey AS k, "
    + ", ".join(f"{v.replace('k', 'c_custkey')} AS {n}" for n, v in PARTS.items() if n != "k")
    + " FROM customer))"
)
HOLE = re.compile(r"\{(\w)\}")


def _pieces(template: str) -> list[tuple[bool, str]]:
    parts = HOLE.split(template)
    return [(i % 2 == 1, p) for i, p in enumerate(parts) if p]


def column(template: str) -> Column:
    """A template over a column k."""

    def value(name: str) -> Column:
        if name == "x":
            return F.concat(value("c"), F.lit("."), value("e"))
        out = F.expr(PARTS[name]).cast("string")
        return F.lpad(out, 3, "0") if name == "t" else out

    return F.concat(*(value(p) if hole else F.lit(p) for hole, p in _pieces(template)))


def sql(template: str) -> str:
    """A template over BASE."""

    def value(name: str) -> str:
        return "c || '.' || e" if name == "x" else "lpad(t::VARCHAR, 3, '0')" if name == "t" else f"{name}::VARCHAR"

    quoted = lambda p: " || chr(10) || ".join("'" + x.replace("'", "''") + "'" for x in p.split("\n"))
    return "(" + " || ".join(value(p) if hole else quoted(p) for hole, p in _pieces(template)) + ")"


#: Rows that a task makes texts of, and parses: a key is a few bytes, so a split of the file holds the work of many tasks.
ROWS_A_TASK = 4000


def texts(spark: SparkSession, sf_dir: str, template: str, dealt: bool = True) -> DataFrame:
    """(k, text) for each customer; dealt: to tasks by their number, not by the splits of the file."""
    keys = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"))
    if dealt:  # the count is read from the file's footer
        keys = keys.repartition(keys.count() // ROWS_A_TASK + 1, "k")
    return keys.select("k", column(template).alias("text"))
