"""Dictionary entries of editions: (place, headwords, body), one entry for each field of each country of an edition.

place orders entries as the edition does; headwords are those of the country joined to the field's name, and a country's
first entry also has its bare names, ahead of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window as W

from yearloom.functions import text as X
from yearloom.sources import storage

from . import matching
from .entities import headwords
from .keys import fresh

LONGEST = 500
#: Needles that a body meets in one task.
PORTION = 100_000


def _edition(countries: DataFrame, masters: DataFrame, year: int | None) -> DataFrame:
    """One edition, or all."""
    asked = countries if year is None else countries.where(F.col("year") == year)
    return headwords(asked.select("country_id", "name", "master_id"), masters)


def _entries(grouped: DataFrame, body: Column) -> DataFrame:
    """Entries of (country_id, name, codes, field_name, place); place is a struct of category and field."""
    named = F.transform("codes", lambda c: F.concat(c, F.lit(" - "), F.col("field_name")))
    first = F.row_number().over(W.partitionBy("country_id").orderBy("place")) == 1
    place = F.struct("country_id", F.col("place.category_id").alias("category_id"), F.col("place.field_id").alias("field_id"))
    return grouped.select(place.alias("place"), F.when(first, F.concat("codes", named)).otherwise(named).alias("headwords"), body.alias("body"))


def _head(category: Column) -> list[Column]:
    return [F.concat(F.lit("<i>"), X.escaped(F.col("name")), F.lit("</i><br>")), F.concat(F.lit("<small>"), X.escaped(category), F.lit("</small><br><br>"))]


def general(countries: DataFrame, categories: DataFrame, fields: DataFrame, masters: DataFrame, year: int | None = None) -> DataFrame:
    """Entries with whole contents.  A field that a country has twice is one entry under its first category; blank contents
    have none."""
    edition = _edition(countries, masters, year)
    rows = fields.where(F.trim("content") != "").join(edition, "country_id").join(categories.select("category_id", "country_id", "title"), ["category_id", "country_id"])
    at = F.struct("category_id", "field_id")
    parts = F.array_sort(F.collect_list(F.struct("category_id", "field_id", "content")))
    grouped = rows.groupBy("country_id", "name", "codes", "field_name").agg(
        F.min(at).alias("place"), F.min_by("title", at).alias("title"), F.array_join(F.transform(parts, lambda p: p["content"]), "\n").alias("content")
    )
    return _entries(grouped, F.concat_ws("\n", *_head(F.col("title")), X.escaped(F.col("content"))))


def structured(countries: DataFrame, categories: DataFrame, fields: DataFrame, values: DataFrame, masters: DataFrame, year: int | None = None) -> DataFrame:
    """Entries with a line for each sub-value that says anything, under the field's last category.

    values(field_id, sub_field, numeric_val, units) may have text_val, of which LONGEST characters are shown.  Sub-values
    of a field stand in the order of value_id, or of their names if there is none.
    """
    text = F.col("text_val") if "text_val" in values.columns else F.lit(None).cast("string")
    order = F.col("value_id") if "value_id" in values.columns else F.col("sub_field")
    words = F.when(F.length(text) > LONGEST, F.concat(X.escaped(F.left(text, F.lit(LONGEST))), F.lit("..."))).when(text != "", X.escaped(text))
    shown = F.coalesce(X.formatted(F.col("numeric_val"), F.col("units")), words)
    line = F.when(shown != "", F.concat(F.lit("<b>"), X.escaped(F.col("sub_field")), F.lit("</b>: "), shown, F.lit("<br>")))
    lines = values.select("field_id", order.alias("value"), line.alias("line"))
    edition = _edition(countries, masters, year)
    rows = fields.select("field_id", "category_id", "country_id", "field_name").join(edition, "country_id")
    rows = rows.join(categories.select("category_id", "title"), "category_id").join(lines, "field_id")
    at = F.struct("category_id", "field_id")
    parts = F.array_sort(F.collect_list(F.struct("category_id", "field_id", "value", "line")))
    grouped = rows.groupBy("country_id", "name", "codes", "field_name").agg(
        F.min(at).alias("place"), F.max_by("title", at).alias("title"), F.array_compact(F.transform(parts, lambda p: p["line"])).alias("lines")
    )
    return _entries(grouped, F.array_join(F.concat(F.array(*_head(F.col("title"))), F.col("lines")), "\n"))


def merged(entries: DataFrame) -> DataFrame:
    """Entries of one primary headword as one: bodies joined in their order, each headword once, where it first stands."""
    parts = F.array_sort(F.collect_list(F.struct("place", "headwords", "body")))
    grouped = entries.groupBy(F.get("headwords", F.lit(0)).alias("primary")).agg(F.min("place").alias("place"), parts.alias("parts"))
    return grouped.select(
        "place",
        F.array_distinct(F.flatten(F.transform("parts", lambda p: p["headwords"]))).alias("headwords"),
        F.array_join(F.transform("parts", lambda p: p["body"]), "\n").alias("body"),
    )


def checks(entries: DataFrame, shortest: int = 30, book: Column | None = None) -> DataFrame:
    """(check, observed): entries, primary headwords that a book has more than once, short bodies, bodies without a name or
    category, with tags left open, spoilt characters, entries without headwords, and characters in all."""
    body = F.col("body")
    primary = entries.groupBy((F.lit(0) if book is None else book).alias("book"), F.get("headwords", F.lit(0)).alias("primary")).agg(F.count(F.lit(1)).alias("n"))
    doubled = primary.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("observed")).select(F.lit("doubled").alias("check"), "observed")
    times = lambda x: F.length(body) - F.length(F.replace(body, F.lit(x), F.lit("")))
    unbalanced = F.lit(False)
    for tag in ("i", "b", "small"):
        unbalanced |= times(f"<{tag}>") / (len(tag) + 2) != times(f"</{tag}>") / (len(tag) + 3)
    told = {
        "entries": F.count(F.lit(1)), "short": F.count_if(F.octet_length(body) < shortest), "no_category": F.count_if(~body.contains("<small>")), "no_name": F.count_if(~body.contains("<i>")),
        "unbalanced": F.count_if(unbalanced), "spoilt": F.count_if(body.contains("\ufffd")), "no_headword": F.count_if(F.size("headwords") < 1), "characters": F.coalesce(F.sum(F.length(body).cast("long")), F.lit(0)),
    }
    one = entries.agg(*(c.alias(n) for n, c in told.items()))
    return one.unpivot([], list(told), "check", "observed").union(doubled)


def truths_told(entries: DataFrame, truths: DataFrame) -> DataFrame:
    """truths(book, headword, needle) with ok: whether an entry of that headword, be it its first or another, has the needle
    in its body.  An empty or null needle asks for the entry only; a headword that the book lacks fails.

    entries has book, headwords and body.  A body meets all needles of its headword in one task, PORTION of them at a time,
    and is read once for each length that they have; bodies go along with the headwords that are asked for only.
    """
    import pyarrow as pa

    spark, keys = truths.sparkSession, ["book", "headword"]
    part = fresh(truths, "_part")
    told = F.col("book").isNotNull() & F.col("headword").isNotNull()
    # Written, so that what is asked for is made once and its size is known to the joins.
    folder = storage.new_folder(spark, "asked")
    truths.where(told).groupBy(*keys).agg((F.floor(F.count(F.lit(1)) / PORTION) + 1).alias("parts")).write.parquet(folder)
    asked = spark.read.parquet(folder)
    words = entries.select("book", F.explode(F.array_distinct("headwords")).alias("headword"), "body").join(asked, keys)
    upto = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    words = words.select(*keys, F.explode(upto).alias(part), F.coalesce("body", F.lit("")).alias("body"))
    rows = truths.where(told).join(asked.withColumnRenamed("parts", part), keys).select(*truths.columns, part)
    rows = rows.withColumn(part, F.pmod(F.xxhash64(F.coalesce("needle", F.lit(""))), F.col(part)))
    names, at = truths.columns, truths.columns.index("needle")

    def meet(asked: pa.Table, known: pa.Table) -> pa.Table:
        needles = [n or "" for n in asked.column(at).to_pylist()]
        found, left = set(), set(needles)
        for body in known.column("body").to_pylist():
            found |= matching.inside(body, list(left))
            left -= found
        return asked.select(names).append_column("ok", pa.array([n in found for n in needles], pa.bool_()))

    schema = T.StructType([*truths.schema]).add("ok", "boolean")
    by = [*keys, part]
    met = rows.groupBy(*by).cogroup(words.groupBy(*by)).applyInArrow(meet, schema)
    return met.unionByName(truths.where(~told).withColumn("ok", F.lit(False)))


def sub_fields_told(entries: DataFrame, asked: DataFrame) -> DataFrame:
    """asked(field_name, sub_field) with entries and lacking: structured entries of the field, and those without a line for
    the sub-field.  entries has field_name and body."""
    line = F.concat(F.lit("<b>"), X.escaped(F.col("sub_field")), F.lit("</b>: "))
    n = asked.join(entries, "field_name").groupBy("field_name", "sub_field").agg(F.count(F.lit(1)).alias("entries"), F.count_if(~F.contains(F.coalesce("body", F.lit("")), line)).alias("lacking"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return asked.join(n, ["field_name", "sub_field"], "left").select("field_name", "sub_field", zero("entries"), zero("lacking"))


def names(entries: DataFrame) -> DataFrame:
    """(book, name): the countries of a book, by what stands before " - " in an entry's first headword."""
    return entries.select("book", F.substring_index(F.get("headwords", F.lit(0)), " - ", 1).alias("name")).distinct()


def names_apart(entries: DataFrame, expected: DataFrame) -> DataFrame:
    """(book, name, side): names of expected(book, name) that a book lacks ("lacking"), and names that only the book has
    ("added").  Nulls are left out."""
    sides = names(entries).withColumn("_in", F.lit(1)).unionByName(expected.select("book", "name").distinct().withColumn("_in", F.lit(2)))
    told = sides.where("book IS NOT NULL AND name IS NOT NULL").groupBy("book", "name").agg(F.sum("_in").alias("_in"))
    return told.where("_in < 3").select("book", "name", F.when(F.col("_in") == 2, "lacking").otherwise("added").alias("side"))


def alike(first: DataFrame, second: DataFrame) -> DataFrame:
    """(book, shared, equal) of two dictionaries(book, entry, body) of the same books: entries in both, and those with the
    same body in both.  Bodies are compared as digests, which is all that is shuffled of them."""
    side = lambda df, c: df.select("book", "entry", F.sha2("body", 256).alias(c))
    both = side(first, "a").join(side(second, "b"), ["book", "entry"])
    return both.groupBy("book").agg(F.count(F.lit(1)).alias("shared"), F.count_if(F.col("a").eqNullSafe(F.col("b"))).alias("equal"))
