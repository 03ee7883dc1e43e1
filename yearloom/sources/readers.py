"""Editions as they come: whole texts, archives of pages, trees of objects, tables of names, indexes of captures."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

#: Names of pages that describe no entity (fixed values).
SKIPPED = ["template", "print", "summary", "notes", "appendix", "index", "wfb"]
#: One object of a tree.
OBJECT = "name string, code string, categories array<struct<title:string,fields:array<struct<name:string,content:string,value:string>>>>"
#: Bytes of a capture below which it isn't the whole edition.
LEAST_CAPTURE = 1_000_000


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of each file; bytes that aren't UTF-8 turn into replacement characters."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.expr("try_validate_utf8(cast(content AS string))").alias("good"), "content").select(
        "path", F.coalesce("good", F.expr("make_valid_utf8(cast(content AS string))")).alias("text")
    )


def zipped_pages(spark: SparkSession, path: str, folder: str = "/geos/") -> DataFrame:
    """(path, code, html) of archives of pages: those under the folder, by short names, the first of each code.

    An archive is opened where it lies; only its pages leave the task.  A file that isn't an archive has no pages.
    """
    import pyarrow as pa

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not zipfile.is_zipfile(io.BytesIO(content or b"")):
                    continue
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for place, name in enumerate(archive.namelist()):
                        if folder in "/" + name and name.endswith(".html"):
                            html = archive.read(name).decode("utf-8", "replace")
                            yield pa.RecordBatch.from_pydict({"path": [where], "place": [place], "name": [name], "html": [html]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(path)
    found = files.select("path", "content").mapInArrow(pages, "path string, place long, name string, html string")
    code = F.lower(F.regexp_extract("name", r"([^/]+)\.html$", 1))
    kept = found.withColumn("code", code).where((F.length("code") <= 5) & ~F.col("code").rlike("|".join(SKIPPED)))
    first = F.row_number().over(W.partitionBy("path", "code").orderBy("place"))
    return kept.withColumn("_n", first).where("_n = 1").select("path", "code", "html")


def object_tree(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, code, categories) of a tree of JSON files, one object a file; a file that isn't JSON has null columns."""
    rows = spark.read.schema(OBJECT).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return rows.select(F.col("_metadata.file_path").alias("path"), "name", "code", "categories")


def lookup(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of names from CSV with a header; codes keep their leading zeros, as the schema says what they are."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def capture(index: Column, least: int = LEAST_CAPTURE) -> Column:
    """Of a capture index (a JSON table with a header row) the time of the first good capture of more bytes than least."""
    rows = F.slice(F.from_json(index, "array<array<string>>"), 2, 1 << 30)
    good = F.filter(rows, lambda r: (F.get(r, F.lit(4)) == "200") & (F.get(r, F.lit(6)).try_cast("long") > least))
    return F.get(F.get(good, F.lit(0)), F.lit(1))


def dumped(spark: SparkSession, path: str) -> DataFrame:
    """(path, table, values) of INSERT statements in SQL dumps, a row for each tuple; values is an array of texts, NULL as
    null.  A tuple begins on a line of its own, as sinks.sql_dump writes it; text in quotes may hold anything, line breaks
    and lines that look like tuples among it.

    A file is read in as many splits as Spark gives it.  Whether a line begins inside quotes follows from the parity of the
    quotes before it: each split counts its own, a running sum over the splits says how each begins, and lines are cut
    into units (a line that begins outside quotes, and those inside quotes after it).  Only the first and last unit of a
    split may be in parts, so no other moves again; the name of the last statement's table is carried over likewise.
    """
    order = W.partitionBy("path").orderBy("block")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("path", "block").orderBy("at")
    so_far = inside.rowsBetween(W.unboundedPreceding, 0)

    text = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")]
    lines = text.select(*place, "value").withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit("'"), F.lit(""))))
    # A row for each split, as the driver's plan has.
    splits = lines.groupBy("path", "block").agg(F.sum("quotes").alias("quotes"))
    splits = splits.select("path", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("open"))
    lines = lines.join(splits, ["path", "block"]).withColumn("past", F.col("open") + F.sum("quotes").over(so_far) - F.col("quotes"))
    lines = lines.withColumn("unit", F.sum((F.col("past") % 2 == 0).cast("int")).over(so_far))

    pieces = lines.groupBy("path", "block", "unit").agg(
        F.min("at").alias("at"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), "\n").alias("text")
    )
    pieces = pieces.withColumn("named", F.nullif(F.regexp_extract("text", r"^INSERT INTO (\w+)", 1), F.lit(""))).withColumn("named", F.when(F.col("unit") > 0, F.col("named")))
    pieces = pieces.withColumn("table", F.last("named", ignorenulls=True).over(so_far))
    ends = pieces.groupBy("path", "block").agg(F.max("unit").alias("last"), F.max_by("table", "at").alias("name"))
    # The split that has the beginning of what this one goes on with, and the table named last before it.
    owner = F.last(F.when(F.col("last") > 0, F.struct("block", "last")), ignorenulls=True).over(before)
    ends = ends.select("path", "block", "last", owner.alias("owner"), F.last("name", ignorenulls=True).over(before).alias("carried"))
    pieces = pieces.join(ends, ["path", "block"]).withColumn("table", F.coalesce("table", "carried"))
    whole = (F.col("unit") > 0) & (F.col("unit") < F.col("last"))
    parts = pieces.where(~whole).withColumn("key", F.when(F.col("unit") > 0, F.struct("block", "unit")).otherwise(F.col("owner").cast("struct<block:bigint,unit:bigint>")))
    parts = parts.groupBy("path", "key").agg(
        F.min_by("table", F.struct("block", "at")).alias("table"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "text"))), lambda x: x["text"]), "\n").alias("text"),
    )
    units = pieces.where(whole).select("path", "table", "text").unionByName(parts.select("path", "table", "text"))
    # Runs of text without quotes are taken whole, so that long values don't nest the matcher.
    item = r"\G[(,]\s*(N?'[^']*+(?:''[^']*+)*+'|[^',()]+)"
    raw = F.regexp_extract_all("text", F.lit(item), F.lit(1))
    plain = lambda x: F.when(F.trim(x) == "NULL", None).when(x.rlike("^N?'"), F.replace(F.regexp_replace(x, r"^N?'|'$", ""), F.lit("''"), F.lit("'"))).otherwise(F.trim(x))
    return units.where(F.startswith("text", F.lit("("))).select("path", "table", F.transform(raw, plain).alias("values"))
