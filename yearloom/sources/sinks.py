"""What an archive is written as: partitioned Parquet, SQL dumps by year, JSON feeds and dictionary files.

Each sink is a Spark write: rows are formatted by column expressions or inside tasks, and no file passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from . import stardict
from .archive import Archive

#: Tuples of one INSERT statement (a fixed value).
BATCH = 1_000
#: Tables with a row for each field or value, which are written by year.
BY_YEAR = ("fields", "values")


def write_archive(archive: Archive, folder: str) -> None:
    """The tables as Archive.from_parquet reads them; fields and values by year, so that a filter on it prunes files.
    Entities also say when they were written."""
    years = archive.countries.select("country_id", "year")
    keys = archive.fields.select("field_id", "country_id").join(years, "country_id").select("field_id", "year")
    for name in Archive.TABLES:
        table = getattr(archive, name)
        if name == "fields":
            table = table.join(years, "country_id")
        elif name == "values":
            table = table.join(keys, "field_id")
        elif name == "masters":
            table = table.withColumn("created", F.current_timestamp())
        if name in BY_YEAR:  # a large year is split over tasks by its size
            table.hint("rebalance", "year").write.mode("overwrite").partitionBy("year").parquet(f"{folder}/{name}")
        else:
            table.write.mode("overwrite").parquet(f"{folder}/{name}")


def literal(column: str, kind: str) -> Column:
    """A value as SQL writes it: quotes doubled, nulls named, truth as 1 and 0."""
    c = F.col(column)
    if kind == "string":
        said = F.concat(F.lit("N'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))
    else:
        said = c.cast("int").cast("string") if kind == "boolean" else c.cast("string")
    return F.coalesce(said, F.lit("NULL"))


def statements(df: DataFrame, table: str, by: str) -> DataFrame:
    """(by, first, text): INSERT statements of BATCH tuples at most, a tuple a line, of rows sorted by by in each task;
    first is the place in its task of a statement's first tuple."""
    import pyarrow as pa

    columns, batch = [c for c in df.columns if c != by], BATCH
    tuples = F.concat(F.lit("("), F.concat_ws(", ", *(literal(c, dict(df.dtypes)[c]) for c in columns)), F.lit(")"))
    head = f"INSERT INTO {table} ({', '.join(columns)}) VALUES\n"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, value, first, n = [], None, 0, 0

        def said() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([value], kind), pa.array([first]), pa.array([head + ",\n".join(held) + ";"])], names=[by, "first", "text"])

        for part in batches:
            kind = part.schema.field(0).type
            for v, line in zip(*(c.to_pylist() for c in part.columns)):
                if held and (v != value or len(held) == batch):
                    yield said()
                    held = []
                if not held:
                    value, first = v, n
                held.append(line)
                n += 1
        if held:
            yield said()

    kind = dict(df.dtypes)[by]
    return df.select(by, tuples.alias("tuple")).mapInArrow(run, f"{by} {kind}, first long, text string")


def sql_dump(df: DataFrame, table: str, order: str, folder: str, year: str = "year", rows_per_file: int = 1_000_000) -> None:
    """A dump by year, compressed: folder/year=Y/part-*.gz, of some rows_per_file rows each.  A year's statements stand in
    the order of the key, over its files by their names.  Rows are dealt by ranges of year and key, so a year may be the
    work of many tasks."""
    dealt = df.repartitionByRange(df.count() // rows_per_file + 1, year, order).sortWithinPartitions(year, order)
    made = statements(dealt, table, year).sortWithinPartitions(year, "first").select(year, "text")
    made.write.mode("overwrite").partitionBy(year).option("compression", "gzip").text(folder)


def browse_feed(entities: DataFrame, years: DataFrame) -> DataFrame:
    """One row (feed): the JSON object {entities, years}, both in the order of their first column.  Dimensions of some
    hundred rows, which is what makes a feed of one object."""

    def listed(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name))

    return listed(entities, "entities").crossJoin(listed(years, "years")).select(F.to_json(F.struct("entities", "years")).alias("feed"))


def dictionary(entries: DataFrame, folder: str, book: str = "book") -> DataFrame:
    """Writes dictionaries of entries(book, headwords, body) as files and gives (book, entries, bytes), a row each."""
    stardict.write(entries, folder, book)
    return stardict.books(entries.sparkSession, folder).select("book", "entries", "bytes")


def missing_books(expected: DataFrame, folder: str) -> DataFrame:
    """expected(book) of which a file is absent or empty, with what is there."""
    there = stardict.books(expected.sparkSession, folder).select("book", "parts")
    return expected.join(there, "book", "left").where(F.coalesce(F.size("parts"), F.lit(0)) < len(stardict.PARTS))
