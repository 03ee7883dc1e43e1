"""Helpers that several training-data operators share."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The white space that separates words in every contract of this package (fixed values).
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where it is unset and all runs on one machine, as in
    tests, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Deletes what was written to the shared folder, whatever store it is in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a copy in the shared folder.

    Shuffle files that nothing refers to any more go as soon as the driver's garbage is collected (and older copies too,
    on a cluster that sets spark.cleaner.referenceTracking.cleanCheckpoints), which a driver under no memory pressure puts
    off; so it is asked here, else the rounds of an iteration pile up on disk.
    """
    shared_folder(df.sparkSession)
    copy = df.checkpoint(eager=True)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return copy


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have, whatever case it is written in."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns named by their place, so that none clashes with a name used on the way."""
    return df.toDF(*(f"_c{i}" for i in range(len(df.columns))))


def named_back(df: DataFrame, columns: list[str], new: tuple[str, ...]) -> DataFrame:
    """The columns of the numbered table under their own names, those of new names left out, then the new ones."""
    old = [F.col(f"_c{i}").alias(c) for i, c in enumerate(columns) if c.lower() not in new]
    return df.select(*old, *new)


def place(df: DataFrame, column: str) -> str:
    """What numbered() calls a column."""
    return f"_c{[c.lower() for c in df.columns].index(column.lower())}"


def lowest(df: DataFrame, key: Column, most: int, ties: list[str], shrink: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows of least key (a hash of all that tells rows apart), most at most; shrink makes them small before they meet.

    A count first sets a bound below which some four times as many rows lie, so that what meets in one place to be sorted
    doesn't grow with the input.  Where so many rows are equal that none lies below it, all are sorted.
    """
    n = df.count()
    if n > 8 * most:
        low = df.where(key < -(1 << 63) + (1 << 64) * 4 * most // n)
        df = df if low.isEmpty() else low
    if shrink is not None:
        df = shrink(df)
    return df.orderBy(key, *ties).limit(most)


def ranked(keys: DataFrame, order: list[Column], rank: str = "rank") -> tuple[DataFrame, int]:
    """keys with a gapless global position from 0 in the given order, and the number of rows.

    One range shuffle of the key columns; no task sees more than its range.  A row's place inside its range is frozen by
    the checkpoint, and only one count per range is summed up in a single place.
    """
    placed = checkpoint(
        keys.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_place", 33))
    )
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # A row per range, not per key: ranges number as many as shuffle partitions.
    tallies = sorted((r["_range"], r["_n"]) for r in counts.collect())
    total, offsets = 0, []
    for part, n in tallies:
        offsets += [F.lit(part), F.lit(total)]
        total += n
    if not offsets:
        return placed.withColumn(rank, F.lit(0).cast("long")).drop("_place", "_range"), 0
    offset = F.element_at(F.create_map(*offsets), F.col("_range")).cast("long")
    return placed.withColumn(rank, offset + F.col("_place").bitwiseAND((1 << 33) - 1)).drop("_place", "_range"), total


def appended(df: DataFrame, fields: str, function, *inputs: str) -> DataFrame:
    """df with further columns that function(*columns as lists) gives as lists, batch by batch in Arrow.

    fields is a DDL list of the new columns; a column of df with such a name is replaced.
    """
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    new = T.StructType.fromDDL(fields)
    names = {f.name.lower() for f in new}
    df_in = df
    kept = [c for c in df.columns if c.lower() not in names]
    # Inputs are read under names of their own, so that one may be replaced.
    at = {c: i for i, c in enumerate(df_in.columns)}
    spots = [at[c] for c in inputs]
    keep_spots = [at[c] for c in kept]
    schema = T.StructType([df_in.schema[c] for c in kept] + new.fields)
    kinds = [to_arrow_type(f.dataType) for f in new]

    def run(batches):
        call = function()
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                out = call(*(batch.column(i).to_pylist() for i in spots))
                arrays = [batch.column(i) for i in keep_spots] + [pa.array(v, k) for v, k in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df_in.mapInArrow(run, schema)
