"""Editions as a stream: an extension, as almanacs come once a year.

New fields are parsed as they come and replace their edition; events are counted in windows of time with late ones let in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from yearloom.functions import subvalues


def values_of(fields: DataFrame, among: list[str] | None = None) -> DataFrame:
    """Sub-values of fields(year, field_id, canonical, content), batch or stream: no shuffle, no state."""
    return subvalues.extract(fields.select("year", "field_id", "canonical", "content"), "canonical", "content", among=among)


def ingest(fields: DataFrame, folder: str, checkpoint: str, among: list[str] | None = None) -> StreamingQuery:
    """Writes the sub-values of a stream of fields under folder by year; ends when all that is there has been read.

    A year that comes again replaces what was written for it, as a reload of an edition does; a batch that is run again
    after a failure writes the same.  An edition therefore has to come within one batch.  among: the canonical names that
    may come, which keeps the plan of each batch small.
    """

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(folder)

    return values_of(fields, among).writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream of the Parquet files that come to a folder, one file a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def windowed(events: DataFrame, time: str, kind: str, value: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, end, kind, n, total) of events by windows of time; in a stream, state is kept until the watermark passes."""
    keyed = events.withWatermark(time, late).groupBy(F.window(time, size), kind)
    return keyed.agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select("window.start", "window.end", F.col(kind).alias("kind"), "n", "total")
