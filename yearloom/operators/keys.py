"""Surrogate keys and ranks over a whole table, without a window over all of it.

Rows are dealt to tasks by ranges of the order and sorted there; only a few figures of each range (how many rows, which
values at its ends) meet in one place.  What was dealt is written to the shared folder first, since ranges are sampled and
a task that ran again could get other ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from yearloom.sources import storage

RANGE, PLACE = "_range", "_place"


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have, whatever case it is written in."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def dealt(df: DataFrame, order: list[Column]) -> DataFrame:
    """df in ranges of the order: with _range, and _place from 0 on in it.

    Rows that are equal in the order go by a hash of the whole row, so that a key of many rows is cut into several ranges.
    """
    hashed = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    order = [*order, F.xxhash64(*hashed)] if hashed else order
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(PLACE, F.monotonically_increasing_id())
    placed = placed.withColumns({RANGE: F.shiftright(PLACE, 33).cast("int"), PLACE: F.col(PLACE).bitwiseAND((1 << 33) - 1)})
    folder = storage.new_folder(df.sparkSession, "dealt")
    placed.write.parquet(folder)
    return df.sparkSession.read.schema(placed.schema).parquet(folder)


def _before(ranges: DataFrame, n: str, out: str) -> DataFrame:
    """ranges(_range, ...) with the sum of n over those before; a row for each task of a shuffle."""
    w = W.orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    return ranges.withColumn(out, F.coalesce(F.sum(n).over(w), F.lit(0)))


def numbered(df: DataFrame, order: list[str | Column], out: str) -> DataFrame:
    """df with out, gapless from 1 in the given order (nulls first); keys may be of any type that sorts.

    Rows equal in the order stand in any order.  A column of df named out is replaced.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = dealt(df, keys)
    counts = _before(placed.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n")), "_n", "_before").select(RANGE, "_before")
    # A row for each range.
    numbers = placed.join(F.broadcast(counts), RANGE).withColumn(out, F.col("_before") + F.col(PLACE) + 1)
    return numbers.select(*(c for c in df.columns if c.lower() != out.lower()), out)


def ranked(df: DataFrame, by: Column, tiles: int = 4, ascending: bool = True) -> DataFrame:
    """df with rank, dense_rank and tile of a whole table by one value, ties and all; nulls come first, last if not ascending.

    A value that many rows share may lie in several ranges: the first of them to have it tells its rank, and every range
    takes over what the one before ended with.  Tiles are those of ntile: of n rows the first n % tiles tiles get one more.
    Rows of equal value go to tiles in any order.
    """
    key = fresh(df, "_key")
    placed = dealt(df.withColumn(key, by), [F.col(key) if ascending else F.col(key).desc()])
    # In a range values are sorted, so a value's first place in it and the number of values before it are local figures.
    inside = W.partitionBy(RANGE).orderBy(PLACE).rowsBetween(W.unboundedPreceding, 0)
    began = F.lag(F.struct(key)).over(W.partitionBy(RANGE).orderBy(PLACE))
    new = began.isNull() | ~F.coalesce(began[key].eqNullSafe(F.col(key)), F.lit(False))
    placed = placed.withColumn("_new", new).withColumns(
        {"_first": F.max(F.when(F.col("_new"), F.col(PLACE))).over(inside), "_values": F.sum(F.col("_new").cast("long")).over(inside)}
    )
    ends = placed.groupBy(RANGE).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_values").alias("_v"), F.min_by(F.struct(key), PLACE).alias("_lo"), F.max_by(F.struct(key), PLACE).alias("_hi"), F.max("_first").alias("_hi_at")
    )
    ends = _before(ends, "_n", "_before")
    order = W.orderBy(RANGE)
    # Whether the first value of a range is the last one of the range before: then it counts once, and its rank is older.
    ends = ends.withColumn("_on", F.coalesce(F.lag("_hi").over(order)[key].eqNullSafe(F.col("_lo")[key]) & F.lag(F.lit(1)).over(order).isNotNull(), F.lit(False)))
    own = F.col("_v") - F.col("_on").cast("long")
    ends = ends.withColumn("_seen", F.coalesce(F.sum(own).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) - F.col("_on").cast("long"))
    # Where the last value of a range began: in it, unless the range has no other value and goes on with an older one.
    began_at = F.when((F.col("_v") > 1) | ~F.col("_on"), F.col("_before") + F.col("_hi_at"))
    ends = ends.withColumn("_since", F.last(began_at, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)))
    total = ends.agg(F.sum("_n").alias("n"))
    tasks = F.broadcast(ends.select(RANGE, "_before", "_on", "_seen", "_since"))
    rows = placed.join(tasks, RANGE).withColumn("_total", F.coalesce(total.scalar(), F.lit(0)))
    older = F.col("_on") & (F.col("_values") == 1)
    at, large, small = F.col("_before") + F.col(PLACE), F.floor(F.col("_total") / tiles) + 1, F.floor(F.col("_total") / tiles)
    over = F.col("_total") % tiles
    tile = F.when(at < over * large, F.floor(at / large)).otherwise(over + F.floor((at - over * large) / F.greatest(small, F.lit(1))))
    return rows.select(
        *(c for c in df.columns if c.lower() not in ("rank", "dense_rank", "tile")),
        (F.when(older, F.col("_since")).otherwise(F.col("_before") + F.col("_first")) + 1).alias("rank"),
        (F.col("_seen") + F.col("_values")).alias("dense_rank"),
        (tile + 1).cast("int").alias("tile"),
    )


def ranked_within(df: DataFrame, group: list[str], by: Column, ascending: bool = True) -> DataFrame:
    """df with rank and dense_rank within groups of any size, ties and all; null values come first, last if not ascending.

    All groups are ranked as one order, by group and then value, so a group that holds most rows is dealt like any other;
    a group's own ranks start where its first row stands.  Null is a group too.
    """
    key = fresh(df, "_by")
    rows = ranked(df.withColumn(key, by), F.struct(*group, key), 1, ascending).drop("tile")
    starts = rows.groupBy(*(F.col(c).alias(f"_g{i}") for i, c in enumerate(group))).agg(F.min("rank").alias("_rank"), F.min("dense_rank").alias("_dense"))
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    own = rows.join(starts, same).withColumns({"rank": F.col("rank") - F.col("_rank") + 1, "dense_rank": F.col("dense_rank") - F.col("_dense") + 1})
    return own.select(*(c for c in df.columns if c.lower() not in ("rank", "dense_rank")), "rank", "dense_rank")
