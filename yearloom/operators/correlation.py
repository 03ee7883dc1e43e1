"""Correlation and regression of every pair of variables over the observations that have both.

Rows say (observation, variable, value).  Variables are numbered and dealt to blocks of BLOCK; an observation's values go
once to each pair of blocks that it has values in, where a task adds up six sums for each pair of variables (how many,
both values, their squares, their product).  No row is joined with another, and a task holds the sums of one pair of
blocks, whatever the number of variables.  Values are taken from their variable's mean first, which changes no result and
keeps digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

BLOCK = 128
#: Observations of a pair of blocks that one task adds up.
PORTION = 200_000
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def pairwise(df: DataFrame, observation: str, variable: str, value: str, block: int = BLOCK) -> DataFrame:
    """(x, y, n, corr, slope, intercept) of each pair of variables x < y that some observation has both of.

    slope and intercept are those of y by x.  Several values of a variable in one observation count as their mean; null
    and NaN values count as missing, as do rows with a null observation or variable.  corr is null where either variable
    doesn't vary over the n observations, slope and intercept where x doesn't.
    """
    import pyarrow as pa

    known = df.select(F.col(observation).alias("o"), F.col(variable).alias("v"), F.col(value).cast("double").alias("a"))
    known = known.where("o IS NOT NULL AND v IS NOT NULL AND a IS NOT NULL AND NOT isnan(a)").groupBy("o", "v").agg(F.avg("a").alias("a"))
    # A row for each variable.
    names = known.groupBy("v").agg(F.avg("a").alias("mean")).withColumn("i", F.row_number().over(W.orderBy("v")) - 1)
    rows = known.join(names, "v").select("o", "i", (F.col("a") - F.col("mean")).alias("a"))
    rows = rows.groupBy("o", F.floor(F.col("i") / block).cast("int").alias("b")).agg(F.collect_list(F.struct("i", "a")).alias("has"))
    blocks = rows.groupBy("o").agg(F.collect_list(F.struct("b", "has")).alias("blocks"))
    pairs = F.flatten(F.transform("blocks", lambda x: F.transform(F.filter("blocks", lambda y: x["b"] <= y["b"]), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    met = blocks.select("o", F.inline(pairs)).select("o", "x", "y")
    portions = known.select("o").distinct().count() // PORTION + 1
    at = [F.col("x.b").alias("bx"), F.col("y.b").alias("by"), F.pmod(F.xxhash64("o"), F.lit(portions)).alias("p")]
    met = met.select(*at, *(F.col(f"{s}.has.{k}").alias(s + k) for s in "xy" for k in "ia"))
    met = met.repartition("bx", "by", "p").sortWithinPartitions("bx", "by", "p")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sums = None, None

        def told() -> pa.RecordBatch:
            i, j = np.nonzero(sums[0])
            x, y = i + place[0] * block, j + place[1] * block
            keep = x < y
            columns = [pa.array(x[keep], pa.int64()), pa.array(y[keep], pa.int64()), *(pa.array(s[i, j][keep], pa.float64()) for s in sums)]
            return pa.RecordBatch.from_arrays(columns, names=["i", "j", *SUMS])

        def dense(index: pa.ListArray, values: pa.ListArray, start: int) -> np.ndarray:
            """A row for each observation; NaN where it has no value."""
            out = np.full((len(index), block), np.nan)
            lengths = np.diff(index.offsets.to_numpy())
            out[np.repeat(np.arange(len(index)), lengths), index.flatten().to_numpy() - start] = values.flatten().to_numpy()
            return out

        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                batch = whole.slice(begin, 1024)
                bx, by = (batch.column(k).to_numpy() for k in (0, 1))
                cuts = [0, *(np.flatnonzero((bx[1:] != bx[:-1]) | (by[1:] != by[:-1])) + 1), len(bx)]
                for a, b in zip(cuts, cuts[1:]):
                    if place != (bx[a], by[a]):
                        if place is not None:
                            yield told()
                        place, sums = (int(bx[a]), int(by[a])), np.zeros((6, block, block))
                    x, y = (dense(*(pa.concat_arrays([batch.column(k).slice(a, b - a)]) for k in ks), place[s] * block) for s, ks in enumerate(((3, 4), (5, 6))))
                    hx, hy = (~np.isnan(m) for m in (x, y))
                    x, y, hx, hy = np.nan_to_num(x), np.nan_to_num(y), hx.astype(float), hy.astype(float)
                    for k, (left, right) in enumerate(((hx, hy), (x, hy), (hx, y), (x * x, hy), (hx, y * y), (x, y))):
                        sums[k] += left.T @ right
        if place is not None:
            yield told()

    found = met.mapInArrow(added, "i long, j long, " + ", ".join(f"{s} double" for s in SUMS))
    found = found.groupBy("i", "j").agg(*(F.sum(s).alias(s) for s in SUMS))
    x, y = (names.select(F.col("i").cast("long").alias(i), F.col("v").alias(n), F.col("mean").alias("m" + n)) for i, n in (("i", "x"), ("j", "y")))
    n = F.col("n")
    vx, vy, c = (n * F.col(a) - F.col(b) * F.col(d) for a, b, d in (("sxx", "sx", "sx"), ("syy", "sy", "sy"), ("sxy", "sx", "sy")))
    slope = F.when(vx > 0, c / vx)
    return found.join(x, "i").join(y, "j").select(
        "x", "y", n.cast("long").alias("n"), F.when((vx > 0) & (vy > 0), c / F.sqrt(vx * vy)).alias("corr"), slope.alias("slope"),
        (F.col("my") + F.col("sy") / n - slope * (F.col("mx") + F.col("sx") / n)).alias("intercept"),
    )
