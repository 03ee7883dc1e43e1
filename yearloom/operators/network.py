"""Networks of weighted edges: ranks by random walks and cores by degree.

Both are iterations over a table of edges that is written once.  Each round joins it with one figure a node, adds up by
the other end (partial sums first, so a hub's many edges meet as few rows), writes the result to the shared folder, which
cuts the lineage, and drops that of the round before.  The edges of a hub are dealt to portions of HUB edges, and its
figure is repeated for each, so no task has all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

from yearloom.sources import storage

HUB = 100_000
#: Names that stand for many entities; they take no part in totals (fixed values).
WHOLES = ("World", "European Union")


class Rounds:
    """Tables that are written round by round; all but the last two go, as one round reads the one before."""

    def __init__(self, spark: SparkSession):
        self.spark, self.old = spark, []

    def kept(self, df: DataFrame) -> DataFrame:
        folder = storage.new_folder(self.spark, "round")
        df.write.parquet(folder)
        self.old.append(folder)
        while len(self.old) > 2:
            storage.drop_folder(self.spark, self.old.pop(0))
        return self.spark.read.schema(df.schema).parquet(folder)


def edges(df: DataFrame, source: str, target: str, weight: str) -> DataFrame:
    """(source, target, weight): one row for each pair of different nodes; null ends and weights, weights of 0 or less, and
    names of wholes are left out."""
    rows = df.select(F.col(source).alias("source"), F.col(target).alias("target"), F.col(weight).cast("double").alias("weight"))
    rows = rows.where("source <> target AND weight > 0")
    if dict(rows.dtypes)["source"] == "string":
        rows = rows.where(~F.col("source").isin(*WHOLES) & ~F.col("target").isin(*WHOLES))
    return rows.groupBy("source", "target").agg(F.sum("weight").alias("weight"))


def _dealt(links: DataFrame, node: str, other: str, hub: int) -> tuple[DataFrame, DataFrame]:
    """links with a portion, and (node, portions)."""
    sized = links.groupBy(node).agg(F.floor((F.count(F.lit(1)) - 1) / hub).cast("int").alias("portions"))
    dealt = links.join(sized, node).withColumn("portion", F.pmod(F.xxhash64(other), F.col("portions") + 1).cast("int")).drop("portions")
    return dealt, sized


def ranks(links: DataFrame, damping: float = 0.85, near: float = 1e-10, most: int = 200, hub: int = HUB) -> DataFrame:
    """(node, rank): how often a walk is at a node that follows edges by weight and starts anew, anywhere, with 1 - damping;
    it also does from nodes without edges.  Ranks add up to 1 and have settled to near in sum, after most rounds at most.
    """
    spark, rounds = links.sparkSession, Rounds(links.sparkSession)
    out = links.groupBy("source").agg(F.sum("weight").alias("_all"))
    moves = links.join(out, "source").select("source", "target", (F.col("weight") / F.col("_all")).alias("share"))
    dealt, sized = _dealt(moves, "source", "target", hub)
    fixed = Rounds(spark)
    dealt, nodes = fixed.kept(dealt), links.select(F.col("source").alias("node")).union(links.select("target")).distinct()
    nodes = fixed.kept(nodes.join(sized.withColumnRenamed("source", "node"), "node", "left"))
    n = nodes.count()
    if not n:
        return nodes.select("node", F.lit(None).cast("double").alias("rank"))
    now = rounds.kept(nodes.select("node", "portions", F.lit(1.0 / n).alias("rank"), F.lit(0.0).alias("moved")))
    for _ in range(most):
        lost = now.where("portions IS NULL").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("x"))
        spread = now.where("portions IS NOT NULL").select(F.col("node").alias("source"), "rank", F.explode(F.sequence(F.lit(0), F.col("portions"))).alias("portion"))
        came = dealt.join(spread, ["source", "portion"]).groupBy(F.col("target").alias("node")).agg(F.sum(F.col("rank") * F.col("share")).alias("came"))
        new = (1 - damping) / n + damping * (F.coalesce("came", F.lit(0.0)) + lost.scalar() / n)
        now = rounds.kept(now.join(came, "node", "left").select("node", "portions", new.alias("rank"), F.abs(new - F.col("rank")).alias("moved")))
        if now.agg(F.sum("moved").alias("x")).first()["x"] < near:
            break
    return now.select("node", "rank")


def cores(links: DataFrame) -> DataFrame:
    """(node, core): the largest k for which the node is in a part of the network where all have k neighbours at least.

    Each node starts from its degree and takes, round by round, the largest h so that h neighbours have h or more; what
    this settles to are the cores.  Values of a node's neighbours are counted, not listed.
    """
    spark, rounds, fixed = links.sparkSession, Rounds(links.sparkSession), Rounds(links.sparkSession)
    both = links.select(F.col("source").alias("a"), F.col("target").alias("b"))
    both = fixed.kept(both.union(both.select("b", "a")).distinct())
    now = rounds.kept(both.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("core"), F.lit(True).alias("moved")))
    while now.where("moved").limit(1).count():
        near = both.join(now.select(F.col("node").alias("b"), "core"), "b").join(now.select(F.col("node").alias("a"), F.col("core").alias("own")), "a")
        counts = near.groupBy("a", F.least("core", "own").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.first("own").alias("own"))
        # A row for each value that neighbours have, the own one at most.
        above = F.sum("n").over(W.partitionBy("a").orderBy(F.desc("h")))
        found = counts.withColumn("n", above).groupBy(F.col("a").alias("node")).agg(F.max(F.least("h", "n")).alias("core"), F.first("own").alias("own"))
        now = rounds.kept(found.select("node", "core", (F.col("core") < F.col("own")).alias("moved")))
    return now.select("node", "core")
