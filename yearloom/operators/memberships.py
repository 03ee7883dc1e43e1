"""Organisations that entities belong to: lists in contents as rows, who joined and left when, and their network.

No two entities are paired through an organisation: an organisation is a node, so one that all entities belong to costs a
row for each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

MEMBER = "member"


def listed(fields: DataFrame, content: str = "content") -> DataFrame:
    """fields(master_id, year, content) as (master_id, year, organisation, standing), once each.

    Names stand between commas or semicolons outside of brackets; what follows "note:" isn't one.  Brackets behind a name
    tell its standing, in lower case; without any it is that of a member, which also counts where an edition tells
    several, else the first in order.  Null and blank contents, keys and years give nothing.
    """
    text = F.regexp_replace(F.col(content), r"(?is)\bnote\s*:.*$", "")
    parts = F.transform(F.split(text, r"[,;](?![^()]*\))"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    rows = fields.where("master_id IS NOT NULL AND year IS NOT NULL").select("master_id", "year", F.explode(F.filter(parts, lambda p: p != "")).alias("_part"))
    told = F.lower(F.trim(F.regexp_extract("_part", r"\(([^()]*)\)$", 1)))
    name = F.trim(F.regexp_replace("_part", r"\([^()]*\)$", ""))
    rows = rows.select("master_id", "year", name.alias("organisation"), F.when(told != "", told).otherwise(MEMBER).alias("standing")).where("organisation <> ''")
    first = F.min(F.struct((F.col("standing") != MEMBER).alias("other"), "standing"))["standing"]
    return rows.groupBy("master_id", "year", "organisation").agg(first.alias("standing"))


def moves(memberships: DataFrame, editions: DataFrame) -> DataFrame:
    """(master_id, organisation, year, move): joined in the first edition that lists what the one before didn't, left in the
    first that lists it no more.

    editions(master_id, year) are those that tell of memberships at all: years without one neither end nor begin any, and
    what an entity's first edition lists was there before.
    """
    own = editions.where("master_id IS NOT NULL AND year IS NOT NULL").select("master_id", "year").distinct()
    w = W.partitionBy("master_id").orderBy("year")
    own = own.select("master_id", "year", F.row_number().over(w).alias("_at"), F.lead("year").over(w).alias("_next"))
    placed = memberships.select("master_id", "organisation", "year").distinct().join(own, ["master_id", "year"])
    # An entity has a row for each of its editions in an organisation.
    w = W.partitionBy("master_id", "organisation").orderBy("_at")
    joined = F.when((F.col("_at") > 1) & ~F.lag("_at").over(w).eqNullSafe(F.col("_at") - 1), F.struct(F.col("year"), F.lit("joined").alias("move")))
    left = F.when(F.col("_next").isNotNull() & ~F.lead("_at").over(w).eqNullSafe(F.col("_at") + 1), F.struct(F.col("_next").alias("year"), F.lit("left").alias("move")))
    both = placed.select("master_id", "organisation", F.array_compact(F.array(joined, left)).alias("_moves"))
    return both.select("master_id", "organisation", F.inline("_moves"))


def sizes(memberships: DataFrame, moves: DataFrame) -> DataFrame:
    """(organisation, year, members, others, joined, left): entities of each standing, and moves, by year; years with
    neither are left out."""
    n = memberships.select("organisation", "year", (F.col("standing") == MEMBER).cast("int").alias("m"), (F.col("standing") != MEMBER).cast("int").alias("o"), F.lit(0).alias("j"), F.lit(0).alias("l"))
    moved = moves.select("organisation", "year", F.lit(0).alias("m"), F.lit(0).alias("o"), (F.col("move") == "joined").cast("int").alias("j"), (F.col("move") == "left").cast("int").alias("l"))
    names = {"m": "members", "o": "others", "j": "joined", "l": "left"}
    return n.unionByName(moved).groupBy("organisation", "year").agg(*(F.sum(c).alias(out) for c, out in names.items()))


def ties(memberships: DataFrame, year: int) -> DataFrame:
    """(source, target, weight) of one year's memberships for network.ranks and network.cores, both ways between entity:<key>
    and organisation:<name>; a full member's tie weighs 1, any other's a half."""
    entity, org = F.concat(F.lit("entity:"), F.col("master_id").cast("string")), F.concat(F.lit("organisation:"), F.col("organisation"))
    weight = F.when(F.col("standing") == MEMBER, 1.0).otherwise(0.5)
    rows = memberships.where(F.col("year") == year).select(entity.alias("source"), org.alias("target"), weight.alias("weight"))
    return rows.union(rows.select("target", "source", "weight"))
