"""Indicators over the years: who ranks where and how that moves, who leads how long, what two indicators say of each other,
which fields are covered when, and regions as sums of their entities.

An indicator is a canonical field with one of its sub-values; a series has one value for each entity, year and indicator.
Groups of a rank may be of any size (keys.ranked_within); windows here lie within one entity's years of one indicator or
field, whose number is that of the editions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from . import keys

#: Series of all the world and of unions would count twice in sums (fixed values).
AGGREGATES = ["World", "European Union"]


def series(values: DataFrame, fields: DataFrame, countries: DataFrame, mappings: DataFrame) -> DataFrame:
    """(master_id, year, indicator, value): of several values of one entity, year and indicator that of the last field,
    there the largest.  Null values, fields without a mapping and editions without an entity are left out."""
    named = fields.join(mappings.select(F.col("original").alias("field_name"), "canonical"), "field_name")
    rows = values.where("numeric_val IS NOT NULL").join(named.select("field_id", "country_id", "canonical"), "field_id")
    rows = rows.join(countries.where("master_id IS NOT NULL").select("country_id", "master_id", "year"), "country_id")
    indicator = F.concat_ws(": ", "canonical", "sub_field").alias("indicator")
    last = F.max(F.struct("field_id", "numeric_val"))["numeric_val"]
    return rows.groupBy("master_id", "year", indicator).agg(last.alias("value"))


def race(series: DataFrame) -> DataFrame:
    """series with rank and dense_rank within indicator and year, the largest first, previous (the entity's rank in the
    year that it was ranked in before, null in its first) and moved (places won since).  Ties share a rank."""
    rows = keys.ranked_within(series, ["indicator", "year"], F.col("value"), ascending=False)
    before = F.lag("rank").over(W.partitionBy("indicator", "master_id").orderBy("year"))
    return rows.withColumn("previous", before).withColumn("moved", F.col("previous") - F.col("rank"))


def leaders(ranked: DataFrame) -> DataFrame:
    """(indicator, master_id, first_year, last_year, editions): unbroken stretches of an entity at the top of an indicator.

    A stretch goes on as long as the entity leads in each year that has the indicator; years without it don't break one.
    Entities that share the top lead both.
    """
    # Years of an indicator are numbered once, a row for each of its years.
    years = ranked.select("indicator", "year").distinct().withColumn("_at", F.row_number().over(W.partitionBy("indicator").orderBy("year")))
    top = ranked.where("rank = 1").join(years, ["indicator", "year"])
    run = F.col("_at") - F.row_number().over(W.partitionBy("indicator", "master_id").orderBy("year"))
    stretches = top.withColumn("_run", run).groupBy("indicator", "master_id", "_run")
    return stretches.agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count(F.lit(1)).alias("editions")).drop("_run")


def scatter(series: DataFrame, x: str, y: str, limit: float = 2.0) -> DataFrame:
    """(master_id, year, x, y, residual, deviations, outlier) of entities that have both indicators in a year.

    The line is fitted to each year; deviations is the residual over the residuals' standard deviation (n - 2), null where
    fewer than three points, equal x or a line that meets all points leave none.  The two indicators are set side by side
    by one grouping; the fits, a row for each year, meet the points again.
    """
    pick = lambda name, out: F.max(F.when(F.col("indicator") == name, F.col("value"))).alias(out)
    points = series.where(F.col("indicator").isin(x, y)).groupBy("master_id", "year").agg(pick(x, "x"), pick(y, "y")).where("x IS NOT NULL AND y IS NOT NULL")
    of = lambda f: f(F.col("y"), F.col("x"))
    fits = points.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), of(F.regr_slope).alias("slope"), of(F.regr_intercept).alias("base"),
        of(F.regr_syy).alias("syy"), (of(F.regr_syy) - of(F.regr_slope) * of(F.regr_sxy)).alias("left"),
    )
    # What rounding leaves of a perfect fit is no spread.
    spread = F.when((F.col("n") > 2) & (F.col("left") > 1e-9 * F.col("syy")), F.sqrt(F.col("left") / (F.col("n") - 2)))
    rows = points.join(fits.select("year", "slope", "base", spread.alias("spread")), "year")
    rows = rows.withColumn("residual", F.col("y") - F.col("base") - F.col("slope") * F.col("x")).withColumn("deviations", F.col("residual") / F.col("spread"))
    return rows.select("master_id", "year", "x", "y", "residual", "deviations", F.coalesce(F.abs("deviations") > limit, F.lit(False)).alias("outlier"))


def held(fields: DataFrame, countries: DataFrame, mappings: DataFrame) -> DataFrame:
    """(master_id, canonical, year), once, where an entity's edition says anything under a field that isn't noise."""
    names = mappings.where("coalesce(is_noise, 0) = 0").select(F.col("original").alias("field_name"), "canonical")
    rows = fields.where(F.trim("content") != "").select("country_id", "field_name").join(names, "field_name")
    return rows.join(countries.where("master_id IS NOT NULL").select("country_id", "master_id", "year"), "country_id").select("master_id", "canonical", "year").distinct()


def coverage(held: DataFrame, countries: DataFrame) -> DataFrame:
    """(canonical, year, entities, share) for each field and each year of the archive, zeros too: entities that have the
    field, and their share of the entities of that year's edition, to six places."""
    edition = countries.where("master_id IS NOT NULL").groupBy("year").agg(F.count_distinct("master_id").alias("of"))
    n = held.groupBy("canonical", "year").agg(F.count(F.lit(1)).alias("entities"))
    # Fields and years are the two edges of the matrix; years, a row for each edition, go to every field as one array.
    years = edition.agg(F.collect_set("year").alias("years"))
    grid = n.select("canonical").distinct().select("canonical", F.explode(years.scalar()).alias("year"))
    rows = grid.join(n, ["canonical", "year"], "left").join(edition, "year")
    entities = F.coalesce("entities", F.lit(0))
    return rows.select("canonical", "year", entities.alias("entities"), F.round(entities / F.col("of"), 6).alias("share"))


def spans(held: DataFrame, countries: DataFrame) -> DataFrame:
    """(master_id, canonical, first_year, last_year, editions, missing, longest): a field of an entity over its own editions.

    missing counts the entity's editions between the first and the last that lack the field, longest is the most editions
    in a row that have it.
    """
    own = countries.where("master_id IS NOT NULL").select("master_id", "year").distinct()
    own = own.withColumn("_at", F.row_number().over(W.partitionBy("master_id").orderBy("year")))
    placed = held.join(own, ["master_id", "year"])
    w = W.partitionBy("master_id", "canonical")
    runs = placed.withColumn("_run", F.col("_at") - F.row_number().over(w.orderBy("year"))).groupBy("master_id", "canonical", "_run")
    n = F.count(F.lit(1)).alias("n")
    runs = runs.agg(F.min("year").alias("a"), F.max("year").alias("b"), F.min("_at").alias("i"), F.max("_at").alias("j"), n)
    total = F.sum("n")
    return runs.groupBy("master_id", "canonical").agg(
        F.min("a").alias("first_year"), F.max("b").alias("last_year"), total.alias("editions"), (F.max("j") - F.min("i") + 1 - total).alias("missing"), F.max("n").alias("longest")
    )


def rolled_up(series: DataFrame, regions: DataFrame, names: DataFrame, last: int | Column, carry: int = 2) -> DataFrame:
    """(region, indicator, year, entities, carried, total): sums over regions(master_id, region).

    An entity that lacks a year keeps its last value for up to carry years, up to the year last; carried counts such
    values.  AGGREGATES, by names(master_id, name), and entities without a region are left out.
    """
    till = F.lead("year").over(W.partitionBy("master_id", "indicator").orderBy("year")) - 1
    # A value is good for the years until the next one: no grid of years is made and filled.
    until = F.least(F.coalesce(till, F.lit(9999)), F.col("year") + carry, F.greatest(F.lit(last), F.col("year")))
    good = series.select("master_id", "indicator", "value", F.col("year").alias("told"), until.cast("int").alias("_until"))
    good = good.select("master_id", "indicator", "value", "told", F.explode(F.sequence("told", "_until")).alias("year"))
    kept = names.where(~F.col("name").isin(AGGREGATES)).select("master_id").join(regions.where("region IS NOT NULL"), "master_id")
    rows = good.join(kept, "master_id").groupBy("region", "indicator", "year")
    return rows.agg(F.count(F.lit(1)).alias("entities"), F.count_if(F.col("told") < F.col("year")).alias("carried"), F.sum("value").alias("total"))
