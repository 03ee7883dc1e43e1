"""Queries over indicators: rankings that move, leaders, outliers, coverage and regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from yearloom.operators import indicators as I, memberships as M
from yearloom.sources.archive import Archive, VIEWS

from .registry import query
from .relational import over_archive

SERIES = """, series AS (SELECT master_id, year, canonical || ': ' || sub_field AS indicator, max({'f': field_id, 'v': numeric_val}).v AS value
 FROM vals JOIN fields USING (field_id) JOIN mappings ON field_name = original JOIN countries USING (country_id) WHERE master_id IS NOT NULL AND numeric_val IS NOT NULL GROUP BY 1, 2, 3)
"""
RANKED = SERIES + """, ranked AS (SELECT *, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank FROM series WINDOW w AS (PARTITION BY indicator, year ORDER BY value DESC))
"""
HELD = """, held AS (SELECT DISTINCT master_id, canonical, year FROM fields JOIN mappings ON field_name = original JOIN countries USING (country_id) WHERE is_noise = 0 AND trim(content) <> '' AND master_id IS NOT NULL)
"""


def series(a):
    return I.series(a.values, a.fields, a.countries, a.mappings)


@over_archive("rank_race", RANKED + """, r AS (SELECT *, lag(rank) OVER (PARTITION BY indicator, master_id ORDER BY year) AS previous FROM ranked)
SELECT *, previous - rank AS moved FROM r""")
def rank_race(a):
    """Every entity's rank in every indicator and year, and the places it won or lost since it was last ranked."""
    return I.race(series(a))


@over_archive("rank_leaders", RANKED + """, y AS (SELECT indicator, year, row_number() OVER (PARTITION BY indicator ORDER BY year) AS pos FROM (SELECT DISTINCT indicator, year FROM series)),
top AS (SELECT indicator, master_id, year, pos - row_number() OVER (PARTITION BY indicator, master_id ORDER BY year) AS run FROM ranked JOIN y USING (indicator, year) WHERE rank = 1)
SELECT indicator, master_id, min(year) AS first_year, max(year) AS last_year, count(*) AS editions FROM top GROUP BY indicator, master_id, run""")
def rank_leaders(a):
    """Who leads an indicator from when to when."""
    return I.leaders(I.race(series(a)))


@over_archive("scatter_outliers", SERIES + """, p AS (SELECT master_id, year, max(value) FILTER (indicator = 'Area: total') AS x, max(value) FILTER (indicator = 'Low: land') AS y FROM series GROUP BY 1, 2 HAVING x IS NOT NULL AND y IS NOT NULL),
f AS (SELECT year, regr_slope(y, x) AS slope, regr_intercept(y, x) AS base, sqrt(sum_left / nullif(n - 2, 0)) AS spread FROM (
 SELECT year, x, y, n, sum((y - base0 - slope0 * x) * (y - base0 - slope0 * x)) OVER (PARTITION BY year) AS sum_left FROM (
  SELECT *, count(*) OVER w AS n, regr_slope(y, x) OVER w AS slope0, regr_intercept(y, x) OVER w AS base0 FROM p WINDOW w AS (PARTITION BY year))) GROUP BY year, sum_left, n)
SELECT master_id, year, x, y, round(y - base - slope * x, 2) AS residual, round((y - base - slope * x) / spread, 4) AS deviations, coalesce(abs((y - base - slope * x) / spread) > 2, false) AS outlier FROM p JOIN f USING (year)""")
def scatter_outliers(a):
    """Entities off the line that two indicators make in a year."""
    points = I.scatter(series(a), "Area: total", "Low: land")
    return points.withColumns({"residual": F.round("residual", 2), "deviations": F.round("deviations", 4)})


@over_archive("coverage_matrix", HELD + """, e AS (SELECT year, count(DISTINCT master_id) AS n FROM countries WHERE master_id IS NOT NULL GROUP BY 1)
SELECT canonical, year, count(held.master_id) AS entities, round(count(held.master_id) / any_value(n), 6) AS share
FROM (SELECT DISTINCT canonical FROM held) CROSS JOIN e LEFT JOIN held USING (canonical, year) GROUP BY 1, 2""")
def coverage_matrix(a):
    """Fields by years: how many entities have them."""
    return I.coverage(I.held(a.fields, a.countries, a.mappings), a.countries)


@over_archive("coverage_spans", HELD + """, own AS (SELECT master_id, year, row_number() OVER (PARTITION BY master_id ORDER BY year) AS pos FROM (SELECT DISTINCT master_id, year FROM countries WHERE master_id IS NOT NULL)),
r AS (SELECT *, pos - row_number() OVER (PARTITION BY master_id, canonical ORDER BY year) AS run FROM held JOIN own USING (master_id, year)),
n AS (SELECT master_id, canonical, run, min(year) AS a, max(year) AS b, min(pos) AS i, max(pos) AS j, count(*) AS n FROM r GROUP BY 1, 2, 3)
SELECT master_id, canonical, min(a) AS first_year, max(b) AS last_year, sum(n)::BIGINT AS editions, (max(j) - min(i) + 1 - sum(n))::BIGINT AS missing, max(n) AS longest FROM n GROUP BY 1, 2""")
def coverage_spans(a):
    """Each entity's fields: since when, until when, with which gaps."""
    return I.spans(I.held(a.fields, a.countries, a.mappings), a.countries)


@query("region_rollup", VIEWS + SERIES + """, s AS (SELECT *, least(coalesce(lead(year) OVER (PARTITION BY master_id, indicator ORDER BY year) - 1, 9999), year + 2, (SELECT max(year) FROM countries)) AS until FROM series),
k AS (SELECT master_id, indicator, value, year AS told, unnest(range(year, until + 1)) AS year FROM s)
SELECT r_name AS region, indicator, k.year::INTEGER AS year, count(*) AS entities, count(*) FILTER (told < k.year) AS carried, sum(value) AS total
FROM k JOIN nation ON n_nationkey = master_id JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3""")
def region_rollup(spark, sf_dir):
    """Regions as sums of their entities, values good for two years."""
    a = Archive.from_star(spark, sf_dir)
    nation, region = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("nation", "region"))
    regions = nation.join(region, F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("n_nationkey").alias("master_id"), F.col("r_name").alias("region"))
    return I.rolled_up(series(a), regions, a.masters, a.countries.agg(F.max("year")).scalar())


ORGS = """WITH m AS (SELECT DISTINCT c_nationkey AS master_id, year(o_orderdate) AS year, 'Body ' || l_suppkey AS organisation, CASE WHEN l_suppkey % 5 = 0 THEN 'observer' ELSE 'member' END AS standing
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
own AS (SELECT *, row_number() OVER w AS pos, lead(year) OVER w AS next_year FROM (SELECT DISTINCT master_id, year FROM m) WINDOW w AS (PARTITION BY master_id ORDER BY year)),
p AS (SELECT master_id, organisation, year, pos, next_year, lag(pos) OVER w AS before, lead(pos) OVER w AS after FROM m JOIN own USING (master_id, year) WINDOW w AS (PARTITION BY master_id, organisation ORDER BY pos)),
moves AS (SELECT master_id, organisation, year, 'joined' AS move FROM p WHERE pos > 1 AND coalesce(before <> pos - 1, true)
 UNION ALL SELECT master_id, organisation, next_year, 'left' FROM p WHERE next_year IS NOT NULL AND coalesce(after <> pos + 1, true))
"""


def told_memberships(spark, sf_dir):
    """Memberships read back from contents: each order lists its suppliers as bodies that the customer's nation belongs to."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    name = F.concat(F.lit("Body "), F.col("l_suppkey").cast("string"), F.when(F.col("l_suppkey") % 5 == 0, " (observer)").otherwise(""))
    # An order has few lines.
    contents = read("lineitem").groupBy("l_orderkey").agg(F.concat(F.array_join(F.collect_list(name), ", "), F.lit(" note: as told, by order")).alias("content"))
    orders = read("orders").join(read("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    fields = contents.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("c_nationkey").alias("master_id"), F.year("o_orderdate").alias("year"), "content")
    return M.listed(fields)


@query("org_moves", ORGS + "SELECT * FROM moves")
def org_moves(spark, sf_dir):
    """Who joined or left which body when."""
    m = told_memberships(spark, sf_dir)
    return M.moves(m, m)


@query("org_sizes", ORGS + """, u AS (SELECT organisation, year, (standing = 'member')::INTEGER AS m, (standing <> 'member')::INTEGER AS o, 0 AS j, 0 AS l FROM m
 UNION ALL SELECT organisation, year, 0, 0, (move = 'joined')::INTEGER, (move = 'left')::INTEGER FROM moves)
SELECT organisation, year, sum(m)::BIGINT AS members, sum(o)::BIGINT AS others, sum(j)::BIGINT AS joined, sum(l)::BIGINT AS "left" FROM u GROUP BY 1, 2""")
def org_sizes(spark, sf_dir):
    """Bodies by year: members, others, and who came and went."""
    m = told_memberships(spark, sf_dir)
    return M.sizes(m, M.moves(m, m))
