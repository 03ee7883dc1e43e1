"""Scans, filters, joins, aggregates, windows, sorts and set operations over the archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

from yearloom.operators import correlation, matching, network
from yearloom.sources.archive import VIEWS as V, Archive

from .registry import query


def over_archive(name: str, sql: str | None = None):
    """Registers f(archive) with the archive of the star tables."""

    def put(f):
        @query(name, None if sql is None else V + sql)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Archive.from_star(spark, sf_dir))

        run.__doc__ = f.__doc__
        return f

    return put


def star(a: Archive) -> DataFrame:
    """Fields with their mapping, edition and entity; the dimensions are small and broadcast by their size."""
    return (
        a.fields.join(a.mappings, a.fields.field_name == a.mappings.original)
        .join(a.countries.withColumnRenamed("name", "country_name").drop("code"), "country_id")
        .join(a.masters, "master_id")
    )


STAR = """ FROM fields f JOIN mappings m ON f.field_name = m.original JOIN countries c ON f.country_id = c.country_id
 JOIN masters e ON c.master_id = e.master_id """


@query("scan_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def scan_table(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@query("scan_pruned", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45")
def scan_pruned(spark, sf_dir):
    """Two columns and a predicate; both reach the scan."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_quantity > 45").select("l_orderkey", "l_quantity")


@over_archive("scan_by_year", "SELECT f.field_id, c.year, f.field_name FROM fields f JOIN countries c USING (country_id) WHERE c.year = 1997")
def scan_by_year(a):
    return a.fields.join(a.countries.where("year = 1997"), "country_id").select("field_id", "year", "field_name")


@over_archive("filter_basic", "SELECT country_id, year, code FROM countries WHERE source = 'html' AND (code = 'N03' OR code = 'N05')")
def filter_basic(a):
    return a.countries.where((F.col("source") == "html") & ((F.col("code") == "N03") | (F.col("code") == "N05"))).select("country_id", "year", "code")


@over_archive("filter_in", "SELECT country_id, code FROM countries WHERE code IN ('N01','N02','N04') AND source NOT IN ('text')")
def filter_in(a):
    return a.countries.where(F.col("code").isin("N01", "N02", "N04") & ~F.col("source").isin("text")).select("country_id", "code")


@query("like_search", "SELECT doc_id, lang FROM documents WHERE text ILIKE '%license%' AND text NOT LIKE '%Apache%'")
def like_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.where(F.col("text").ilike("%license%") & ~F.col("text").like("%Apache%")).select("doc_id", "lang")


@query("like_class", "SELECT doc_id FROM documents WHERE regexp_matches(text, '[0-9]')")
def like_class(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("text").rlike("[0-9]")).select("doc_id")


@over_archive("filter_between", "SELECT country_id, year FROM countries WHERE year BETWEEN 1996 AND 1998")
def filter_between(a):
    return a.countries.where(F.col("year").between(1996, 1998)).select("country_id", "year")


@over_archive("filter_cmp", "SELECT master_id, code, iso2 FROM masters WHERE code <> iso2 AND master_id > 3")
def filter_cmp(a):
    return a.masters.where((F.col("code") != F.col("iso2")) & (F.col("master_id") > 3)).select("master_id", "code", "iso2")


@over_archive("null_blank", "SELECT 'no master' AS what, country_id::BIGINT AS id FROM countries WHERE master_id IS NULL UNION ALL SELECT 'blank', field_id FROM fields WHERE content IS NULL OR trim(content) = ''")
def null_blank(a):
    """Editions without an entity, and fields without content."""
    left = a.countries.where("master_id IS NULL").select(F.lit("no master").alias("what"), F.col("country_id").cast("long").alias("id"))
    blank = F.col("content").isNull() | (F.trim("content") == "")
    return left.union(a.fields.where(blank).select(F.lit("blank"), "field_id"))


@over_archive("fallback_chain", "SELECT master_id, coalesce(nullif(iso2, ''), code) AS label FROM masters")
def fallback_chain(a):
    return a.masters.select("master_id", F.coalesce(F.nullif("iso2", F.lit("")), "code").alias("label"))


@over_archive("star_join", "SELECT f.field_id, c.year, e.name AS country, m.canonical" + STAR + "WHERE m.is_noise = 0")
def star_join(a):
    return star(a).where("is_noise = 0").select("field_id", "year", F.col("name").alias("country"), "canonical")


@over_archive("snowflake_join", "SELECT c.name, g.title, count(*) AS n FROM countries c JOIN categories g USING (country_id) JOIN fields f USING (category_id) GROUP BY 1, 2")
def snowflake_join(a):
    return (
        a.countries.join(a.categories, "country_id").join(a.fields.drop("country_id"), "category_id").groupBy("name", "title").agg(F.count(F.lit(1)).alias("n"))
    )


@over_archive("composite_join", "SELECT g.title, count(*) AS n FROM fields f JOIN categories g USING (category_id, country_id) GROUP BY 1")
def composite_join(a):
    return a.fields.join(a.categories, ["category_id", "country_id"]).groupBy("title").agg(F.count(F.lit(1)).alias("n"))


@over_archive("left_join_agg", "SELECT e.code, count(c.country_id) AS editions, min(c.year) AS first_year FROM masters e LEFT JOIN countries c ON c.master_id = e.master_id AND c.year < 1997 GROUP BY 1")
def left_join_agg(a):
    early = a.countries.where("year < 1997").select("master_id", "country_id", "year")
    return a.masters.join(early, "master_id", "left").groupBy("code").agg(F.count("country_id").alias("editions"), F.min("year").alias("first_year"))


@over_archive("self_join_admin", "SELECT t.name AS territory, t.entity_type, s.name AS administered_by, s.entity_type AS admin_type FROM masters t LEFT JOIN masters s ON t.admin_id = s.master_id WHERE t.entity_type IN ('territory', 'disputed')")
def self_join_admin(a):
    t, s = a.masters.alias("t"), a.masters.alias("s")
    out = t.where(F.col("t.entity_type").isin("territory", "disputed")).join(s, F.col("t.admin_id") == F.col("s.master_id"), "left")
    return out.select(F.col("t.name").alias("territory"), "t.entity_type", F.col("s.name").alias("administered_by"), F.col("s.entity_type").alias("admin_type"))


@over_archive("code_collision", """, m AS (SELECT master_id, name, chr(65 + master_id % 13) || chr(65 + master_id % 5) AS fips, CASE WHEN iso2 IS NOT NULL THEN chr(65 + master_id % 5) || chr(65 + master_id % 7) END AS iso FROM masters)
SELECT x.fips AS shared_code, x.name AS fips_name, y.name AS iso_name, (SELECT count(*) FROM m WHERE iso <> fips) AS differing FROM m x JOIN m y ON x.fips = y.iso AND x.master_id <> y.master_id""")
def code_collision(a):
    """Codes of one system that are another entity's in the other system, over codes of two letters made from the keys."""
    key = F.col("master_id")
    letters = lambda p, q: F.concat(F.chr(65 + key % p), F.chr(65 + key % q))
    m = a.masters.select("master_id", "name", letters(13, 5).alias("fips"), F.when(F.col("iso2").isNotNull(), letters(5, 7)).alias("iso"))
    x, y = m.alias("x"), m.alias("y")
    hits = x.join(y, (F.col("x.fips") == F.col("y.iso")) & (F.col("x.master_id") != F.col("y.master_id")))
    rows = hits.select(F.col("x.fips").alias("shared_code"), F.col("x.name").alias("fips_name"), F.col("y.name").alias("iso_name"))
    return rows.withColumn("differing", m.where("iso <> fips").agg(F.count(F.lit(1))).scalar())


@over_archive("anti_unmapped", "SELECT DISTINCT field_name FROM fields f WHERE NOT EXISTS (SELECT 1 FROM mappings m WHERE m.original = f.field_name)")
def anti_unmapped(a):
    return a.fields.join(a.mappings, a.fields.field_name == a.mappings.original, "left_anti").select("field_name").distinct()


@over_archive("anti_not_in", "SELECT count(*) AS without_values FROM fields WHERE field_id NOT IN (SELECT field_id FROM vals)")
def anti_not_in(a):
    return a.fields.join(a.values, "field_id", "left_anti").agg(F.count(F.lit(1)).alias("without_values"))


@over_archive("semi_in", "SELECT country_id, title FROM categories WHERE country_id IN (SELECT country_id FROM countries WHERE source = 'json')")
def semi_in(a):
    return a.categories.join(a.countries.where("source = 'json'"), "country_id", "left_semi").select("country_id", "title")


@over_archive("join_preagg", "SELECT e.code, coalesce(n.editions, 0) AS editions FROM masters e LEFT JOIN (SELECT master_id, count(*) AS editions FROM countries GROUP BY 1) n USING (master_id)")
def join_preagg(a):
    n = a.countries.groupBy("master_id").agg(F.count(F.lit(1)).alias("editions"))
    return a.masters.join(n, "master_id", "left").select("code", F.coalesce("editions", F.lit(0)).alias("editions"))


@over_archive("years_fanout", "SELECT c.year, count(DISTINCT c.country_id) AS countries, count(DISTINCT g.category_id) AS categories, count(f.field_id) AS fields FROM countries c LEFT JOIN categories g USING (country_id) LEFT JOIN fields f USING (country_id) GROUP BY 1")
def years_fanout(a):
    """Both joins on the edition multiply its fields by its categories.  Counts are kept apart and multiplied, so that the
    multiplied rows are never made."""
    g = a.categories.groupBy("country_id").agg(F.count_distinct("category_id").alias("g"))
    f = a.fields.groupBy("country_id").agg(F.count("field_id").alias("f"))
    both = a.countries.join(g, "country_id", "left").join(f, "country_id", "left")
    fields = F.coalesce("f", F.lit(0)) * F.greatest(F.coalesce("g", F.lit(0)), F.lit(1))
    return both.groupBy("year").agg(F.count_distinct("country_id").alias("countries"), F.sum(F.coalesce("g", F.lit(0))).alias("categories"), F.sum(fields).alias("fields"))


@over_archive("ci_lookup", "SELECT f.field_name, m.canonical FROM (SELECT DISTINCT lower(field_name) AS field_name FROM fields) f JOIN mappings m ON f.field_name = lower(m.original) QUALIFY row_number() OVER (PARTITION BY f.field_name ORDER BY m.mapping_id) = 1")
def ci_lookup(a):
    """A case-insensitive lookup that takes the mapping of least id."""
    names = a.fields.select(F.lower("field_name").alias("field_name")).distinct()
    got = a.mappings.groupBy(F.lower("original").alias("field_name")).agg(F.min_by("canonical", "mapping_id").alias("canonical"))
    return names.join(got, "field_name")


@over_archive("map_default", "SELECT f.field_id, coalesce(m.canonical, f.field_name) AS canonical FROM fields f LEFT JOIN mappings m ON f.field_name = m.original AND m.is_noise = 0")
def map_default(a):
    m = a.mappings.where("is_noise = 0")
    return a.fields.join(m, a.fields.field_name == m.original, "left").select("field_id", F.coalesce("canonical", "field_name").alias("canonical"))


@query("snapshot_asof", """WITH cutoffs AS (SELECT DISTINCT date_trunc('day', ts) AS cutoff FROM events)
SELECT c.cutoff, (SELECT e.event_id FROM events e WHERE e.ts < c.cutoff ORDER BY e.ts DESC, e.event_id DESC LIMIT 1) AS snapshot FROM cutoffs c""")
def snapshot_asof(spark, sf_dir):
    """The last event before each cutoff.  Events are first cut to the last of each day; the running last of those is
    carried over the days, so that no cutoff meets every event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    days = events.groupBy(F.date_trunc("day", "ts").alias("cutoff")).agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("last"))
    before = F.last("last", ignorenulls=True).over(W.orderBy("cutoff").rowsBetween(W.unboundedPreceding, -1))
    return days.select("cutoff", before.alias("snapshot"))


@over_archive("sync_diff", """, mirror AS (SELECT master_id, code, CASE WHEN master_id % 5 = 0 THEN name || '*' WHEN master_id % 5 = 1 THEN NULL ELSE name END AS name FROM masters)
SELECT e.code, e.name AS old, s.name AS new FROM masters e JOIN mirror s USING (master_id) WHERE s.name <> '' AND s.name IS DISTINCT FROM e.name""")
def sync_diff(a):
    """What a mirror says differently; its empty values change nothing."""
    k = F.col("master_id") % 5
    mirror = a.masters.select("master_id", F.when(k == 0, F.concat("name", F.lit("*"))).when(k == 1, None).otherwise(F.col("name")).alias("new"))
    both = a.masters.join(mirror, "master_id").where((F.col("new") != "") & ~F.col("new").eqNullSafe(F.col("name")))
    return both.select("code", F.col("name").alias("old"), "new")


@over_archive("lookup_join", "SELECT e.code, e.entity_type, l.rank FROM masters e JOIN (VALUES ('sovereign', 1), ('territory', 2), ('disputed', 3)) l(entity_type, rank) USING (entity_type)")
def lookup_join(a):
    """A lookup of a few literal rows, as read from a CSV file."""
    spark = a.masters.sparkSession
    rows = spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(k).alias("entity_type"), F.lit(i).alias("rank")) for i, k in enumerate(["sovereign", "territory", "disputed"], 1)))))
    return a.masters.join(F.broadcast(rows), "entity_type").select("code", "entity_type", "rank")


@over_archive("fuzzy_contains", """, keys(key, id) AS (VALUES ('NATION_1', 1), ('ION_2', 2), ('NATION_24 (FORMER)', 3))
SELECT e.master_id, k.key FROM masters e JOIN keys k ON contains(k.key, e.name) OR contains(e.name, k.key) QUALIFY row_number() OVER (PARTITION BY e.master_id ORDER BY k.id) = 1""")
def fuzzy_contains(a):
    """Names that hold one another; the key of least id wins."""
    spark = a.masters.sparkSession
    keys = spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(k).alias("key"), F.lit(i).alias("id")) for i, k in enumerate(["NATION_1", "ION_2", "NATION_24 (FORMER)"], 1)))))
    hits = matching.containing(a.masters.select("master_id", "name"), "name", keys, "key")
    return hits.groupBy("master_id").agg(F.min_by("key", "id").alias("key"))


@over_archive("tiered_match", """, asked(q) AS (VALUES ('NATION_3'), ('the NATION_4'), ('NATION_7 Republic'), ('nowhere')), hits AS (
  SELECT q, master_id, CASE WHEN q = name THEN 1 WHEN regexp_replace(q, '^the ', '') = name THEN 2 ELSE 3 END AS tier
  FROM asked, masters WHERE q = name OR regexp_replace(q, '^the ', '') = name OR contains(q, name) OR contains(name, q))
SELECT q, master_id, tier FROM hits QUALIFY row_number() OVER (PARTITION BY q ORDER BY tier, master_id) = 1""")
def tiered_match(a):
    """Exact name, then without its article, then containment; within a tier the least id."""
    spark = a.masters.sparkSession
    asked = spark.range(1).select(F.explode(F.array(*map(F.lit, ["NATION_3", "the NATION_4", "NATION_7 Republic", "nowhere"]))).alias("q"))
    return matching.best(asked, "q", a.masters)


@query("alias_match", """WITH named AS (SELECT n_name AS called, n_nationkey AS master_id FROM nation UNION ALL SELECT 'Land ' || chr((65 + n_nationkey)::INTEGER), n_nationkey FROM nation), asked AS (
  SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN n_name WHEN 1 THEN 'the ' || n_name WHEN 2 THEN 'Land ' || chr((65 + c_nationkey)::INTEGER) WHEN 3 THEN 'former Land ' || chr((65 + c_nationkey)::INTEGER) || ' and isles'
   WHEN 4 THEN 'ION_' || (c_custkey % 3) ELSE 'nowhere ' || c_custkey END AS q FROM customer JOIN nation ON n_nationkey = c_nationkey
), hits AS (
  SELECT c_custkey, master_id, CASE WHEN q = called THEN 1 WHEN regexp_replace(q, '^the ', '') = called THEN 2 ELSE 3 END AS tier FROM asked, named WHERE contains(q, called) OR contains(called, q))
SELECT c_custkey, master_id, tier FROM hits QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY tier, master_id) = 1""")
def alias_match(spark, sf_dir):
    """What every customer calls its nation, matched to names and aliases in both directions."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    masters = read("nation").select(F.col("n_nationkey").alias("master_id"), F.col("n_name").alias("name"))
    aliases = masters.select(F.concat(F.lit("Land "), F.chr(65 + F.col("master_id"))).alias("alias"), "master_id")
    k, land = F.col("c_custkey"), F.concat(F.lit("Land "), F.chr(65 + F.col("c_nationkey")))
    said = F.when(k % 6 == 0, F.col("name")).when(k % 6 == 1, F.concat(F.lit("the "), "name")).when(k % 6 == 2, land)
    said = said.when(k % 6 == 3, F.concat(F.lit("former "), land, F.lit(" and isles"))).when(k % 6 == 4, F.concat(F.lit("ION_"), (k % 3).cast("string"))).otherwise(F.concat(F.lit("nowhere "), k.cast("string")))
    asked = read("customer").join(masters, F.col("c_nationkey") == F.col("master_id")).select("c_custkey", said.alias("q"))
    return asked.join(matching.best(asked, "q", masters, aliases), "q").select("c_custkey", "master_id", "tier")



@over_archive("agg_count", "SELECT count(*) AS n, count(content) AS with_content FROM fields")
def agg_count(a):
    return a.fields.agg(F.count(F.lit(1)).alias("n"), F.count("content").alias("with_content"))


@over_archive("multi_distinct", "SELECT c.year, count(DISTINCT c.country_id) AS countries, count(DISTINCT f.field_id) AS fields, count(DISTINCT f.field_name) AS names, count(DISTINCT m.canonical) AS canonicals FROM countries c JOIN fields f USING (country_id) JOIN mappings m ON f.field_name = m.original WHERE m.is_noise = 0 GROUP BY 1")
def multi_distinct(a):
    """Four distinct counts a year.  field_id is a key, so its count needs no distinct set; the rest count after a
    reduction to distinct triples."""
    m = a.mappings.where("is_noise = 0").select(F.col("original").alias("field_name"), "canonical")
    rows = a.fields.join(a.countries.select("country_id", "year"), "country_id").join(m, "field_name")
    small = rows.groupBy("year", "country_id", "field_name", "canonical").agg(F.count("field_id").alias("n"))
    return small.groupBy("year").agg(
        F.count_distinct("country_id").alias("countries"), F.sum("n").alias("fields"), F.count_distinct("field_name").alias("names"), F.count_distinct("canonical").alias("canonicals")
    )


@over_archive("agg_minmaxsum", "SELECT min(first_year) AS first_year, max(last_year) AS last_year, sum(use_count)::BIGINT AS uses FROM mappings")
def agg_minmaxsum(a):
    return a.mappings.agg(F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year"), F.sum("use_count").alias("uses"))


@over_archive("having_span", "SELECT m.canonical, min(c.year) AS first_year, max(c.year) AS last_year, count(DISTINCT c.year) AS years, count(DISTINCT e.master_id) AS entities, count(*) AS records" + STAR + "WHERE m.is_noise = 0 AND e.entity_type = 'sovereign' GROUP BY 1 HAVING count(DISTINCT c.year) >= 5")
def having_span(a):
    out = star(a).where("is_noise = 0 AND entity_type = 'sovereign'").groupBy("canonical").agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count_distinct("year").alias("years"),
        F.count_distinct("master_id").alias("entities"), F.count(F.lit(1)).alias("records"),
    )
    return out.where("years >= 5")


@over_archive("string_agg", "SELECT entity_type, count(*) AS n, string_agg(name, ', ' ORDER BY name) AS names FROM masters GROUP BY 1")
def string_agg(a):
    return a.masters.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("names"))


@over_archive("cond_sum", "SELECT c.year, sum(CASE WHEN content IS NULL OR trim(content) = '' THEN 1 ELSE 0 END)::BIGINT AS blank, count(*) AS n FROM fields JOIN countries c USING (country_id) GROUP BY 1")
def cond_sum(a):
    blank = F.col("content").isNull() | (F.trim("content") == "")
    return a.fields.join(a.countries, "country_id").groupBy("year").agg(F.count_if(blank).alias("blank"), F.count(F.lit(1)).alias("n"))


@over_archive("cond_distinct", "SELECT count(DISTINCT CASE WHEN is_noise = 0 THEN canonical END) AS kept, count(DISTINCT CASE WHEN is_noise = 1 THEN canonical END) AS noise FROM mappings")
def cond_distinct(a):
    return a.mappings.agg(F.count_distinct(F.when(F.col("is_noise") == 0, F.col("canonical"))).alias("kept"), F.count_distinct(F.when(F.col("is_noise") == 1, F.col("canonical"))).alias("noise"))


@over_archive("eav_pivot", "SELECT f.field_id, c.name, max(CASE WHEN sub_field = 'total' THEN numeric_val END) AS total, max(CASE WHEN sub_field = 'land' THEN numeric_val END) AS land FROM vals v JOIN fields f USING (field_id) JOIN countries c USING (country_id) WHERE c.year = 1998 GROUP BY 1, 2 ORDER BY total DESC, f.field_id LIMIT 15")
def eav_pivot(a):
    """The fifteen largest of an edition; the filter on the year reaches the fields before the values are turned."""
    fields = a.fields.join(a.countries.where("year = 1998").select("country_id", "name"), "country_id").select("field_id", "name")
    wide = a.values.join(fields, "field_id").groupBy("field_id", "name").pivot("sub_field", ["total", "land"]).agg(F.max("numeric_val"))
    return wide.orderBy(F.desc_nulls_last("total"), "field_id").limit(15)


@over_archive("pivot_scatter", "SELECT field_id, total, land FROM (SELECT field_id, max(CASE WHEN sub_field = 'total' THEN numeric_val END) AS total, max(CASE WHEN sub_field = 'land' THEN numeric_val END) AS land FROM vals GROUP BY 1) WHERE total IS NOT NULL AND land IS NOT NULL ORDER BY field_id LIMIT 200")
def pivot_scatter(a):
    wide = a.values.groupBy("field_id").pivot("sub_field", ["total", "land"]).agg(F.max("numeric_val"))
    return wide.dropna(subset=["total", "land"]).orderBy("field_id").limit(200)


@over_archive("distinct_proj", "SELECT DISTINCT c.year, g.title FROM categories g JOIN countries c USING (country_id) WHERE c.name = 'NATION_4'")
def distinct_proj(a):
    return a.categories.join(a.countries.where("name = 'NATION_4'"), "country_id").select("year", "title").distinct()


@over_archive("distinct_pairs", "SELECT count(*) AS pairs FROM (SELECT DISTINCT country_id, field_name FROM fields)")
def distinct_pairs(a):
    return a.fields.select("country_id", "field_name").distinct().agg(F.count(F.lit(1)).alias("pairs"))


@over_archive("next_id", "SELECT coalesce(max(mapping_id), 0) + 1 AS next_id FROM mappings")
def next_id(a):
    return a.mappings.agg((F.coalesce(F.max("mapping_id"), F.lit(0)) + 1).alias("next_id"))


@over_archive("parse_confidence", "SELECT f.field_id, round(sum(length(v.source_fragment)) / length(any_value(f.content)), 6) AS confidence FROM fields f JOIN vals v USING (field_id) GROUP BY 1 HAVING sum(length(v.source_fragment)) / length(any_value(f.content)) < 0.5")
def parse_confidence(a):
    covered = F.sum(F.length("source_fragment")) / F.max(F.length("content"))
    return a.fields.join(a.values, "field_id").groupBy("field_id").agg(F.round(covered, 6).alias("confidence"), covered.alias("c")).where("c < 0.5").drop("c")


@over_archive("merge_fields", "SELECT country_id, field_name, min(category_id) AS category_id, string_agg(content, chr(10) ORDER BY field_id) AS body FROM fields WHERE trim(content) <> '' GROUP BY 1, 2")
def merge_fields(a):
    """Contents of one name and edition joined in order of their fields."""
    parts = F.array_sort(F.collect_list(F.struct("field_id", "content")))
    out = a.fields.where(F.trim("content") != "").groupBy("country_id", "field_name").agg(F.min("category_id").alias("category_id"), parts.alias("p"))
    return out.select("country_id", "field_name", "category_id", F.array_join("p.content", "\n").alias("body"))


@over_archive("avg_per_group", "SELECT c.year, round(count(f.field_id) / greatest(count(DISTINCT c.country_id), 1), 6) AS per_country FROM countries c LEFT JOIN fields f USING (country_id) GROUP BY 1")
def avg_per_group(a):
    n = a.fields.groupBy("country_id").agg(F.count("field_id").alias("n"))
    return a.countries.join(n, "country_id", "left").groupBy("year").agg(F.round(F.sum(F.coalesce("n", F.lit(0))) / F.greatest(F.count_distinct("country_id"), F.lit(1)), 6).alias("per_country"))


@over_archive("toc_fields", "SELECT canonical, mapping_type, consolidated_to, count(DISTINCT original) AS variants, min(first_year) AS first_year, max(last_year) AS last_year, sum(use_count)::BIGINT AS uses FROM mappings WHERE is_noise = 0 GROUP BY 1, 2, 3")
def toc_fields(a):
    return a.mappings.where("is_noise = 0").groupBy("canonical", "mapping_type", "consolidated_to").agg(
        F.count_distinct("original").alias("variants"), F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year"), F.sum("use_count").alias("uses")
    )


@over_archive("window_dedupe", "SELECT c.year, f.field_id, f.field_name FROM fields f JOIN countries c USING (country_id) WHERE f.content ILIKE '%order 1%' QUALIFY row_number() OVER (PARTITION BY f.country_id, f.field_name, left(f.content, 200) ORDER BY f.field_id) = 1 ORDER BY c.year, f.field_id LIMIT 50")
def window_dedupe(a):
    """Keyword search: the first of equal contents in an edition, the first fifty."""
    found = a.fields.where(F.col("content").ilike("%order 1%")).groupBy("country_id", "field_name", F.left("content", F.lit(200))).agg(F.min("field_id").alias("field_id"))
    return found.join(a.countries.select("country_id", "year"), "country_id").select("year", "field_id", "field_name").orderBy("year", "field_id").limit(50)


@over_archive("yoy_delta", "SELECT year, count(*) AS n, count(*) - lag(count(*)) OVER (ORDER BY year) AS delta FROM countries GROUP BY 1")
def yoy_delta(a):
    n = a.countries.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("delta", F.col("n") - F.lag("n").over(W.orderBy("year")))


@over_archive("yoy_anomaly", "SELECT year, n, round(100.0 * (n - p) / p, 4) AS pct, abs(100.0 * (n - p) / p) > 15 AS anomaly FROM (SELECT c.year, count(*) AS n, lag(count(*)) OVER (ORDER BY c.year) AS p FROM fields JOIN countries c USING (country_id) GROUP BY 1)")
def yoy_anomaly(a):
    n = a.fields.join(a.countries, "country_id").groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    n = n.withColumn("p", F.lag("n").over(W.orderBy("year")))
    pct = (F.col("n") - F.col("p")) * 100.0 / F.col("p")
    return n.select("year", "n", F.round(pct, 4).alias("pct"), (F.abs(pct) > 15).alias("anomaly"))


@over_archive("latest_per_entity", "SELECT master_id, max(year) AS year, arg_max(country_id, year) AS country_id FROM countries WHERE master_id IS NOT NULL GROUP BY 1")
def latest_per_entity(a):
    return a.countries.where("master_id IS NOT NULL").groupBy("master_id").agg(F.max("year").alias("year"), F.max_by("country_id", "year").alias("country_id"))


@over_archive("first_per_key", "SELECT category_id, min(field_id) AS field_id, arg_min(field_name, field_id) AS field_name FROM fields GROUP BY 1")
def first_per_key(a):
    return a.fields.groupBy("category_id").agg(F.min("field_id").alias("field_id"), F.min_by("field_name", "field_id").alias("field_name"))


@over_archive("last_per_key", "SELECT country_id, field_name, max(field_id) AS field_id FROM fields GROUP BY 1, 2")
def last_per_key(a):
    return a.fields.groupBy("country_id", "field_name").agg(F.max("field_id").alias("field_id"))


@query("marker_spans", "SELECT conv_id, turn, role, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS ends FROM conversations WHERE role = 'user'")
def marker_spans(spark, sf_dir):
    """Each marker runs to the next one."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").where("role = 'user'")
    return turns.select("conv_id", "turn", "role", F.lead("turn").over(W.partitionBy("conv_id").orderBy("turn")).alias("ends"))


@query("carry_forward", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS section FROM conversations")
def carry_forward(spark, sf_dir):
    """The last marker so far labels what follows it."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    label = F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True)
    return turns.select("conv_id", "turn", label.over(W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, 0)).alias("section"))


@over_archive("iso_owner", "SELECT substr(iso2, 1, 1) AS iso, arg_min(code, CASE WHEN entity_type = 'sovereign' THEN -master_id ELSE 1000 + master_id END) AS owner FROM masters WHERE iso2 IS NOT NULL GROUP BY 1")
def iso_owner(a):
    """The last sovereign owns a code; without any, the first entity."""
    order = F.when(F.col("entity_type") == "sovereign", -F.col("master_id")).otherwise(1000 + F.col("master_id"))
    return a.masters.where("iso2 IS NOT NULL").groupBy(F.substring("iso2", 1, 1).alias("iso")).agg(F.min_by("code", order).alias("owner"))


@over_archive("topk_mixed", "SELECT c.year, e.name, f.field_id" + STAR + "WHERE m.canonical = 'Area' AND e.entity_type = 'sovereign' ORDER BY c.year DESC, e.name, f.field_id LIMIT 40")
def topk_mixed(a):
    rows = star(a).where("canonical = 'Area' AND entity_type = 'sovereign'").select("year", "name", "field_id")
    return rows.orderBy(F.desc("year"), "name", "field_id").limit(40)


@over_archive("sort_agg", "SELECT field_name, count(*) AS n FROM fields GROUP BY 1 ORDER BY n DESC, field_name")
def sort_agg(a):
    return a.fields.groupBy("field_name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "field_name")


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@over_archive("sample_every", ", t AS (SELECT country_id, row_number() OVER (ORDER BY country_id) - 1 AS i, count(*) OVER () AS n FROM countries) SELECT country_id FROM t WHERE i % greatest(1, n // 8) = 0 AND i // greatest(1, n // 8) < 8")
def sample_every(a):
    """Eight rows at even distances of the small edition table."""
    t = a.countries.select("country_id", (F.row_number().over(W.orderBy("country_id")) - 1).alias("i"), F.count(F.lit(1)).over(W.partitionBy()).alias("n"))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 8))
    return t.where((F.col("i") % step == 0) & (F.floor(F.col("i") / step) < 8)).select("country_id")


@over_archive("union_all_counts", "SELECT 'masters' AS what, count(*) AS n FROM masters UNION ALL SELECT 'countries', count(*) FROM countries UNION ALL SELECT 'categories', count(*) FROM categories UNION ALL SELECT 'fields', count(*) FROM fields UNION ALL SELECT 'values', count(*) FROM vals")
def union_all_counts(a):
    parts = [getattr(a, t).agg(F.lit(t).alias("what"), F.count(F.lit(1)).alias("n")) for t in ("masters", "countries", "categories", "fields", "values")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def names_of(a: Archive, year: int) -> DataFrame:
    return a.countries.where((F.col("year") == year) & F.col("master_id").isNotNull()).select("code")


@over_archive("union_distinct", "SELECT code FROM countries WHERE year = 2000 AND master_id IS NOT NULL UNION SELECT code FROM countries WHERE year = 2001 AND master_id IS NOT NULL")
def union_distinct(a):
    return names_of(a, 2000).union(names_of(a, 2001)).distinct()


@over_archive("except_names", "SELECT code, 'gone' AS change FROM (SELECT code FROM countries WHERE year = 1999 AND master_id IS NOT NULL EXCEPT SELECT code FROM countries WHERE year = 2000 AND master_id IS NOT NULL) UNION ALL SELECT code, 'new' FROM (SELECT code FROM countries WHERE year = 2000 AND master_id IS NOT NULL EXCEPT SELECT code FROM countries WHERE year = 1999 AND master_id IS NOT NULL)")
def except_names(a):
    x, y = names_of(a, 1999), names_of(a, 2000)
    return x.subtract(y).withColumn("change", F.lit("gone")).union(y.subtract(x).withColumn("change", F.lit("new")))


@over_archive("subset_check", "SELECT count(*) = 0 AS holds FROM (SELECT DISTINCT original FROM mappings EXCEPT SELECT field_name FROM fields)")
def subset_check(a):
    left = a.mappings.join(a.fields, a.fields.field_name == a.mappings.original, "left_anti")
    return left.agg((F.count(F.lit(1)) == 0).alias("holds"))


@over_archive("assignment_diff", """, want(code, region) AS (SELECT code, CASE WHEN master_id % 6 = 0 THEN 'east' ELSE 'west' END FROM masters WHERE master_id < 20),
have(code, region) AS (SELECT code, CASE WHEN master_id % 5 = 0 THEN 'east' ELSE 'west' END FROM masters WHERE master_id > 3)
SELECT coalesce(w.code, h.code) AS code, CASE WHEN h.code IS NULL THEN 'missing' WHEN w.code IS NULL THEN 'extra' ELSE 'wrong' END AS problem FROM want w FULL JOIN have h ON w.code = h.code WHERE w.region IS DISTINCT FROM h.region""")
def assignment_diff(a):
    """An assignment of entities to regions against the one that is expected."""
    def given(part: str, every: int) -> DataFrame:
        return a.masters.where(part).select("code", F.when(F.col("master_id") % every == 0, "east").otherwise("west").alias("region"))

    w, h = given("master_id < 20", 6).alias("w"), given("master_id > 3", 5).alias("h")
    both = w.join(h, F.col("w.code") == F.col("h.code"), "full").where(~F.col("w.region").eqNullSafe(F.col("h.region")))
    problem = F.when(F.col("h.code").isNull(), "missing").when(F.col("w.code").isNull(), "extra").otherwise("wrong")
    return both.select(F.coalesce("w.code", "h.code").alias("code"), problem.alias("problem"))


@over_archive("missing_years", "SELECT e.code, y.year::INTEGER AS year FROM masters e, range(1995, 2002) y(year) WHERE NOT EXISTS (SELECT 1 FROM countries c WHERE c.master_id = e.master_id AND c.year = y.year)")
def missing_years(a):
    expected = a.masters.select("code", "master_id", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year"))
    return expected.join(a.countries, ["master_id", "year"], "left_anti").select("code", "year")


@query("correlations", """WITH a AS (SELECT l_partkey AS o, l_returnflag || m AS v, avg(CASE WHEN m = ' size' THEN l_quantity ELSE l_discount END) AS a FROM lineitem, (VALUES (' size'), (' cut')) t(m) GROUP BY 1, 2)
SELECT x.v AS x, y.v AS y, count(*) AS n, round(corr(y.a, x.a), 6) AS corr, round(regr_slope(y.a, x.a), 6) AS slope, round(regr_intercept(y.a, x.a), 4) AS intercept
FROM a x JOIN a y ON x.o = y.o AND x.v < y.v GROUP BY 1, 2""")
def correlations(spark, sf_dir):
    """How the measures of one kind of return go with those of another, over the parts that have both."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    each = F.array(*(F.struct(F.lit(m).alias("m"), F.col(c).cast("double").alias("a")) for m, c in ((" size", "l_quantity"), (" cut", "l_discount"))))
    told = rows.select("l_partkey", "l_returnflag", F.inline(each)).select("l_partkey", F.concat("l_returnflag", "m").alias("v"), "a")
    found = correlation.pairwise(told, "l_partkey", "v", "a", block=8)
    return found.select("x", "y", "n", F.round("corr", 6).alias("corr"), F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


def trade(spark, sf_dir):
    """What customers of one nation buy from suppliers of another."""
    read = lambda t, *c: spark.read.parquet(f"{sf_dir}/{t}.parquet").select(*c)
    rows = read("lineitem", "l_orderkey", "l_suppkey", "l_quantity").join(read("orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(read("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(read("supplier", "s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return network.edges(rows, "c_nationkey", "s_nationkey", "l_quantity")


@query("trade_ranks", """WITH RECURSIVE e AS (SELECT c_nationkey AS s, s_nationkey AS d, sum(l_quantity)::DOUBLE AS w FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
 WHERE c_nationkey <> s_nationkey GROUP BY 1, 2), o AS (SELECT s, sum(w) AS t FROM e GROUP BY 1), nodes AS (SELECT s AS v FROM e UNION SELECT d FROM e), n AS (SELECT count(*)::DOUBLE AS n FROM nodes),
r AS (SELECT 0 AS i, v, 1 / n AS x FROM nodes, n UNION ALL
 SELECT r.i + 1, nodes.v, 0.15 / n + 0.85 * sum(CASE WHEN o.t IS NULL THEN x / n ELSE coalesce(w / t, 0) * x END) FROM nodes CROSS JOIN n CROSS JOIN r LEFT JOIN e ON e.s = r.v AND e.d = nodes.v LEFT JOIN o ON o.s = r.v WHERE r.i < 100 GROUP BY r.i, nodes.v, n)
SELECT v AS node, round(x, 6) AS rank FROM r WHERE i = 100""")
def trade_ranks(spark, sf_dir):
    """Nations by where a walk along purchases ends up."""
    return network.ranks(trade(spark, sf_dir), near=1e-8).select("node", F.round("rank", 6).alias("rank"))
