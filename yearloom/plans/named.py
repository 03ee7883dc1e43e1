"""The named analytical queries: time series, summaries, command-line views, feeds and mutations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from yearloom.operators import changes, keys, matching
from yearloom.sources import storage
from yearloom.sources.archive import Archive
from yearloom.sources.versions import Versioned

from . import made
from .registry import query
from .relational import STAR, over_archive, star


@over_archive("bi_timeseries", "SELECT c.year, e.name AS country, f.field_name, f.content" + STAR + "WHERE m.canonical = 'Area' AND e.name = 'NATION_4' AND m.is_noise = 0 ORDER BY c.year, f.field_id")
def bi_timeseries(a):
    """One canonical field of one entity over the years."""
    rows = star(a).where("canonical = 'Area' AND name = 'NATION_4' AND is_noise = 0")
    return rows.orderBy("year", "field_id").select("year", F.col("name").alias("country"), "field_name", "content")


@over_archive("bi_multi_compare", "SELECT c.year, e.name AS country, f.field_id" + STAR + "WHERE m.canonical = 'Low' AND e.name IN ('NATION_4', 'NATION_8', 'NATION_12') AND m.is_noise = 0")
def bi_multi_compare(a):
    return star(a).where(F.col("name").isin("NATION_4", "NATION_8", "NATION_12") & (F.col("canonical") == "Low") & (F.col("is_noise") == 0)).select("year", F.col("name").alias("country"), "field_id")


@over_archive("bi_entity_span", "SELECT e.code, e.name, e.entity_type, e.iso2, min(c.year) AS first_year, max(c.year) AS last_year, count(DISTINCT c.year) AS years FROM masters e LEFT JOIN countries c USING (master_id) GROUP BY 1, 2, 3, 4")
def bi_entity_span(a):
    c = a.countries.select("master_id", "year")
    return a.masters.join(c, "master_id", "left").groupBy("code", "name", "entity_type", "iso2").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count_distinct("year").alias("years"))


@over_archive("bi_type_summary", "SELECT entity_type, count(*) AS n, count(iso2) AS with_iso, string_agg(name, ', ' ORDER BY name) AS names FROM masters GROUP BY 1 ORDER BY n DESC, entity_type")
def bi_type_summary(a):
    return a.masters.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n"), F.count("iso2").alias("with_iso"), F.expr("listagg(name, ', ') WITHIN GROUP (ORDER BY name)").alias("names")).orderBy(F.desc("n"), "entity_type")


@over_archive("bi_consolidated", "SELECT c.year, e.name AS country, m.canonical AS sub_field, m.consolidated_to AS parent, f.field_id" + STAR + "WHERE m.consolidated_to = 'Geography' AND e.name = 'NATION_8' AND m.is_noise = 0")
def bi_consolidated(a):
    rows = star(a).where("consolidated_to = 'Geography' AND name = 'NATION_8' AND is_noise = 0")
    return rows.select("year", F.col("name").alias("country"), F.col("canonical").alias("sub_field"), F.col("consolidated_to").alias("parent"), "field_id")


@over_archive("case_status", "SELECT e.name, min(c.year) AS first_year, max(c.year) AS last_year, CASE WHEN max(c.year) < 2001 THEN 'gone' WHEN min(c.year) > 1995 THEN 'added' ELSE 'throughout' END AS status FROM masters e JOIN countries c USING (master_id) WHERE e.entity_type IN ('sovereign', 'disputed', 'dissolved') GROUP BY 1 HAVING min(c.year) > 1995 OR max(c.year) < 2001")
def case_status(a):
    """Entities that appear or disappear within the years covered."""
    kept = a.masters.where(F.col("entity_type").isin("sovereign", "disputed", "dissolved")).select("master_id", "name")
    span = a.countries.groupBy("master_id").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    status = F.when(F.col("last_year") < 2001, "gone").when(F.col("first_year") > 1995, "added").otherwise("throughout")
    return kept.join(span, "master_id").where("first_year > 1995 OR last_year < 2001").select("name", "first_year", "last_year", status.alias("status"))


@over_archive("bi_source", "SELECT c.year, c.source, count(DISTINCT c.country_id) AS countries, count(f.field_id) AS fields FROM countries c JOIN fields f USING (country_id) GROUP BY 1, 2")
def bi_source(a):
    n = a.fields.groupBy("country_id").agg(F.count("field_id").alias("n"))
    return a.countries.join(n, "country_id").groupBy("year", "source").agg(F.count_distinct("country_id").alias("countries"), F.sum("n").alias("fields"))


def flat(a):
    rows = star(a).where("is_noise = 0").join(a.categories.select("category_id", "title"), "category_id", "left")
    return rows.select("year", "code", F.col("name").alias("country"), "title", "canonical", "field_id", "content", "source")


@over_archive("bi_flat_fact", "SELECT c.year, e.code, e.name AS country, g.title, m.canonical, f.field_id, f.content, c.source FROM fields f JOIN mappings m ON f.field_name = m.original JOIN countries c ON f.country_id = c.country_id JOIN masters e ON c.master_id = e.master_id LEFT JOIN categories g ON f.category_id = g.category_id WHERE m.is_noise = 0 ORDER BY c.year, e.name, g.title, m.canonical, f.field_id LIMIT 10000")
def bi_flat_fact(a):
    """The flat export of the first 10,000 rows, a preview of bi_flat_fact_full."""
    return flat(a).orderBy("year", "country", "title", "canonical", "field_id").limit(10000)


@over_archive("bi_flat_fact_full", "SELECT c.year, e.code, e.name AS country, g.title, m.canonical, f.field_id, f.content, c.source FROM fields f JOIN mappings m ON f.field_name = m.original JOIN countries c ON f.country_id = c.country_id JOIN masters e ON c.master_id = e.master_id LEFT JOIN categories g ON f.category_id = g.category_id WHERE m.is_noise = 0")
def bi_flat_fact_full(a):
    """The flat export of all rows, in no order."""
    return flat(a)


@over_archive("bi_mapping_types", "SELECT mapping_type, is_noise, count(*) AS n, sum(use_count)::BIGINT AS uses, min(first_year) AS earliest, max(last_year) AS latest FROM mappings GROUP BY 1, 2")
def bi_mapping_types(a):
    return a.mappings.groupBy("mapping_type", "is_noise").agg(
        F.count(F.lit(1)).alias("n"), F.sum("use_count").alias("uses"), F.min("first_year").alias("earliest"), F.max("last_year").alias("latest")
    )


@over_archive("tq_01_counts", "SELECT year, source, count(*) AS n FROM countries GROUP BY 1, 2")
def tq_01(a):
    return a.countries.groupBy("year", "source").agg(F.count(F.lit(1)).alias("n"))


@over_archive("tq_02_list", "SELECT code, name FROM countries WHERE year = 2001 ORDER BY name")
def tq_02(a):
    return a.countries.where("year = 2001").select("code", "name").orderBy("name")


@over_archive("tq_03_categories", "SELECT title, count(*) AS n FROM categories JOIN countries USING (country_id) WHERE year = 2000 GROUP BY 1")
def tq_03(a):
    return a.categories.join(a.countries.where("year = 2000"), "country_id").groupBy("title").agg(F.count(F.lit(1)).alias("n"))


@over_archive("tq_04_view", "SELECT g.title, f.field_name, left(f.content, 40) AS preview FROM fields f JOIN categories g USING (category_id) JOIN countries c ON c.country_id = f.country_id WHERE c.year = 1996 AND lower(c.code) = 'n07'")
def tq_04(a):
    rows = a.fields.join(a.countries.where((F.col("year") == 1996) & (F.lower("code") == "n07")).select("country_id"), "country_id")
    return rows.join(a.categories.select("category_id", "title"), "category_id").select("title", "field_name", F.left("content", F.lit(40)).alias("preview"))


@over_archive("tq_05_search", "SELECT DISTINCT c.name, c.year FROM fields f JOIN countries c USING (country_id) WHERE f.content ILIKE '%ORDER 99%'")
def tq_05(a):
    return a.fields.where(F.col("content").ilike("%ORDER 99%")).join(a.countries, "country_id").select("name", "year").distinct()


@over_archive("tq_06_compare", "SELECT c.year, f.content FROM fields f JOIN countries c USING (country_id) WHERE c.code = 'N09' AND f.field_name ILIKE '%urgent%'")
def tq_06(a):
    return a.fields.where(F.col("field_name").ilike("%urgent%")).join(a.countries.where("code = 'N09'"), "country_id").select("year", "content")


@over_archive("tq_07_like_chain", "SELECT c.name, f.field_id FROM fields f JOIN countries c USING (country_id) WHERE f.field_name ILIKE '%low%' AND f.content NOT ILIKE '%order 1%' AND (f.content ILIKE '%1997 est%' OR f.content ILIKE '%1998 est%')")
def tq_07(a):
    c = F.col("content")
    rows = a.fields.where(F.col("field_name").ilike("%low%") & ~c.ilike("%order 1%") & (c.ilike("%1997 est%") | c.ilike("%1998 est%")))
    return rows.join(a.countries, "country_id").select("name", "field_id")


@over_archive("tq_08_phrase", "SELECT c.year, c.name, f.field_id FROM fields f JOIN countries c USING (country_id) WHERE f.content ILIKE '%comparison to the world: 42%' ORDER BY c.year DESC, c.name, f.field_id")
def tq_08(a):
    rows = a.fields.where(F.col("content").ilike("%comparison to the world: 42%")).join(a.countries, "country_id")
    return rows.select("year", "name", "field_id").orderBy(F.desc("year"), "name", "field_id")


@over_archive("tq_09_totals", "SELECT count(*) AS fields, count(DISTINCT country_id) AS countries FROM fields")
def tq_09(a):
    return a.fields.agg(F.count(F.lit(1)).alias("fields"), F.count_distinct("country_id").alias("countries"))


@over_archive("tq_10_find", "SELECT DISTINCT code, name FROM countries WHERE name ILIKE '%nation_1%'")
def tq_10(a):
    return a.countries.where(F.col("name").ilike("%nation\\_1%")).select("code", "name").distinct()


@over_archive("tq_11_stats", "SELECT 'years' AS what, count(DISTINCT year) AS n FROM countries UNION ALL SELECT 'sources', count(DISTINCT source) FROM countries UNION ALL SELECT 'titles', count(DISTINCT title) FROM categories")
def tq_11(a):
    one = lambda df, c, w: df.agg(F.lit(w).alias("what"), F.count_distinct(c).alias("n"))
    return one(a.countries, "year", "years").union(one(a.countries, "source", "sources")).union(one(a.categories, "title", "titles"))


@over_archive("tq_12_top", "SELECT f.field_name, c.year, count(*) AS n FROM fields f JOIN countries c USING (country_id) WHERE f.field_name LIKE '%-%I%' GROUP BY 1, 2 ORDER BY n DESC, f.field_name, c.year LIMIT 20")
def tq_12(a):
    rows = a.fields.where(F.col("field_name").like("%-%I%")).join(a.countries, "country_id")
    return rows.groupBy("field_name", "year").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "field_name", "year").limit(20)


@over_archive("resolve_entity", """, hits AS (SELECT q, master_id, CASE WHEN upper(q) = iso2 THEN 1 WHEN upper(q) = code THEN 2 ELSE 3 END AS tier
 FROM masters, (VALUES ('xb'), ('n06'), ('tion_1'), ('none')) v(q) WHERE upper(q) = iso2 OR upper(q) = code OR name ILIKE '%' || q || '%')
SELECT q, master_id, tier FROM hits QUALIFY row_number() OVER (PARTITION BY q ORDER BY tier, master_id) = 1""")
def resolve_entity(a):
    """ISO code, then the archive's own code, then part of the name; the least id within a tier."""
    return resolve(a.masters, ["xb", "n06", "tion_1", "none"])


def resolve(masters: DataFrame, asked: list[str]) -> DataFrame:
    """(q, master_id, tier) for each of the asked strings that names an entity."""
    words = masters.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, asked))).alias("q"))
    up = F.upper("q")
    keys = masters.select("master_id", F.explode(F.array(F.struct(F.col("iso2").alias("key"), F.lit(1).alias("tier")), F.struct(F.col("code").alias("key"), F.lit(2).alias("tier")))).alias("k"))
    by_key = words.join(keys, up == F.col("k.key")).select("q", "k.tier", "master_id")
    lower = words.withColumn("asked", F.lower("q"))
    by_name = matching.containing(masters.select("master_id", F.lower("name").alias("name")), "name", lower, "asked", both=False).select("q", F.lit(3).alias("tier"), "master_id")
    hits = by_key.union(by_name).groupBy("q").agg(F.min(F.struct("tier", "master_id")).alias("best"))
    return hits.select("q", "best.master_id", "best.tier")


ASKED = ["xb", "N06", "nation_7", "n99", "tion_12", "nowhere"]
ASKED_SQL = """, asked AS (SELECT unnest(['xb', 'N06', 'nation_7', 'n99', 'tion_12', 'nowhere']) AS q),
hits AS (SELECT q, e.master_id, CASE WHEN upper(q) = e.iso2 THEN 1 WHEN upper(q) = e.code THEN 2 WHEN contains(lower(e.name), lower(q)) THEN 3 END AS tier FROM asked, masters e),
best AS (SELECT q, (min({'t': tier, 'm': master_id}) FILTER (tier IS NOT NULL))['m'] AS master_id FROM hits GROUP BY 1),
found AS (SELECT q, 1 AS step, c.year, c.country_id FROM best JOIN countries c ON c.master_id = best.master_id
 UNION ALL SELECT q, 2, c.year, c.country_id FROM best JOIN countries c ON best.master_id IS NULL AND c.code IN (lower(q), upper(q))
 UNION ALL SELECT q, 3, c.year, c.country_id FROM asked JOIN countries c ON contains(lower(c.name), lower(q))),
who AS (SELECT q, arg_min(country_id, {'s': step, 'y': -year, 'c': country_id}) AS country_id FROM found GROUP BY 1)"""


def edition_of(a: Archive, asked: list[str], year: int | None = None) -> DataFrame:
    """(q, country_id): the edition that a question means.  An entity by ISO code, code or name, in the year asked for or
    its latest; for what names no entity, an edition by its own code; at last one by its name."""
    words = a.masters.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, asked))).alias("q"))
    editions = a.countries if year is None else a.countries.where(F.col("year") == year)
    editions = editions.select("country_id", "year", "code", "name", "master_id")
    known = resolve(a.masters, asked).select("q", "master_id")
    by_entity = known.join(editions, "master_id").select("q", F.lit(1).alias("step"), "year", "country_id")
    rest = words.join(known, "q", "left_anti")
    either = rest.select("q", F.explode(F.array_distinct(F.array(F.lower("q"), F.upper("q")))).alias("code"))
    by_code = either.join(editions, "code").select("q", F.lit(2), "year", "country_id")
    called = a.countries.select("year", "country_id", F.lower("name").alias("name"))
    by_name = matching.containing(called, "name", words.withColumn("asked", F.lower("q")), "asked", both=False).select("q", F.lit(3), "year", "country_id")
    return by_entity.union(by_code).union(by_name).groupBy("q").agg(F.min_by("country_id", F.struct("step", -F.col("year"), "country_id")).alias("country_id"))


@over_archive("cli_country", ASKED_SQL + " SELECT q, g.title, f.field_name, f.field_id FROM who JOIN fields f USING (country_id) JOIN categories g USING (category_id)")
def cli_country(a):
    """The edition that each of several questions means, field by field."""
    rows = edition_of(a, ASKED).join(a.fields, "country_id").join(a.categories.select("category_id", "title"), "category_id")
    return rows.select("q", "title", "field_name", "field_id")


@over_archive("cli_compare", "SELECT c.year, c.name, f.field_name, f.field_id FROM fields f JOIN countries c USING (country_id) WHERE c.code ILIKE 'n05' AND f.field_name ILIKE '%high%'")
def cli_compare(a):
    return a.fields.where(F.col("field_name").ilike("%high%")).join(a.countries.where(F.col("code").ilike("n05")), "country_id").select("year", "name", "field_name", "field_id")


@over_archive("cli_toc", "SELECT DISTINCT 'entity' AS what, code || ' ' || name AS label FROM countries WHERE year = 1999 UNION SELECT DISTINCT 'category', title FROM categories JOIN countries USING (country_id) WHERE year = 1999")
def cli_toc(a):
    now = a.countries.where("year = 1999")
    titles = a.categories.join(now, "country_id").select(F.lit("category").alias("what"), F.col("title").alias("label"))
    return now.select(F.lit("entity").alias("what"), F.concat_ws(" ", "code", "name").alias("label")).union(titles).distinct()


@over_archive("browse_entities", "SELECT e.name, coalesce(lower(e.iso2), lower(e.code)) AS link_code, e.entity_type, n.first_year, n.last_year, n.editions FROM masters e JOIN (SELECT master_id, min(year) AS first_year, max(year) AS last_year, count(*) AS editions FROM countries GROUP BY 1) n USING (master_id)")
def browse_entities(a):
    n = a.countries.groupBy("master_id").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count(F.lit(1)).alias("editions"))
    link = F.coalesce(F.lower("iso2"), F.lower("code")).alias("link_code")
    return a.masters.join(n, "master_id").select("name", link, "entity_type", "first_year", "last_year", "editions")


@over_archive("browse_years", "SELECT year, count(*) AS countries, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM countries GROUP BY 1")
def browse_years(a):
    return a.countries.groupBy("year").agg(F.count(F.lit(1)).alias("countries"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


#: What clients take out of a content with one pattern each (fixed values): name -> pattern with one group.
CLIENT = {
    "population": r"([\d,]{5,})", "per_capita": r"\$([\d,]+)", "life_expectancy": r"total population:\s*([\d.]+)", "growth": r"(-?[\d.]+)%",
    "military": r"([\d.]+)%\s*of\s*G[DN]P", "area": r"total\s*:?\s*([\d,]+)\s*sq\s*km", "rate": r"([\d.]+)\s*(?:births|deaths)\s*/\s*1,000",
}
CLIENT_TEXT = "total: {b},{t} sq km | ${a},{t} | total population: {x} years | -{x}% | {c}.4% of GDP | {c}.5 births/1,000"


@query("client_extract", f"{made.BASE} SELECT k, (b * 1000 + t)::DOUBLE AS population, (a * 1000 + t)::DOUBLE AS per_capita, x AS life_expectancy, -x AS growth, CAST(c || '.4' AS DOUBLE) AS military, (b * 1000 + t)::DOUBLE AS area, CAST(c || '.5' AS DOUBLE) AS rate FROM base")
def client_extract(spark, sf_dir):
    """Seven values by one pattern each; a first run of five digits and commas is the population, whatever it counts."""
    rows = made.texts(spark, sf_dir, CLIENT_TEXT)
    found = {n: F.replace(F.regexp_extract("text", p, 1), F.lit(","), F.lit("")).try_cast("double").alias(n) for n, p in CLIENT.items()}
    return rows.select("k", *found.values())


@over_archive("provenance", "SELECT sub_field, CASE WHEN is_computed = 1 THEN 'computed' ELSE 'extracted' END AS origin, count(*) AS n FROM vals GROUP BY 1, 2")
def provenance(a):
    origin = F.when(F.col("is_computed") == 1, "computed").otherwise("extracted").alias("origin")
    return a.values.groupBy("sub_field", origin).agg(F.count(F.lit(1)).alias("n"))


# Mutations give the new table; nothing is changed in place.


def without_year(table: DataFrame, countries: DataFrame, year: int) -> DataFrame:
    """A table of the archive without one edition's rows."""
    return table.join(countries.where(F.col("year") == year), "country_id", "left_anti")


@over_archive("delete_year", "SELECT field_id FROM fields WHERE country_id NOT IN (SELECT country_id FROM countries WHERE year = 1999)")
def delete_year(a):
    return without_year(a.fields, a.countries, 1999).select("field_id")


@over_archive("replace_partition", "SELECT field_id, content FROM fields JOIN countries c USING (country_id) WHERE NOT (c.year = 1997 AND c.code = 'N02') UNION ALL SELECT field_id + 1000000, 'new ' || field_id FROM fields JOIN countries c USING (country_id) WHERE c.year = 1997 AND c.code = 'N02'")
def replace_partition(a):
    """One entity's edition replaced by new rows."""
    old = a.countries.where("year = 1997 AND code = 'N02'")
    new = a.fields.join(old, "country_id", "left_semi").select((F.col("field_id") + 1000000).alias("field_id"), F.concat(F.lit("new "), F.col("field_id").cast("string")).alias("content"))
    return a.fields.join(old, "country_id", "left_anti").select("field_id", "content").unionByName(new)


@over_archive("content_changes", r""", e AS (SELECT f.field_id, coalesce(content, '') AS old, lead(field_id) OVER w AS next_field_id, coalesce(lead(content) OVER w, '') AS new
 FROM fields f JOIN countries c USING (country_id) JOIN categories USING (category_id, country_id) WINDOW w AS (PARTITION BY c.code, title, field_name ORDER BY c.year, field_id))
SELECT field_id, next_field_id, len(regexp_extract_all(old, '\S+|\s+')) AS old_tokens, len(regexp_extract_all(new, '\S+|\s+')) AS new_tokens, md5(new) AS rebuilt FROM e WHERE next_field_id IS NOT NULL""")
def content_changes(a):
    """What changes from one edition of a field to the next; the later text is rebuilt from the earlier one."""
    rows = a.fields.join(a.countries.select("country_id", "year", "code"), "country_id").join(a.categories.select("category_id", "title"), "category_id")
    pairs = changes.consecutive(rows, ["code", "title", "field_name"], ["year", "field_id"], "field_id", "content")
    told = changes.compared(pairs, "old", "new")
    again = changes.rebuilt(F.col("old"), F.col("script"))
    return told.select("field_id", "next_field_id", changes.tokens_of(F.col("script"), "=", "-").alias("old_tokens"), changes.tokens_of(F.col("script"), "=", "+").alias("new_tokens"), F.md5(again.cast("binary")).alias("rebuilt"))


@over_archive("versioned_changes", """, f AS (SELECT field_id, f.country_id, field_name, year, master_id FROM fields f JOIN countries USING (country_id))
SELECT field_id, year, CASE WHEN year = 1996 THEN upper(field_name) ELSE field_name END AS field_name, CASE WHEN master_id = 3 THEN 2 ELSE master_id END AS master_id FROM f WHERE year <> 1994""")
def versioned_changes(a):
    """A stored table after a year was deleted, another replaced, and an entity merged into another."""
    rows = a.fields.join(a.countries.select("country_id", "year", "master_id"), "country_id").select("field_id", "year", "field_name", "master_id")
    table = Versioned.create(rows, storage.new_folder(rows.sparkSession, "versions"))
    table.delete([1994])
    table.replace(table.read().where("year = 1996").withColumn("field_name", F.upper("field_name")))
    table.update(F.col("master_id") == 3, {"master_id": F.lit(2).cast(dict(rows.dtypes)["master_id"])})
    return table.read()


@over_archive("scan_year_folder", "SELECT f.field_id, f.field_name FROM fields f JOIN countries c USING (country_id) WHERE c.year = 1997")
def scan_year_folder(a):
    """One year of an archive that is stored by year; only its folder is read."""
    rows = a.fields.join(a.countries.select("country_id", "year"), "country_id").select("field_id", "field_name", "year")
    table = Versioned.create(rows, storage.new_folder(rows.sparkSession, "years"))
    return table.read().where("year = 1997").select("field_id", "field_name")


@over_archive("merge_duplicate", """, src AS (SELECT f.*, g.title FROM fields f JOIN categories g USING (category_id) JOIN countries c ON c.country_id = f.country_id WHERE c.code = 'N03'),
tgt AS (SELECT f.*, g.title, c.year FROM fields f JOIN categories g USING (category_id) JOIN countries c ON c.country_id = f.country_id WHERE c.code = 'N04')
SELECT s.field_id, t.country_id FROM src s JOIN countries sc ON sc.country_id = s.country_id JOIN countries t ON t.code = 'N04' AND t.year = sc.year
WHERE EXISTS (SELECT 1 FROM categories g WHERE g.country_id = t.country_id AND g.title = s.title)
 AND NOT EXISTS (SELECT 1 FROM tgt x WHERE x.country_id = t.country_id AND x.title = s.title AND x.field_name = s.field_name)""")
def merge_duplicate(a):
    """Fields that move from a duplicate entity: those whose category the target has and whose name it lacks there."""
    titled = a.fields.join(a.categories.select("category_id", "title"), "category_id")
    editions = a.countries.select("country_id", "code", "year")
    target = editions.where("code = 'N04'").select(F.col("country_id").alias("to_id"), "year")
    src = titled.join(editions.where("code = 'N03'"), "country_id").join(target, "year")
    has = a.categories.select(F.col("country_id").alias("to_id"), "title")
    taken = titled.select(F.col("country_id").alias("to_id"), "title", "field_name")
    moved = src.join(has, ["to_id", "title"], "left_semi").join(taken, ["to_id", "title", "field_name"], "left_anti")
    return moved.select("field_id", F.col("to_id").alias("country_id"))


@over_archive("link_restore", ", saved AS (SELECT DISTINCT code, master_id FROM countries WHERE master_id IS NOT NULL) SELECT c.country_id, coalesce(c.master_id, s.master_id) AS master_id FROM countries c LEFT JOIN saved s USING (code)")
def link_restore(a):
    """Links to entities by code, as saved before a reload."""
    saved = a.countries.where("master_id IS NOT NULL").select("code", F.col("master_id").alias("saved")).distinct()
    return a.countries.join(saved, "code", "left").select("country_id", F.coalesce("master_id", "saved").alias("master_id"))


@over_archive("surrogate_keys", "SELECT field_id, row_number() OVER (ORDER BY country_id, category_id, field_id) AS row_id FROM fields")
def surrogate_keys(a):
    """Gapless keys for the fact table in its natural order."""
    order = ["country_id", "category_id", "field_id"]
    return keys.numbered(a.fields.select(*order), order, "row_id").select("field_id", "row_id")


@query("global_ranks", "SELECT l_orderkey, l_linenumber, rank() OVER (ORDER BY l_returnflag DESC) AS rank, dense_rank() OVER (ORDER BY l_returnflag DESC) AS dense_rank FROM lineitem")
def global_ranks(spark, sf_dir):
    """Ranks over a whole table by a value that half of its rows share."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_returnflag")
    return keys.ranked(rows, F.col("l_returnflag"), ascending=False).select("l_orderkey", "l_linenumber", "rank", "dense_rank")


@over_archive("value_ranks", "SELECT field_id, sub_field, rank() OVER (ORDER BY numeric_val) AS rank, dense_rank() OVER (ORDER BY numeric_val) AS dense_rank FROM vals")
def value_ranks(a):
    """Where a sub-value stands among all of them."""
    return keys.ranked(a.values.select("field_id", "sub_field", "numeric_val"), F.col("numeric_val")).select("field_id", "sub_field", "rank", "dense_rank")


@over_archive("sql_literal", "SELECT master_id, '(' || master_id || ', N''' || replace(replace(name, '_', ''''), '''', '''''') || ''', ' || coalesce('N''' || iso2 || '''', 'NULL') || ')' AS line FROM masters")
def sql_literal(a):
    """A row as a VALUES tuple: quotes doubled, nulls named."""
    quoted = lambda c: F.concat(F.lit("N'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))
    line = F.concat(F.lit("("), F.col("master_id").cast("string"), F.lit(", "), quoted(F.replace(F.col("name"), F.lit("_"), F.lit("'"))), F.lit(", "), F.coalesce(quoted(F.col("iso2")), F.lit("NULL")), F.lit(")"))
    return a.masters.select("master_id", line.alias("line"))


@query("encoding_audit", "SELECT doc_id, (length(text) - length(replace(text, 'é', '')))::INTEGER AS odd FROM documents WHERE contains(text, 'é')")
def encoding_audit(spark, sf_dir):
    """How often a suspect character stands in a text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.contains("text", F.lit("é")))
    return docs.select("doc_id", (F.length("text") - F.length(F.replace("text", F.lit("é"), F.lit("")))).alias("odd"))


@query("repair_fold", "SELECT doc_id, md5(replace(replace(text, 'é', 'e'), 'ee', 'E')) AS repaired FROM documents WHERE lang = 'fr'")
def repair_fold(spark, sf_dir):
    """Replacements folded over a text in their order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang = 'fr'")
    repairs = F.array(F.struct(F.lit("é").alias("old"), F.lit("e").alias("new")), F.struct(F.lit("ee").alias("old"), F.lit("E").alias("new")))
    return docs.select("doc_id", F.md5(F.aggregate(repairs, F.col("text"), lambda t, r: F.replace(t, r["old"], r["new"])).cast("binary")).alias("repaired"))
