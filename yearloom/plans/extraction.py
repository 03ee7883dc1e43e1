"""Queries over the text functions, parsers, name rules, entities, layouts and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from yearloom.functions import subvalues, text as X
from yearloom.operators import entities, inverted, layouts, names
from yearloom.operators.inverted import All, Any, Not, Phrase, Prefix, Term

from . import made
from .registry import query
from .relational import over_archive


@over_archive("normalize_content", r"SELECT field_id, trim(regexp_replace(regexp_replace(coalesce(content, ''), '\s*\|?\s*country comparison to the world:\s*\d+', '', 'g'), ':\s*\|\s*', ': ', 'g')) AS content FROM fields")
def normalize_content(a):
    return a.fields.select("field_id", X.normalized(F.col("content")).alias("content"))


@over_archive("extract_rank", r"SELECT field_id, TRY_CAST(nullif(regexp_extract(content, 'country comparison to the world:\s*(\d+)', 1), '') AS INTEGER) AS rank FROM fields")
def extract_rank(a):
    return a.fields.select("field_id", X.rank(F.col("content")).alias("rank"))


@over_archive("date_est", r"SELECT field_id, nullif(regexp_extract(content, '\((\d{4}\s*est\.?)\)', 1), '') AS date_est FROM fields")
def date_est(a):
    return a.fields.select("field_id", X.date_est(F.col("content")).alias("date_est"))


@query("html_to_pipe", r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
 regexp_replace(html, '<br\s*/?\s*>\s*(?:<br\s*/?\s*>)?', ' | ', 'gi'), '</p>\s*<p[^>]*>', ' | ', 'gi'), '</div>\s*<div[^>]*>', ' | ', 'gi'), '<[^>]+>', ' ', 'g'), '&[a-zA-Z]+;', ' ', 'g'), '\s+', ' ', 'g')),
 '(\s*\|\s*)+', ' | ', 'g'), '^\s*\|\s*', ''), '\s*\|\s*$', '')) AS text FROM pages""")
def html_to_pipe(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.trim(X.html_to_pipe(F.col("html"))).alias("text"))


STRIPPED = r"""SELECT page_id, {0} AS text FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '<br\s*/?\s*>\s*(?:<br\s*/?\s*>)?', ' | ', 'gi'), '</p>\s*<p[^>]*>', ' | ', 'gi'), '<[^>]+>', ' ', 'g') AS t FROM pages)"""
DECODED = "t"
for _entity, _letter in X.ENTITIES.items():
    DECODED = f"replace({DECODED}, '{_entity}', '{_letter}')"
PIPED = r"trim(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace({0}, '\s+', ' ', 'g')), '(\s*\|\s*)+', ' | ', 'g'), '^\s*\|\s*', ''), '\s*\|\s*$', ''))"


@query("strip_html", STRIPPED.format(PIPED.format(DECODED)))
def strip_html(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.trim(X.strip_html(F.col("html"))).alias("text"))


@query("page_title", r"""WITH t AS (SELECT page_id, trim(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '–', ' - '), '—', ' - ')) AS t FROM pages),
p AS (SELECT page_id, t, regexp_split_to_array(t, '--|::| - ') AS parts FROM t),
n AS (SELECT page_id, CASE WHEN len(parts) > 1 THEN list_filter(list_transform(list_reverse(parts), lambda x: trim(regexp_replace(regexp_replace(x, 'The World Factbook.*|Central Intelligence Agency', '', 'g'), '^\s*CIA\s*$|^[\s-]+|[\s-]+$', '', 'g'))), lambda x: length(x) > 1)[1] END AS part,
 nullif(trim(regexp_replace(regexp_replace(t, 'CIA|Central Intelligence Agency|The World Factbook|\d{4}|-|::', ' ', 'g'), '\s+', ' ', 'g')), '') AS rest FROM p)
SELECT page_id, CASE WHEN name = upper(name) AND regexp_matches(name, '\p{L}')
 THEN array_to_string(list_transform(regexp_extract_all(name, '\p{L}+|[^\p{L}]+'), lambda x: upper(left(x, 1)) || lower(substr(x, 2))), '') ELSE name END AS name
FROM (SELECT page_id, coalesce(part, rest, 'Unknown') AS name FROM n)""")
def page_title(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", layouts.page_name(F.col("html")).alias("name"))


@over_archive("layout_dispatch", "SELECT DISTINCT year, CASE WHEN year BETWEEN 2001 AND 2008 THEN 'table' ELSE 'classic' END AS layout FROM countries")
def layout_dispatch(a):
    return a.countries.select("year", layouts.html_layout(F.col("year")).alias("layout")).distinct()


@query("layout_years", f"{made.BASE} SELECT y AS year, CASE WHEN y < 2001 OR y > 2020 THEN 'classic' WHEN y <= 2008 THEN 'table' WHEN y <= 2014 THEN 'collapsiblepanel' WHEN y <= 2017 THEN 'expandcollapse' ELSE 'modern' END AS layout, count(*) AS n FROM base GROUP BY 1, 2")
def layout_years(spark, sf_dir):
    """The layout of pages of all years that an archive may have."""
    years = made.texts(spark, sf_dir, "").select((1990 + F.col("k") % 36).cast("int").alias("year"))
    return years.groupBy("year", layouts.html_layout(F.col("year")).alias("layout")).agg(F.count(F.lit(1)).alias("n"))


@over_archive("extract_area", r""", c AS (SELECT field_id, content, nullif(regexp_extract(content, '\((\d{4} est\.)\)', 1), '') AS d FROM fields WHERE content LIKE '%total%')
SELECT field_id, 'total' AS sub_field, replace(regexp_extract(content, 'total: ([0-9,]+)', 1), ',', '')::DOUBLE AS numeric_val, NULL AS text_val, d AS date_est,
 TRY_CAST(nullif(regexp_extract(content, 'to the world: (\d+)', 1), '') AS INTEGER) AS rank FROM c
UNION ALL SELECT field_id, 'land', replace(regexp_extract(content, 'land: ([0-9,]+)', 1), ',', '')::DOUBLE, NULL, d, NULL FROM c
UNION ALL SELECT field_id, 'note', NULL, regexp_extract(content, 'note: (.*?)(?: country comparison.*)?$', 1), NULL, NULL FROM c""")
def extract_area(a):
    """The parser of areas over every field of the archive."""
    rows = subvalues.parsed(a.fields.select("field_id", "content"), "content", subvalues.area)
    return subvalues.exploded(rows.select("field_id", "sub_values"), F.col("sub_values")).select("field_id", "sub_field", "numeric_val", "text_val", "date_est", "rank")


@over_archive("extract_all")
def extract_all(a):
    """Sub-values of every field by the parser of its canonical name."""
    m = a.mappings.where("is_noise = 0").select(F.col("original").alias("field_name"), "canonical")
    named = a.fields.join(m, "field_name", "left").withColumn("canonical", F.coalesce("canonical", "field_name"))
    among = [r["canonical"] for r in m.select("canonical").distinct().collect()]  # a dimension of some thousand names
    return subvalues.extract(named.select("field_id", "canonical", "content"), "canonical", "content", among=among)


@over_archive("dash_normalize", "SELECT original, regexp_replace(original, '^(.+?)(?:--|-)(.+)$', '\\1 - \\2') AS dashed FROM mappings")
def dash_normalize(a):
    return a.mappings.select("original", names.dash_normalized(F.col("original")).alias("dashed"))


@over_archive("canonical_rules", """, used AS (SELECT field_name AS original, min(year) AS first_year, max(year) AS last_year, count(*) AS use_count FROM fields LEFT JOIN countries USING (country_id) GROUP BY 1)
SELECT original, first_year, last_year, use_count,
 CASE original WHEN '1-URGENT' THEN 'Area' WHEN '2-HIGH' THEN 'Area' WHEN '4-NOT SPECIFIED' THEN '4-NOT SPECIFIED' ELSE original END AS canonical,
 CASE original WHEN '1-URGENT' THEN 'rename' WHEN '2-HIGH' THEN 'dash_format' WHEN '3-MEDIUM' THEN 'identity' WHEN '4-NOT SPECIFIED' THEN 'country_specific' ELSE 'consolidation' END AS mapping_type,
 CASE original WHEN '5-LOW' THEN 'Geography' END AS consolidated_to, 0 AS is_noise FROM used""")
def canonical_rules(a):
    """One name for each of five outcomes: a known rename, one once its dash is spelled out, a name of the last edition, an
    entry that isn't a field, and a part of another field."""
    used = names.usage(a.fields, a.countries)
    lookup = lambda cols, rows: a.masters.sparkSession.createDataFrame(rows, cols)
    renames = lookup("name string, canonical string", [("1-URGENT", "Area"), ("2 - HIGH", "Area")])
    parents = lookup("name string, parent string", [("5-LOW", "Geography")])
    modern = lookup("name string", [("3-MEDIUM",), ("1-URGENT",)])
    return names.canonical(used, modern, renames, parents, lookup("name string", [("4-NOT SPECIFIED",)]))


@over_archive("backfill_mapping", "SELECT DISTINCT field_name AS original, field_name AS canonical, 'unmapped' AS mapping_type FROM fields WHERE field_name NOT IN (SELECT original FROM mappings)")
def backfill_mapping(a):
    return names.backfilled(a.fields, a.mappings)


USED = """, used AS (SELECT original, min(year) AS first_year, max(year) AS last_year, count(*) AS use_count FROM (
  SELECT title || CASE WHEN field_id % 7 = 0 THEN ' (' || field_id % 100 || ')' WHEN field_id % 7 = 1 THEN '.' WHEN field_id % 7 = 2 THEN ' parties' WHEN field_id % 7 = 3 THEN ', Senate' ELSE '' END AS original, year
  FROM fields JOIN categories USING (category_id, country_id) JOIN countries USING (country_id)) GROUP BY 1)
"""


def used_names(a):
    """Titles with endings, taken as names of fields, so that several rules have something to find."""
    k = F.col("field_id")
    ending = F.when(k % 7 == 0, F.concat(F.lit(" ("), (k % 100).cast("string"), F.lit(")"))).when(k % 7 == 1, ".").when(k % 7 == 2, " parties").when(k % 7 == 3, ", Senate").otherwise("")
    titled = a.fields.join(a.categories.select("category_id", "title"), "category_id").select("country_id", F.concat("title", ending).alias("field_name"))
    return names.usage(titled, a.countries)


@over_archive("noise_flags", USED + r"""SELECT original, (
  length(original) <= 2 AND regexp_matches(original, '^\p{L}+$') OR original LIKE '%.' AND length(original) <= 6
  OR original = upper(original) AND regexp_matches(original, '\p{Lu}') AND length(original) <= 4 AND use_count <= 5 OR regexp_matches(original, '^\p{Ll}') AND (use_count <= 10 OR first_year <= 1998)
  OR length(original) > 80 AND use_count <= 3 OR regexp_matches(original, '^with (run|permanent)|^Articles? [0-9]|^US(--| as )') OR contains(original, ',') AND use_count <= 3 AND length(original) > 40
  OR last_year <= 2001 AND use_count <= 10 AND regexp_matches(lower(original), 'parties|bloc|rightist|leftist|populist|resistance forces|ruling coalition|umbrella group|africans|people''s army')
  OR use_count <= 5 AND last_year <= 2001 AND length(original) < 40 OR contains(original, 'includes') AND use_count <= 5 OR original LIKE '%)' AND use_count <= 3 AND last_year <= 2001) AS noise,
 last_year <= 2001 AND use_count <= 100 AND (contains(original, 'Assembly') OR contains(original, 'Senate')) AS body
FROM used""")
def noise_flags(a):
    used = used_names(a)
    c = [F.col(x) for x in ("original", "use_count", "first_year", "last_year")]
    return used.select("original", names.is_noise(*c).alias("noise"), names.is_body(c[0], c[1], c[3]).alias("body"))


@over_archive("headwords", """, own AS (SELECT iso2 AS o, name AS owner FROM masters WHERE iso2 IS NOT NULL)
SELECT c.country_id, c.name, c.master_id, array_to_string(list_filter([c.name, CASE WHEN own.owner = c.name THEN e.iso2 END, CASE WHEN e.code IS DISTINCT FROM e.iso2 AND e.code NOT IN (SELECT o FROM own) THEN e.code END], lambda x: x IS NOT NULL), ';') AS codes
FROM countries c JOIN masters e USING (master_id) LEFT JOIN own ON own.o = e.iso2""")
def headwords(a):
    return entities.headwords(a.countries.select("country_id", "name", "master_id"), a.masters).withColumn("codes", F.array_join("codes", ";"))


@query("dup_keys", "SELECT (1990 + c_custkey % 36)::INTEGER AS year, n_name AS name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2 HAVING count(*) > 1")
def dup_keys(spark, sf_dir):
    """Years and names that stand more than once, over customers taken as editions."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    editions = read("customer").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    year = (F.lit(1990) + F.col("c_custkey") % 36).cast("int").alias("year")
    return editions.groupBy(year, F.col("n_name").alias("name")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@over_archive("dq_iso_coverage", "SELECT count(*) AS sovereigns, count(iso2) AS with_iso FROM masters WHERE entity_type = 'sovereign'")
def dq_iso_coverage(a):
    return a.masters.where("entity_type = 'sovereign'").agg(F.count(F.lit(1)).alias("sovereigns"), F.count("iso2").alias("with_iso"))


@over_archive("dq_structure", """, f AS (SELECT country_id, count(*) AS n FROM fields GROUP BY 1), g AS (SELECT country_id, count(*) AS n FROM categories GROUP BY 1)
SELECT c.year, count(*) AS countries, sum(g.n)::BIGINT AS categories, sum(f.n)::BIGINT AS fields, round(sum(f.n) / count(*), 4)::DOUBLE AS fields_each, round(sum(g.n) / count(*), 4)::DOUBLE AS categories_each, sum(f.n) / count(*) < 30 AS thin
FROM countries c JOIN f USING (country_id) JOIN g USING (country_id) GROUP BY 1""")
def dq_structure(a):
    """Per edition: entities, categories, fields, both for each entity, and whether it is thin."""
    n = a.fields.groupBy("country_id").agg(F.count(F.lit(1)).alias("f")).join(a.categories.groupBy("country_id").agg(F.count(F.lit(1)).alias("g")), "country_id")
    told = n.join(a.countries, "country_id").groupBy("year").agg(F.count(F.lit(1)).alias("countries"), F.sum("g").alias("categories"), F.sum("f").alias("fields"))
    each = lambda c: F.col(c) / F.greatest(F.col("countries"), F.lit(1))
    return told.select("*", F.round(each("fields"), 4).alias("fields_each"), F.round(each("categories"), 4).alias("categories_each"), (each("fields") < 30).alias("thin"))


@over_archive("fv_checks", """, n AS (SELECT (SELECT count(*) FROM vals) AS v, (SELECT count(*) FROM fields) AS f, (SELECT count(DISTINCT field_id) FROM vals) AS parsed, (SELECT count(numeric_val) FROM vals) AS num,
 (SELECT count(source_fragment) FROM vals) AS frag, (SELECT count(*) FROM vals WHERE is_computed = 1) AS comp, (SELECT count(*) FROM fields JOIN mappings ON field_name = original WHERE canonical = 'Area') AS registered)
SELECT 'expansion' AS "check", round(v / f, 6) AS observed, v / f > 1 AS ok FROM n UNION ALL SELECT 'coverage', round(parsed / f, 6), parsed / f >= 0.95 FROM n
UNION ALL SELECT 'numeric', round(num / v, 6), num / v >= 0.2 FROM n UNION ALL SELECT 'fragments', round(frag / v, 6), frag / v >= 0.95 FROM n
UNION ALL SELECT 'computed', round(comp / v, 6), comp < v FROM n UNION ALL SELECT 'registered', round(registered / f, 6), registered > 0 FROM n""")
def fv_checks(a):
    """Sub-values held against thresholds: a row for each check.  Registered fields have a parser of their own."""
    of = a.fields.join(a.mappings.select(F.col("original").alias("field_name"), "canonical"), "field_name", "left")
    named = F.count_if(F.col("canonical").isin(list(subvalues.PARSERS)))
    f = of.agg(F.count(F.lit(1)).alias("f"), named.alias("registered"))
    v = a.values.agg(F.count(F.lit(1)).alias("v"), F.count_distinct("field_id").alias("parsed"), F.count("numeric_val").alias("num"), F.count("source_fragment").alias("frag"), F.count_if(F.col("is_computed") == 1).alias("comp"))
    share = lambda x, y: F.col(x) / F.col(y)
    told = [
        ("expansion", share("v", "f"), share("v", "f") > 1), ("coverage", share("parsed", "f"), share("parsed", "f") >= 0.95), ("numeric", share("num", "v"), share("num", "v") >= 0.2),
        ("fragments", share("frag", "v"), share("frag", "v") >= 0.95), ("computed", share("comp", "v"), F.col("comp") < F.col("v")), ("registered", share("registered", "f"), F.col("registered") > 0),
    ]
    rows = F.array(*(F.struct(F.lit(n).alias("check"), F.round(x, 6).alias("observed"), ok.alias("ok")) for n, x, ok in told))
    return f.crossJoin(v).select(F.inline(rows))  # one row each


@over_archive("fv_coverage", "SELECT count(*) AS vals, count(DISTINCT field_id) AS fields, count(numeric_val) AS with_number, count(source_fragment) AS with_fragment FROM vals")
def fv_coverage(a):
    return a.values.agg(F.count(F.lit(1)).alias("vals"), F.count_distinct("field_id").alias("fields"), F.count("numeric_val").alias("with_number"), F.count("source_fragment").alias("with_fragment"))


@over_archive("fv_top_subfields", "SELECT sub_field, count(*) AS n FROM vals GROUP BY 1 ORDER BY n DESC, sub_field LIMIT 20")
def fv_top_subfields(a):
    return a.values.groupBy("sub_field").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "sub_field").limit(20)


@over_archive("mapping_coverage", """, used AS (SELECT field_name, count(*) AS n FROM fields GROUP BY 1)
SELECT 'mapped' AS "check", 'all' AS key, count(*) FILTER (m.original IS NOT NULL) AS observed, count(*) AS expected FROM used LEFT JOIN mappings m ON field_name = m.original
UNION ALL SELECT 'unmapped', field_name, n, 0 FROM used WHERE field_name NOT IN (SELECT original FROM mappings)
UNION ALL SELECT 'case_variant', field_name, n, 0 FROM used WHERE field_name NOT IN (SELECT original FROM mappings) AND lower(field_name) IN (SELECT lower(original) FROM mappings)
UNION ALL SELECT 'nameless', 'all', count(*) FILTER (trim(coalesce(field_name, '')) = ''), 0 FROM fields
UNION ALL SELECT 'doubled', 'all', count(*) - count(DISTINCT original), 0 FROM mappings
UNION ALL SELECT 'rows', 'all', count(*), 4 FROM mappings
UNION ALL SELECT 'years', 'NATION_8', count(DISTINCT c.year), 7 FROM fields f JOIN mappings m ON f.field_name = m.original JOIN countries c USING (country_id) JOIN masters e USING (master_id) WHERE e.name = 'NATION_8' AND m.canonical = 'Area'
UNION ALL SELECT 'type', mapping_type, count(*), NULL FROM mappings GROUP BY 2""")
def mapping_coverage(a):
    """The checks of the name mapping: what is mapped, what isn't, names that differ in case only, nameless fields, doubled
    and all rows, the years that one entity's field is found in, and rows by type."""
    n, all_ = F.count(F.lit(1)), F.lit("all")
    used = a.fields.groupBy("field_name").agg(n.alias("n"))
    known = a.mappings.select(F.col("original").alias("field_name"), F.lit(True).alias("known"))
    told = lambda df, check, key, observed, expected: df.select(F.lit(check).alias("check"), key.alias("key"), observed.alias("observed"), F.lit(expected).cast("long").alias("expected"))
    mapped = used.join(known, "field_name", "left").agg(F.count("known").alias("o"), n.alias("e"))
    missing = used.join(known, "field_name", "left_anti")
    variants = missing.join(a.mappings.select(F.lower("original").alias("low")).distinct(), F.lower("field_name") == F.col("low"), "left_semi")
    from .relational import star

    years = star(a).where("name = 'NATION_8' AND canonical = 'Area'").agg(F.count_distinct("year").alias("o"))
    parts = [
        mapped.select(F.lit("mapped").alias("check"), all_.alias("key"), F.col("o").alias("observed"), F.col("e").alias("expected")),
        told(missing, "unmapped", F.col("field_name"), F.col("n"), 0),
        told(variants, "case_variant", F.col("field_name"), F.col("n"), 0),
        told(a.fields.agg(F.count_if(F.trim(F.coalesce("field_name", F.lit(""))) == "").alias("o")), "nameless", all_, F.col("o"), 0),
        told(a.mappings.agg((n - F.count_distinct("original")).alias("o")), "doubled", all_, F.col("o"), 0),
        told(a.mappings.agg(n.alias("o")), "rows", all_, F.col("o"), 4),
        told(years, "years", F.lit("NATION_8"), F.col("o"), 7),
        told(a.mappings.groupBy("mapping_type").agg(n.alias("o")), "type", F.col("mapping_type"), F.col("o"), None),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out


TERMS = r"WITH d AS (SELECT doc_id AS doc, list_filter(string_split_regex(strip_accents(lower(coalesce(text, ''))), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t FROM documents) "


def index(spark, sf_dir):
    """The stored index of documents, built once in a session."""
    return inverted.of_table(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")


@query("fts_and", TERMS + "SELECT doc FROM d WHERE list_has_all(t, ['license', 'the'])")
def fts_and(spark, sf_dir):
    return index(spark, sf_dir).search(All((Term("license"), Term("the"))))


@query("fts_or", TERMS + "SELECT doc FROM d WHERE list_has_any(t, ['license', 'copyright'])")
def fts_or(spark, sf_dir):
    return index(spark, sf_dir).search(Any((Term("license"), Term("copyright"))))


@query("fts_not", TERMS + "SELECT doc FROM d WHERE list_contains(t, 'the') AND NOT list_contains(t, 'license')")
def fts_not(spark, sf_dir):
    return index(spark, sf_dir).search(All((Term("the"), Not(Term("license")))))


@query("fts_prefix", TERMS + "SELECT doc FROM d WHERE len(list_filter(t, lambda x: starts_with(x, 'licen'))) > 0")
def fts_prefix(spark, sf_dir):
    return index(spark, sf_dir).search(Prefix("licen"))


@query("fts_phrase", TERMS + "SELECT doc FROM d WHERE contains(' ' || array_to_string(t, ' ') || ' ', ' under the ')")
def fts_phrase(spark, sf_dir):
    return index(spark, sf_dir).search(Phrase(("under", "the")))


@query("fts_grammar", TERMS + """SELECT doc FROM d WHERE (contains(' ' || array_to_string(t, ' ') || ' ', ' under the ') OR len(list_filter(t, lambda x: starts_with(x, 'copyr'))) > 0)
 AND list_contains(t, 'license') AND NOT (list_contains(t, 'und') OR contains(' ' || array_to_string(t, ' ') || ' ', ' of the '))""")
def fts_grammar(spark, sf_dir):
    """Words, phrases and beginnings under and, or and not, in one pass over their postings."""
    either = Any((Phrase(("under", "the")), Prefix("copyr")))
    return index(spark, sf_dir).search(All((either, Term("license"), Not(Any((Term("und"), Phrase(("of", "the"))))))))


@query("fts_tokens", TERMS + "SELECT term, count(*) AS times, count(DISTINCT doc) AS docs FROM (SELECT doc, unnest(t) AS term FROM d) GROUP BY 1")
def fts_tokens(spark, sf_dir):
    """The terms of the index and how often they stand."""
    return index(spark, sf_dir).terms()


@query("fts_bm25", TERMS + """, s AS (SELECT doc, len(t) AS n, len(list_filter(t, lambda x: x = 'license')) AS a, len(list_filter(t, lambda x: x = 'copyright')) AS b FROM d),
g AS (SELECT count(*) AS docs, avg(n) AS mean, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM s)
SELECT doc, round(CASE WHEN a > 0 THEN ln((docs - da + 0.5) / (da + 0.5) + 1) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * n / mean)) ELSE 0 END
 + CASE WHEN b > 0 THEN ln((docs - db + 0.5) / (db + 0.5) + 1) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * n / mean)) ELSE 0 END, 6) AS score FROM s, g WHERE a > 0 OR b > 0""")
def fts_bm25(spark, sf_dir):
    return index(spark, sf_dir).bm25(["license", "copyright"]).select("doc", F.round("score", 6).alias("score"))
