"""Queries over dictionary entries, and further data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from yearloom.functions import text as X
from yearloom.operators import booksets, dictionary as D, layouts
from yearloom.sources import sinks, stardict, storage

from .extraction import DECODED, PIPED
from .registry import query
from .relational import over_archive, star

EDITION = """, named AS (SELECT c.country_id, c.name, list_filter([c.name, e.iso2, e.code], lambda x: x IS NOT NULL) AS codes
 FROM countries c JOIN masters e USING (master_id))"""
GENERAL = EDITION + """, g AS (SELECT country_id, field_name, any_value(name) AS name, any_value(codes) AS codes, arg_min(title, category_id) AS title,
 string_agg(content, chr(10) ORDER BY category_id, field_id) AS content, min({'c': category_id, 'f': field_id}) AS place
 FROM fields JOIN named USING (country_id) JOIN categories USING (category_id, country_id) WHERE trim(content) <> '' GROUP BY 1, 2),
entries AS (SELECT name || ' - ' || field_name AS entry, CASE WHEN row_number() OVER (PARTITION BY country_id ORDER BY place) = 1 THEN array_to_string(codes, ';') || ';' ELSE '' END
 || array_to_string(list_transform(codes, lambda x: x || ' - ' || field_name), ';') AS headwords,
 '<i>' || name || '</i><br>' || chr(10) || '<small>' || title || '</small><br><br>' || chr(10) || content AS body, country_id, place FROM g)
"""


def shown(entries):
    """Entries by edition and the headword that joins name and field, the headwords as one text."""
    words = F.col("headwords")
    return entries.select("place.country_id", F.get(F.filter(words, lambda w: w.contains(" - ")), F.lit(0)).alias("entry"), F.array_join(words, ";").alias("headwords"), "body")


def general(a, *years):
    """Entries of all editions, or of those named."""
    countries = a.countries.where(F.col("year").isin(*years)) if years else a.countries
    return D.general(countries, a.categories, a.fields, a.masters)


@over_archive("dict_general", GENERAL + "SELECT country_id, entry, headwords, body FROM entries")
def dict_general(a):
    return shown(general(a))


@over_archive("dict_files", GENERAL + "SELECT 'general ' || (country_id % 10000) AS book, array_to_string(list_sort(string_split(headwords, ';')), ';') AS headwords, body FROM entries")
def dict_files(a):
    """The dictionaries of all editions, a book each, written to files and read back from them."""
    spark = a.fields.sparkSession
    books = general(a).select(F.concat(F.lit("general "), (F.col("place.country_id") % 10000).cast("string")).alias("book"), "headwords", "body")
    folder = storage.new_folder(spark, "books")
    stardict.write(books, folder)
    return stardict.read(spark, folder).select("book", F.array_join(F.array_sort("headwords"), ";").alias("headwords"), "body")


@over_archive("dict_structured", EDITION + """, v AS (SELECT field_id, string_agg('<b>' || sub_field || '</b>: ' || format('{:,}', numeric_val::BIGINT) || ' ' || units || '<br>', chr(10) ORDER BY sub_field) AS lines FROM vals GROUP BY 1),
g AS (SELECT country_id, field_name, any_value(name) AS name, any_value(codes) AS codes, arg_max(title, category_id) AS title, string_agg(lines, chr(10) ORDER BY category_id, field_id) AS lines, min({'c': category_id, 'f': field_id}) AS place
 FROM fields JOIN named USING (country_id) JOIN categories USING (category_id, country_id) JOIN v USING (field_id) GROUP BY 1, 2)
SELECT country_id, name || ' - ' || field_name AS entry, CASE WHEN row_number() OVER (PARTITION BY country_id ORDER BY place) = 1 THEN array_to_string(codes, ';') || ';' ELSE '' END
 || array_to_string(list_transform(codes, lambda x: x || ' - ' || field_name), ';') AS headwords, '<i>' || name || '</i><br>' || chr(10) || '<small>' || title || '</small><br><br>' || chr(10) || lines AS body FROM g""")
def dict_structured(a):
    return shown(D.structured(a.countries, a.categories, a.fields, a.values, a.masters))


@over_archive("dict_overlap", GENERAL + """, w AS (SELECT DISTINCT country_id % 10000 AS book, unnest(string_split(headwords, ';')) AS word FROM entries), n AS (SELECT book, count(*) AS n FROM w GROUP BY 1),
p AS (SELECT book, lead(book) OVER (ORDER BY book) AS next_book FROM n), s AS (SELECT book, next_book, count(*) AS shared FROM w JOIN p USING (book) WHERE (next_book, word) IN (SELECT (book, word) FROM w) GROUP BY 1, 2)
SELECT p.book, p.next_book, coalesce(shared, 0) AS shared, a.n - coalesce(shared, 0) AS gone, b.n - coalesce(shared, 0) AS came, true AS near
FROM p JOIN n a ON a.book = p.book JOIN n b ON b.book = p.next_book LEFT JOIN s ON s.book = p.book""")
def dict_overlap(a):
    """Headwords that each edition's dictionary shares with the next, and whether sketches of both say nearly the same."""
    rows = general(a).select((F.col("place.country_id") % 10000).alias("book"), F.explode("headwords").alias("word"))
    words = booksets.sets(rows, "book", "word")
    pairs = booksets.followers(words)
    told = booksets.sketched(words, pairs)
    told = told.select("book", *(F.col(c).alias(f"_{c}") for c in ("shared", "gone", "came", "deviation")))
    near = [booksets.within(F.col(f"_{c}"), F.col(c), F.col("_deviation")) for c in ("shared", "gone", "came")]
    return booksets.exact(words, pairs).join(told, "book").select("book", "next_book", "shared", "gone", "came", (near[0] & near[1] & near[2]).alias("near"))


@over_archive("dict_pair_checks", GENERAL + EDITION.replace(", named AS", ", named2 AS") + """, have AS (SELECT country_id % 10000 AS book, count(*) AS n FROM entries GROUP BY 1),
stored AS (SELECT c.year AS book, count(DISTINCT (country_id, field_name)) AS n FROM fields JOIN countries c USING (country_id) WHERE master_id IS NOT NULL AND trim(content) <> '' GROUP BY 1),
v AS (SELECT field_id FROM vals GROUP BY 1), st AS (SELECT DISTINCT country_id, name || ' - ' || field_name AS entry FROM fields JOIN named2 USING (country_id) JOIN v USING (field_id)),
iso AS (SELECT country_id, iso2 FROM countries JOIN masters e USING (master_id) WHERE iso2 IS NOT NULL)
SELECT unnest(['count', 'subset', 'iso', 'files', 'round_trip']) AS "check", unnest([
 (SELECT count(*) FROM stored LEFT JOIN have USING (book) WHERE abs(coalesce(have.n, 0) - stored.n) > greatest(5, stored.n / 100)),
 (SELECT count(*) FROM st WHERE (country_id, entry) NOT IN (SELECT (country_id, entry) FROM entries)),
 (SELECT count(*) FROM iso WHERE country_id IN (SELECT country_id FROM entries) AND (country_id, iso2) NOT IN (SELECT (country_id, unnest(string_split(headwords, ';'))) FROM entries)), 0, 0]) AS observed""")
def dict_pair_checks(a):
    """Checks of dictionaries against the archive, each other and their files: books whose number of entries isn't that
    of the fields stored, structured entries that the general one lacks, ISO codes that are no headword, books with
    missing files, and entries that files don't give back."""
    spark, years = a.fields.sparkSession, (F.col("place.country_id") % 10000).alias("book")
    # Five checks read the entries; they are made once.
    kept = storage.new_folder(spark, "entries")
    general(a).write.parquet(kept)
    plain = spark.read.parquet(kept)
    entries = shown(plain)
    have = plain.groupBy(years).agg(F.count(F.lit(1)).alias("n"))
    linked = a.countries.where("master_id IS NOT NULL").select("country_id", F.col("year").alias("book"))
    stored = a.fields.where(F.trim("content") != "").join(linked, "country_id").select("book", "country_id", "field_name").distinct().groupBy("book").agg(F.count(F.lit(1)).alias("stored"))
    off = stored.join(have, "book", "left").where(F.abs(F.coalesce("n", F.lit(0)) - F.col("stored")) > F.greatest(F.lit(5), F.col("stored") / 100))
    structured = shown(D.structured(a.countries, a.categories, a.fields, a.values, a.masters)).select("country_id", "entry")
    lacking = structured.join(entries.select("country_id", "entry"), ["country_id", "entry"], "left_anti")
    words = plain.select("place.country_id", F.explode("headwords").alias("iso2")).distinct()
    iso = a.countries.join(a.masters.where("iso2 IS NOT NULL").select("master_id", "iso2"), "master_id").join(entries.select("country_id"), "country_id", "left_semi")
    folder = storage.new_folder(spark, "books")
    books = plain.select(years.cast("string").alias("book"), "headwords", "body")
    stardict.write(books, folder)
    same = lambda df: df.select("book", F.array_join(F.array_sort("headwords"), ";").alias("headwords"), "body")
    found = {
        "count": off,
        "subset": lacking,
        "iso": iso.join(words, ["country_id", "iso2"], "left_anti"),
        "files": sinks.missing_books(books.select("book").distinct(), folder),
        "round_trip": same(books).exceptAll(same(stardict.read(spark, folder))),
    }
    parts = [df.agg(F.count(F.lit(1)).alias("observed")).select(F.lit(name).alias("check"), "observed") for name, df in found.items()]
    return reduce(DataFrame.unionByName, parts)


LINES = """, v AS (SELECT field_id, string_agg('<b>' || sub_field || '</b>: ' || format('{:,}', numeric_val::BIGINT) || ' ' || units || '<br>', chr(10) ORDER BY sub_field) AS lines FROM vals GROUP BY 1),
sg AS (SELECT country_id, field_name, any_value(name) AS name, arg_max(title, category_id) AS title, string_agg(lines, chr(10) ORDER BY category_id, field_id) AS lines
 FROM fields JOIN named USING (country_id) JOIN categories USING (category_id, country_id) JOIN v USING (field_id) GROUP BY 1, 2),
lined AS (SELECT country_id, field_name, name || ' - ' || field_name AS entry, '<i>' || name || '</i><br>' || chr(10) || '<small>' || title || '</small><br><br>' || chr(10) || lines AS body FROM sg)
"""
TRUTHS = """, t AS (SELECT country_id % 10000 AS book, name || ' - ' || field_name AS entry, CASE WHEN is_computed = 1 THEN 'computed ' ELSE '' END || source_fragment AS needle
 FROM vals JOIN fields USING (field_id) JOIN named USING (country_id))
"""


def by_book(entries):
    """Entries with their book, the edition whose year ends the key of its countries."""
    return entries.select((F.col("place.country_id") % 10000).alias("book"), "headwords", "body")


def truths(a):
    """What the stored values say must stand in the entries of their fields; computed ones say that they are, which no body has."""
    rows = a.values.select("field_id", F.concat(F.when(F.col("is_computed") == 1, "computed ").otherwise(""), "source_fragment").alias("needle"))
    rows = rows.join(a.fields.select("field_id", "country_id", "field_name"), "field_id").join(a.countries.where("master_id IS NOT NULL").select("country_id", "name"), "country_id")
    return rows.select((F.col("country_id") % 10000).alias("book"), F.concat_ws(" - ", "name", "field_name").alias("headword"), "needle")


@over_archive("dict_truths", GENERAL + TRUTHS + """SELECT book, count(*) AS truths, count(*) FILTER (NOT coalesce(contains(body, needle), false)) AS untold
FROM t LEFT JOIN (SELECT country_id % 10000 AS book, entry, body FROM entries) USING (book, entry) GROUP BY 1""")
def dict_truths(a):
    """Stored values against the bodies of each book."""
    told = D.truths_told(by_book(general(a)), truths(a))
    return told.groupBy("book").agg(F.count(F.lit(1)).alias("truths"), F.count_if(~F.col("ok")).alias("untold"))


ASKED = [("1-URGENT", "total"), ("1-URGENT", "land"), ("2-HIGH", "water"), ("no such field", "total")]


@over_archive("dict_edition_checks", GENERAL + LINES + """, asked(field_name, sub_field) AS (VALUES ('1-URGENT', 'total'), ('1-URGENT', 'land'), ('2-HIGH', 'water'), ('no such field', 'total')),
have AS (SELECT DISTINCT country_id % 10000 AS book, name FROM g), stored AS (SELECT DISTINCT c.year AS book, c.name FROM fields JOIN countries c USING (country_id) WHERE master_id IS NOT NULL AND trim(content) <> ''),
past AS (SELECT year AS book, name FROM countries WHERE year = (SELECT min(year) FROM countries)),
both_have AS (SELECT e.body AS a, l.body AS b FROM entries e JOIN lined l USING (country_id, entry))
SELECT unnest(['sub_fields', 'names', 'past', 'shared', 'equal']) AS "check", unnest([
 (SELECT count(*) FROM asked JOIN lined USING (field_name) WHERE NOT contains(body, '<b>' || sub_field || '</b>: ')),
 (SELECT count(*) FROM ((SELECT * FROM have EXCEPT SELECT * FROM stored) UNION ALL (SELECT * FROM stored EXCEPT SELECT * FROM have))),
 (SELECT count(*) FROM (SELECT * FROM past EXCEPT SELECT * FROM have)),
 (SELECT count(*) FROM both_have), (SELECT count(*) FROM both_have WHERE a = b)]) AS observed""")
def dict_edition_checks(a):
    """Checks of what editions say: structured entries without a sub-field that is asked of their field, names that only the
    archive or only a book has, names of the first edition that its book lacks, entries that the general and the structured
    book share, and those that are the same in both."""
    spark = a.fields.sparkSession
    # Four checks read the entries; they are made once.
    folders = [storage.new_folder(spark, "entries") for _ in range(2)]
    general(a).write.parquet(folders[0])
    D.structured(a.countries, a.categories, a.fields, a.values, a.masters).write.parquet(folders[1])
    plain, lined = (spark.read.parquet(f) for f in folders)
    books = by_book(plain)
    asked = spark.createDataFrame(ASKED, "field_name string, sub_field string")
    linked = a.countries.where("master_id IS NOT NULL").select("country_id", F.col("year").alias("book"), "name")
    stored = a.fields.where(F.trim("content") != "").select("country_id").distinct().join(linked, "country_id")
    oldest = a.countries.agg(F.min("year")).scalar()
    past = a.countries.where(F.col("year") == oldest).select(F.col("year").alias("book"), "name")
    keyed = [shown(x).select(F.col("country_id").alias("book"), "entry", "body") for x in (plain, lined)]
    both = D.alike(*keyed)
    total = lambda df, c: df.agg(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias("observed"))
    field = shown(lined).select(F.regexp_replace("entry", "^.*? - ", "").alias("field_name"), "body")
    found = {
        "sub_fields": total(D.sub_fields_told(field, asked), "lacking"),
        "names": total(D.names_apart(books, stored).withColumn("n", F.lit(1)), "n"),
        "past": total(D.names_apart(books, past).where("side = 'lacking'").withColumn("n", F.lit(1)), "n"),
        "shared": total(both, "shared"),
        "equal": total(both, "equal"),
    }
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("check"), "observed") for name, df in found.items()])


@over_archive("dict_dedup", GENERAL + """, u AS (SELECT split_part(headwords, ';', 1) AS main, unnest(string_split(headwords, ';')) AS word FROM entries), w AS (SELECT main, count(DISTINCT word) AS words FROM u GROUP BY 1)
SELECT main, words, string_agg(body, chr(10) ORDER BY country_id, place) AS body FROM entries JOIN w ON main = split_part(headwords, ';', 1) GROUP BY 1, 2""")
def dict_dedup(a):
    """All editions in one dictionary: what has the same primary headword becomes one entry."""
    return D.merged(general(a)).select(F.get("headwords", F.lit(0)).alias("main"), F.size("headwords").cast("long").alias("words"), "body")


@over_archive("dict_checks", GENERAL + """SELECT unnest(['entries', 'short', 'no_category', 'no_name', 'unbalanced', 'spoilt', 'no_headword', 'characters', 'doubled']) AS "check",
 unnest([count(*), count(*) FILTER (strlen(body) < 30), count(*) FILTER (NOT contains(body, '<small>')), count(*) FILTER (NOT contains(body, '<i>')),
  count(*) FILTER (len(regexp_extract_all(body, '<(i|b|small)>')) <> len(regexp_extract_all(body, '</(i|b|small)>'))), count(*) FILTER (contains(body, chr(65533))), count(*) FILTER (headwords = ''),
  sum(length(body))::BIGINT, count(*) - count(DISTINCT (country_id % 10000) || split_part(headwords, ';', 1))]) AS observed FROM entries""")
def dict_checks(a):
    """The checks of the dictionaries of all editions; a book is an edition, whose year ends the key of its countries."""
    return D.checks(general(a), book=F.col("place.country_id") % 10000)


@query("format_numeric", "SELECT o_orderkey, CASE WHEN o_totalprice = floor(o_totalprice) THEN format('{:,}', o_totalprice::BIGINT) ELSE regexp_replace(format('{:,.4f}', o_totalprice), '\\.?0+$', '') END || ' sq km' AS shown FROM orders")
def format_numeric(spark, sf_dir):
    price = F.col("o_totalprice").cast("double")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", X.formatted(price, F.lit("sq km")).alias("shown"))


@over_archive("fv_per_year", "SELECT c.year, count(*) AS vals, count(DISTINCT field_id) AS fields FROM vals JOIN fields USING (field_id) JOIN countries c USING (country_id) GROUP BY 1")
def fv_per_year(a):
    """Values are counted by field before they meet the fields."""
    n = a.values.groupBy("field_id").agg(F.count(F.lit(1)).alias("n"))
    rows = n.join(a.fields.select("field_id", "country_id"), "field_id").join(a.countries.select("country_id", "year"), "country_id")
    return rows.groupBy("year").agg(F.sum("n").alias("vals"), F.count(F.lit(1)).alias("fields"))


@over_archive("dq_load", """, n AS (SELECT country_id, count(*) AS fields, count(DISTINCT category_id) AS categories FROM fields GROUP BY 1)
SELECT year, count(*) AS countries, sum((coalesce(categories, 0) < 3)::INTEGER)::BIGINT AS few_categories, sum((coalesce(fields, 0) < 10)::INTEGER)::BIGINT AS few_fields FROM countries LEFT JOIN n USING (country_id) GROUP BY 1""")
def dq_load(a):
    """Per edition: its countries, and those of fewer than 3 categories or 10 fields."""
    n = a.fields.groupBy("country_id").agg(F.count(F.lit(1)).alias("fields"), F.count_distinct("category_id").alias("categories"))
    both = a.countries.join(n, "country_id", "left")
    few = lambda c, least: F.count_if(F.coalesce(c, F.lit(0)) < least)
    return both.groupBy("year").agg(F.count(F.lit(1)).alias("countries"), few("categories", 3).alias("few_categories"), few("fields", 10).alias("few_fields"))


@over_archive("dq_category", """, has AS (SELECT DISTINCT country_id, title FROM categories)
SELECT year, count(*) - count(has.country_id) AS missing, count(*) - count(has.country_id) > 10 AS flagged
FROM countries c LEFT JOIN has ON has.country_id = c.country_id AND title = CASE WHEN year <= 1995 THEN 'MACHINERY' ELSE 'BUILDING' END GROUP BY 1""")
def dq_category(a):
    """Countries without the key category, whose name depends on the edition."""
    key = F.when(F.col("year") <= 1995, "MACHINERY").otherwise("BUILDING")
    has = a.categories.select("country_id", "title", F.lit(1).alias("has")).distinct()
    both = a.countries.withColumn("title", key).join(has, ["country_id", "title"], "left")
    missing = F.count_if(F.col("has").isNull())
    return both.groupBy("year").agg(missing.alias("missing"), (missing > 10).alias("flagged"))


@over_archive("dq_benchmark", """, n AS (SELECT field_id, list_filter(list_transform(regexp_extract_all(content, '[0-9][0-9,]*'), lambda x: replace(x, ',', '')::BIGINT), lambda x: x > 100000 AND x < 200000)[1] AS observed FROM fields)
SELECT field_id, observed, abs(observed - 150000) <= 10000 AS ok FROM n WHERE observed IS NOT NULL""")
def dq_benchmark(a):
    """The first number of a content that lies in the plausible range, held against the truth."""
    numbers = F.transform(F.regexp_extract_all("content", F.lit("[0-9][0-9,]*"), F.lit(0)), lambda x: F.replace(x, F.lit(","), F.lit("")).cast("long"))
    rows = a.fields.select("field_id", F.get(F.filter(numbers, lambda x: (x > 100000) & (x < 200000)), F.lit(0)).alias("observed"))
    return rows.where("observed IS NOT NULL").withColumn("ok", F.abs(F.col("observed") - 150000) <= 10000)


@over_archive("spot_checks", """, truth(field_id, sub_field, expected, tolerance) AS (VALUES (1, 'total', 170000.0, 20000.0), (2, 'total', 40000.0, 100000.0), (3, 'land', 1.0, 1.0), (-1, 'total', 5.0, 1.0))
SELECT t.field_id, t.sub_field, v.numeric_val AS observed, coalesce(abs(v.numeric_val - t.expected) <= t.tolerance, false) AS ok FROM truth t LEFT JOIN vals v ON v.field_id = t.field_id AND v.sub_field = t.sub_field""")
def spot_checks(a):
    """Single values against known ones; a missing value fails."""
    truth = a.values.sparkSession.createDataFrame([(1, "total", 170000.0, 20000.0), (2, "total", 40000.0, 100000.0), (3, "land", 1.0, 1.0), (-1, "total", 5.0, 1.0)], "field_id long, sub_field string, expected double, tolerance double")
    got = truth.join(a.values.select("field_id", "sub_field", "numeric_val"), ["field_id", "sub_field"], "left")
    ok = F.coalesce(F.abs(F.col("numeric_val") - F.col("expected")) <= F.col("tolerance"), F.lit(False))
    return got.select("field_id", "sub_field", F.col("numeric_val").alias("observed"), ok.alias("ok"))


@over_archive("dq_samples", """, a AS (SELECT c.year, arg_min(f.content, f.field_id) AS content FROM fields f JOIN mappings m ON f.field_name = m.original JOIN countries c USING (country_id) JOIN masters e USING (master_id)
 WHERE m.canonical = 'Area' AND e.code = 'N08' AND trim(f.content) <> '' GROUP BY 1), n AS (SELECT year, TRY_CAST(replace(regexp_extract(content, '([0-9][0-9,]*)', 1), ',', '') AS DOUBLE) AS observed FROM a)
SELECT year, observed, coalesce(abs(observed - 200000) <= 190000, false) AS ok FROM n""")
def dq_samples(a):
    """One entity's first content of a field in each edition, its first number held against a range."""
    rows = star(a).where("canonical = 'Area' AND code = 'N08' AND trim(content) <> ''").groupBy("year").agg(F.min_by("content", "field_id").alias("content"))
    observed = F.replace(F.regexp_extract("content", "([0-9][0-9,]*)", 1), F.lit(","), F.lit("")).try_cast("double")
    return rows.select("year", observed.alias("observed")).withColumn("ok", F.coalesce(F.abs(F.col("observed") - 200000) <= 190000, F.lit(False)))


NEEDLES = [(1, "total: "), (2, "sq km"), (3, "nothing of the sort"), (-1, "x")]


@over_archive("substring_checks", ", t(field_id, needle) AS (VALUES (1, 'total: '), (2, 'sq km'), (3, 'nothing of the sort'), (-1, 'x')) SELECT t.field_id, needle, coalesce(contains(content, needle), false) AS ok FROM t LEFT JOIN fields f ON f.field_id = t.field_id")
def substring_checks(a):
    """Whether single contents hold what a repair should have put there; a missing field fails."""
    asked = a.fields.sparkSession.createDataFrame(NEEDLES, "field_id long, needle string")
    return asked.join(a.fields.select("field_id", "content"), "field_id", "left").select("field_id", "needle", F.coalesce(F.contains("content", F.col("needle")), F.lit(False)).alias("ok"))


@over_archive("set_entity_type", ", t(code, kind) AS (VALUES ('N03', 'special'), ('N08', 'antarctic'), ('N99', 'none')) SELECT master_id, coalesce(kind, entity_type) AS entity_type FROM masters LEFT JOIN t USING (code)")
def set_entity_type(a):
    """Kinds of entities set by code; a code that nobody has changes nothing."""
    told = a.masters.sparkSession.createDataFrame([("N03", "special"), ("N08", "antarctic"), ("N99", "none")], "code string, kind string")
    return a.masters.join(told, "code", "left").select("master_id", F.coalesce("kind", "entity_type").alias("entity_type"))


SKIPPED = ["template", "print", "summary", "notes", "appendix", "index", "wfb"]


@query("page_select", """WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '([^/.?#]+)[^/]*$', 1)) AS code FROM pages)
SELECT code, min(url) AS url FROM p WHERE code <> '' AND length(code) <= 5 AND NOT regexp_matches(code, 'template|print|summary|notes|appendix|index|wfb') GROUP BY 1""")
def page_select(spark, sf_dir):
    """The first page of each short code, by address; templates and the like aren't pages of a country."""
    code = F.lower(F.regexp_extract("url", "([^/.?#]+)[^/]*$", 1))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url", code.alias("code"))
    kept = pages.where((F.length("code").between(1, 5)) & ~F.col("code").rlike("|".join(SKIPPED)))
    return kept.groupBy("code").agg(F.min("url").alias("url"))


@query("json_explode", "SELECT conv_id::VARCHAR AS code, role AS category, turn::BIGINT AS place, 'text' AS field, " + PIPED.format(DECODED) + """ AS content
FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(text, '<br\\s*/?\\s*>\\s*(?:<br\\s*/?\\s*>)?', ' | ', 'gi'), '</p>\\s*<p[^>]*>', ' | ', 'gi'), '<[^>]+>', ' ', 'g') AS t FROM conversations)""")
def json_explode(spark, sf_dir):
    """Nested objects to rows, over turns made nested."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    field = F.struct(F.lit("text").alias("name"), F.col("text").alias("content"), F.lit(None).cast("string").alias("value"))
    nested = turns.select(F.col("conv_id").cast("string").alias("code"), F.col("turn").cast("long").alias("turn"), F.array(F.struct(F.col("role").alias("title"), F.array(field).alias("fields"))).alias("categories"))
    return _with_turn(nested)


def _with_turn(nested):
    """json_rows numbers places inside one object; a turn is its own object here, so its number is part of the code."""
    keyed = nested.select(F.concat_ws("#", "code", "turn").alias("code"), "categories")
    rows = layouts.json_rows(keyed)
    return rows.select(F.substring_index("code", "#", 1).alias("code"), "category", F.substring_index("code", "#", -1).cast("long").alias("place"), "field", "content")
