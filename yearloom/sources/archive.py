"""The archive's tables: a star of editions, categories and fields around a dimension of entities.

Archive.from_star derives them from an order-processing star schema, which gives every operator rows to work on where no
almanac is at hand; VIEWS says the same in SQL.  Archive.from_parquet reads a stored archive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
KINDS = ["sovereign", "territory", "disputed", "dissolved"]


@dataclass(frozen=True)
class Archive:
    masters: DataFrame  # master_id, code, name, iso2, entity_type, admin_id
    countries: DataFrame  # country_id, year, code, name, source, master_id
    categories: DataFrame  # category_id, country_id, title
    fields: DataFrame  # field_id, category_id, country_id, field_name, content
    mappings: DataFrame  # mapping_id, original, canonical, mapping_type, consolidated_to, is_noise, first_year, last_year, use_count
    values: DataFrame  # field_id, sub_field, numeric_val, units, date_est, source_fragment, is_computed

    TABLES = ("masters", "countries", "categories", "fields", "mappings", "values")

    @staticmethod
    def from_parquet(spark: SparkSession, folder: str) -> "Archive":
        """A stored archive; fields and values are partitioned by year, so that a filter on it prunes files."""
        return Archive(*(spark.read.parquet(f"{folder}/{t}") for t in Archive.TABLES))

    @staticmethod
    def from_star(spark: SparkSession, sf_dir: str) -> "Archive":
        read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
        key = F.col("n_nationkey")
        code = F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0"))
        kind = F.element_at(F.array(*map(F.lit, KINDS)), (key % 4 + 1).cast("int"))
        masters = read("nation").select(
            key.alias("master_id"),
            code.alias("code"),
            F.col("n_name").alias("name"),
            F.when(key % 7 != 0, F.concat(F.lit("X"), F.chr(65 + key))).alias("iso2"),
            kind.alias("entity_type"),
            F.when(key % 4 == 1, F.col("n_regionkey") * 4).alias("admin_id"),
        )
        orders = read("orders").join(read("customer").select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        year = F.year("o_orderdate")
        country = F.col("c_nationkey") * 10000 + year
        orders = orders.withColumns({"year": year, "country_id": country})
        countries = orders.select("country_id", "year", F.col("c_nationkey").alias("n")).distinct()
        countries = countries.join(read("nation").select(key.alias("n"), F.col("n_name").alias("name")), "n").select(
            "country_id",
            "year",
            F.concat(F.lit("N"), F.lpad(F.col("n").cast("string"), 2, "0")).alias("code"),
            "name",
            F.when(F.col("year") < 1996, "text").when(F.col("year") < 1999, "html").otherwise("json").alias("source"),
            F.when((F.col("n") + F.col("year")) % 11 != 0, F.col("n")).alias("master_id"),
        )
        place = F.array_position(F.array(*map(F.lit, SEGMENTS)), F.col("c_mktsegment")).cast("int")
        orders = orders.withColumn("category_id", F.col("country_id") * 10 + place)
        categories = orders.select("category_id", "country_id", F.col("c_mktsegment").alias("title")).distinct()
        total, land = F.floor("o_totalprice").cast("long"), F.floor(F.col("o_totalprice") / 2).cast("long")
        content = F.concat(
            F.lit("total: "), F.format_number(total, 0), F.lit(" sq km | land: "), F.format_number(land, 0), F.lit(" sq km | note: order "),
            F.col("o_orderkey").cast("string"), F.lit(" ("), F.col("year").cast("string"), F.lit(" est.)"),
            F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit(" country comparison to the world: "), (F.col("o_orderkey") % 97).cast("string"))).otherwise(""),
        )
        content = F.when(F.col("o_orderkey") % 50 == 7, None).when(F.col("o_orderkey") % 50 == 8, " ").otherwise(content)
        fields = orders.select(F.col("o_orderkey").alias("field_id"), "category_id", "country_id", F.col("o_orderpriority").alias("field_name"), content.alias("content"))
        name = F.col("field_name")
        named = fields.join(countries.select("country_id", "year"), "country_id").groupBy("field_name").agg(
            F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count(F.lit(1)).alias("use_count")
        )
        mappings = named.where(name != "3-MEDIUM").select(
            F.substring(name, 1, 1).cast("int").alias("mapping_id"),
            name.alias("original"),
            F.when(name.isin("1-URGENT", "2-HIGH"), "Area").otherwise(F.initcap(F.substring(name, 3, 50))).alias("canonical"),
            F.when(name.isin("1-URGENT", "2-HIGH"), "rename").when(name == "4-NOT SPECIFIED", "noise").otherwise("manual").alias("mapping_type"),
            F.when(name.isin("1-URGENT", "2-HIGH"), "Geography").alias("consolidated_to"),
            (name == "4-NOT SPECIFIED").cast("int").alias("is_noise"),
            "first_year", "last_year", "use_count",
        )
        parts = F.regexp_extract_all("content", F.lit(r"((?:total|land): [\d,]+ sq km)"), F.lit(1))
        found = fields.select("field_id", "content", F.explode(parts).alias("source_fragment"))
        values = found.select(
            "field_id",
            F.substring_index("source_fragment", ":", 1).alias("sub_field"),
            F.replace(F.regexp_extract("source_fragment", r"([\d,]+)", 1), F.lit(","), F.lit("")).cast("double").alias("numeric_val"),
            F.lit("sq km").alias("units"),
            F.nullif(F.regexp_extract("content", r"\((\d{4} est\.)\)", 1), F.lit("")).alias("date_est"),
            "source_fragment",
            F.when(F.col("field_id") % 13 == 0, 1).otherwise(0).alias("is_computed"),
        )
        return Archive(masters, countries, categories, fields, mappings, values)


#: The same tables for SQL engines; a query's text follows.
VIEWS = """WITH masters AS (
  SELECT n_nationkey AS master_id, 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS code, n_name AS name,
         CASE WHEN n_nationkey % 7 <> 0 THEN 'X' || chr(65 + n_nationkey) END AS iso2,
         CASE n_nationkey % 4 WHEN 0 THEN 'sovereign' WHEN 1 THEN 'territory' WHEN 2 THEN 'disputed' ELSE 'dissolved' END AS entity_type,
         CASE WHEN n_nationkey % 4 = 1 THEN n_regionkey * 4 END AS admin_id
  FROM nation
), star AS (
  SELECT o.*, c_nationkey, c_mktsegment, year(o_orderdate)::INTEGER AS year, (c_nationkey * 10000 + year(o_orderdate))::INTEGER AS country_id,
         ((c_nationkey * 10000 + year(o_orderdate)) * 10 + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
          WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END)::INTEGER AS category_id
  FROM orders o JOIN customer ON o_custkey = c_custkey
), countries AS (
  SELECT DISTINCT country_id, year, 'N' || lpad(c_nationkey::VARCHAR, 2, '0') AS code, n_name AS name,
         CASE WHEN year < 1996 THEN 'text' WHEN year < 1999 THEN 'html' ELSE 'json' END AS source,
         CASE WHEN (c_nationkey + year) % 11 <> 0 THEN c_nationkey END AS master_id
  FROM star JOIN nation ON n_nationkey = c_nationkey
), categories AS (
  SELECT DISTINCT category_id, country_id, c_mktsegment AS title FROM star
), fields AS (
  SELECT o_orderkey AS field_id, category_id, country_id, o_orderpriority AS field_name,
         CASE WHEN o_orderkey % 50 = 7 THEN NULL WHEN o_orderkey % 50 = 8 THEN ' ' ELSE
         'total: ' || format('{:,}', floor(o_totalprice)::BIGINT) || ' sq km | land: ' || format('{:,}', floor(o_totalprice / 2)::BIGINT)
         || ' sq km | note: order ' || o_orderkey || ' (' || year || ' est.)'
         || CASE WHEN o_orderkey % 5 = 0 THEN ' country comparison to the world: ' || (o_orderkey % 97) ELSE '' END END AS content
  FROM star
), mappings AS (
  SELECT substr(field_name, 1, 1)::INTEGER AS mapping_id, field_name AS original,
         CASE field_name WHEN '1-URGENT' THEN 'Area' WHEN '2-HIGH' THEN 'Area' WHEN '4-NOT SPECIFIED' THEN 'Not Specified' ELSE 'Low' END AS canonical,
         CASE WHEN field_name IN ('1-URGENT', '2-HIGH') THEN 'rename' WHEN field_name = '4-NOT SPECIFIED' THEN 'noise' ELSE 'manual' END AS mapping_type,
         CASE WHEN field_name IN ('1-URGENT', '2-HIGH') THEN 'Geography' END AS consolidated_to,
         (field_name = '4-NOT SPECIFIED')::INTEGER AS is_noise,
         min(year) AS first_year, max(year) AS last_year, count(*) AS use_count
  FROM fields JOIN countries USING (country_id) WHERE field_name <> '3-MEDIUM' GROUP BY field_name
), vals AS (
  SELECT field_id, split_part(fragment, ':', 1) AS sub_field, replace(regexp_extract(fragment, '([0-9,]+)', 1), ',', '')::DOUBLE AS numeric_val,
         'sq km' AS units, nullif(regexp_extract(content, '\\(([0-9]{4} est\\.)\\)', 1), '') AS date_est, fragment AS source_fragment,
         CASE WHEN field_id % 13 = 0 THEN 1 ELSE 0 END AS is_computed
  FROM (SELECT field_id, content, unnest(regexp_extract_all(content, '(total|land): [0-9,]+ sq km')) AS fragment FROM fields)
)
"""
