"""Canonical field names: ordered rules over name tables, the first that fits decides.

The tables of renames, consolidations, modern names and reference entries are data: they come as DataFrames, as read from
their CSV files, and are joined by name.  Names number thousands at most, so Spark broadcasts them by their size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from yearloom.functions.text import has_any

#: Words of legislative and similar bodies (fixed values).
BODIES = [
    "Assembly", "Senate", "Parliament", "Congress", "Council", "Chamber", "House of", "Duma", "Diet", "Sejm", "Seimas", "Storting", "Bundestag", "Bundesrat",
    "Majlis", "Shura", "Tribunal", "Court", "Staten", "Knesset", "Hural", "Sobranje", "Soviet", "Keneshom", "Folketing", "Fono", "Legislative Yuan", "Lagting",
    "Majilis", "Presidential Administration", "Group of Assistants", "Armed Forces", "KRAF",
]
#: Words of parties and factions, lower-cased (fixed values).
PARTIES = ["parties", "bloc", "rightist", "leftist", "populist", "resistance forces", "ruling coalition", "umbrella group", "africans", "people's army"]
DASHED = r"^(.+?)(?:--|(?<! )-)(.+)$"


def dash_normalized(name: Column) -> Column:
    """`a-b` and `a--b` as `a - b`; null where there is no such dash."""
    left, right = F.trim(F.regexp_extract(name, DASHED, 1)), F.trim(F.regexp_extract(name, DASHED, 2))
    return F.when(name.rlike(DASHED), F.concat(left, F.lit(" - "), right))


def is_body(name: Column, uses: Column, last: Column) -> Column:
    """A legislative body of old editions; unknown years count as not."""
    return F.coalesce((last <= 2001) & (uses <= 100) & has_any(name, BODIES), F.lit(False))


def is_noise(name: Column, uses: Column, first: Column, last: Column, phrases: list[str] = (), labels: list[str] = ()) -> Column:
    """Fragments that were taken for field names.  phrases (lower case) and labels are the caller's lists."""
    size, old, low = F.length(name), last <= 2001, F.lower(name)
    small = name.rlike(r"^\p{Ll}")
    tests = [
        (size <= 2) & name.rlike(r"^\p{L}+$"),
        F.endswith(name, F.lit(".")) & (size <= 6),
        (name == F.upper(name)) & name.rlike(r"\p{Lu}") & (size <= 4) & (uses <= 5),
        small & (uses <= 10),
        (size > 80) & (uses <= 3),
        has_any(low, list(phrases)) if phrases else F.lit(False),
        name.rlike("^with (run|permanent)"),
        name.rlike("^Articles? [0-9]"),
        F.contains(name, F.lit(",")) & (uses <= 3) & (size > 40),
        name.isin(list(labels)) if labels else F.lit(False),
        old & (uses <= 10) & has_any(low, PARTIES),
        small & (first <= 1998),
        (uses <= 5) & old & (size < 40),
        name.rlike("^US(--| as )"),
        F.contains(name, F.lit("includes")) & (uses <= 5),
        F.endswith(name, F.lit(")")) & (uses <= 3) & old,
    ]
    return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])


def usage(fields: DataFrame, countries: DataFrame) -> DataFrame:
    """(original, first_year, last_year, use_count) of each name that isn't blank; fields without an edition count too."""
    named = fields.where(F.trim("field_name") != "").join(countries.select("country_id", "year"), "country_id", "left")
    return named.groupBy(F.col("field_name").alias("original")).agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count(F.lit(1)).alias("use_count"))


def canonical(
    names: DataFrame, modern: DataFrame, renames: DataFrame, parents: DataFrame, references: DataFrame, phrases: list[str] = (), labels: list[str] = ()
) -> DataFrame:
    """names (as usage() gives them) with canonical, mapping_type, consolidated_to and is_noise.

    modern(name), renames(name, canonical), parents(name, parent), references(name): names of current editions, known
    renames, parts of other fields, and entries that aren't fields.
    """
    spelled = names.withColumn("_dashed", dash_normalized(F.col("original")))

    def looked_up(df: DataFrame, key: str, flag: str) -> DataFrame:
        new = modern.select(F.col("name").alias(f"{flag}_k")).distinct().withColumn(f"{flag}_modern", F.lit(True))
        to = renames.select(F.col("name").alias(f"{flag}_r"), F.col("canonical").alias(f"{flag}_rename"))
        up = parents.select(F.col("name").alias(f"{flag}_p"), F.col("parent").alias(f"{flag}_parent"))
        for table, column in ((new, f"{flag}_k"), (to, f"{flag}_r"), (up, f"{flag}_p")):
            df = df.join(table, F.col(key) == F.col(column), "left").drop(column)
        return df

    known = looked_up(looked_up(spelled, "original", "o"), "_dashed", "d")
    known = known.join(references.select(F.col("name").alias("_ref")).distinct(), F.col("original") == F.col("_ref"), "left")
    own, d = F.col("original"), F.col("_dashed")

    def told(to: Column, kind: str, parent=None, noise: int = 0) -> Column:
        parent = F.lit(None).cast("string") if parent is None else parent
        return F.struct(to.alias("canonical"), F.lit(kind).alias("mapping_type"), parent.alias("consolidated_to"), F.lit(noise).alias("is_noise"))

    noisy = is_noise(own, F.col("use_count"), F.col("first_year"), F.col("last_year"), phrases, labels)
    out = (
        F.when(F.col("o_modern") & F.col("o_rename").isNull(), told(own, "identity"))
        .when(F.col("d_rename").isNotNull(), told(F.col("d_rename"), "dash_format"))
        .when(F.col("d_modern"), told(d, "dash_format"))
        .when(F.col("d_parent").isNotNull(), told(d, "dash_format", F.col("d_parent")))
        .when(F.col("o_rename").isNotNull(), told(F.col("o_rename"), "rename"))
        .when(F.col("o_parent").isNotNull(), told(own, "consolidation", F.col("o_parent")))
        .when(is_body(own, F.col("use_count"), F.col("last_year")), told(F.lit("Legislative branch"), "country_specific"))
        .when(F.col("_ref").isNotNull(), told(own, "country_specific"))
        .when(noisy, told(own, "noise", noise=1))
        .otherwise(told(own, "manual"))
    )
    return known.select(*names.columns, out.alias("_m")).select(*names.columns, "_m.*")


def backfilled(fields: DataFrame, mappings: DataFrame) -> DataFrame:
    """(original, canonical, mapping_type) of names without a mapping: that of the least id whose name differs in case
    only, else the name itself as unmapped."""
    missing = fields.where(F.trim("field_name") != "").select(F.col("field_name").alias("original")).distinct().join(mappings.select("original"), "original", "left_anti")
    same = mappings.groupBy(F.lower("original").alias("_low")).agg(F.min_by(F.struct("canonical", "mapping_type"), "mapping_id").alias("m"))
    both = missing.join(same, F.lower("original") == F.col("_low"), "left")
    return both.select("original", F.coalesce("m.canonical", "original").alias("canonical"), F.coalesce("m.mapping_type", F.lit("unmapped")).alias("mapping_type"))
