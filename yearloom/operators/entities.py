"""Entities: what kind they are, whether an edition's name fits, and what they are looked up by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from yearloom.functions.text import has_any

#: Words of dependency and of government that tell the kind of an entity (fixed values).
DEPENDENT = [
    "territory", "dependency", "overseas", "unincorporated", "self-governing", "crown", "collectivity", "constituent", "special municipality", "country within",
]
ASSOCIATED = ["free association", "freely associated"]
STOP_WORDS = ["the", "of", "and", "republic"]


def classified(dependency: Column, government: Column, override: Column) -> Column:
    """The kind of an entity: an override, else by its dependency status, else sovereign where it has a government.

    The rule for governments has no other outcome than sovereign, whatever their words.
    """
    dep, gov = F.lower(F.trim(F.coalesce(dependency, F.lit("")))), F.trim(F.coalesce(government, F.lit("")))
    return (
        F.when(override.isNotNull(), override)
        .when(has_any(dep, DEPENDENT), "territory")
        .when(has_any(dep, ASSOCIATED), "freely_associated")
        .when(~dep.isin("", "none", "n/a"), "territory")
        .when(gov != "", "sovereign")
        .otherwise("unknown")
    )


def latest(fields: DataFrame, countries: DataFrame, pattern: str, out: str) -> DataFrame:
    """(master_id, out): the latest content of the field whose name is like the pattern; of equal years the least field."""
    rows = fields.where(F.col("field_name").like(pattern)).join(countries.where("master_id IS NOT NULL").select("country_id", "master_id", "year"), "country_id")
    return rows.groupBy("master_id").agg(F.max_by("content", F.struct("year", -F.col("field_id"))).alias(out))


def name_fits(name: Column, canonical: Column) -> Column:
    """Equal, one inside the other, or the same first word that isn't a stop word."""
    a, b = F.lower(F.trim(name)), F.lower(F.trim(canonical))

    def lead(c: Column) -> Column:
        words = F.split(F.trim(F.replace(c, F.lit(","), F.lit(""))), r"\s+")
        return F.get(F.filter(words, lambda w: ~w.isin(*STOP_WORDS, "")), F.lit(0))

    return F.coalesce((a == b) | F.contains(a, b) | F.contains(b, a) | (lead(a) == lead(b)), F.lit(False))


def owners(masters: DataFrame) -> DataFrame:
    """(iso2, owner): a sovereign before any other entity; of several sovereigns the last, of others the first."""
    order = F.when(F.col("entity_type") == "sovereign", -F.col("master_id")).otherwise((1 << 40) + F.col("master_id"))
    return masters.where("iso2 IS NOT NULL").groupBy("iso2").agg(F.min_by("name", order).alias("owner"))


def headwords(countries: DataFrame, masters: DataFrame) -> DataFrame:
    """countries with codes: the name, the ISO code if the name owns it, the archive's code if it is nobody's ISO code."""
    own = owners(masters)
    m = masters.select("master_id", "iso2", F.col("code").alias("m_code"))
    taken = own.select(F.col("iso2").alias("m_code"), F.lit(True).alias("taken"))
    rows = countries.join(m, "master_id").join(own, "iso2", "left").join(taken, "m_code", "left")
    iso = F.when(F.col("owner") == F.col("name"), F.col("iso2"))
    code = F.when(~F.col("m_code").eqNullSafe(F.col("iso2")) & F.col("taken").isNull(), F.col("m_code"))
    return rows.select(*(F.col(c) for c in countries.columns), F.array_compact(F.array("name", iso, code)).alias("codes"))
