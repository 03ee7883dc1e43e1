"""Each sub-value parser over contents made from keys, against the values that they were made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from yearloom.functions import subvalues as S

from . import made
from .registry import query

EST = "{y} est."
#: name -> (parser, content, [(sub-field, number, units, text, date, rank)]); numbers are SQL over made.BASE, texts, dates
#: and sub-fields are templates.
CASES: dict[str, tuple] = {
    "population": (S.population, "total: {b},{t} (2020 est.) male: {c},{t} female: {a},{t} country comparison to the world: {b}", [
        ("total", "b * 1000 + t", None, None, "2020 est.", "b"), ("male", "c * 1000 + t", None, None, None, None), ("female", "a * 1000 + t", None, None, None, None)]),
    "life_expectancy": (S.life_expectancy, "total population: {x} years ({y} est.) male: {c}.5 years female: {c}.7 years", [
        ("total_population", "x", "years", None, EST, None), ("male", "c.5", "years", None, None, None), ("female", "c.7", "years", None, None, None)]),
    "age_structure": (S.age_structure, "0-14 years: {x}% (male {b},{t}/female {c},{t})", [
        ("0-14 years_pct", "x", "%", None, None, None), ("0-14 years_male", "b * 1000 + t", None, None, None, None), ("0-14 years_female", "c * 1000 + t", None, None, None, None)]),
    "single_rate": (S.single_rate, "{x} births/1,000 population ({y} est.)", [("value", "x", "per 1,000", None, EST, None)]),
    "infant_mortality": (S.infant_mortality, "total: {x} deaths/1,000 live births male: {c}.1 deaths/1,000 live births female: {c}.2 deaths/1,000 live births ({y} est.)", [
        (s, v, "deaths/1,000 live births", None, d, None) for s, v, d in (("total", "x", EST), ("male", "c.1", None), ("female", "c.2", None))]),
    "single_value": (S.single_value, "{x} children born/woman ({y} est.)", [("value", "x", "children born/woman", None, EST, None)]),
    "dollars": (S.dollars, "${x} billion ({y} est.) ${c}.1 million (1989 est.) note: data are in {y} dollars country comparison to the world: {b}", [
        ("value_{y}", "x * 1e9", "USD", None, EST, "b"), ("value_1989", "c.1 * 1e6", "USD", None, "1989 est.", None), ("note", None, None, "data are in {y} dollars", None, None)]),
    "share_of_gdp": (S.share_of_gdp, "{x}% of GDP ({y} est.) {c}.3% of GDP (1988 est.)", [
        ("pct_gdp_{y}", "x", "% of GDP", None, EST, None), ("pct_gdp_1988", "c.3", "% of GDP", None, "1988 est.", None)]),
    "percents": (S.percents, "-{x}% ({y} est.) {c}.4% (1987 est.)", [("value_{y}", "-x", "%", None, EST, None), ("value_1987", "c.4", "%", None, "1987 est.", None)]),
    "trade": (S.trade, "${x} billion ({y} est.) commodities: coal {a}, tin partners: Atlantis {b}%, Lemuria {c}% note: none", [
        ("value_{y}", "x * 1e9", "USD", None, EST, None), ("commodities", None, None, "coal {a}, tin", None, None), ("partners", None, None, "Atlantis {b}%, Lemuria {c}%", None, None),
        ("partner_Atlantis", "b", "%", None, None, None), ("partner_Lemuria", "c", "%", None, None, None)]),
    "budget": (S.budget, "revenues: ${x} billion expenditures: ${c}.2 million ({y} est.)", [("revenues", "x * 1e9", "USD", None, EST, None), ("expenditures", "c.2 * 1e6", "USD", None, EST, None)]),
    "land_use": (S.land_use, "agricultural land: {x}% arable land: {c}.5% forest: {b}% ({y} est.)", [
        ("agricultural_land", "x", "%", None, EST, None), ("arable_land", "c.5", "%", None, EST, None), ("forest", "b", "%", None, EST, None)]),
    "electricity": (S.electricity, "production: {x} billion kWh consumption: {c}.3 million kWh ({y} est.)", [
        ("production", "x * 1e9", "kWh", None, EST, None), ("consumption", "c.3 * 1e6", "kWh", None, EST, None)]),
    "dependency_ratios": (S.dependency_ratios, "total dependency ratio: {x} youth dependency ratio: {c}.1 elderly dependency ratio: {c}.2 potential support ratio: {c}.3 ({y} est.)", [
        (s, v, None, None, EST, None) for s, v in (("total", "x"), ("youth", "c.1"), ("elderly", "c.2"), ("potential_support_ratio", "c.3"))]),
    "urbanization": (S.urbanization, "urban population: {x}% of total population ({y}) rate of urbanization: {c}.7% a year", [
        ("urban_population", "x", "%", None, "{y}", None), ("rate_of_urbanization", "c.7", "%", None, None, None)]),
    "elevation": (S.elevation, "mean elevation: {a} m lowest point: Salt Sea -{b} m highest point: Mount Nowhere {b},{t} m", [
        ("mean", "a", "m", None, None, None), ("lowest", "-b", "m", "Salt Sea", None, None), ("highest", "b * 1000 + t", "m", "Mount Nowhere", None, None)]),
    "coordinates": (S.coordinates, "{c} 30 N, {b} 15 W", [("latitude", "c + 0.5", "degrees", None, None, None), ("longitude", "-(b + 0.25)", "degrees", None, None, None)]),
    "with_units": (S.with_units, "{b},{t} km", [("value", "b * 1000 + t", "km", None, None, None)]),
    "median_age": (S.median_age, "total: {x} years male: {c}.1 years female: {c}.2 years ({y} est.)", [
        ("total", "x", "years", None, EST, None), ("male", "c.1", "years", None, None, None), ("female", "c.2", "years", None, None, None)]),
    "sex_ratio": (S.sex_ratio, "at birth: 1.0{e} male(s)/female total population: 0.9{e} male(s)/female ({y} est.)", [
        ("at_birth", "CAST('1.0' || e AS DOUBLE)", "male(s)/female", None, None, None), ("total_population", "CAST('0.9' || e AS DOUBLE)", "male(s)/female", None, EST, None)]),
    "literacy": (S.literacy, "definition: age {c} and over can read total population: {x}% male: {c}.3% female: {c}.4% ({y} est.)", [
        ("definition", None, None, "age {c} and over can read", None, None), ("total_population", "x", "%", None, EST, None), ("male", "c.3", "%", None, None, None), ("female", "c.4", "%", None, None, None)]),
    "maritime_claims": (S.maritime_claims, "territorial sea: {b} nm exclusive economic zone: {a} nm continental shelf: {c}00-m depth", [
        ("territorial_sea", "b", "nm", None, None, None), ("exclusive_economic_zone", "a", "nm", None, None, None), ("continental_shelf", "c * 100", "m depth", "{c}00-m depth", None, None)]),
    "natural_gas": (S.natural_gas, "production: {x} billion cubic meters proven reserves: {c}.5 trillion cubic meters ({y} est.)", [
        ("production", "x * 1e9", "cu m", None, EST, None), ("proven_reserves", "c.5 * 1e12", "cu m", None, EST, None)]),
    "internet_users": (S.internet_users, "total: {x} million percent of population: {c}.5% ({y} est.)", [("total", "x * 1e6", None, None, EST, None), ("percent_of_population", "c.5", "%", None, EST, None)]),
    "telephones": (S.telephones, "total subscriptions: {x} million subscriptions per 100 inhabitants: {b} ({y} est.)", [
        ("total_subscriptions", "x * 1e6", None, None, EST, None), ("subscriptions_per_100", "b", None, None, EST, None)]),
    "gdp_composition": (S.gdp_composition, "agriculture: {x}% industry: {c}.1% services: {c}.2% ({y} est.) country comparison to the world: {b}", [
        ("agriculture", "x", "%", None, EST, "b"), ("industry", "c.1", "%", None, EST, None), ("services", "c.2", "%", None, EST, None)]),
    "household_income": (S.household_income, "lowest 10%: {x}% highest 10%: {c}.9% ({y})", [("lowest_10pct", "x", "%", None, "{y}", None), ("highest_10pct", "c.9", "%", None, "{y}", None)]),
    "school_life": (S.school_life, "total: {a} years male: {c} years female: {b} years ({y})", [(s, v, "years", None, "{y}", None) for s, v in (("total", "a"), ("male", "c"), ("female", "b"))]),
    "youth_unemployment": (S.youth_unemployment, "total: {x}% male: {c}.1% female: {c}.2% ({y} est.) country comparison to the world: {b}", [
        ("total", "x", "%", None, EST, "b"), ("male", "c.1", "%", None, EST, None), ("female", "c.2", "%", None, EST, None)]),
    "co2": (S.co2, "{x} million metric tonnes of CO2 ({y} est.) from coal and metallurgical coke: {c}.1 million metric tonnes of CO2", [
        ("total", "x * 1e6", "metric tonnes CO2", None, EST, None), ("from_coal", "c.1 * 1e6", "metric tonnes CO2", None, EST, None)]),
    "water_withdrawal": (S.water_withdrawal, "municipal: {x} billion cubic meters industrial: {c}.1 million cubic meters ({y} est.)", [
        ("municipal", "x * 1e9", "cu m", None, EST, None), ("industrial", "c.1 * 1e6", "cu m", None, EST, None)]),
    "broadband": (S.broadband, "total: {x} million subscriptions per 100 inhabitants: {b} ({y} est.)", [("total", "x * 1e6", None, None, EST, None), ("subscriptions_per_100", "b", None, None, EST, None)]),
    "water_source": (S.water_source, "improved: urban: {x}% of population rural: {c}.1% of population unimproved: urban: {b}% of population ({y} est.)", [
        (s, v, "% of population", None, EST, None) for s, v in (("improved_urban", "x"), ("improved_rural", "c.1"), ("unimproved_urban", "b"))]),
    "waste": (S.waste, "municipal solid waste generated annually: {x} million tons ({y} est.) percent of municipal solid waste recycled: {c}.5% ({y} est.)", [
        ("generated_annually", "x * 1e6", "tons", None, None, None), ("percent_recycled", "c.5", "%", None, None, None)]),
    "forest_revenue": (S.forest_revenue, "forest revenues: {x}% of GDP ({y} est.)", [("value", "x", "% of GDP", None, EST, None)]),
    "generic": (S.generic, "length: {x} km | cost: ${c} million | share: {b}% | kind: plain {a}", [
        ("length", "x", "km", None, None, None), ("cost", "c * 1e6", "USD", None, None, None), ("share", "b", "%", None, None, None), ("kind", None, None, "plain {a}", None, None)]),
}


def _number(value: str | None) -> str:
    """c.5 stands for c and five tenths, read as a decimal number is."""
    if value is None:
        return "NULL::DOUBLE"
    if value[:2] == "c." and value[2].isdigit():
        value = f"CAST(c || '.{value[2]}' AS DOUBLE){value[3:]}"
    return f"CAST({value} AS DOUBLE)"


def _said(value: str | None) -> str:
    return "NULL::VARCHAR" if value is None else made.sql(value)


def _register(name: str, parser, content: str, found: list[tuple]) -> None:
    parts = [
        f"SELECT k AS field_id, {_said(s)} AS sub_field, {_number(v)} AS numeric_val, {_said(u)} AS units, {_said(t)} AS text_val, {_said(d)} AS date_est, CAST({r or 'NULL'} AS INTEGER) AS rank FROM base"
        for s, v, u, t, d, r in found
    ]

    @query(f"extract_{name}", f"{made.BASE} " + " UNION ALL ".join(parts))
    def run(spark, sf_dir):
        rows = S.parsed(made.texts(spark, sf_dir, content), "text", parser).select(F.col("k").alias("field_id"), "sub_values")
        return S.exploded(rows, F.col("sub_values")).select("field_id", "sub_field", "numeric_val", "units", "text_val", "date_est", "rank")


for _name, _case in CASES.items():
    _register(_name, *_case)


def _canonical(parser) -> str:
    """A field name that picks the parser; the generic one has none of its own."""
    return next((n for n, p in S.PARSERS.items() if p is parser), "Field without a parser")


_MIXED = " UNION ALL ".join(
    f"SELECT k AS field_id, '{_canonical(parser)}' AS canonical, {_said(s)} AS sub_field, {_number(v)} AS numeric_val, {_said(u)} AS units, {_said(t)} AS text_val, {_said(d)} AS date_est, CAST({r or 'NULL'} AS INTEGER) AS rank FROM base WHERE k % {len(CASES)} = {i}"
    for i, (parser, _, found) in enumerate(CASES.values())
    for s, v, u, t, d, r in found
)


@query("extract_mixed", f"{made.BASE} {_MIXED}")
def extract_mixed(spark, sf_dir):
    """Fields of all parsers in one table, each by the parser of its name in one pass."""
    i = F.col("k") % len(CASES)
    name = F.get(F.array(*(F.lit(_canonical(p)) for p, *_ in CASES.values())), i.cast("int"))
    content = F.lit(None).cast("string")
    for at, (_, text, _) in enumerate(CASES.values()):
        content = F.when(i == at, made.column(text)).otherwise(content)
    fields = made.texts(spark, sf_dir, "", dealt=False).select(F.col("k").alias("field_id"), name.alias("canonical"), content.alias("content"))
    return S.extract(fields, "canonical", "content").select("field_id", "canonical", "sub_field", "numeric_val", "units", "text_val", "date_est", "rank")
