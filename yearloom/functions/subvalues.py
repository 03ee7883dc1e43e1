"""Sub-values of free-text fields: each parser is a column expression that gives an array of rows.

A parser is a list of rules over the normalised content.  A rule yields one row where its pattern matches (one()), or a
row for each match (many()).  Rules that stand in otherwise() count only where those before them gave nothing.

A pattern that matches something which isn't a number spoils its field: the field then has one text row, its content.
Nothing is shuffled, and a field meets only the parser of its name.

Patterns, labels, names of sub-fields and units, and the names in PARSERS are fixed values: other ones would find other rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from . import text as X

FRAGMENT, WHOLE = 500, 4000
ROW = (
    "array<struct<sub_field:string,numeric_val:double,units:string,text_val:string,date_est:string,rank:int,"
    "source_fragment:string,is_computed:int,spoilt:boolean>>"
)


@dataclass(frozen=True)
class Field:
    """Columns of one field: content normalised and as it stands, its date and rank; strict says how male is told."""

    c: Column
    raw: Column
    date: Column
    rank: Column
    strict: bool = False

    def male(self, tail: str) -> str:
        """Patterns for male also hit the end of female, unless strict."""
        return (r"(?<![a-z])" if self.strict else "") + "male" + tail


def text_(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("string")


def row(sub, number=None, units=None, text=None, date=None, rank=None, fragment=None, computed=0, spoilt=None) -> Column:
    return F.struct(
        text_(sub).alias("sub_field"),
        (F.lit(None) if number is None else number).cast("double").alias("numeric_val"),
        text_(units).alias("units"),
        text_(text).alias("text_val"),
        text_(date).alias("date_est"),
        (F.lit(None) if rank is None else rank).cast("int").alias("rank"),
        F.left(text_(fragment), F.lit(FRAGMENT)).alias("source_fragment"),
        F.lit(computed).alias("is_computed"),
        (F.lit(False) if spoilt is None else F.coalesce(spoilt, F.lit(False))).alias("spoilt"),
    )


def one(c: Column, pattern: str, sub, units=None, at: int | None = 1, scale: int | None = None, text: int | None = None, flags="Ud", lenient=False, **more) -> Column:
    """A row for the first match: group at as number times the magnitude in group scale, group text as text."""
    more.setdefault("spoilt", None)
    said = X.stripped(F.coalesce(X.found(c, pattern, text, flags), F.lit(""))) if text else None

    def told(whole: Column) -> Column:
        if not at:
            return row(sub, None, units, said, fragment=whole, **more)
        value = X.number(X.found(c, pattern, at, flags))
        if scale:
            value = value * X.magnitude(X.found(c, pattern, scale, flags))
        return X.bound(value, lambda v: row(sub, v, units, said, fragment=whole, **(more if lenient else {**more, "spoilt": v.isNull()})))

    return X.bound(X.found(c, pattern, 0, flags), lambda whole: F.when(whole.isNotNull(), told(whole)))


def rows(*parts: Column) -> Column:
    return F.array_compact(F.array(*parts)).cast(ROW)


def otherwise(first: Column, *more: Column) -> Column:
    """The first array with rows in it, or the last."""
    for x in more:
        first = F.when(F.size(first) > 0, first).otherwise(x)
    return first


def many(c: Column, pattern: str, groups: int, make: Callable, flags: str = "Ud") -> Column:
    """make(list of groups, position) of every match, the whole match being group 0; groups without a match are empty."""
    every = [F.regexp_extract_all(c, F.lit(f"(?{flags}){pattern}"), F.lit(g)) for g in range(groups + 1)]
    zipped = F.arrays_zip(*(e.alias(f"g{i}") for i, e in enumerate(every)))
    return F.array_compact(F.transform(zipped, lambda m, i: make([m[f"g{g}"] for g in range(groups + 1)], i))).cast(ROW)


MONEY = r"\$([\d.,]+)\s*(trillion|billion|million)?\s*(?:\((\d{4})\s*est\.?\))?"
NOTE = r"note\s*:\s*(.+?)$"


def note(f: Field) -> Column:
    return one(f.c, NOTE, "note", at=None, text=1, flags="iUd")


def yearly(f: Field, pattern: str, stem: str, first: str, units: str, scale: bool = False, skip: bool = False, flags="Ud") -> Column:
    """A row for each amount: named by its year, else by its place among the matches."""
    year_at = 3 if scale else 2

    def make(g, i):
        value = X.number(g[1])
        amount = value * X.magnitude(g[2]) if scale else value
        year = F.nullif(g[year_at], F.lit(""))
        sub = F.when(year.isNotNull(), F.concat(F.lit(stem), year)).when(i == 0, F.lit(first)).otherwise(F.concat(F.lit(stem), i.cast("string")))
        out = row(sub, amount, units, date=F.concat(year, F.lit(" est.")), rank=F.when(i == 0, f.rank), fragment=g[0], spoilt=None if skip else value.isNull())
        return F.when(value.isNotNull(), out) if skip else out

    return many(f.c, pattern, year_at, make, flags)


def area(f: Field) -> Column:
    out = []
    for label in ("total area", "total", "land area", "land", "water"):
        sub = label.replace(" area", "")
        out.append(one(f.c, label + r"\s*:?\s*([\d,]+)\s*(?:sq\s*km|km2)", sub, "sq km", flags="iUd", lenient=True, date=f.date, rank=f.rank if sub == "total" else None))
    out.append(one(f.c, r"comparative\s*(?:area)?\s*:?\s*(.+?)(?:\s*(?:note|$))", "comparative", at=None, text=1, flags="iUd"))
    return rows(*out, one(f.c, r"note\s*:?\s*(.+)", "note", at=None, text=1, flags="iUd"))


def population(f: Field) -> Column:
    total = one(f.c, r"total\s*:\s*([\d,]+)", "total", lenient=True, date=f.date, rank=f.rank)
    sexes = [one(f.c, f.male(r"\s*:\s*([\d,]+)"), "male", lenient=True), one(f.c, r"female\s*:\s*([\d,]+)", "female", lenient=True)]
    old = rows(
        one(f.c, r"([\d,]{5,})", "total", lenient=True, date=f.date, rank=f.rank), one(f.c, r"growth rate\s*(-?[\d.]+)%", "growth_rate", "%")
    )
    return F.when(total.isNotNull(), rows(total, *sexes)).otherwise(old)


def sexes(f: Field, tail: str, units: str, first: Column, dated: bool = False, flags: str = "Ud") -> Column:
    more = {"date": f.date} if dated else {}
    return rows(first, one(f.c, f.male(tail), "male", units, flags=flags, **more), one(f.c, "female" + tail, "female", units, flags=flags, **more))


def life_expectancy(f: Field) -> Column:
    modern = sexes(f, r":\s*([\d.]+)\s*years", "years", one(f.c, r"total population:\s*([\d.]+)", "total_population", "years", date=f.date, rank=f.rank))
    pair = r"([\d.]+)\s*years?\s*male\b.*?([\d.]+)\s*years?\s*female"
    whole, m, w = X.found(f.c, pair), X.number(X.found(f.c, pair, 1)), X.number(X.found(f.c, pair, 2))
    spoilt = m.isNull() | w.isNull()
    both = F.array(
        row("male", m, "years", fragment=whole, spoilt=spoilt),
        row("female", w, "years", fragment=whole, spoilt=spoilt),
        row("total_population", F.round((m + w) / 2, 1), "years", date=f.date, rank=f.rank, fragment=whole, computed=1, spoilt=spoilt),
    ).cast(ROW)
    bare = rows(one(f.c, r"^([\d.]+)\s*years?", "total_population", "years", date=f.date, rank=f.rank))
    return otherwise(modern, F.when(whole.isNotNull(), both).otherwise(bare))


BRACKET = r"(\d+[-–]\d+\s*years?|65\s*years?\s*and\s*over)"


def age_structure(f: Field) -> Column:
    def make(g, _):
        bracket, share = F.replace(X.stripped(g[1]), F.lit("–"), F.lit("-")), X.number(g[2])
        sides = [F.when(g[k] != "", row(F.concat(bracket, F.lit(s)), X.number(g[k]), fragment=g[0])) for k, s in ((3, "_male"), (4, "_female"))]
        return F.array(row(F.concat(bracket, F.lit("_pct")), share, "%", date=f.date, fragment=g[0], spoilt=share.isNull()), *sides)

    pattern = BRACKET + r"\s*:\s*([\d.]+)%(?:\s*(?:\(\d{4}\s*est\.?\)\s*)?\(male\s*([\d,]+)\s*[/;]\s*female\s*([\d,]+)\))?"
    every = [F.regexp_extract_all(f.c, F.lit("(?Ud)" + pattern), F.lit(g)) for g in range(5)]
    zipped = F.arrays_zip(*(e.alias(f"g{i}") for i, e in enumerate(every)))
    return F.array_compact(F.flatten(F.transform(zipped, lambda m, i: make([m[f"g{g}"] for g in range(5)], i)))).cast(ROW)


def single_rate(f: Field) -> Column:
    more = {"date": f.date, "rank": f.rank}
    return otherwise(rows(one(f.c, r"([\d.]+)\s*(?:births|deaths)\s*/\s*1,000", "value", "per 1,000", **more)), rows(one(f.c, r"^([\d.]+)", "value", "per 1,000", **more)))


def infant_mortality(f: Field) -> Column:
    units = "deaths/1,000 live births"
    modern = sexes(f, r":\s*([\d.]+)\s*deaths", units, one(f.c, r"total:\s*([\d.]+)\s*deaths", "total", units, date=f.date, rank=f.rank))
    return otherwise(modern, rows(one(f.c, r"([\d.]+)\s*(?:deaths|per)", "total", units, date=f.date, rank=f.rank)))


def single_value(f: Field) -> Column:
    pattern = r"([\d.]+)\s*(children born/woman|%|years?|births)"
    named = rows(one(f.c, pattern, "value", X.found(f.c, pattern, 2), date=f.date, rank=f.rank))
    return otherwise(named, rows(one(f.c, r"^([\d.]+)", "value", date=f.date, rank=f.rank)))


def dollars(f: Field) -> Column:
    return F.concat(yearly(f, MONEY, "value_", "value", "USD", scale=True, skip=True, flags="iUd"), rows(note(f)))


def share_of_gdp(f: Field) -> Column:
    return yearly(f, r"([\d.]+)%\s*(?:of\s*G[DN]P)?\s*(?:\((\d{4})\s*est\.?\))?", "pct_gdp_", "pct_gdp", "% of GDP")


def percents(f: Field) -> Column:
    return F.concat(yearly(f, r"(-?[\d.]+)%\s*(?:\((\d{4})\s*est\.?\))?", "value_", "value", "%"), rows(note(f)))


def trade(f: Field) -> Column:
    goods = one(f.c, r"commodities\s*[-:]\s*(.+?)(?:\s*partners|\s*note|\s*$)", "commodities", at=None, text=1, flags="iUd")
    listed = r"partners\s*[-:]\s*(.+?)(?:\s*note|\s*$)"
    partners = one(f.c, listed, "partners", at=None, text=1, flags="iUd")

    def make(g, _):
        name, share = F.rtrim(X.stripped(g[1]), F.lit(",")), X.number(g[2])
        out = row(F.concat(F.lit("partner_"), name), share, "%", fragment=g[0], spoilt=share.isNull())
        return F.when(share.isNull() | ((share > 0) & (F.length(name) < 50)), out)

    said = X.stripped(F.coalesce(X.found(f.c, listed, 1, "iUd"), F.lit("")))
    each = many(said, r"([A-Z][\w\s,.'-]+?)\s+([\d.]+)%", 2, make)
    return F.concat(yearly(f, MONEY, "value_", "value", "USD", scale=True, skip=True, flags="iUd"), rows(goods, partners), each)


def budget(f: Field) -> Column:
    out = []
    for label in ("revenues", "expenditures"):
        r = one(f.c, label + r"\s*:?\s*\$?([\d.,]+)\s*(trillion|billion|million)?", label, "USD", scale=2, flags="iUd", lenient=True, date=f.date)
        out.append(F.when(r["numeric_val"].isNotNull(), r))
    return rows(*out)


def labelled(f: Field, labels: dict[str, str], tail: str, units=None, dated: bool = True, scale: int | None = None) -> Column:
    return rows(*(one(f.c, label + tail, sub, units, scale=scale, flags="iUd", date=f.date if dated else None) for label, sub in labels.items()))


def land_use(f: Field) -> Column:
    labels = ("agricultural land", "arable land", "permanent crops", "permanent pasture", "forest", "other")
    return labelled(f, {x: x.replace(" ", "_") for x in labels}, r"\s*:?\s*([\d.]+)%", "%")


def old_total(f: Field, pattern: str, sub: str, units: str, scaled: bool, date=None) -> Column:
    """A bare amount of old editions; billion or million anywhere before the end of the match scales it."""
    whole = X.found(f.c, pattern)
    value = X.number(X.found(f.c, pattern, 1))
    if scaled:
        before = F.call_function("substring_index", f.c, whole, F.lit(1))
        said = F.concat(before, whole)
        value = value * F.when(F.contains(said, F.lit("billion")), 1e9).when(F.contains(said, F.lit("million")), 1e6).otherwise(1.0)
    return F.when(whole.isNotNull(), row(sub, value, units, date=date, fragment=whole, spoilt=value.isNull() if scaled else None))


def electricity(f: Field) -> Column:
    amount = r"\s*:\s*([\d.,]+)\s*(trillion|billion|million)?\s*(kWh)"
    capacity = r"(?:installed\s+generating\s+)?capacity\s*:\s*([\d.,]+)\s*(billion|million|thousand)?\s*(kW)"
    unit = lambda p: X.found(f.c, p, 3, "iUd")
    modern = rows(
        one(f.c, capacity, "installed_generating_capacity", unit(capacity), scale=2, flags="iUd", date=f.date),
        *(one(f.c, sub + amount, sub, unit(sub + amount), scale=2, flags="iUd", date=f.date) for sub in ("consumption", "exports", "imports", "production")),
    )
    old = rows(
        old_total(f, r"([\d,]+)\s*(?:million\s+)?kW\s+capacity", "installed_generating_capacity", "kW", False),
        old_total(f, r"([\d,]+)\s*(?:billion|million)?\s*kWh\s*(?:produced|production)", "production", "kWh", True),
    )
    return otherwise(modern, old)


def dependency_ratios(f: Field) -> Column:
    labels = {"total dependency ratio": "total", "youth dependency ratio": "youth", "elderly dependency ratio": "elderly", "potential support ratio": "potential_support_ratio"}
    return labelled(f, labels, r"\s*:?\s*([\d.]+)")


def urbanization(f: Field) -> Column:
    return rows(
        one(f.c, r"urban population\s*:\s*([\d.]+)%", "urban_population", "%", flags="iUd", date=f.date),
        one(f.c, r"rate of urbanization\s*:\s*([\d.]+)%", "rate_of_urbanization", "%", flags="iUd"),
    )


def elevation(f: Field) -> Column:
    point = r" point\s*:?\s*(.+?)\s+(-?[\d,]+)\s*m"
    return rows(
        one(f.c, r"mean elevation\s*:?\s*([\d,]+)\s*m", "mean", "m", flags="iUd", lenient=True),
        *(one(f.c, x + point, x, "m", at=2, text=1, flags="iUd", lenient=True) for x in ("highest", "lowest")),
    )


def coordinates(f: Field) -> Column:
    p = r"(\d+)\s+(\d+)\s*([NS])\s*,?\s*(\d+)\s+(\d+)\s*([EW])"
    g = [X.found(f.c, p, k) for k in range(7)]
    out = F.array(*(row(sub, X.degrees(g[k], g[k + 1], g[k + 2]), "degrees", fragment=g[0]) for sub, k in (("latitude", 1), ("longitude", 4))))
    return F.when(g[0].isNotNull(), out.cast(ROW)).otherwise(F.array().cast(ROW))


def with_units(f: Field) -> Column:
    p = r"([\d,]+)\s*(sq\s*km|km2|km|nm|m|hectares)"
    return rows(one(f.c, p, "value", F.replace(X.found(f.c, p, 2), F.lit("km2"), F.lit("sq km")), lenient=True, date=f.date, rank=f.rank))


def median_age(f: Field) -> Column:
    return sexes(f, r"\s*:\s*([\d.]+)\s*years", "years", one(f.c, r"total\s*:\s*([\d.]+)\s*years", "total", "years", date=f.date, rank=f.rank))


def sex_ratio(f: Field) -> Column:
    def make(g, _):
        label = F.replace(F.replace(F.lower(X.stripped(g[1])), F.lit("–"), F.lit("-")), F.lit(" "), F.lit("_"))
        whole, value = label == "total_population", X.number(g[2])
        return row(label, value, "male(s)/female", date=F.when(whole, f.date), rank=F.when(whole, f.rank), fragment=g[0], spoilt=value.isNull())

    pattern = r"(at birth|total population|\d+[-–]\d+\s*years?|65\s*years?\s*and\s*over)\s*:\s*([\d.]+)\s*male\(s\)/female"
    old = rows(one(f.c, r"([\d.]+)\s*male", "total_population", "male(s)/female", date=f.date, rank=f.rank))
    return otherwise(many(f.c, pattern, 2, make, "iUd"), old)


def literacy(f: Field) -> Column:
    modern = rows(
        one(f.c, r"definition\s*:\s*(.+?)(?=\s*total population\s*:|\s*$)", "definition", at=None, text=1, flags="iUd"),
        one(f.c, r"total population\s*:\s*([\d.]+)%", "total_population", "%", flags="iUd", date=f.date),
        one(f.c, f.male(r"\s*:\s*([\d.]+)%"), "male", "%", flags="iUd"),
        one(f.c, r"female\s*:\s*([\d.]+)%", "female", "%", flags="iUd"),
    )
    return otherwise(modern, rows(one(f.c, r"([\d.]+)%", "total_population", "%", date=f.date)))


def maritime_claims(f: Field) -> Column:
    out = []
    for label in ("territorial sea", "exclusive economic zone", "contiguous zone", "continental shelf", "exclusive fishing zone"):
        p = label + r"\s*:\s*([\d.]+)\s*(nm|km)"
        told = one(f.c, p, label.replace(" ", "_"), X.found(f.c, p, 2, "iUd"), flags="iUd")
        if label == "continental shelf":
            q = label + r"\s*:\s*(.+?)(?=\s+\w+\s*(?:sea|zone|shelf|fishing)\s*:|$)"
            whole, said = X.found(f.c, q, 0, "iUd"), X.stripped(F.coalesce(X.found(f.c, q, 1, "iUd"), F.lit("")))
            depth = X.number(X.found(said, r"(\d+)[\s-]*m(?:\s+depth)?", 1))
            worded = row("continental_shelf", depth, F.when(depth.isNotNull(), "m depth"), said, fragment=whole)
            told = F.coalesce(told, F.when(whole.isNotNull(), worded))
        out.append(told)
    return rows(*out)


def natural_gas(f: Field) -> Column:
    labels = {x: x.replace(" ", "_") for x in ("production", "consumption", "exports", "imports", "proven reserves")}
    modern = labelled(f, labels, r"\s*:\s*([\d.,]+)\s*(trillion|billion|million)?\s*cubic\s*meters", "cu m", scale=2)
    return otherwise(modern, rows(old_total(f, r"([\d,]+)\s*(?:million|billion)?\s*cu\s*m", "production", "cu m", True, f.date)))


def own_date(f: Field, pattern: str) -> Column:
    """The date inside the match if there is one, else that of the whole content."""
    return F.coalesce(X.date_est(X.found(f.c, pattern, 0, "iUd")), f.date)


def dated(f: Field, pattern: str, sub: str, units=None, scale: int | None = None, **more) -> Column:
    return one(f.c, pattern, sub, units, scale=scale, flags="iUd", date=own_date(f, pattern), **more)


PER_100 = r"subscriptions per 100 inhabitants\s*:\s*([\d.]+)"
COUNT = r"\s*:\s*([\d.,]+)\s*(million|billion)?"


def internet_users(f: Field) -> Column:
    modern = rows(dated(f, "total" + COUNT, "total", scale=2), dated(f, r"percent of population\s*:\s*([\d.]+)%?", "percent_of_population", "%"))
    return otherwise(modern, rows(one(f.c, r"([\d,]{5,})", "total", lenient=True, date=f.date)))


def telephones(f: Field) -> Column:
    modern = rows(dated(f, r"total\s*(?:subscriptions)?" + COUNT, "total_subscriptions", scale=2), dated(f, PER_100, "subscriptions_per_100"))
    return otherwise(modern, rows(one(f.c, r"([\d,]{5,})", "total_subscriptions", lenient=True, date=f.date)))


def gdp_composition(f: Field) -> Column:
    parts = [dated(f, x + r"\s*:\s*([\d.]+)%", x, "%", rank=f.rank if x == "agriculture" else None) for x in ("agriculture", "industry", "services")]
    return rows(*parts, note(f))


def household_income(f: Field) -> Column:
    return rows(*(dated(f, x + r" 10%\s*:\s*([\d.]+)%", f"{x}_10pct", "%") for x in ("lowest", "highest")), note(f))


def by_sex(f: Field, tail: str, units: str, ranked: bool) -> list[Column]:
    """Total, male and female; unlike elsewhere labels are matched in lower case only, and each has its own date."""
    out = []
    for sub, p in (("total", "total" + tail), ("male", f.male(tail)), ("female", "female" + tail)):
        date = F.coalesce(X.date_est(X.found(f.c, p)), f.date)
        out.append(one(f.c, p, sub, units, date=date, rank=f.rank if ranked and sub == "total" else None))
    return out


def school_life(f: Field) -> Column:
    return rows(*by_sex(f, r"\s*:\s*(\d+)\s*years?", "years", False))


def youth_unemployment(f: Field) -> Column:
    return rows(*by_sex(f, r"\s*:\s*([\d.]+)%", "%", True), note(f))


def co2(f: Field) -> Column:
    units, amount = "metric tonnes CO2", r"([\d.,]+)\s*(trillion|billion|million)?\s*(?:metric\s+)?(?:tonn?es?\s*(?:of\s*CO2)?|Mt)"
    head = F.get(F.split(f.c, r"(?Ud)\bfrom\s+(?:coal|petroleum|consumed)", 2), F.lit(0))
    total = one(head, amount, "total", units, scale=2, flags="iUd", date=F.coalesce(X.date_est(head), f.date), rank=f.rank)
    sources = {r"from\s+coal\s+and\s+metallurgical\s+coke": "from_coal", r"from\s+petroleum\s+and\s+other\s+liquids": "from_petroleum", r"from\s+consumed\s+natural\s+gas": "from_natural_gas"}
    return rows(total, *(dated(f, p + r"\s*:\s*" + amount, sub, units, scale=2) for p, sub in sources.items()))


def water_withdrawal(f: Field) -> Column:
    tail = r"\s*:\s*([\d.,]+)\s*(trillion|billion|million)?\s*cubic\s*meters"
    modern = rows(*(dated(f, x + tail, x, "cu m", scale=2) for x in ("municipal", "industrial", "agricultural")))
    total = one(f.c, r"total\s*:\s*([\d.,]+)\s*cu\s*km/yr", "total", "cu m", flags="iUd", date=f.date)
    total = total.withField("numeric_val", total["numeric_val"] * 1e9)
    shares = r"\((\d+)%/(\d+)%/(\d+)%\)"
    parts = [one(f.c, shares, f"{x}_pct", "%", at=k) for k, x in enumerate(("domestic", "industrial", "agricultural"), 1)]
    return otherwise(modern, rows(total, *parts, one(f.c, r"per capita\s*:\s*([\d.,]+)\s*cu\s*m/yr", "per_capita", "cu m/yr", flags="iUd", date=f.date)))


def broadband(f: Field) -> Column:
    return rows(dated(f, "total" + COUNT, "total", scale=2), dated(f, PER_100, "subscriptions_per_100"))


def water_source(f: Field) -> Column:
    """Sections headed improved and unimproved; without them six shares, or three, in that order."""
    units, share = "% of population", r"\s*:\s*([\d.]+)%\s*of\s*population"

    def section(s: Column) -> Column:
        kind = F.lower(F.regexp_extract(s, r"(?i)^(unimproved|improved)", 1))
        body = F.regexp_replace(s, r"(?iU)^(unimproved|improved)\s*:", "")
        parts = [one(body, place + share, F.concat(kind, F.lit("_" + place)), units, flags="iUd", date=f.date) for place in ("urban", "rural", "total")]
        return F.when(kind != "", rows(*parts)).otherwise(F.array().cast(ROW))

    sections = F.split(f.c, r"(?iU)\b(?=(?:unimproved|improved)\s*:)")
    headed = F.flatten(F.transform(sections, section))
    flat = "(urban|rural|total)" + share
    n = F.size(F.regexp_extract_all(f.c, F.lit("(?iUd)" + flat), F.lit(0)))

    def make(g, i):
        kind = F.when(i < 3, "improved_").otherwise("unimproved_")
        value = X.number(g[2])
        return row(F.concat(kind, F.lower(g[1])), value, units, date=F.coalesce(X.date_est(g[0]), f.date), fragment=g[0], spoilt=value.isNull())

    unheaded = F.when(n.isin(3, 6), many(f.c, flat, 2, make, "iUd")).otherwise(F.array().cast(ROW))
    return F.when(f.c.rlike(r"(?iU)\bimproved\s*:"), headed).otherwise(unheaded)


def waste(f: Field) -> Column:
    stem, tail = "municipal solid waste ", r"\s*:\s*([\d.,]+)\s*(million|billion)?\s*tons?"
    inside = lambda p: X.date_est(X.found(f.c, p, 0, "iUd"))
    out = []
    for name in ("generated_annually", "recycled_annually"):
        p = stem + name.replace("_", " ") + tail
        out.append(one(f.c, p, name, "tons", scale=2, flags="iUd", date=inside(p)))
    p = r"percent of municipal solid waste recycled\s*:\s*([\d.]+)%"
    return rows(*out, one(f.c, p, "percent_recycled", "%", flags="iUd", date=inside(p)))


def forest_revenue(f: Field) -> Column:
    return rows(one(f.c, r"(?:forest revenues\s*:\s*)?([\d.]+)%\s*of\s*GDP", "value", "% of GDP", flags="iUd", date=f.date))


UNITS = r"^(%|sq\s*km|km|nm|m|years?|kW|kWh|bbl/day|liters|metric tonn?es?|USD|deaths|births)"


def generic(f: Field) -> Column:
    """Any field: `label: value` parts, a bare number before them, or the whole as text."""
    label, lead = r"^([a-zA-Z][a-zA-Z\s\-/()]{1,60}):\s*(.+)", r"^(-?[\d,]+\.?\d*)\s*(.*)"
    parts = F.when(F.contains(f.c, F.lit(" | ")), F.transform(F.split(f.c, r" \| "), X.stripped)).otherwise(F.array(f.c))

    def make(p: Column) -> Column:
        name = F.replace(F.lower(X.stripped(X.found(p, label, 1))), F.lit(" "), F.lit("_"))
        said = X.stripped(X.found(p, label, 2))
        rest, date = X.stripped(F.regexp_extract(said, "(?Ud)" + lead, 2)), X.date_est(said)
        plain = row(name, X.number(X.found(said, lead, 1)), X.found(rest, UNITS, 1), date=date, fragment=p)
        money, share = r"\$([\d.,]+)\s*(trillion|billion|million)?", r"([\d.]+)%"
        dollar = X.number(X.found(said, money, 1, "iUd"))
        percent = X.number(X.found(said, share, 1))
        named = (
            F.when(X.found(said, lead).isNotNull(), plain)
            .when(X.found(said, money, 0, "iUd").isNotNull(), row(name, dollar * X.magnitude(X.found(said, money, 2, "iUd")), "USD", date=date, fragment=p, spoilt=dollar.isNull()))
            .when(X.found(said, share).isNotNull(), row(name, percent, "%", date=date, fragment=p, spoilt=percent.isNull()))
            .otherwise(row(name, text=said, fragment=p))
        )
        bare = X.number(X.found(X.stripped(p), lead, 1))
        told = F.when(said.isNotNull(), named).when(bare.isNotNull(), row("value", bare, date=f.date, rank=f.rank, fragment=p))
        return F.struct(said.isNotNull().alias("named"), told.alias("row"))

    made = F.filter(F.transform(parts, make), lambda x: x["row"].isNotNull())
    kept = F.transform(F.filter(made, lambda x, i: x["named"] | (i == 0)), lambda x: x["row"]).cast(ROW)
    whole = rows(row("value", text=F.left(f.c, F.lit(WHOLE)), date=f.date, rank=f.rank, fragment=f.c))
    return F.when(f.c == "", F.array().cast(ROW)).otherwise(otherwise(kept, whole))


#: The parser of each canonical field name; any other name has the generic one.
PARSERS: dict[str, Callable[[Field], Column]] = {
    **dict.fromkeys(["Area"], area),
    **dict.fromkeys(["Population"], population),
    **dict.fromkeys(["Life expectancy at birth"], life_expectancy),
    **dict.fromkeys(["Age structure"], age_structure),
    **dict.fromkeys(["Birth rate", "Death rate"], single_rate),
    **dict.fromkeys(["Infant mortality rate"], infant_mortality),
    **dict.fromkeys(["Total fertility rate"], single_value),
    **dict.fromkeys(
        ["Real GDP (purchasing power parity)", "GDP (purchasing power parity)", "Real GDP per capita", "GDP - per capita (PPP)", "GDP (official exchange rate)",
         "Current account balance", "Reserves of foreign exchange and gold", "Debt - external"], dollars),
    **dict.fromkeys(["Military expenditures"], share_of_gdp),
    **dict.fromkeys(["Exports", "Imports"], trade),
    **dict.fromkeys(["Budget"], budget),
    **dict.fromkeys(["Land use"], land_use),
    **dict.fromkeys(["Electricity"], electricity),
    **dict.fromkeys(
        ["Unemployment rate", "Inflation rate (consumer prices)", "Real GDP growth rate", "GDP - real growth rate", "Population growth rate", "Public debt",
         "Industrial production growth rate"], percents),
    **dict.fromkeys(["Dependency ratios"], dependency_ratios),
    **dict.fromkeys(["Urbanization"], urbanization),
    **dict.fromkeys(["Elevation"], elevation),
    **dict.fromkeys(["Geographic coordinates"], coordinates),
    **dict.fromkeys(["Coastline"], with_units),
    **dict.fromkeys(["Median age"], median_age),
    **dict.fromkeys(["Sex ratio"], sex_ratio),
    **dict.fromkeys(["Literacy"], literacy),
    **dict.fromkeys(["Maritime claims"], maritime_claims),
    **dict.fromkeys(["Natural gas"], natural_gas),
    **dict.fromkeys(["Internet users"], internet_users),
    **dict.fromkeys(["Telephones - fixed lines", "Telephones - mobile cellular"], telephones),
    **dict.fromkeys(["GDP - composition, by sector of origin"], gdp_composition),
    **dict.fromkeys(["Household income or consumption by percentage share"], household_income),
    **dict.fromkeys(["School life expectancy (primary to tertiary education)"], school_life),
    **dict.fromkeys(["Youth unemployment rate (ages 15-24)", "Unemployment, youth ages 15-24"], youth_unemployment),
    **dict.fromkeys(["Carbon dioxide emissions", "Carbon dioxide emissions from consumption of energy"], co2),
    **dict.fromkeys(["Total water withdrawal", "Freshwater withdrawal (domestic/industrial/agricultural)"], water_withdrawal),
    **dict.fromkeys(["Broadband - fixed subscriptions"], broadband),
    **dict.fromkeys(["Drinking water source", "Sanitation facility access"], water_source),
    **dict.fromkeys(["Waste and recycling"], waste),
    **dict.fromkeys(["Revenue from forest resources"], forest_revenue),
}


def parsed(df: DataFrame, content: str, parser: Callable[[Field], Column], strict: bool = False) -> DataFrame:
    """df with sub_values: what one parser makes of a column; null for null or empty content."""
    return df.withColumn("sub_values", _values(F.col(content), parser, strict))


def _values(content: Column, parser: Callable[[Field], Column], strict: bool) -> Column:
    """The rows of one field.  Content is normalised, dated and parsed once; each is bound to a variable, since as plain
    expressions they would be copied to every place that names them."""
    whole = rows(row("value", text=F.left(content, F.lit(WHOLE)), fragment=content))
    safe = lambda made: F.when(F.exists(made, lambda r: r["spoilt"]), whole).otherwise(made)
    told = lambda c: F.struct(c.alias("c"), X.date_est(c).alias("date"), X.rank(content).alias("rank"))
    field = X.bound(X.bound(X.normalized(content), told), lambda s: X.bound(parser(Field(s["c"], content, s["date"], s["rank"], strict)), safe))
    return F.when(content != "", field)


def extract(fields: DataFrame, canonical: str, content: str, strict: bool = False, among: list[str] | None = None) -> DataFrame:
    """fields with the columns of each of their sub-values, one row for each; fields without any are left out.

    One pass: a field's name picks its parser.  among: the canonical names that occur, if known; parsers without any of
    them are left out of the plan.
    """
    parsers: dict[Callable, list[str]] = {}
    for name, parser in PARSERS.items():
        if among is None or name in among:
            parsers.setdefault(parser, []).append(name)
    name, c = F.col(canonical), F.col(content)
    picked = None
    for parser, names in parsers.items():
        values = _values(c, parser, strict)
        picked = F.when(name.isin(names), values) if picked is None else picked.when(name.isin(names), values)
    rest = _values(c, generic, strict)
    values = rest if picked is None else picked.otherwise(rest)
    return exploded(fields.where(c != ""), values)


def exploded(df: DataFrame, values: Column) -> DataFrame:
    """A row for each value, with df's columns.  The outer form keeps Spark from making the values once more in a filter
    on their number."""
    out = df.withColumn("_row", F.explode_outer(values)).where(F.col("_row").isNotNull())
    return out.select(*df.columns, "_row.*").drop("spoilt")
