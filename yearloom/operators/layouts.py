"""Text and HTML layouts of editions as rows (country, category, field, content).

Lines are exploded with their place; what a marker line says is carried forward by windows inside one document, and the
lines of a field are joined in their order.  Every layout is a rule table for the same steps, so a document's lines are
shuffled once, by document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from yearloom.functions import text as X
from yearloom.operators.pages import ANCHORS

#: Section titles (fixed values).
SECTIONS = [
    "Geography", "People", "Government", "Economy", "Communications", "Transportation", "Defense Forces", "Military", "Transnational Issues", "Introduction",
    "People and Society",
]
TITLES = "|".join(sorted(SECTIONS, key=len, reverse=True))
NAME = r"[A-Za-z][A-Za-z ,'.\-()]+"


@dataclass(frozen=True)
class Layout:
    country: str  # pattern of a line that names a country, in group 1
    section: str  # pattern of a line that names a section, in its last group
    field: str  # pattern of a line that names a field (group 1) and may hold content (group 2)
    joint: str  # between the lines of a content
    rule: str = r"^[-=_]{10,}\s*$"  # lines without meaning
    start: str | None = None  # nothing counts before this line
    trim: bool = False  # lines are looked at without their indent


# The line patterns of the layouts are fixed values.
INLINE = r"^\s*([A-Z][\w\s\-,()/]+?):\s+(.+)"
INDENTED = r"^([^\s:][^:]*):\s*(.*)"
MIXED = r"^\s{0,2}([A-Z][\w\s\-,()/.]+?):\s*(.*)"
LAYOUTS = {
    "old": Layout(r"^Country:\s{2,}(.+)", r"^- ([A-Z].*)", INLINE, " "),
    "tagged": Layout(r"^_@_([^\d*].*)", r"^\s*_\*_(.*)", r"^\s*_#_([^:]+):\s*(.+)", " "),
    "colon": Layout(
        r"^:([A-Za-z][\w\s,'.\-()]+?)\s+(?:" + TITLES + r")\s*$", r"^:[A-Za-z][\w\s,'.\-()]+?\s+(" + TITLES + r")\s*$", INDENTED, " | ", r"^\s*[*\-=_]{5,}"
    ),
    "asterisk": Layout(r"^[*@](.+),\s*(?:" + TITLES + r")\s*$", r"^[*@].+,\s*(" + TITLES + r")\s*$", INDENTED, " | ", r"^\s*[*\-=_]{5,}"),
    "atsign": Layout(r"^@([^:]+):[A-Za-z][\w ]*", r"^(?:@[^:]+:([A-Za-z][\w ]*)|(" + TITLES + r")\s*$)", MIXED, " | ", start="^_{20,}$"),
    "atsign_bare": Layout("^@(" + NAME + ")$", r"^\s*(" + TITLES + r")\s*$", MIXED, " | ", r"^\s*(-+|=+)\s*$|^[-=_]{10,}\s*$"),
    "equals": Layout("^@(" + NAME + ")$", r"^" + NAME + r"[ \t]{4,}(" + TITLES + r")[\w ]*$", INLINE, " "),
    "repair": Layout(r"^\s{20,}([A-Z][A-Za-z ,'.\-()]+?)\s*$", r"^ {10,}(" + TITLES + r")\s*$", r"^\s{3,7}([A-Z][\w\s\-,()/.']+?):\s*(.*)", " ", r"^\d{2}/\d{2}/\d{2}\s.*Page\s+\d+\s*$"),
}
#: The layout of each edition of plain text (fixed values).
TEXT_YEARS = {
    1990: "old", 1991: "tagged", 1992: "colon", 1993: "asterisk", 1994: "asterisk", 1995: "atsign", 1996: "atsign_bare", 1997: "atsign", 1998: "atsign",
    1999: "atsign_bare", 2001: "equals",
}


def strip_wrapper(text: Column) -> Column:
    """What stands between the start and end notes of an e-book."""
    mark = r"\*\*\* %s OF (?:THE )?PROJECT GUTENBERG EBOOK.*?\*\*\*"
    body = F.regexp_replace(F.coalesce(text, F.lit("")), "(?s)^.*?" + mark % "START", "")
    return X.stripped(F.regexp_replace(body, "(?s)" + mark % "END" + ".*$", ""))


def html_layout(year: Column) -> Column:
    """The layout of an edition of web pages."""
    return (
        F.when(year.between(2001, 2008), "table")
        .when(year.between(2009, 2014), "collapsiblepanel")
        .when(year.between(2015, 2017), "expandcollapse")
        .when(year.between(2018, 2020), "modern")
        .otherwise("classic")
    )


def text_rows(docs: DataFrame, doc: str, text: str, layout: str | Layout) -> DataFrame:
    """(doc, place, country, category, field, content) of documents in one layout.

    place orders fields as they stand.  Lines before the first field of a section belong to none; a field without content
    is left out.  Null texts have no rows.
    """
    rules = LAYOUTS[layout] if isinstance(layout, str) else layout
    lines = docs.select(F.col(doc).alias("doc"), F.posexplode(F.split(strip_wrapper(F.col(text)), "\r?\n")).alias("at", "line"))
    w = W.partitionBy("doc").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    line = F.col("line")
    if rules.start:
        lines = lines.withColumn("_on", F.max(line.rlike(rules.start)).over(w)).where("_on").drop("_on")
    country, section = line.rlike(rules.country), line.rlike(rules.section)
    field = ~country & ~section & line.rlike("(?U)" + rules.field)
    title = F.coalesce(*(F.nullif(F.regexp_extract(line, rules.section, g), F.lit("")) for g in range(1, rules.section.replace("(?:", "").replace(r"\(", "").count("(") + 1)))
    marked = lines.where(~line.rlike(rules.rule) & (F.trim(line) != "")).select(
        "doc",
        "at",
        "line",
        F.when(country, F.trim(F.regexp_extract(line, rules.country, 1))).alias("c"),
        F.when(section, F.trim(title)).alias("s"),
        F.when(country | section, F.lit("")).when(field, F.trim(F.regexp_extract(line, "(?U)" + rules.field, 1))).alias("f"),
        F.when(country | section | field, F.col("at")).alias("head"),
        F.when(field, X.stripped(F.regexp_extract(line, "(?U)" + rules.field, 2))).otherwise(X.stripped(line)).alias("part"),
        (country | section).alias("mark"),
        (country & ~section).alias("opens"),
    )
    carried = marked.select(
        "doc",
        "at",
        "part",
        "mark",
        F.last("c", ignorenulls=True).over(w).alias("country"),
        # A country line without a section ends the section before it.
        F.last(F.when(F.col("opens"), "").otherwise(F.col("s")), ignorenulls=True).over(w).alias("category"),
        F.last("f", ignorenulls=True).over(w).alias("field"),
        F.last("head", ignorenulls=True).over(w).alias("place"),
    )
    kept = carried.where("country <> '' AND category <> '' AND field <> '' AND NOT mark AND part <> ''")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda x: x["part"])
    return kept.groupBy("doc", "place", "country", "category", "field").agg(F.array_join(parts, rules.joint).alias("content"))


#: What makes a layout's one section of a text of fields.
SHELLS = {"inline": ("old", "Country:  x\n- X\n"), "indented": ("colon", ":Xx Geography\n"), "mixed": ("atsign_bare", "@Xx\nGeography\n")}


def field_rows(docs: DataFrame, doc: str, text: str, style: str) -> DataFrame:
    """(doc, place, field, content) of texts that hold the fields of one section, in one of the styles of SHELLS."""
    layout, shell = SHELLS[style]
    whole = docs.select(F.col(doc).alias("doc"), F.concat(F.lit(shell), F.col(text)).alias("text"))
    return text_rows(whole, "doc", "text", layout).select("doc", "place", "field", "content")


def classic_html(pages: DataFrame, page: str, html: str) -> DataFrame:
    """(page, category, field, content): sections start at named anchors, fields at bold labels."""
    anchors = r"(?i)(?=<a\s+name=\"[^\"]+\"[^>]*>[^<]*</a>)"
    cut = pages.select(F.col(page).alias("page"), F.posexplode(F.split(html, anchors)).alias("section", "body"))
    anchor = r"(?i)^<a\s+name=\"([^\"]+)\"[^>]*>([^<]*)</a>"
    named = cut.where(F.col("body").rlike(anchor)).select(
        "page",
        "section",
        F.coalesce(
            F.nullif(F.trim(F.regexp_extract("body", anchor, 2)), F.lit("")),
            F.try_element_at(F.create_map(*(F.lit(x) for pair in ANCHORS.items() for x in pair)), F.regexp_extract("body", anchor, 1)),
            F.regexp_extract("body", anchor, 1),
        ).alias("category"),
        F.regexp_replace(F.regexp_replace("body", anchor, ""), r"(?is)<p><center><table.*$", "").alias("body"),
    )
    fields = named.select("page", "section", "category", F.posexplode(F.split("body", r"(?i)(?=<b>[^<]+?:</b>)")).alias("place", "part"))
    label = r"(?i)^<b>([^<]+?):</b>"
    out = fields.where(F.col("part").rlike(label)).select(
        "page",
        "section",
        "place",
        "category",
        F.trim(F.regexp_extract("part", label, 1)).alias("field"),
        X.html_to_pipe(F.regexp_replace("part", label, "")).alias("content"),
    )
    return out.where("content <> ''")


def page_name(html: Column) -> Column:
    """The name of a page's subject: from the title, the last part between dashes or double colons that says anything, or
    else what is left of it; then the element of class countryName, what follows :: in a category, and in a heading."""

    def titled(title: Column) -> Column:
        parts = F.split(title, "--|::| - ")
        clean = F.transform(parts, lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, "The World Factbook.*|Central Intelligence Agency", ""), r"^\s*CIA\s*$|^[\s-]+|[\s-]+$", "")))
        told = F.get(F.reverse(F.filter(clean, lambda p: F.length(p) > 1)), F.lit(0))
        rest = F.regexp_replace(title, r"CIA|Central Intelligence Agency|The World Factbook|\d{4}|-|::", " ")
        return F.coalesce(F.when(F.size(parts) > 1, told), F.nullif(X.stripped(F.regexp_replace(rest, r"\s+", " ")), F.lit("")))

    def inside(pattern: str) -> Column:
        told = X.stripped(F.regexp_replace(F.regexp_extract(html, pattern, 1), "<[^>]+>", ""))
        return F.nullif(told, F.lit(""))

    title = F.regexp_replace(X.stripped(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), "[–—]", " - ")
    found = F.coalesce(
        X.bound(title, titled),
        inside(r"(?is)class=[\"']?countryName\b[^>]*>(.*?)</"),
        inside(r"(?is)<(?:span|a)\b[^>]*class=[\"']?(?:category|tabHead)\b[^>]*>[^<]*::([^<]+)<"),
        inside(r"(?is)<h2\b[^>]*sectiontitle=[^>]*>[^<]*::(.*?)</h2>"),
    )
    return F.coalesce(X.title_case(found), F.lit("Unknown"))


def json_rows(editions: DataFrame) -> DataFrame:
    """(code, category, place, field, content) of editions(code, categories): one row for each field, in order.

    categories is an array of (title, fields), fields one of (name, content, value); content stands before value.
    """
    cats = editions.select("code", F.posexplode("categories").alias("c_at", "c"))
    fields = cats.select("code", F.col("c.title").alias("category"), "c_at", F.posexplode("c.fields").alias("f_at", "f"))
    content = X.strip_html(F.coalesce("f.content", "f.value"))
    return fields.select("code", F.left("category", F.lit(200)).alias("category"), (F.col("c_at") * 100000 + F.col("f_at")).alias("place"), F.left("f.name", F.lit(200)).alias("field"), content.alias("content"))
