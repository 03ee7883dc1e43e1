"""Document layouts, name rules and entity rules over texts made from keys, against the rows that they were made of."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from yearloom.functions import text as X
from yearloom.operators import entities, layouts as L, names, pages as P

from . import made
from .registry import query

#: name -> (layout, document, [(country, category, field, content)]) of plain text.
TEXTS: dict[str, tuple[str, str, list[tuple[str, str, str, str]]]] = {
    "text_old": ("old", "\nCountry:  Land {a}\n- Geography\nTotal area: {b},{t} km2\n  of land\n- People\nPopulation: {c}", [
        ("Land {a}", "Geography", "Total area", "{b},{t} km2 of land"), ("Land {a}", "People", "Population", "{c}")]),
    "tagged_lines": ("tagged", "\n_@_Land {a}\n_*_Geography\n_#_Total area: {b},{t} km2\nmore {e}\n_#_Coast: none", [
        ("Land {a}", "Geography", "Total area", "{b},{t} km2 more {e}"), ("Land {a}", "Geography", "Coast", "none")]),
    "text_colon": ("colon", ":Aa Geography\nTotal area:\n    {b},{t} km2\n:B C People\nPopulation:\n  {c}\n  est {y}", [
        ("Aa", "Geography", "Total area", "{b},{t} km2"), ("B C", "People", "Population", "{c} | est {y}")]),
    "text_asterisk": ("asterisk", "*Korea, North, Geography\nLocation:\n  Asia {a}\nArea:\n  total area:\n  {b}", [
        ("Korea, North", "Geography", "Location", "Asia {a}"), ("Korea, North", "Geography", "Area", "total area: | {b}")]),
    "text_atsign": ("atsign", "x\n@Z:Geography\n Location: no\n_________________________\n@Land:Geography\n Location: Asia {a}\nEconomy\n Budget: {b}", [
        ("Land", "Geography", "Location", "Asia {a}"), ("Land", "Economy", "Budget", "{b}")]),
    "text_atsign_bare": ("atsign_bare", "@Aa\n-----\nGeography\n---------\nLocation: Asia {a}\n@Bb\nPeople\nPopulation: {b}", [
        ("Aa", "Geography", "Location", "Asia {a}"), ("Bb", "People", "Population", "{b}")]),
    "text_equals": ("equals", "@Aa\n\nAa    Introduction\nBackground: long {a}\ntext\n\nAa    Geography Top of Page\nLocation: Asia {b}", [
        ("Aa", "Introduction", "Background", "long {a} text"), ("Aa", "Geography", "Location", "Asia {b}")]),
    "text_repair": ("repair", "01/02/97  CIA  Page {a}\n                         Landia\n            Geography\n    Location:  Asia {b}\n      and more\n    Area:  {c} km", [
        ("Landia", "Geography", "Location", "Asia {b} and more"), ("Landia", "Geography", "Area", "{c} km")]),
}
#: name -> (layout, page, [(category, field, content)]), the pages of every third key.
PAGES: dict[str, tuple[str, str, list[tuple[str, str, str]]]] = {
    "html_table": ("table", '<a name="Geo">x</a><table><tr><td class="FieldLabel"><div>Area:</div></td><td>total: {b},{t} sq km<br>land: {a} sq km</td></tr></table><a name="Econ"></a><table><tr><td class="FieldLabel">Budget:</td><td>${c} million</td></tr></table>', [
        ("Geography", "Area", "total: {b},{t} sq km | land: {a} sq km"), ("Economy", "Budget", "${c} million")]),
    "html_panels": ("collapsiblepanel", '<div class="CollapsiblePanel"><table><tr><td class="CollapsiblePanelTab"><span class="category">Geography::Land</span></td></tr></table><table class="CollapsiblePanelContent"><tr class="na_light"><td><div class="category"><a href="x">Area:</a></div></td></tr><tr><td><div class="category">total: <span class="category_data">{b},{t} sq km</span></div></td></tr><tr class="na_light"><td><div class="category"><a href="x">Coast:</a></div></td></tr><tr><td><div class="category_data">{a} km</div></td></tr></table></div>', [
        ("Geography", "Area", "total: | {b},{t} sq km"), ("Geography", "Coast", "{a} km")]),
    "html_expand": ("expandcollapse", '<h2 class="question" sectiontitle="Geography">Geography :: LAND</h2><div id="field" class="category noa_light"><a href="x">Area:</a></div><div><span class="category">total: </span><span class="category_data">{b},{t} sq km</span></div><div><span class="category">land: </span><span class="category_data">{a} sq km</span></div>', [
        ("Geography", "Area", "total: {b},{t} sq km | land: {a} sq km")]),
    "html_modern": ("modern", '<ul><li id="geography-category-section-anchor"><a class="tabHead">Geography ::Land</a></li></ul><div class="category" id="field-anchor-geography-area"><a>Area:</a></div><div id="field-area"><div class="category_data subfield"><span>total:</span> <span>{b},{t} sq km</span></div><div class="category_data subfield">land: {a} sq km</div><div class="category_data"><a href="rank.html">rank {e}</a></div></div>', [
        ("Geography", "Area", "total: {b},{t} sq km | land: {a} sq km")]),
}


#: name -> the same for the next keys: nested tables, sections without fields, fields before a section, without a label or
#: without a value.
NESTED: dict[str, tuple[str, list[tuple[str, str, str]]]] = {
    "html_table": ('<a name="Top">x</a><table><tr><td class="FieldLabel">Early:</td><td>{e} km</td></tr><tr><td><a name="Geo">Geo graphy</a></td></tr><tr><td class="FieldLabel" width=20><div align="right">Area:</div></td><td bgcolor=w>total: <i>{a}</i> sq km<br>land: {b} sq km<a href=x><img src=y> map</a></td></tr><tr><td class="FieldLabel">Coast:</td><td><table><tr><td>{c}</td><td>km</td></tr></table></td></tr><tr><td class="FieldLabel">:</td><td>nameless</td></tr><tr><td class="FieldLabel">Empty:</td><td> </td></tr><tr><td><a name="Econ"></a></td></tr><tr><td class=FieldLabel>Budget:</td><td>${t} &amp; more</td></tr></table>', [
        ("General", "Early", "{e} km"), ("Geography", "Area", "total: {a} sq km | land: {b} sq km"), ("Geography", "Coast", "{c} km"), ("Economy", "Budget", "${t} & more")]),
    "html_panels": ('<div class="CollapsiblePanel"><table><tr><td class="CollapsiblePanelTab"><span class="category">Geography::Land</span></td></tr></table><table class="CollapsiblePanelContent"><tr class="na_light"><td><div class="category"><a href=x>Area</a>:</div></td></tr><tr><td><div class="category">total: <span class="category_data">{a} sq km</span></div><div class="category">land: <span class="category_data">{b} sq km</span></div></td></tr><tr class="noa_light"><td><div class="category"><a href=x>Empty:</a></div></td></tr><tr><td></td></tr></table></div><div class="CollapsiblePanel"><h2 class="question" sectiontitle="x">Economy</h2><table class="CollapsiblePanelContent"><tr class="na_light"><td>Budget:</td></tr><tr><td><span class="category_data">${c}</span></td></tr></table></div>', [
        ("Geography", "Area", "total: | {a} sq km | land: | {b} sq km"), ("Economy", "Budget", "${c}")]),
    "html_expand": ("<ul><li><h2 class='question' sectiontitle='Geography'>Geography :: LAND</h2><div id='field' class='category noa_light'><a href='x'>Area:</a></div><div><span class=category>total: </span><span class=category_data>{a} sq km</span></div><div id='field' class='category noa_light'><a>Coast:</a></div><div class=category_data>{b} km</div><div id='field' class='category'>Empty:</div></li><li><h2 class='question' sectiontitle='People'>People :: LAND</h2></li><li><h2 class='question' sectiontitle='Economy'>Economy :: LAND</h2><div id='field' class='category'>Budget:</div><div class=category_data>${c}</div></li></ul>", [
        ("Geography", "Area", "total: {a} sq km"), ("Geography", "Coast", "{b} km"), ("Economy", "Budget", "${c}")]),
    "html_modern": ('<ul><div id="field-anchor-early"><a>Early</a></div><div id="field-early"><div class="category_data subfield">{e}</div></div><li><a class="tabHead">Geography ::Land</a></li><div class="category" id="field-anchor-geography-area"><a>Area:</a></div><div id="field-area"><div class="category_data subfield"><span>total:</span> <span>{a} sq km</span></div><div class="category_data subfield">land: {b} sq km</div><div class="category_data"><a href="../rank.html">comparison: {e}</a></div></div><div id="field-anchor-geography-none"><a>None</a></div><div id="field-none"></div><li><a class="tabHead">Economy ::Land</a></li><div id="field-anchor-economy-budget"><a>Budget</a></div><div id="field-budget"><div class="category_data subfield">${c}</div></div></ul>', [
        ("General", "Early", "{e}"), ("Geography", "Area", "total: {a} sq km | land: {b} sq km"), ("Economy", "Budget", "${c}")]),
}
#: A page without fields, for the keys that are left, and its row.
BARE = ("<p>no fields {a}</p><script>x</script><p>at  all", [("Full Content", "Text", "no fields {a}\nat  all")])


def _selects(rows: list[tuple], columns: tuple[str, ...], where: str = "") -> list[str]:
    return ["SELECT k, " + ", ".join(f"{made.sql(v)} AS {c}" for v, c in zip(r, columns)) + f" FROM base{where}" for r in rows]


def _union(rows: list[tuple], columns: tuple[str, ...]) -> str:
    return f"{made.BASE} " + " UNION ALL ".join(_selects(rows, columns))


def _text(name: str, layout: str, document: str, rows: list[tuple]) -> None:
    @query(name, _union(rows, ("country", "category", "field", "content")))
    def run(spark, sf_dir):
        return L.text_rows(made.texts(spark, sf_dir, document), "k", "text", layout).select(F.col("doc").alias("k"), "country", "category", "field", "content")


def _page(name: str, layout: str, page: str, rows: list[tuple]) -> None:
    kinds = [(page, rows), NESTED[name], BARE]
    columns = ("category", "field", "content")

    @query(name, f"{made.BASE} " + " UNION ALL ".join(x for i, (_, r) in enumerate(kinds) for x in _selects(r, columns, f" WHERE k % 3 = {i}")))
    def run(spark, sf_dir):
        texts = F.when(F.col("k") % 3 == 0, made.column(kinds[0][0])).when(F.col("k") % 3 == 1, made.column(kinds[1][0])).otherwise(made.column(kinds[2][0]))
        pages = made.texts(spark, sf_dir, "").select("k", texts.alias("text"))
        return P.page_rows(pages, "k", "text", layout).select(F.col("page").alias("k"), *columns)


for _name, _case in TEXTS.items():
    _text(_name, *_case)
for _name, _case in PAGES.items():
    _page(_name, *_case)

CLASSIC = '<body><a name="Geo"></a><p><b>Area:</b> <i>total:</i> {b},{t} sq km<br>land: {a} sq km<b>Coast:</b> {c} km<p><center><table><tr><td>x</td></tr></table><a name="Econ">Economy</a><b>Budget:</b> ${e} million</body>'


@query("html_sections", _union([("Geography", "Area", "total: {b},{t} sq km | land: {a} sq km"), ("Geography", "Coast", "{c} km"), ("Economy", "Budget", "${e} million")], ("category", "field", "content")))
def html_sections(spark, sf_dir):
    """Pages whose sections start at named anchors and whose fields start at bold labels."""
    return L.classic_html(made.texts(spark, sf_dir, CLASSIC), "k", "text").select(F.col("page").alias("k"), "category", "field", "content")


WRAPPED = "about\n*** START OF THE PROJECT GUTENBERG EBOOK X ***\n\nbody {a}\nof {b}\n*** END OF THE PROJECT GUTENBERG EBOOK X ***\nafter"


@query("strip_wrapper", _union([("body {a}\nof {b}",)], ("body",)))
def strip_wrapper(spark, sf_dir):
    """What stands between the start and end notes of an e-book."""
    return made.texts(spark, sf_dir, WRAPPED).select("k", L.strip_wrapper(F.col("text")).alias("body"))


FIELDS = "Climate: mild {a}\n  and dry\nTerrain: flat\n"


@query("inline_fields", _union([("Climate", "mild {a} and dry"), ("Terrain", "flat")], ("field", "content")))
def inline_fields(spark, sf_dir):
    """Fields of one section, joined by a blank."""
    return L.field_rows(made.texts(spark, sf_dir, FIELDS), "k", "text", "inline").select(F.col("doc").alias("k"), "field", "content")


@query("indented_fields", _union([("Climate", "mild {a} | and dry"), ("Terrain", "flat")], ("field", "content")))
def indented_fields(spark, sf_dir):
    """Fields whose lines are indented, joined by bars."""
    return L.field_rows(made.texts(spark, sf_dir, FIELDS), "k", "text", "indented").select(F.col("doc").alias("k"), "field", "content")


@query("mixed_fields", _union([("Climate", "mild {a} | and dry"), ("Terrain", "flat")], ("field", "content")))
def mixed_fields(spark, sf_dir):
    """Fields whose labels may be indented by two, joined by bars."""
    return L.field_rows(made.texts(spark, sf_dir, "  " + FIELDS), "k", "text", "mixed").select(F.col("doc").alias("k"), "field", "content")


NAMES = {0: "Senate of {a}", 1: "House of {b} or so", 2: "Exports", 3: "Council {c}"}


def _one_of_four(templates: dict[int, str]) -> Column:
    """One of four templates by key."""
    col = F.when(F.lit(False), F.lit(""))
    for i, t in templates.items():
        col = col.when(F.col("k") % 4 == i, made.column(t))
    return col


def _sql_of_four(templates: dict[int, str]) -> str:
    """The SQL of `_one_of_four`; columns need a session, which there is none of when this module is imported."""
    return "CASE k % 4 " + " ".join(f"WHEN {i} THEN {made.sql(t)}" for i, t in templates.items()) + " END"


@query("gov_body", f"{made.BASE} SELECT k, {_sql_of_four(NAMES)} AS name, (k % 4 <> 2 AND 1995 + k % 13 <= 2001 AND k % 180 <= 100) AS body FROM base")
def gov_body(spark, sf_dir):
    """Legislative bodies among the field names of old editions."""
    rows = made.texts(spark, sf_dir, "").select("k", _one_of_four(NAMES).alias("name"))
    return rows.select("k", "name", names.is_body(F.col("name"), F.col("k") % 180, 1995 + F.col("k") % 13).alias("body"))


STATUS = {0: "overseas territory of {a}", 1: "in free association with {b}", 2: "none", 3: ""}
STATES = {0: "republic", 1: "", 2: "kingdom {c}", 3: " "}


@query("classify_entity", f"{made.BASE} SELECT k, CASE WHEN k % 11 = 0 THEN 'disputed' WHEN k % 4 = 0 THEN 'territory' WHEN k % 4 = 1 THEN 'freely_associated' WHEN k % 4 = 2 THEN 'sovereign' ELSE 'unknown' END AS kind FROM base")
def classify_entity(spark, sf_dir):
    """Overrides before dependency status before government."""
    rows = made.texts(spark, sf_dir, "").select("k", _one_of_four(STATUS).alias("dep"), _one_of_four(STATES).alias("gov"), F.when(F.col("k") % 11 == 0, "disputed").alias("o"))
    return rows.select("k", entities.classified(F.col("dep"), F.col("gov"), F.col("o")).alias("kind"))


CALLED = {0: "The Land of {a}", 1: "Land", 2: "Republic of Landia", 3: "Elsewhere {b}"}


@query("name_mismatch", f"{made.BASE} SELECT k, {_sql_of_four(CALLED)} AS name FROM base WHERE k % 4 = 3 OR k % 4 = 2 AND k % 3 = 0")
def name_mismatch(spark, sf_dir):
    """Names that don't fit the entity they are linked to: neither equal nor inside one another, with other first words."""
    rows = made.texts(spark, sf_dir, "").select("k", _one_of_four(CALLED).alias("name"), F.when(F.col("k") % 3 == 0, "Land of Isles").otherwise("Landia").alias("known"))
    rows = rows.withColumn("known", F.when(F.col("k") % 4 == 1, "Landia").when(F.col("k") % 4 == 0, "land").otherwise(F.col("known")))
    return rows.where(~entities.name_fits(F.col("name"), F.col("known"))).select("k", "name")


@query("make_code", f"{made.BASE} SELECT k, CASE k % 4 WHEN 0 THEN 'se' WHEN 1 THEN 'ho' WHEN 2 THEN 'ex' ELSE 'co' END AS code FROM base")
def make_code(spark, sf_dir):
    """Two letters of a name."""
    return made.texts(spark, sf_dir, "").select("k", X.short_code(_one_of_four(NAMES)).alias("code"))


CDX = '[["urlkey","timestamp","original","mimetype","statuscode","digest","length"],["x","{y}0101","u","t","404","d","{a}0000000"],["x","{y}0202","u","t","200","d","{a}"],["x","{y}0303","u","t","200","d","{a}0000"],["x","{y}0404","u","t","200","d","{a}00000"]]'


@query("cdx_pick", f"{made.BASE} SELECT k, CASE WHEN a * 10000 > 1000000 THEN y || '0303' ELSE y || '0404' END AS stamp FROM base")
def cdx_pick(spark, sf_dir):
    """Of a capture index the first good capture that is large enough."""
    from yearloom.sources.readers import capture

    return made.texts(spark, sf_dir, CDX).select("k", capture(F.col("text")).alias("stamp"))
