"""Layouts of web pages on small pages with nested tags."""

import pytest

from yearloom.operators import layouts as L, pages as P

TABLE = """<html><body><a name="Top">x</a><table><tr><td><a name="Geo">Geo graphy</a></td></tr>
<tr><td class="FieldLabel" width=20><div align="right">Area:</div></td><td bgcolor=w>total: <i>5</i> sq km<br>land: 4 sq km<a href=x><img src=y> map</a></td></tr>
<tr><td class="FieldLabel">Coast:</td><td><table><tr><td>12</td><td>km</td></tr></table></td></tr>
<tr><td><a name="Econ"></a></td></tr><tr><td class=FieldLabel>Budget:</td><td>$5 &amp; more</td></tr></table></body></html>"""
PANEL = """<div class="CollapsiblePanel" id="CollapsiblePanel1_Geo"><table><tr><td class="CollapsiblePanelTab"><span class="category">Geography::Nowhere</span></td></tr></table>
<table class="CollapsiblePanelContent"><tr class="na_light"><td><div class="category"><a href=x>Area</a>:</div></td></tr>
<tr><td><div class="category">total: <span class="category_data">5 sq km</span></div><div class="category">land: <span class="category_data">4 sq km</span></div></td></tr>
<tr class="noa_light"><td><div class="category"><a href=x>Coast:</a></div></td></tr><tr><td><div class="category_data">12 km</div></td></tr></table></div>
<div class="CollapsiblePanel"><h2 class="question" sectiontitle="x">Economy</h2><table class="CollapsiblePanelContent"><tr class="na_light"><td>Budget:</td></tr><tr><td><span class="category_data">$5</span></td></tr></table></div>"""
EXPAND = """<ul><li><h2 class='question' sectiontitle='Geography'>Geography :: NOWHERE</h2><div id='field' class='category noa_light'><a href='x'>Area:</a></div>
<div><span class=category>total: </span><span class=category_data>5 sq km</span></div><div><span class=category>land: </span><span class=category_data>4 sq km</span></div>
<div id='field' class='category noa_light'><a>Coast:</a></div><div class=category_data>12 km</div></li>
<li><h2 class='question' sectiontitle='Economy'>Economy :: NOWHERE</h2><div id='field' class='category'>Budget:</div><div class=category_data>$5</div></li></ul>"""
MODERN = """<ul><li id="geography-category-section-anchor"><a class="tabHead">Geography ::Nowhere</a></li>
<div class="category eur_light" id="field-anchor-geography-area"><a>Area:</a></div>
<div id="field-area"><div class="category_data subfield numeric"><span class="subfield-name">total:</span> <span>5 sq km</span></div><div class="category_data subfield numeric">land: 4 sq km</div>
<div class="category_data"><a href="../rank.html">country comparison: 9</a></div></div>
<div class="category" id="field-anchor-geography-coast"><a>Coast</a></div><div id="field-coast"><div class="category_data subfield">12 km</div></div>
<li id="economy-category-section-anchor"><a class="tabHead">Economy ::Nowhere</a></li><div id="field-anchor-economy-budget"><a>Budget</a></div><div id="field-budget"><div class="category_data subfield">$5</div></div></ul>"""
CASES = [
    ("table", TABLE, [("Geography", "Area", "total: 5 sq km | land: 4 sq km"), ("Geography", "Coast", "12 km"), ("Economy", "Budget", "$5 & more")]),
    ("collapsiblepanel", PANEL, [("Geography", "Area", "total: | 5 sq km | land: | 4 sq km"), ("Geography", "Coast", "12 km"), ("Economy", "Budget", "$5")]),
    ("expandcollapse", EXPAND, [("Geography", "Area", "total: 5 sq km | land: 4 sq km"), ("Geography", "Coast", "12 km"), ("Economy", "Budget", "$5")]),
    ("modern", MODERN, [("Geography", "Area", "total: 5 sq km | land: 4 sq km"), ("Geography", "Coast", "12 km"), ("Economy", "Budget", "$5")]),
]


@pytest.mark.parametrize("layout,html,want", CASES)
def test_page_layout(spark, layout, html, want):
    df = spark.createDataFrame([(1, html), (2, None), (3, "<p>no fields</p><script>x</script><p>at all"), (4, html)], "id long, html string")
    got = P.page_rows(df, "id", "html", layout).orderBy("page", "place").collect()
    for page in (1, 4):
        assert [(r["category"], r["field"], r["content"]) for r in got if r["page"] == page] == want
    assert [tuple(r)[2:] for r in got if r["page"] == 3] == [("Full Content", "Text", "no fields\nat all")]
    assert not [r for r in got if r["page"] == 2]


def test_classic(spark):
    html = '<body><a name="Geo"></a><p><b>Area:</b> <i>total:</i> 5 sq km<br>land: 4 sq km<b>Coast:</b> 12 km<p><center><table><tr><td>x</td></tr></table><a name="Econ">Economy</a><b>Budget:</b> $5</body>'
    got = L.classic_html(spark.createDataFrame([(1, html)], "id long, html string"), "id", "html").orderBy("section", "place").collect()
    assert [(r["category"], r["field"], r["content"]) for r in got] == [("Geography", "Area", "total: 5 sq km | land: 4 sq km"), ("Geography", "Coast", "12 km"), ("Economy", "Budget", "$5")]


@pytest.mark.parametrize("html,want", [
    ("<title>CIA -- The World Factbook 2000 -- Aruba</title>", "Aruba"),
    ("<title>Europe :: ALBANIA — The World Factbook - Central Intelligence Agency</title>", "Albania"),
    ("<title>The World Factbook</title><span class='countryName'>CHAD</span>", "Chad"),
    ("<title>The World Factbook</title><span class='category'>Geography::Peru</span>", "Peru"),
    ("<title>x</title>", "x"),
    ("<h2 class='q' sectiontitle='Geography'>Geography :: <i>Togo</i></h2>", "Togo"),
    ("<p>nothing</p>", "Unknown"),
])
def test_page_name(spark, html, want):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(L.page_name(df["html"]).alias("n")).first()["n"] == want


@pytest.mark.parametrize("layout", P.LAYOUTS)
def test_one_pass(spark, layout):
    """No row moves, and each page is read once, also where pages repeat."""
    html = dict((name, page) for name, page, _ in CASES)[layout]
    df = spark.createDataFrame([(1, html), (1, html), (None, html)], "id long, html string")
    rows = P.page_rows(df, "id", "html", layout)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and plan.count("MapInArrow") == 1
    got = sorted((str(r["page"]), r["place"], r["field"], r["content"]) for r in rows.collect())
    assert len(got) == 9 and got[0:6:2] == got[1:6:2]


def test_links_with_pictures_and_open_ends(spark):
    html = '<td class="FieldLabel">A:</td><td>one<a href=x>two<img src=y></a>three<a href=x>four<a href=z>five</td><td class="FieldLabel">B:</td><td>six<script>no</script><a>seven'
    df = spark.createDataFrame([(1, f"<table><tr>{html}")], "id long, html string")
    got = [(r["field"], r["content"]) for r in P.page_rows(df, "id", "html", "table").orderBy("place").collect()]
    assert got == [("A", "one three four five"), ("B", "six seven")]


@pytest.mark.parametrize("layout", P.LAYOUTS)
def test_long_page_without_fields(spark, layout):
    """The text of a page without fields is whole, whatever its length."""
    lines = [f"line {i} of the page" for i in range(15_000)]
    df = spark.createDataFrame([(1, "<body><p>" + "<p>".join(lines) + "</body>")], "id long, html string")
    want = "\n".join(lines)
    assert len(want) > 300_000
    assert [tuple(r) for r in P.page_rows(df, "id", "html", layout).collect()] == [(1, 0, "Full Content", "Text", want)]


def test_long_table_page_whose_labels_have_no_values(spark):
    """Labels beside empty cells are no fields, so the page's text is told, and whole."""
    lines = [f"note {i} below the table" for i in range(15_000)]
    html = '<table><tr><td class="FieldLabel">Area:</td><td> </td></tr><tr><td class="FieldLabel">Coast:</td></tr></table><p>' + "<br>".join(lines)
    df = spark.createDataFrame([(1, html), (2, html + "<p>end")], "id long, html string")
    want = "\n".join(["Area:", "Coast:", *lines])
    got = [tuple(r) for r in P.page_rows(df, "id", "html", "table").orderBy("page").collect()]
    assert got == [(1, 0, "Full Content", "Text", want), (2, 0, "Full Content", "Text", want + "\nend")]
