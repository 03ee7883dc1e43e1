"""Dictionary entries of a small edition."""

from yearloom.operators import dictionary as D


def tables(spark):
    return (
        spark.createDataFrame([(1, 2000, "A", 7), (2, 2000, "B", 8), (3, 1999, "A", 7)], "country_id long, year int, name string, master_id long"),
        spark.createDataFrame([(10, 1, "Geo"), (11, 1, "Eco"), (20, 2, "Geo")], "category_id long, country_id long, title string"),
        spark.createDataFrame(
            [(100, 10, 1, "Area", "5 < 6"), (101, 11, 1, "Area", "more"), (102, 10, 1, "Coast", " "), (103, 11, 1, "GDP", "9"), (104, 10, 1, "None", None), (200, 20, 2, "Area", "7")],
            "field_id long, category_id long, country_id long, field_name string, content string",
        ),
        spark.createDataFrame([(7, "AA", "A", "a1", "sovereign"), (8, "BB", "B", None, "sovereign")], "master_id long, code string, name string, iso2 string, entity_type string"),
    )


def test_general(spark):
    countries, categories, fields, masters = tables(spark)
    got = [(r["headwords"], r["body"]) for r in D.general(countries, categories, fields, masters, 2000).orderBy("place").collect()]
    assert got == [
        (["A", "a1", "AA", "A - Area", "a1 - Area", "AA - Area"], "<i>A</i><br>\n<small>Geo</small><br><br>\n5 &lt; 6\nmore"),
        (["A - GDP", "a1 - GDP", "AA - GDP"], "<i>A</i><br>\n<small>Eco</small><br><br>\n9"),
        (["B", "BB", "B - Area", "BB - Area"], "<i>B</i><br>\n<small>Geo</small><br><br>\n7"),
    ]
    assert D.general(countries, categories, fields.limit(0), masters, 2000).count() == 0


def test_structured(spark):
    countries, categories, fields, masters = tables(spark)
    rows = [(1, 100, "total", 1234.5, "km", None), (2, 100, "note", None, None, "x" * 501), (3, 100, "none", None, None, None), (4, 101, "land", 3.0, None, None)]
    values = spark.createDataFrame(rows, "value_id long, field_id long, sub_field string, numeric_val double, units string, text_val string")
    (got,) = D.structured(countries, categories, fields, values, masters, 2000).collect()
    assert got["headwords"][0] == "A"
    assert got["body"] == "<i>A</i><br>\n<small>Eco</small><br><br>\n<b>total</b>: 1,234.5 km<br>\n<b>note</b>: " + "x" * 500 + "...<br>\n<b>land</b>: 3<br>"


def test_merged_and_checks(spark):
    rows = [((2,), ["A", "c"], "two"), ((1,), ["A", "b", "c"], "one"), ((3,), ["B"], "<small>x�</small>" + "y" * 30)]
    entries = spark.createDataFrame(rows, "place struct<country_id: long>, headwords array<string>, body string")
    got = {r["headwords"][0]: (r["headwords"], r["body"]) for r in D.merged(entries).collect()}
    assert got["A"] == (["A", "b", "c"], "one\ntwo") and len(got) == 2
    want = {"entries": 3, "short": 2, "no_category": 2, "no_name": 3, "unbalanced": 0, "spoilt": 1, "no_headword": 0, "characters": 53, "doubled": 1}
    assert dict(map(tuple, D.checks(entries).collect())) == want
    apart = dict(map(tuple, D.checks(entries, book=entries["place.country_id"]).collect()))
    assert apart == {**want, "doubled": 0}
    assert dict(map(tuple, D.checks(entries.limit(0)).collect())) == {k: 0 for k in want}


def test_all_editions(spark):
    countries, categories, fields, masters = tables(spark)
    more = spark.createDataFrame([(30, 3, "Geo")], categories.schema), spark.createDataFrame([(300, 30, 3, "Area", "4")], fields.schema)
    got = D.general(countries, categories.union(more[0]), fields.union(more[1]), masters).groupBy("place.country_id").count().collect()
    assert {r["country_id"]: r["count"] for r in got} == {1: 2, 2: 1, 3: 1}


def books(spark):
    rows = [
        ("1990", ["Old Land", "OL", "Old Land - Area"], "<i>Old Land</i> total 5 % 100"), ("1990", ["Old Land - Coast"], None), ("1990", [], "nobody's"),
        ("1990", ["New - Area"], "a\nb"), ("2000", ["New", "New - Area"], "<b>total</b>: 7<br>"), ("2000", ["New", "New - Area"], "twice"),
    ]
    return spark.createDataFrame(rows, "book string, headwords array<string>, body string")


def test_truths(spark):
    rows = [
        ("1990", "Old Land - Area", "5 % 100", True), ("1990", "OL", "total", True), ("1990", "Old Land", "nothing", False), ("1990", "Old Land - Coast", "x", False), ("1990", "Old Land - Coast", "", True),
        ("1990", "New - Area", None, True), ("2000", "New", "twice", True), ("2000", "New - Area", "total", True), ("2000", "Old Land", "", False), ("1990", None, "x", False), ("1990", "OL", "total", True),
    ]
    truths = spark.createDataFrame([x[:3] for x in rows], "book string, headword string, needle string")
    told = D.truths_told(books(spark), truths)
    assert told.columns == ["book", "headword", "needle", "ok"]
    assert sorted(map(str, (tuple(r) for r in told.collect()))) == sorted(map(str, rows))
    assert D.truths_told(books(spark).limit(0), truths).where("ok").count() == 0 and D.truths_told(books(spark), truths.limit(0)).count() == 0


def test_many_truths(spark, monkeypatch):
    """Many needles of a headword are dealt in portions, and found without one being compared with the body each."""
    monkeypatch.setattr(D, "PORTION", 1000)
    monkeypatch.setattr(D.matching, "BLOCK", 512)
    body = "é".join(f"total: {i * 7919 % 100003} km" for i in range(6000))
    entries = spark.createDataFrame([("b", ["x", "y"], body), ("b", ["y"], "z"), ("b", ["unasked"], None)], "book string, headwords array<string>, body string")
    asked = [f"total: {i} km" for i in range(5000)] + ["z", "", None, body, body + "!"]
    truths = spark.createDataFrame([("b", h, n) for h in "xy" for n in asked] + [("c", "x", ""), (None, "x", "")], "book string, headword string, needle string")
    got = D.truths_told(entries, truths)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((b, h, n, b == "b" and ((n or "") in body or h == "y" and n == "z"))) for b, h, n in truths.collect())
    assert "CoGroup" in got._jdf.queryExecution().toString()


def test_inside():
    import random

    rng = random.Random(5)
    text = "".join(rng.choice("abé") for _ in range(5000))
    needles = ["".join(rng.choice("abé") for _ in range(rng.choice([1, 3, 7, 9]))) for _ in range(800)] + ["", text, text + "a"]
    assert D.matching.inside(text, needles) == {n for n in needles if n in text}
    assert D.matching.inside("", needles) == {""}


def test_sub_fields(spark):
    entries = spark.createDataFrame([("Area", "<b>total</b>: 1<br>\n<b>a &lt; b</b>: 2<br>"), ("Area", "<b>land</b>: 1<br>"), ("Coast", None), (None, "x")], "field_name string, body string")
    asked = spark.createDataFrame([("Area", "total"), ("Area", "a < b"), ("Area", "water"), ("None", "total")], "field_name string, sub_field string")
    got = sorted(map(tuple, D.sub_fields_told(entries, asked).collect()))
    assert got == [("Area", "a < b", 2, 1), ("Area", "total", 2, 1), ("Area", "water", 2, 2), ("None", "total", 0, 0)]


def test_names_apart(spark):
    expected = spark.createDataFrame([("1990", "Old Land"), ("1990", "Old Land"), ("1990", "Gone"), ("2000", "New"), ("2010", "Later"), (None, "x"), ("1990", None)], "book string, name string")
    got = sorted(map(tuple, D.names_apart(books(spark), expected).collect()))
    assert got == [("1990", "Gone", "lacking"), ("1990", "New", "added"), ("2010", "Later", "lacking")]
    assert D.names_apart(books(spark).limit(0), expected.limit(0)).count() == 0


def test_alike(spark):
    first = spark.createDataFrame([("a", "x", "1"), ("a", "y", "2"), ("a", "z", None), ("b", "x", "1"), ("c", "x", "1")], "book string, entry string, body string")
    second = spark.createDataFrame([("a", "x", "1"), ("a", "y", "3"), ("a", "z", None), ("b", "x", ""), ("d", "x", "1")], first.schema)
    assert sorted(map(tuple, D.alike(first, second).collect())) == [("a", 3, 2), ("b", 1, 0)]
