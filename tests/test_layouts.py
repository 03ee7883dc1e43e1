"""Text layouts on minimal documents."""

import pytest

from yearloom.operators import layouts as L

CASES = [
    ("old", "\nCountry:  A\n- Geography\nTotal area: 647,500 km2\n  of land\n- People\nPopulation: 5", [("A", "Geography", "Total area", "647,500 km2 of land"), ("A", "People", "Population", "5")]),
    ("tagged", "\n_@_A\n_*_Geography\n_#_Total area: 647,500 km2\nmore\n_#_Coast: none", [("A", "Geography", "Total area", "647,500 km2 more"), ("A", "Geography", "Coast", "none")]),
    ("colon", ":Aa Geography\nTotal area:\n    647,500 km2\n:B C People\nPopulation:\n  7", [("Aa", "Geography", "Total area", "647,500 km2"), ("B C", "People", "Population", "7")]),
    ("asterisk", "*Korea, North, Geography\nLocation:\n  Asia\nArea:\n  total area:\n  5", [("Korea, North", "Geography", "Location", "Asia"), ("Korea, North", "Geography", "Area", "total area: | 5")]),
    ("atsign", "x\n@Z:Geography\n Location: no\n" + "_" * 25 + "\n@A:Geography\n Location: Asia\nEconomy\n Budget: 5", [("A", "Geography", "Location", "Asia"), ("A", "Economy", "Budget", "5")]),
    ("atsign_bare", "@Aa\n-----\nGeography\n---------\nLocation: Asia\n@Bb\nPeople\nPopulation: 6", [("Aa", "Geography", "Location", "Asia"), ("Bb", "People", "Population", "6")]),
    ("equals", "@Aa\n\nAa    Introduction\nBackground: long\ntext\n\nAa    Geography Top of Page\nLocation: Asia", [("Aa", "Introduction", "Background", "long text"), ("Aa", "Geography", "Location", "Asia")]),
]


@pytest.mark.parametrize("layout,text,want", CASES)
def test_layout(spark, layout, text, want):
    df = spark.createDataFrame([(1, text), (2, None)], "id long, text string")
    got = L.text_rows(df, "id", "text", layout).orderBy("doc", "place").collect()
    assert [(r["country"], r["category"], r["field"], r["content"]) for r in got] == want
