"""Indicators over the years, by hand and against plain Python."""

import random
from statistics import linear_regression

from yearloom.operators import indicators as I

SERIES = "master_id long, year int, indicator string, value double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SERIES)


def test_series(spark):
    values = spark.createDataFrame(
        [(1, "total", 5.0), (2, "total", 3.0), (2, "total", 4.0), (3, "total", None), (4, "total", 9.0), (5, "total", 9.0), (6, "land", 1.0)], "field_id long, sub_field string, numeric_val double"
    )
    fields = spark.createDataFrame([(1, 10, "Area"), (2, 10, "Total area"), (3, 10, "Area"), (4, 11, "Area"), (5, 10, "unmapped"), (6, 10, None)], "field_id long, country_id long, field_name string")
    countries = spark.createDataFrame([(10, 2000, 7), (11, 2000, None)], "country_id long, year int, master_id long")
    mappings = spark.createDataFrame([("Area", "Area"), ("Total area", "Area")], "original string, canonical string")
    assert [tuple(r) for r in I.series(values, fields, countries, mappings).collect()] == [(7, 2000, "Area: total", 4.0)]
    assert I.series(values.limit(0), fields, countries, mappings).count() == 0


def test_race_and_leaders(spark):
    rows = [(1, 2000, "a", 9.0), (2, 2000, "a", 9.0), (3, 2000, "a", 1.0), (1, 2001, "a", 5.0), (2, 2001, "a", 6.0), (1, 2003, "a", 1.0), (2, 2003, "a", 8.0), (3, 2003, "a", 3.0), (4, 2003, "a", None), (1, 2000, "b", 1.0)]
    got = {(r["master_id"], r["year"], r["indicator"]): (r["rank"], r["dense_rank"], r["previous"], r["moved"]) for r in I.race(frame(spark, rows)).collect()}
    assert got == {
        (1, 2000, "a"): (1, 1, None, None), (2, 2000, "a"): (1, 1, None, None), (3, 2000, "a"): (3, 2, None, None), (2, 2001, "a"): (1, 1, 1, 0), (1, 2001, "a"): (2, 2, 1, -1),
        (2, 2003, "a"): (1, 1, 1, 0), (3, 2003, "a"): (2, 2, 3, 1), (1, 2003, "a"): (3, 3, 2, -1), (4, 2003, "a"): (4, 4, None, None), (1, 2000, "b"): (1, 1, None, None),
    }
    top = sorted(map(tuple, I.leaders(I.race(frame(spark, rows))).select("indicator", "master_id", "first_year", "last_year", "editions").collect()))
    # 2002 has no ranking, so it breaks nothing.
    assert top == [("a", 1, 2000, 2000, 1), ("a", 2, 2000, 2003, 3), ("b", 1, 2000, 2000, 1)]
    assert I.race(frame(spark, [])).count() == 0 and I.leaders(I.race(frame(spark, []))).count() == 0


def test_a_lead_that_is_lost_and_won_back(spark):
    rows = [(m, y, "a", 5.0 if (m == 1) == (y != 2001) else 1.0) for m in (1, 2) for y in (2000, 2001, 2002, 2004)]
    top = sorted(map(tuple, I.leaders(I.race(frame(spark, rows))).select("master_id", "first_year", "last_year", "editions").collect()))
    assert top == [(1, 2000, 2000, 1), (1, 2002, 2004, 2), (2, 2001, 2001, 1)]


def test_scatter(spark):
    r = random.Random(5)
    points = {y: [(m, float(m), 3.0 * m + r.gauss(0, 1) + (40 if m == 7 else 0)) for m in range(30)] for y in (2000, 2001)}
    points[2002] = [(m, float(m), 2.0 * m + 1) for m in range(9)]
    points[2003] = [(1, 1.0, 1.0), (2, 2.0, 5.0)]
    points[2004] = [(m, 4.0, float(m)) for m in range(5)]
    rows = [(m, y, n, v) for y, p in points.items() for m, a, b in p for n, v in (("x", a), ("y", b))] + [(99, 2000, "x", 1.0), (98, 2000, "y", 1.0), (97, 2000, "z", 1.0)]
    got = {(p["master_id"], p["year"]): p for p in I.scatter(frame(spark, rows), "x", "y").collect()}
    assert set(got) == {(m, y) for y, p in points.items() for m, _, _ in p}
    for y in (2000, 2001):
        p = points[y]
        slope, base = linear_regression([a for _, a, _ in p], [b for _, _, b in p])
        left = {m: b - base - slope * a for m, a, b in p}
        spread = (sum(x * x for x in left.values()) / (len(p) - 2)) ** 0.5
        for m, x in left.items():
            assert abs(got[m, y]["residual"] - x) < 1e-8 and abs(got[m, y]["deviations"] - x / spread) < 1e-8 and got[m, y]["outlier"] == (abs(x / spread) > 2)
        assert got[7, y]["outlier"]
    assert all(p["deviations"] is None and not p["outlier"] for (_, y), p in got.items() if y > 2001)


def test_coverage_and_spans(spark):
    countries = spark.createDataFrame([(m * 10000 + y, y, m) for m in (1, 2) for y in (2000, 2001, 2002, 2003, 2005) if (m, y) != (2, 2002)] + [(5, 2000, None)], "country_id long, year int, master_id long")
    mappings = spark.createDataFrame([("Area", "Area", 0), ("Size", "Area", None), ("Junk", "Junk", 1)], "original string, canonical string, is_noise int")
    has = [(1, 2000, "Area", "x"), (1, 2000, "Size", "x"), (1, 2001, "Size", "x"), (1, 2002, "Area", " "), (1, 2003, "Area", None), (1, 2005, "Area", "x"), (2, 2001, "Area", "x"), (2, 2003, "Area", "x"), (2, 2005, "Area", "x"), (1, 2002, "Junk", "x")]
    fields = spark.createDataFrame([(m * 10000 + y, n, c) for m, y, n, c in has], "country_id long, field_name string, content string")
    held = I.held(fields, countries, mappings)
    assert sorted(map(tuple, I.coverage(held, countries).collect())) == [("Area", 2000, 1, 0.5), ("Area", 2001, 2, 1.0), ("Area", 2002, 0, 0.0), ("Area", 2003, 1, 0.5), ("Area", 2005, 2, 1.0)]
    # Entity 2 has no edition of 2002, so that isn't a gap of its field.
    assert sorted(map(tuple, I.spans(held, countries).collect())) == [(1, "Area", 2000, 2005, 3, 2, 2), (2, "Area", 2001, 2005, 3, 0, 3)]
    none = I.held(fields.limit(0), countries, mappings)
    assert I.coverage(none, countries).count() == 0 and I.spans(none, countries).count() == 0


def test_rolled_up(spark):
    rows = [(1, 2000, "a", 10.0), (1, 2004, "a", 20.0), (2, 2001, "a", 1.0), (3, 2000, "a", 500.0), (4, 2000, "a", 70.0), (5, 2001, "a", 3.0)]
    regions = spark.createDataFrame([(1, "N"), (2, "N"), (3, "N"), (4, None), (5, "S")], "master_id long, region string")
    names = spark.createDataFrame([(1, "A"), (2, "B"), (3, "World"), (4, "D"), (5, "E")], "master_id long, name string")
    got = {(r["region"], r["year"]): (r["entities"], r["carried"], r["total"]) for r in I.rolled_up(frame(spark, rows), regions, names, 2004).collect()}
    want = {("N", 2000): (1, 0, 10.0), ("N", 2001): (2, 1, 11.0), ("N", 2002): (2, 2, 11.0), ("N", 2003): (1, 1, 1.0), ("N", 2004): (1, 0, 20.0)}
    assert got == {**want, ("S", 2001): (1, 0, 3.0), ("S", 2002): (1, 1, 3.0), ("S", 2003): (1, 1, 3.0)}
    assert {(r["region"], r["year"]) for r in I.rolled_up(frame(spark, rows), regions, names, 2001, carry=0).collect()} == {("N", 2000), ("N", 2001), ("N", 2004), ("S", 2001)}
