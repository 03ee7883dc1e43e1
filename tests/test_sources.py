"""Readers and sinks: round trips and odd files."""

import gzip
import json
import random
import zipfile
from collections import Counter

import pytest

from pyspark.sql import functions as F

from yearloom.sources import readers, sinks
from yearloom.sources.archive import Archive


def test_whole_texts(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/1990.txt").write_bytes("Country:  Å\n\nend".encode())
    (tmp_path / "1991.txt").write_bytes(b"broken \xff byte")
    got = {r["path"].rsplit("/", 1)[1]: r["text"] for r in readers.whole_texts(spark, str(tmp_path)).collect()}
    assert got == {"1990.txt": "Country:  Å\n\nend", "1991.txt": "broken � byte"}


def test_zipped_pages(spark, tmp_path):
    for year in (2001, 2002):
        with zipfile.ZipFile(tmp_path / f"{year}.zip", "w") as z:
            for name in ("x/geos/aa.html", "y/geos/aa.html", "x/geos/BB.html", "x/geos/index.html", "x/geos/template.html", "x/fields/cc.html", "x/geos/toolong.html", "x/geos/dd.txt"):
                z.writestr(name, f"{year} {name}")
    (tmp_path / "bad.zip").write_bytes(b"not an archive")
    got = sorted((r["path"][-8:-4], r["code"], r["html"]) for r in readers.zipped_pages(spark, str(tmp_path)).collect())
    assert got == [(str(y), c, f"{y} x/geos/{c if c == 'aa' else 'BB'}.html") for y in (2001, 2002) for c in ("aa", "bb")]


def test_object_tree(spark, tmp_path):
    (tmp_path / "africa").mkdir()
    one = {"name": "Land", "code": "AA", "categories": [{"title": "Geography", "fields": [{"name": "Area", "content": "5 <b>km</b>"}, {"name": "Coast", "value": "9"}]}]}
    (tmp_path / "africa/aa.json").write_text(json.dumps(one, indent=1))
    (tmp_path / "bb.json").write_text("{not json")
    got = {r["path"].rsplit("/", 1)[1]: r for r in readers.object_tree(spark, str(tmp_path)).collect()}
    assert got["aa.json"]["categories"][0]["fields"][1]["value"] == "9" and got["bb.json"]["name"] is None
    from yearloom.operators.layouts import json_rows

    rows = json_rows(readers.object_tree(spark, str(tmp_path)).where("code IS NOT NULL")).orderBy("place").collect()
    assert [(r["field"], r["content"]) for r in rows] == [("Area", "5 km"), ("Coast", "9")]


def test_lookup(spark, tmp_path):
    (tmp_path / "iso.csv").write_text('ISOAlpha2,ISONumeric,Name\nAD,020,"Andorra, ""la"" Vella"\nXX,,\n')
    got = [tuple(r) for r in readers.lookup(spark, str(tmp_path), "iso2 string, number string, name string").collect()]
    assert got == [("AD", "020", 'Andorra, "la" Vella'), ("XX", None, None)]


def test_archive_is_written_by_year(spark, sf_dir, tmp_path):
    star = Archive.from_star(spark, sf_dir)
    sinks.write_archive(star, str(tmp_path))
    back = Archive.from_parquet(spark, str(tmp_path))
    for name in Archive.TABLES:
        old, new = getattr(star, name), getattr(back, name)
        assert Counter(map(tuple, old.collect())) == Counter(map(tuple, new.select(*old.columns).collect())), name
    plan = back.fields.where("year = 1997")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert back.fields.where("year = 1997").count() == star.fields.join(star.countries.where("year = 1997"), "country_id").count()


def dumped_rows(spark, path):
    return Counter((r["table"], *r["values"]) for r in readers.dumped(spark, str(path)).collect())


def test_dump_round_trip(spark, tmp_path):
    rows = [(i, 1990 + i % 3, ["O'Brien, (x)", None, "", "NULL", "a, b"][i % 5], i % 2 == 0, None if i % 7 == 0 else i / 4) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, year int, name string, flag boolean, size double")
    sinks.sql_dump(df, "CountryFields", "id", str(tmp_path / "dump"), rows_per_file=1000)
    assert {p.name for p in (tmp_path / "dump").glob("year=*")} == {"year=1990", "year=1991", "year=1992"}
    files = sorted((tmp_path / "dump/year=1990").glob("*.gz"))
    text = "".join(gzip.open(f, "rt").read() for f in files)
    assert len(files) > 1 and "INSERT INTO CountryFields (id, name, flag, size) VALUES" in text and "N'O''Brien, (x)'" in text
    assert [int(x.split(",")[0][1:]) for x in text.split("\n") if x.startswith("(")] == [i for i in range(4000) if i % 3 == 0]
    assert max(x.count("\n(") for x in text.split("INSERT")) <= sinks.BATCH
    want = Counter(("CountryFields", str(i), name, str(int(flag)), None if size is None else str(size)) for i, _, name, flag, size in rows)
    assert dumped_rows(spark, tmp_path / "dump") == want


BITS = ["\n", "'", "''", "(", "\n(4, fake)", "\nINSERT INTO Other (a) VALUES\n", "x" * 40, ", ", ");", "\r\n", "é", " ", "--", "N'"]


def odd_values(n, seed):
    r = random.Random(seed)
    return [(i, 1990 + i % 2, "".join(r.choice(BITS) for _ in range(r.randrange(9)))) for i in range(n)]


@pytest.mark.parametrize("split", [64, 257, 4096, 1 << 27])
def test_dumps_cut_into_splits(spark, tmp_path, split):
    """A plain file of two tables, whatever the size of its splits."""
    rows = odd_values(300, 4) + [(1000, 1990, "one\nline"), (1001, 1990, "x\n(4, fake"), (1002, 1990, "\n" * 500), (1003, 1990, "it's '" * 300)]
    said = lambda x: "N'" + x.replace("'", "''") + "'"
    half = len(rows) // 2
    text = "-- a dump\n" + "".join(
        f"INSERT INTO {name} (id, name) VALUES\n" + ",\n".join(f"({i}, {said(x)})" for i, _, x in part) + ";\nGO\n" for name, part in (("A", rows[:half]), ("B", rows[half:]))
    )
    (tmp_path / "dump.sql").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        plan = readers.dumped(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() >= min(len(text) // split, 50)
        got = Counter((r["table"], *r["values"]) for r in plan.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == Counter((name, str(i), x) for name, part in (("A", rows[:half]), ("B", rows[half:])) for i, _, x in part)


def test_dumps_of_odd_values_and_files(spark, tmp_path):
    rows = odd_values(200, 5) + [(500, 1990, "long 'quoted'\n" * 5000), (501, 1991, None)]
    df = spark.createDataFrame(rows, "id long, year int, name string")
    sinks.sql_dump(df, "T", "id", str(tmp_path / "a"), rows_per_file=50)
    assert dumped_rows(spark, tmp_path / "a") == Counter(("T", str(i), x) for i, _, x in rows)
    (tmp_path / "b").mkdir()
    (tmp_path / "b/empty.sql").write_text("")
    (tmp_path / "b/comment.sql").write_text("-- nothing\n\nGO\n")
    (tmp_path / "b/one.sql").write_text("INSERT INTO U (a) VALUES\n(1, NULL, N'');")
    assert dumped_rows(spark, tmp_path / "b") == Counter([("U", "1", None, "")])
    sinks.sql_dump(df.limit(0), "T", "id", str(tmp_path / "c"))


def test_archive_comes_back_from_its_dumps(spark, sf_dir, tmp_path):
    star = Archive.from_star(spark, sf_dir)
    fields = star.fields.join(star.countries.select("country_id", "year"), "country_id")
    sinks.sql_dump(fields.select("field_id", "country_id", "field_name", "content", "year"), "CountryFields", "field_id", str(tmp_path / "d"))
    back = readers.dumped(spark, str(tmp_path / "d")).select(F.get("values", F.lit(0)).cast("long").alias("field_id"), F.get("values", F.lit(1)).cast("int").alias("country_id"), F.get("values", F.lit(2)).alias("field_name"), F.get("values", F.lit(3)).alias("content"))
    want = fields.select("field_id", "country_id", "field_name", "content")
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, want.collect()))


def test_browse_feed(spark):
    entities = spark.createDataFrame([("b", 2), ("a", None)], "name string, n int")
    years = spark.createDataFrame([(1991, 4), (1990, 5)], "year int, countries int")
    feed = json.loads(sinks.browse_feed(entities, years).first()["feed"])
    assert feed == {"entities": [{"name": "a"}, {"name": "b", "n": 2}], "years": [{"year": 1990, "countries": 5}, {"year": 1991, "countries": 4}]}
