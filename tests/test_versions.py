"""Changes to a stored table: what is touched, what stays, and who goes on reading."""

import pytest
from pyspark.sql import functions as F

from yearloom.sources.versions import Conflict, Versioned

SCHEMA = "id long, year int, name string"
ROWS = [(i, 1990 + i % 5, f"n{i % 7}") for i in range(100)] + [(200, None, None)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    return Versioned.create(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path / "t"))


def parts(files, *years):
    return {f for f in files if any(f"/year={y}/" in f for y in years)}


def test_delete_replace_and_update(spark, table):
    assert rows(table.read()) == sorted(ROWS, key=repr)
    first = table.files()
    old = table.read()
    table.delete([1991, 1977])
    assert table.files() == first - parts(first, 1991)
    table.replace(spark.createDataFrame([(1000, 1992, "new"), (1001, 2001, "year")], SCHEMA))
    second = table.files()
    assert first - second == parts(first, 1991, 1992) and len(second - first) == 2
    table.update((F.col("name") == "n3") & (F.col("year") == 1990), {"name": F.lit("three"), "id": F.col("id") + 5000})
    third = table.files()
    assert second - third == parts(second, 1990) and third - second == parts(third, 1990)
    want = [r for r in ROWS if r[1] not in (1991, 1992)] + [(1000, 1992, "new"), (1001, 2001, "year")]
    want = [(i + 5000, y, "three") if n == "n3" and y == 1990 else (i, y, n) for i, y, n in want]
    assert rows(table.read()) == sorted(want, key=repr)
    # A reader of the first version, and one that began then, see what was there.
    assert rows(table.read(0)) == rows(old) == sorted(ROWS, key=repr)
    assert table.versions() == [0, 1, 2, 3]
    assert table.update(F.col("name") == "nobody", {"name": F.lit("x")}) == 3 and table.files() == third
    table.clear()
    assert table.versions() == [3] and rows(table.read()) == sorted(want, key=repr) and table.files() == third


def test_a_year_is_pruned(table):
    df = table.read().where("year = 1993")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and df.count() == 20
    assert len(df.select("_metadata.file_path").distinct().collect()) == len(parts(table.files(), 1993))
    assert table.read().where("year IS NULL").count() == 1 and table.delete([None]) and table.read().where("year IS NULL").count() == 0


def test_failed_and_late_changes(spark, table):
    before = rows(table.read())
    broken = spark.createDataFrame(ROWS, SCHEMA).selectExpr("id", "year", "CASE WHEN id = 42 THEN raise_error('lost') ELSE name END AS name")
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert table.versions() == [0] and rows(table.read()) == before
    told = table.manifest()
    table.delete([1990])
    with pytest.raises(Conflict):
        table._commit(told | {"parts": {}}, told["version"])
    assert table.versions() == [0, 1] and table.read().count() == 81
    with pytest.raises(ValueError):
        table.update(F.col("id") == 1, {"year": F.lit(1)})
    with pytest.raises(Conflict):
        Versioned.create(spark.createDataFrame(ROWS, SCHEMA), table.folder)
    table.clear()
    assert table.read().count() == 81


def test_empty(spark, tmp_path):
    table = Versioned.create(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"))
    assert table.read().count() == 0 and table.read().columns == ["id", "year", "name"]
    table.replace(spark.createDataFrame(ROWS, SCHEMA))
    assert rows(table.read()) == sorted(ROWS, key=repr)
    table.delete([1990, 1991, 1992, 1993, 1994, None])
    assert table.read().count() == 0
