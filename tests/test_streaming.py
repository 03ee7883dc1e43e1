"""Streams against the same work in one batch."""

from collections import Counter

from pyspark.sql import functions as F

from yearloom.streaming import ingest

SCHEMA = "year int, field_id long, canonical string, content string"


def test_editions_replace_themselves(spark, tmp_path):
    def edition(year, first, n, name):
        rows = [(year, first + i, "Area", f"total: {i + 1},000 sq km") for i in range(n)] + [(year, first + n, "Other", None), (year, first + n + 1, "Other", "size: 5 km")]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = ingest.ingest(ingest.files(spark, str(tmp_path / "in"), SCHEMA), str(tmp_path / "out"), str(tmp_path / "marks"), ["Area"])
        query.awaitTermination(120)
        assert query.exception() is None, name

    edition(1990, 0, 20, "first")
    edition(1991, 100, 10, "second")
    edition(1990, 200, 5, "reload")
    got = Counter((r["year"], r["sub_field"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == {(1990, "total"): 5, (1990, "size"): 1, (1991, "total"): 10, (1991, "size"): 1}


def test_windows(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    time, kind = next(c for c, t in events.dtypes if t.startswith("timestamp")), next(c for c, t in events.dtypes if t == "string")
    rows = events.select(F.col(time).cast("timestamp").alias("ts"), F.col(kind).alias("kind"), F.lit(1.5).alias("value"))
    want = Counter(map(tuple, ingest.windowed(rows, "ts", "kind", "value").collect()))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.windowed(ingest.files(spark, str(tmp_path / "in"), rows._jdf.schema().toDDL()), "ts", "kind", "value")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("windows_of_events").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert Counter(map(tuple, spark.table("windows_of_events").collect())) == want and want
