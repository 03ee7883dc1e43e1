"""Texts made from keys are dealt to tasks by their number, not by the bytes of their keys."""

from yearloom.plans import made


def test_texts_are_dealt(spark, tmp_path, monkeypatch):
    spark.range(900).selectExpr("id AS c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(made, "ROWS_A_TASK", 100)
    out = made.texts(spark, str(tmp_path), "{k} and {a}")
    sizes = out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == 10 and max(sizes) < 200 and sum(sizes) == 900
    assert {(r["k"], r["text"]) for r in out.collect()} == {(k, f"{k} and {k % 900 + 100}") for k in range(900)}
