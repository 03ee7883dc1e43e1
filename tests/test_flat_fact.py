"""The flat export against its SQL form's preview."""

from __spark_entry__ import queries


def test_flat_export_is_whole(spark):
    named, sf_dir = queries(), "/root/testdata/sf0.1"
    full = named["bi_flat_fact_full"](spark, sf_dir).cache()
    preview = named["bi_flat_fact"](spark, sf_dir)
    assert full.count() > 10000 and preview.count() == 10000
    assert preview.exceptAll(full).isEmpty()
    full.unpersist()
