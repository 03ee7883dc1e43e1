"""A training corpus from documents: toxic documents go, then recurring lines, near copies and leaked test items; the
rest is packed into sequences.

Every stage but the last returns the columns of documents; each is written as Parquet in the shared folder and read again
as the input of the next, so a lost executor costs at most the stage at hand.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from yearloom.llm import decontamination, line_dedup, near_dedup, packing, toxicity
from yearloom.llm.common import checkpoint, drop_folder, fresh, shared_folder, table
from yearloom.llm.queries import tokenizer_path, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of labels scores below one half; null and empty texts stay."""
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir))
    return scored.where("toxic_score < 0.5").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of recurring templates; n_chars follows the text, and is null for a null one."""
    cleaned = line_dedup.dedup(docs).select(*docs.columns)
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of least doc_id, and of rows equal in doc_id and text one.  Rows with a
    null doc_id, which nothing tells apart, stay."""
    kept = checkpoint(near_dedup.classes(docs).where("kept").select("doc_id").distinct())
    left = docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    # Repeated ids are few; their rows, and no others, are put in order.
    often = checkpoint(left.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    once = left.join(often, "doc_id", "left_anti").select(*docs.columns)
    place = fresh(docs, "_place")
    first = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy(*docs.columns))
    again = left.join(often, "doc_id", "left_semi").withColumn(place, first).where(F.col(place) == 1).select(*docs.columns)
    return once.unionByName(again).unionByName(docs.where("doc_id IS NULL"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of benchmark occurs; null and empty texts stay."""
    found = decontamination.find(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a null or empty text is one id."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: No stage has a SQL form; tests/llm/test_pipeline.py holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what a stage wrote goes once the next one has been written."""
    docs = table(spark, sf_dir, "documents")
    folder, before = f"{shared_folder(spark)}/corpus-{uuid4().hex}", None
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if before:
            drop_folder(spark, before)
        before = f"{folder}/{k}"
    return docs
