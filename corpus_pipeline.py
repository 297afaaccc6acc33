"""A corpus pipeline of five operators; each stage works on all that the one before it kept.

What all stages share: a null text is empty; rows may repeat, and have no id;
an empty table gives an empty one; other columns, whatever their names, stay as
they are. Decisions are on rows, known by their id and the hash of their text,
so a row that shares its id with a removed one of another text stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import lines, minhash, nbsvm, packing, phrases
from tessera.llm._labels import remainder
from tessera.llm._work import Workspace, fresh

#: Removed rows up to so many (of two numbers) are sent to every task; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def _without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` but for the rows with a removed doc_id and text_key, null ids among them."""
    doc, key = fresh(docs, "removed_doc", "removed_key")
    gone = removed.select(F.col("doc_id").alias(doc), F.col("text_key").alias(key)).distinct()
    gone = Workspace(docs.sparkSession, "removed").keep(gone, "rows")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(key)), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; null and empty texts are scored like any other, equal texts alike."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return nbsvm.accepted(docs, nbsvm.train(docs, labels, "quality", remainder("doc_id", 3) != 1))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines, short ones too, that an earlier line nearly equals; n_chars follows the text.

    Rows without an id come last and lose their lines to all others; rows that
    repeat an id and a text are one document, which keeps its first occurrence
    of a line in each row.
    """
    cleaned = lines.drop_lines(docs, lines.duplicate_lines(docs, threshold=0.8, shingle_words=5))
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id; texts without words stay, rows without an id go if the group has one with."""
    return _without(docs, minhash.near_duplicates(docs, threshold=0.8, shingle_words=5).filter(~F.col("kept"))).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in benchmark windows; texts without words stay, rows without an id are judged too."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, phrases.contamination(docs, items, window=13, share=20).filter("contaminated")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 1024; an empty text is one piece of its end id, each of repeated rows has its own pieces."""
    return packing.pack_documents(docs, capacity=1024, end_id=2)


STAGES = [("quality classifier", quality), ("line dedup", line_dedup), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontaminate), ("best-fit packing", pack)]
#: Tokenizers and a trained classifier can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each one's result is written and read again by the next."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = work.keep(docs, f"stage-{i}")
    return docs
