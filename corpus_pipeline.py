"""A training-data pipeline of five stages over ``documents``.

Each stage works on all that its predecessor kept. All but the last return the
columns of documents, and other columns too, whatever their names.

Null texts count as empty, null ids and sources are values like others, an empty table
gives an empty table, and texts of any length are taken whole. What else holds for odd
rows is said at each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpgraph.llm import bpe, exact_dedup, mixing, near_dedup, quality_model
from corpgraph.llm.work import WorkArea


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good and not toxic, fitted on the graded ones among them.

    Without two different grades all stay. Each row is judged on its own: repeated rows alike, rows of one id by their texts.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.keep_good(docs, quality_model.fit(docs, quality_model.graded(labels)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts: that with the smallest doc_id.

    A row without an id goes if an equal text has one; rows that repeat id and text of the kept one stay.
    """
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: five words, similarity 0.8; that with the smallest doc_id.

    Texts without words and rows without an id stay. Rows of one id are one document, which stays or goes as a whole.
    """
    return near_dedup.keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it; those without words go.

    Rows that repeat id, source and text are taken equally often.
    """
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document of the mix, one row for each time that it is taken."""
    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), full=False)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("bpe", encode)]
#: SQL can express neither the classifier nor BPE; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs, area = spark.read.parquet(f"{sf_dir}/documents.parquet"), WorkArea(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = area.save(docs, name.replace(" ", "-"))
    return docs
