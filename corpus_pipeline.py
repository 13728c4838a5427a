"""The training-data pipeline: documents to encoded ids in five stages.

Every stage works on all rows that its predecessor kept and is written as Parquet before the next one
reads it. All but the last return the columns of the documents table, further ones of any name included. A
stage takes nulls in any column, empty and very long texts, and repeated rows; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from teletally.llm import bpe, mixing, order_minhash, pii, toxicity
from teletally.llm.common import table
from teletally.llm.queries import tokenizer_path
from teletally.storage import shared_path


# Documents are long, and a Python worker holds a few batches of them.
BATCH_ROWS = "2000"


def small_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches, unless the session has a size of its own."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a model learnt from the labels table.

    Null and empty texts, and any text without evidence, stay; without labels, or with labels of one kind, all do. A
    score of exactly 0.5 goes. Repeated rows stay or go together.
    """
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies: the row of the lowest id.

    Of rows that share that id, the one whose text's digest, then whose values hash lowest. Null and empty texts are copies
    of each other. Rows without an id all stay.
    """
    small_batches(spark)
    return order_minhash.without_near_duplicates(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text. Every row stays; null texts stay null."""
    small_batches(spark)
    return pii.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares, rows in mixed order; small sources begin anew when they end.

    Every row is there at least once; rows without a source are a source of their own, null texts have no bytes.
    """
    return mixing.mixed_rows(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it again: one row per row, null texts have no ids."""
    small_batches(spark)
    return bpe.encode(docs, tokenizer_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

# Only the mixing could be written in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
