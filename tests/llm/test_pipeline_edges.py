"""The pipeline on the edge cases: labels of every kind, odd rows, clashing names, empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import CLASH, ODD, docs, texts

NAMES = (*CLASH, "place", "bytes", "epoch", "_stays", "_first", "text_key", "doc", "part", "kept")
LABELS = "doc_id long, quality int, toxic int"


def stored(spark, path, table, labels):
    table.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return str(path)


def staged(spark, folder):
    """Rows of every stage but the last, whose columns stay those of the documents."""
    read, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = read.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, read, folder).write.parquet(f"{folder}/{name}")
        read = spark.read.parquet(f"{folder}/{name}")
        found[name] = read.collect()
        assert name == "bpe" or read.columns == columns
    return found


@pytest.mark.parametrize("kind", ["none", "toxic", "clean", "balanced"])
def test_labels_without_evidence_drop_nothing(spark, tmp_path, kind):
    made = texts(21, 40, 40, 3000)
    table = docs(spark, list(enumerate(made)))
    labels = {
        "none": [],
        "toxic": [(k, 1, 1) for k in range(40)],
        "clean": [(k, 1, 0) for k in range(40)],
        # Every text has words of its own, so no word tells the two halves apart.
        "balanced": [(k, 1, k % 2) for k in range(40)],
    }[kind]
    folder = stored(spark, tmp_path, table, labels)
    read = spark.read.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.reject_toxic(spark, read, folder).count() == 40


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    rows = [*ODD, *[(20, "a row that is here many times over")] * 30]
    table = docs(spark, rows)
    for name in NAMES:
        table = table.withColumn(name, F.lit("clash"))
    found = staged(spark, stored(spark, tmp_path, table, [(5, 1, 0), (None, 1, 1), (6, None, None)]))
    assert len(found["toxicity"]) == len(rows)
    # One row of each text, and all rows without an id.
    assert sorted(str(r.doc_id) for r in found["near_duplicates"]) == sorted(
        map(str, [1, 3, 4, 5, 7, 9, -10, 20, None, None])
    )
    assert len(found["pii"]) == len(found["near_duplicates"])
    # Sources that end early begin anew: no row is lost, some come again.
    assert {(r.doc_id, r.text) for r in found["mixing"]} == {(r.doc_id, r.text) for r in found["pii"]}
    assert len(found["bpe"]) == len(found["mixing"]) and all(r.round_trip for r in found["bpe"])


def test_empty_tables(spark, tmp_path):
    found = staged(spark, stored(spark, tmp_path, docs(spark, []), []))
    assert all(rows == [] for rows in found.values())
