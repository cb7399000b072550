"""The quality ranking: held-out accuracy on the tables, and edge cases."""

import zlib

import numpy as np

from harvestry.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    found = {r["doc_id"]: r for r in quality.scored(docs, model).withColumn(
        "held", quality.is_held_out()).collect()}
    assert len(found) == docs.count()
    held = [r for r in labels.collect() if found[r["doc_id"]]["held"]]
    assert len(held) > 50
    for r in held:
        assert zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
    right = np.mean([found[r["doc_id"]]["predicted"] == r["quality"] for r in held])
    assert right > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
               for r in found.values())


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality")
    first, second = quality.train(docs, labels), quality.train(docs, turned)
    assert np.array_equal(first.weights, second.weights)
    assert first.threshold == second.threshold


def test_nulls_repeats_and_clashing_names(spark):
    docs = spark.createDataFrame(
        [(1, None, 9.0, "a"), (1, "", 9.0, "b"), (None, "Some words. Here.", 9.0, None),
         (4, "x" * 200_000, 9.0, "d"), (5, "é ## $$ " * 50, 9.0, "e")],
        "doc_id long, text string, score double, quality string")
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (5, None)],
                                   "doc_id long, quality int")
    model = quality.train(docs, labels)
    out = quality.scored(docs, model)
    assert out.columns == ["doc_id", "text", "quality", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == 5 and rows[0]["score"] == rows[1]["score"]
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, none)
    assert [r["score"] for r in quality.scored(docs, model).collect()] == [0.5]
    assert quality.scored(docs.limit(0), model).collect() == []
    assert [r[0] for r in quality.keep_good(docs, none).collect()] == [1]
