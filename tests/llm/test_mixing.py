"""The mix: targets against water filling, totals near targets, limits, reruns."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from harvestry.llm import mixing
from harvestry.session import store

SCHEMA = "doc_id long, text string, source string, rank int, size string"


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share the total by weight, cut at ``most`` times the size, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] * (None in sizes)
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weigh[s] / sum(weigh[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: most * sizes[s] for s in over}


def documents(spark):
    rows, n = [], 0
    for source, count, words in (("b", 40, 30), ("a", 300, 50), (None, 20, 200), ("é", 1, 3),
                                 ("Z", 2, 5000), ("c", 5, 0), ("d", 60, 11)):
        for i in range(count):
            text = None if words == 0 and i else " ".join(["w"] * (words + i % 7 if words else 0))
            rows.append((n, text, source, 1, "x"))
            n += 1
    return spark.createDataFrame([*rows, rows[0], (None, "one two", "b", 1, "y")], SCHEMA)


def test_targets_and_taken(spark):
    docs = documents(spark)
    rows = mixing.taken(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = plain_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(0.01 * target, 3), source
    again = mixing.taken(docs.repartition(7)).collect()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(str, ([r[k] for k in key] for r in again))) == sorted(
        map(str, ([r[k] for k in key] for r in rows)))


def test_no_rows_and_no_words(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.taken(none).collect() == []
    blank = spark.createDataFrame([(1, " ", "a", 1, "x"), (2, None, None, 1, "x")], SCHEMA)
    assert [(r["size"], r["taken"]) for r in mixing.taken(blank).collect()] == [(0, 0)] * 2
    assert mixing.mixed(blank).collect() == []


def test_van_der_corput(spark):
    got = [r[0] for r in spark.range(8).select(mixing.van_der_corput(F.col("id"))).collect()]
    assert got == [0, 0.5, 0.25, 0.75, 0.125, 0.625, 0.375, 0.875]


def test_schedule_follows_the_weights_everywhere(spark):
    """Any stretch of the schedule holds each source in its share, but for a few slots."""
    rows = store(mixing.sized(documents(spark), mixing.word_count()), "t")
    sources = store(mixing.targets(rows), "t")
    slots = sorted((r["slot"], r["place"]) for r in mixing.schedule(spark, sources).collect())
    places = [p for _, p in slots]
    for place in set(places):
        share = places.count(place) / len(places)
        for part in range(1, 8):
            stretch = places[:len(places) * part // 8]
            assert abs(stretch.count(place) - share * len(stretch)) <= 14


def test_mixed_documents_are_what_is_taken(spark):
    docs = documents(spark).withColumn("n_chars", F.length("text").cast("long"))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    words = defaultdict(int)
    for r in out.withColumn("words", mixing.word_count()).collect():
        words[r["doc_id"]] += r["words"]
        assert r["n_chars"] == len(r["text"]) and r["words"]
    taken = defaultdict(int)
    for r in mixing.taken(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    assert {k: v for k, v in taken.items() if v} == dict(words)


@pytest.mark.parametrize("size, want", [(1, 1), (1023, 1), (2048, 2), (10 ** 9, 1024)])
def test_block_size(spark, size, want):
    assert spark.range(1).select(mixing.block_size(F.lit(size))).first()[0] == want
