"""Exact top-k next to brute force; recall of the graph search; edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestry.llm import hnsw, topk
from harvestry.session import store

SCHEMA = "vec_id long, embedding array<float>, score string, row int"
NAN, INF = float("nan"), float("inf")


def usable(rows):
    return [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def vectors(seed=1, n=400, dims=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * rng.exponential(1, (n, 1))
    x[50:90] = x[49]
    x[100] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1100, [NAN] * dims), (1200, [None] + [1.0] * (dims - 1)),
             (1300, [INF] * dims), (1400, [1.0] * 3), (1500, [2.0, 0.0, 1.0])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("shard_rows, query_rows", [(4096, 2048), (37, 3)])
def test_top_k_equals_brute_force(spark, shard_rows, query_rows):
    rows = vectors()
    held = store(frame(spark, rows).where(topk.is_finite("embedding")).select(
        F.monotonically_increasing_id().alias("row"), "vec_id",
        topk.quantised("embedding").alias("vector")), "t")
    found = topk.top_k(held, held.where("vec_id % 50 = 0"), 10, shard_rows, query_rows)
    got = sorted(tuple(r) for r in found.collect())
    whole = [(i, np.floor(1024 * v).astype(np.int64)) for i, v in usable(rows)]
    want = []
    for q, x in whole:
        if q % 50 == 0:
            near = sorted((-int(x @ y), i) for i, y in whole if i != q and len(x) == len(y))
            want += [(q, place + 1, i, -s) for place, (s, i) in enumerate(near[:10])]
    assert got == sorted(want)


def test_strips_prune_without_loss():
    rng = np.random.default_rng(6)
    x = np.floor(1024 * rng.normal(size=(900, 24)) * rng.exponential(1, (900, 1))).astype(int)
    ids = rng.permutation(900)
    owner, where, score = topk.shard_top_k(x, ids, np.arange(900), x[:40], np.arange(40), 7, 64)
    for q in range(40):
        near = sorted((-int(x[q] @ x[j]), ids[j]) for j in range(900) if j != q)[:7]
        own = owner == q
        assert list(zip((-score[own]).tolist(), ids[where[own]], strict=True)) == near


def test_repeated_rows_and_few_candidates(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [3.0, 0.0])]
    found = sorted(topk.search(frame(spark, rows)).collect(), key=repr)
    assert len(found) == 6 and all(r["query_id"] == 0 for r in found)
    assert topk.search(frame(spark, rows).limit(0)).collect() == []
    alone = topk.search(frame(spark, [(100, [1.0])]))
    assert alone.collect() == []


def test_top_k_of_shards_that_meet_in_separate_tasks(spark):
    """Vectors and queries of a shard meet whatever the number of partitions they are dealt to,
    and also where only the rows are counted."""
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "11")
    rows = [(i, v) for i, v in vectors(4) if v is not None and len(v) == 16]
    held = store(session.createDataFrame(rows, "vec_id long, embedding array<float>").where(
        topk.is_finite("embedding")).select(F.monotonically_increasing_id().alias("row"), "vec_id",
                                            topk.quantised("embedding").alias("vector")), "t")
    found = topk.top_k(held, held.where("vec_id % 50 = 0"), 10, 37, 3)
    whole = [(i, np.floor(1024 * v).astype(np.int64)) for i, v in usable(rows)]
    want = []
    for q, x in whole:
        if q % 50 == 0:
            near = sorted((-int(x @ y), i) for i, y in whole if i != q)
            want += [(q, place + 1, i, -s) for place, (s, i) in enumerate(near[:10])]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
    assert found.count() == len(want)


def test_empty_vectors_take_part(spark):
    found = topk.search(frame(spark, [(0, []), (3, []), (2, []), (100, [1.0]), (4, None)]))
    assert sorted(tuple(r) for r in found.collect()) == [(0, 1, 2, 0), (0, 2, 3, 0)]


def test_graph_search(spark):
    rng = np.random.default_rng(2)
    rows = vectors(3) + [(2000 + i, v.tolist()) for i, v in enumerate(
        rng.normal(size=(1500, 16)))] + [(4000 + i, [5.0] * 16) for i in range(300)]
    found = {}
    for r in hnsw.search(frame(spark, rows)).collect():
        found.setdefault(r["query_id"], []).append(r)
    whole = [(i, v) for i, v in usable(rows) if v.any()]
    ids = np.array([i for i, _ in whole])
    hits = total = 0
    for q, x in whole:
        if q % 50:
            continue
        mates = [(hnsw.cosine_of(x, y), i) for i, y in whole if i != q and len(y) == len(x)]
        best = sorted(mates, key=lambda m: (-m[0], m[1]))[:5]
        rows_of = sorted(found.get(q, []), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows_of] == list(range(1, len(best) + 1))
        exact = {i: s for s, i in mates}
        assert all(r["score"] == exact[r["vec_id"]] for r in rows_of)
        order = [(-r["score"], r["vec_id"]) for r in rows_of]
        assert order == sorted(order) and len(set(order)) == len(order)
        hits += len({i for _, i in best} & {r["vec_id"] for r in rows_of})
        total += len(best)
    assert set(found) <= set(ids[ids % 50 == 0].tolist())
    assert hits >= 0.95 * total, (hits, total)


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    x = hnsw.unit(np.array([v for _, v in rows]))
    found = {(r["query_id"], r["vec_id"]) for r in hnsw.search(table).collect()}
    hits = total = 0
    for q, (name, _) in enumerate(rows):
        if name % 50 == 0:
            near = x @ x[q]
            near[q] = -2
            hits += sum((name, rows[j][0]) in found for j in np.argsort(-near)[:5])
            total += 5
    assert hits >= 0.9 * total


def test_graph_image_round_trip():
    x = hnsw.unit(np.random.default_rng(1).normal(size=(600, 8))).astype(np.float32)
    graph = hnsw.Graph.build(x)
    again = hnsw.Graph.open(graph.pack())
    for q in x[:50]:
        assert graph.nearest(q, 5).tolist() == again.nearest(q, 5).tolist()
    assert hnsw.Graph.build(x[:1]).nearest(x[0], 5).tolist() == [0]


def test_no_vectors(spark):
    assert hnsw.search(frame(spark, []).limit(0)).collect() == []
    assert hnsw.search(frame(spark, [(50, [0.0, 0.0]), (100, None)])).collect() == []
    both = hnsw.search(frame(spark, [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (51, [2.0, 0.0])]))
    assert [tuple(r) for r in both.collect()] == [(50, 1, 50, 1.0), (50, 2, 51, 1.0)] * 2


def test_every_row_but_the_query_is_a_candidate(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.9, 0.1]), (None, [1.0, 0.01]), (51, [0.0, 1.0]),
            (None, [1.0, 0.01])]
    at = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows]
    want = []
    for q in (0, 1):
        near = sorted((-hnsw.cosine_of(at[q][1], y), -1 if i is None else i)
                      for place, (i, y) in enumerate(at) if place != q)
        want.append([(50, rank, None if i < 0 else i, -s)
                     for rank, (s, i) in enumerate(near, 1)])
    got = [tuple(r) for r in hnsw.search(frame(spark, rows)).collect()]
    lists = [got[at:at + 4] for at in range(0, len(got), 4)]
    assert len(got) == 8 and sorted(lists, key=repr) == sorted(want, key=repr)


def test_recall_over_several_full_shards(spark):
    """Three shards of over 8,000 nodes, in dense clusters of near-equal vectors."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(60, 16))
    x = centres[rng.integers(0, 60, 24_500)] + 0.05 * rng.normal(size=(24_500, 16))
    held = spark.createDataFrame(
        [(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = {(r["query_id"], r["vec_id"]) for r in hnsw.search(held, every=350).collect()}
    y, hits, total = hnsw.unit(x), 0, 0
    for q in range(0, len(y), 350):
        near = y @ y[q]
        near[q] = -2
        hits += sum((q, int(j)) in found for j in np.argsort(-near)[:5])
        total += 5
    print("recall", hits / total)
    assert hits >= 0.9 * total


def test_large_components_are_exact_or_an_error(spark):
    rows = [(0, [20000.0, 1.0]), (1, [20000.0, 0.0]), (2, [30000.0, 0.0]), (3, [-2.0 ** 20, 1.0]),
            (100, [2.0 ** 21, -(2.0 ** 21)]), (101, [2.0 ** 21 + 1, 2.0 ** 21])]
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for q, x in whole:
        if q % 100 == 0:
            near = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i)
                          for i, y in whole if i != q)
            want += [(q, place + 1, i, -s) for place, (s, i) in enumerate(near)]
    assert sorted(tuple(r) for r in topk.search(frame(spark, rows)).collect()) == sorted(want)
    # Terms that pass a long cancel out.
    x = np.array([[1 << 40, 1 << 40], [1 << 40, -(1 << 40)], [1 << 40, 5 - (1 << 40)]])
    owner, where, score = topk.shard_top_k(x, np.arange(3), np.arange(3), x[:1], np.arange(1), 2)
    assert where.tolist() == [2, 1] and score.tolist() == [5 << 40, 0]
    with pytest.raises(OverflowError):
        topk.shard_top_k(x, np.arange(3), np.arange(3), x[:1] << 1, np.array([9]), 2)
    with pytest.raises(Exception, match="too large"):
        topk.search(frame(spark, [(0, [3e38]), (1, [1.0])])).collect()
