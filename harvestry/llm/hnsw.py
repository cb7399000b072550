"""Approximate nearest neighbours by a hierarchical navigable small-world graph per shard.

Equal vectors are one node, which keeps its rows of the smallest ids: a search for k
neighbours never needs more than k + 1 of them. Nodes are dealt into shards by a hash of the
vector; each shard's graph is built by one task and stored as flat arrays: vectors, a
neighbour array of fixed width per layer, and the nodes of the upper layers. Queries run
through every shard's graph and the shards' results are merged by exact cosine.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestry.llm.common import bucket_count
from harvestry.llm.topk import is_finite
from harvestry.session import ship_package, store

SHARD_NODES, QUERY_ROWS = 8192, 1024
#: Neighbours per node (twice as many on the ground layer) and search widths.
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 12, 64, 96


class Graph:
    """Layers of neighbours over unit vectors; -1 fills unused places."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS):
        self.vectors = vectors
        self.links = links
        self.layers = [np.full((len(vectors), 2 * links), -1, np.int32)]
        self.degrees = [np.zeros(len(vectors), np.int32)]
        self.entry, self.top = -1, 0
        self.seen = np.zeros(len(vectors), np.int64)
        self.stamp = 0

    # Upper layers are kept over all nodes while building and cut down when stored.
    def _layer(self, level: int) -> None:
        while len(self.layers) <= level:
            self.layers.append(np.full((len(self.vectors), self.links), -1, np.int32))
            self.degrees.append(np.zeros(len(self.vectors), np.int32))

    def _walk(self, query: np.ndarray, starts: list[tuple[float, int]], level: int, width: int):
        """The ``width`` nearest nodes met, as a heap of (similarity, node)."""
        self.stamp += 1
        layer, degrees, seen = self.layers[level], self.degrees[level], self.seen
        for _, node in starts:
            seen[node] = self.stamp
        ahead = [(-s, node) for s, node in starts]
        heapq.heapify(ahead)
        best = list(starts)
        heapq.heapify(best)
        while ahead:
            near, node = heapq.heappop(ahead)
            if len(best) >= width and -near < best[0][0]:
                break
            around = layer[node, :degrees[node]]
            around = around[seen[around] != self.stamp]
            if not len(around):
                continue
            seen[around] = self.stamp
            close = self.vectors[around] @ query
            if len(best) >= width:
                good = close > best[0][0]
                close, around = close[good], around[good]
            for s, n in zip(close.tolist(), around.tolist(), strict=True):
                if len(best) < width:
                    heapq.heappush(best, (s, n))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, n))
                else:
                    continue
                heapq.heappush(ahead, (-s, n))
        return best

    def _spread(self, near: np.ndarray, similar: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` of ``near`` (nearest first) that lie closer to the node than to one
        another; places left go to the nearest of the others."""
        among = self.vectors[near] @ self.vectors[near].T
        blocked = np.zeros(len(near), bool)
        chosen = []
        for place in range(len(near)):
            if not blocked[place]:
                chosen.append(place)
                if len(chosen) == most:
                    break
                blocked |= among[place] > similar
        if len(chosen) < most:
            rest = np.setdiff1d(np.arange(len(near)), chosen)[:most - len(chosen)]
            chosen = sorted([*chosen, *rest.tolist()])
        return near[chosen]

    def add(self, node: int, level: int) -> None:
        self._layer(level)
        query = self.vectors[node]
        if self.entry < 0:
            self.entry, self.top = node, level
            return
        starts = [(float(self.vectors[self.entry] @ query), self.entry)]
        for layer in range(self.top, level, -1):
            starts = [max(self._walk(query, starts, layer, 1))]
        for layer in range(min(level, self.top), -1, -1):
            starts = self._walk(query, starts, layer, BUILD_WIDTH)
            ordered = sorted(starts, reverse=True)
            near = np.array([n for _, n in ordered])
            similar = np.array([s for s, _ in ordered])
            mine = self._spread(near, similar, self.links)
            table, degrees = self.layers[layer], self.degrees[layer]
            table[node, :len(mine)] = mine
            degrees[node] = len(mine)
            for other in mine.tolist():
                if degrees[other] < table.shape[1]:
                    table[other, degrees[other]] = node
                    degrees[other] += 1
                    continue
                around = np.append(table[other], node)
                close = self.vectors[around] @ self.vectors[other]
                order = np.argsort(-close, kind="stable")
                kept = self._spread(around[order], close[order], table.shape[1])
                table[other] = -1
                table[other, :len(kept)] = kept
                degrees[other] = len(kept)
        if level > self.top:
            self.entry, self.top = node, level

    def nearest(self, query: np.ndarray, k: int, width: int = SEARCH_WIDTH) -> np.ndarray:
        if self.entry < 0:
            return np.zeros(0, np.int64)
        starts = [(float(self.vectors[self.entry] @ query), self.entry)]
        for layer in range(self.top, 0, -1):
            starts = [max(self._walk(query, starts, layer, 1))]
        best = self._walk(query, starts, 0, max(width, k))
        return np.array([n for _, n in heapq.nlargest(k, best)])

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 1) -> Graph:
        graph = cls(vectors)
        levels = np.random.default_rng(seed).exponential(1 / math.log(LINKS), len(vectors))
        for node, level in enumerate(levels.astype(int).tolist()):
            graph.add(node, level)
        return graph

    def pack(self) -> bytes:
        """All arrays as one binary image."""
        out = io.BytesIO()
        upper = {}
        for level, (table, degrees) in enumerate(zip(self.layers, self.degrees, strict=True)):
            nodes = np.flatnonzero(degrees) if level else np.arange(len(degrees))
            upper |= {f"nodes{level}": nodes.astype(np.int32), f"links{level}": table[nodes],
                      f"degrees{level}": degrees[nodes]}
        np.savez(out, vectors=self.vectors, head=np.array(
            [self.entry, self.top, self.links, len(self.layers)]), **upper)
        return out.getvalue()

    @classmethod
    def open(cls, image: bytes) -> Graph:
        held = np.load(io.BytesIO(image))
        entry, top, links, count = held["head"].tolist()
        graph = cls(held["vectors"], links)
        graph.entry, graph.top = entry, top
        for level in range(count):
            graph._layer(level)
            nodes = held[f"nodes{level}"]
            graph.layers[level][nodes] = held[f"links{level}"]
            graph.degrees[level][nodes] = held[f"degrees{level}"]
        return graph


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (by their largest component first: no overflow)."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))


def nodes(usable: DataFrame, k: int) -> DataFrame:
    """A row per distinct vector of ``usable`` (a stored table of ``row``, ``vec_id``,
    ``embedding``): ``node``, ``embedding``, ``rows`` (the k + 1 smallest of its rows as
    ``vec_id``, ``row``; null ids first) and ``dims``. A vector of many rows is cut down per
    salt before it meets in one task."""
    salts = bucket_count(usable.count(), 10_000)

    def smallest(rows):
        return F.slice(F.sort_array(rows), 1, k + 1)

    first = usable.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts))).groupBy(
        "embedding", "salt").agg(
        smallest(F.collect_list(F.struct("vec_id", "row"))).alias("rows"))
    merged = first.groupBy("embedding").agg(
        smallest(F.flatten(F.collect_list("rows"))).alias("rows"))
    return store(merged.select(F.monotonically_increasing_id().alias("node"), "embedding", "rows",
                               F.size("embedding").alias("dims")), "ann_nodes")


INDEX = "dims int, shard long, node array<long>, image binary"


def build_index(distinct: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Graphs of all nodes, one row per shard."""
    ship_package(distinct.sparkSession)
    shards = bucket_count(distinct.count(), shard_nodes)

    def run(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values("node")
        graph = Graph.build(unit(np.stack(held["embedding"].to_numpy())).astype(np.float32))
        return pd.DataFrame({"dims": [key[0]], "shard": [key[1]],
                             "node": [held["node"].to_numpy()], "image": [graph.pack()]})

    # A fixed number of partitions: merged by bytes, as small data are, several graphs would be
    # built one after another in a task.
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)))
    return dealt.repartition(2 * shards, "dims", "shard").groupBy("dims", "shard").applyInPandas(
        run, INDEX)


def search_index(index: DataFrame, queries: DataFrame, distinct: DataFrame, k: int) -> DataFrame:
    """``query`` (a node), ``node``, ``score``: for each query node the k + 1 nearest nodes of
    every shard (itself among them), by exact cosine of the original vectors."""
    ship_package(queries.sparkSession)
    parts = bucket_count(queries.count(), QUERY_ROWS)
    shards = index.select("dims", "shard")
    asked = queries.select(F.col("node").alias("query"), F.col("embedding").alias("wanted"),
                           "dims", F.pmod(F.xxhash64("node"), F.lit(parts)).alias("part"))
    asked = asked.join(shards, "dims").groupBy("dims", "shard", "part").agg(
        F.collect_list("query").alias("queries"), F.collect_list("wanted").alias("wanted"))
    tasks = index.join(asked, ["dims", "shard"]).select("node", "image", "queries", "wanted")
    tasks = tasks.repartition(max(1, shards.count() * parts))  # a graph and a query block each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                held = batch.column(0)[row].values.to_numpy()
                graph = Graph.open(batch.column(1)[row].as_py())
                names = batch.column(2)[row].values.to_numpy()
                wanted = unit(np.array(batch.column(3)[row].as_py())).astype(np.float32)
                found = [held[graph.nearest(q, k + 1)] for q in wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(names, [len(f) for f in found])),
                     pa.array(np.concatenate(found))], names=["query", "node"])

    pairs = tasks.mapInArrow(run, "query long, node long")
    left = queries.select(F.col("node").alias("query"), F.col("embedding").alias("x"))
    right = distinct.select("node", F.col("embedding").alias("y"))

    @F.pandas_udf("double")
    def cosine(x: pd.Series, y: pd.Series) -> pd.Series:
        a, b = (v.map(lambda o: np.asarray(o, np.float64)) for v in (x, y))
        return pd.Series([cosine_of(p, q) for p, q in zip(a, b, strict=True)], dtype="float64")

    return pairs.join(left, "query").join(right, "node").select(
        "query", "node", cosine("x", "y").alias("score"))


def cosine_of(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine in double precision."""
    return float(a @ b / (math.sqrt(a @ a) * math.sqrt(b @ b)))


def search(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found of every row whose
    vec_id is divisible by ``every``, by cosine, ties to the smaller vec_id (null first).

    A query's own row is no candidate, every other one is: rows that repeat its id or vector and
    rows of a null id too, and each row of a repeated id is a query with a list of its own. Zero
    vectors and vectors with null or non-finite components take no part. Fewer candidates are
    all returned (small shards are searched whole); vectors of another dimension are no
    candidates; other columns are not read."""
    usable = store(embeddings.where(is_finite("embedding") & F.exists(
        "embedding", lambda x: x != 0)).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), "embedding"),
        "ann_vectors")
    distinct = nodes(usable, k)
    index = store(build_index(distinct), "ann_index")
    asked = usable.where(F.col("vec_id") % every == 0).select(
        F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), "embedding")
    asked = store(asked.join(distinct.select("embedding", "node"), "embedding").select(
        "query_row", "query_id", F.col("node").alias("query")), "ann_queries")
    wanted = distinct.join(asked.select(F.col("query").alias("node")).distinct(), "node")
    hits = search_index(index, wanted, distinct, k)
    # Cut to what a query can use before its nodes are opened to rows.
    near = Window.partitionBy("query").orderBy(F.desc("score"), "low")
    hits = hits.join(distinct.select("node", "rows", F.col("rows")[0].alias("low")), "node")
    hits = hits.withColumn("place", F.row_number().over(near)).where(F.col("place") <= k + 1)
    opened = asked.join(hits, "query").select(
        "query_row", "query_id", "score", F.inline("rows")).where("row <> query_row")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return opened.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
