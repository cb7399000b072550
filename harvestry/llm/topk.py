"""Exact top-k inner products over norm-sorted shards.

Vectors are dealt into shards by a hash of their row, queries into blocks; each (shard, block)
is one task's work. A shard is sorted by descending length and rotated onto its principal
axes (the right singular vectors), so that the first coordinates carry most of a product. Its
vectors are passed in strips: a query is done when its length times the strip's longest falls
below its k-th score, and a vector is skipped when its partial product over the first
coordinates plus the Cauchy-Schwarz bound of the rest does. What is left is multiplied
exactly, in integers. Shard results, k rows per query, are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestry.llm.common import bucket_count
from harvestry.session import ship_package, store

SHARD_ROWS, QUERY_ROWS, STRIP = 4096, 2048, 512
#: Scaled components are below this, as longs; products of two vectors may still pass a long.
LARGEST = 1 << 62


def is_finite(vector: str) -> Column:
    """Vectors without null or non-finite components; a null vector is none."""
    finite = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def quantised(vector: str, scale: int = 1024) -> Column:
    """floor(scale * x) of each component, as long; an error where that passes LARGEST."""
    def floor(x):
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < F.lit(float(LARGEST)), F.floor(scaled)).otherwise(
            F.raise_error(F.lit("a vector's component is too large for exact products")))
    return F.transform(vector, lambda x: floor(x).cast("long"))


def long_product(a: np.ndarray, b: np.ndarray) -> int:
    """The exact product of two integer vectors; an error if it is no long."""
    score = sum(x * y for x, y in zip(a.tolist(), b.tolist(), strict=True))
    if not -1 << 63 <= score < 1 << 63:
        raise OverflowError("the product of two vectors is too large for a long")
    return score


def shard_top_k(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray,
                query_rows: np.ndarray, k: int, strip: int = STRIP):
    """(query, place in ``vectors``, score) of each query's ``k`` best in a shard, ties to the
    smaller id; a query's own row is left out. Integer inputs; a score beyond a long is an
    error."""
    if not vectors.shape[1]:  # all products are 0, as those with a component of 0
        vectors, queries = (np.zeros((len(x), 1), np.int64) for x in (vectors, queries))
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((rows, ids, -lengths))
    vectors, ids, rows, lengths = (x[order] for x in (vectors, ids, rows, lengths))
    real, asked = vectors.astype(np.float64), queries.astype(np.float64)
    axes = np.linalg.svd(real.T @ real)[0]  # of the Gram matrix: the right singular vectors
    turned, wanted = real @ axes, asked @ axes
    head = max(1, vectors.shape[1] // 4)
    rest = np.sqrt((turned[:, head:] ** 2).sum(axis=1))
    wanted_rest = np.sqrt((wanted[:, head:] ** 2).sum(axis=1))
    wanted_all = np.sqrt((asked ** 2).sum(axis=1))
    slack = 1e-9 * (wanted_all.max(initial=0) * lengths.max(initial=0) + 1)
    exact_in_double = wanted_all.max(initial=0) * lengths.max(initial=0) < 2 ** 52
    least = np.full(len(queries), -np.inf)
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
    for low in range(0, len(vectors), strip):
        span = slice(low, low + strip)
        open_ = np.flatnonzero(wanted_all * lengths[low] + slack >= least)
        if not len(open_):
            break
        bound = (wanted[open_, :head] @ turned[span, :head].T
                 + wanted_rest[open_, None] * rest[None, span])
        alive = bound + slack >= least[open_, None]
        alive &= query_rows[open_, None] != rows[None, span]
        if exact_in_double and alive.mean() > 0.05:
            scores = np.rint(asked[open_] @ real[span].T).astype(np.int64)
        else:
            scores = np.zeros(alive.shape, np.int64)
            at, to = np.nonzero(alive)
            for a in range(0, len(at), 1 << 15):
                b = slice(a, a + (1 << 15))
                scores[at[b], to[b]] = (queries[open_[at[b]]] * vectors[low + to[b]]).sum(axis=1)
            # By Cauchy-Schwarz no sum of the others passes the range of a long.
            far = wanted_all[open_[at]] * lengths[low + to] >= 2.0 ** 62
            for a, b in zip(at[far].tolist(), to[far].tolist(), strict=True):
                scores[a, b] = long_product(queries[open_[a]], vectors[low + b])
        for place, query in enumerate(open_.tolist()):
            hits = np.flatnonzero(alive[place])
            if not len(hits):
                continue
            score = np.concatenate([best[query][0], scores[place, hits]])
            where = np.concatenate([best[query][1], hits + low])
            first = np.lexsort((rows[where], ids[where], -score))[:k]
            best[query] = (score[first], where[first])
            if len(first) == k:
                least[query] = score[first[-1]]
    owners = np.repeat(np.arange(len(queries)), [len(b[0]) for b in best])
    return owners, order[np.concatenate([b[1] for b in best])], np.concatenate(
        [b[0] for b in best])


RESULT = "query_row long, query_id long, row long, vec_id long, score long"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """Each query's ``k`` largest inner products: ``query_id``, ``rank`` from 1, ``vec_id``,
    ``score``.

    Both inputs have ``row`` (unique over both; a query's own row is no candidate), ``vec_id``
    and ``vector`` (array<long>, no nulls) and are stored tables. Ties go to the smaller
    vec_id (null first), then to the smaller row; a query with fewer candidates returns them
    all. Vectors of another dimension than the query's are no candidates."""
    ship_package(vectors.sparkSession)
    shards = bucket_count(vectors.count(), shard_rows)
    parts = bucket_count(queries.count(), query_rows)

    def dealt(rows: DataFrame, own: str, groups: int, other: str, others: int) -> DataFrame:
        # The keys have one type on both sides: an int and a long of one value hash apart. The
        # columns are new ones, as both sides may read one table.
        return rows.select(
            *[F.col(name).alias(name) for name in ("row", "vec_id", "vector")],
            F.size("vector").alias("dims"),
            F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    vectors = dealt(vectors, "shard", shards, "part", parts)
    queries = dealt(queries, "part", parts, "shard", shards)

    def run(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not (len(held) and len(asked)):
            return pd.DataFrame({n.split()[0]: pd.Series([], dtype="int64")
                                 for n in RESULT.split(", ")})
        # A null id sorts before all others.
        ids = held["vec_id"].astype("Int64").fillna(np.iinfo(np.int64).min).to_numpy(np.int64)
        owner, where, score = shard_top_k(
            np.stack(held["vector"].to_numpy()), ids, held["row"].to_numpy(),
            np.stack(asked["vector"].to_numpy()), asked["row"].to_numpy(), k)
        return pd.DataFrame({
            "query_row": asked["row"].to_numpy()[owner],
            "query_id": asked["vec_id"].astype("Int64").array[owner],
            "row": held["row"].to_numpy()[where],
            "vec_id": held["vec_id"].astype("Int64").array[where], "score": score})

    keys = ["shard", "part", "dims"]
    found = vectors.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(run, RESULT)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(embeddings: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Exact top-k of quantised embeddings: queries are the rows whose vec_id is divisible by
    ``every``, candidates all other rows. Null vectors and vectors with null or non-finite
    components take no part; repeated rows are separate candidates and queries; other columns
    are not read."""
    held = store(embeddings.where(is_finite("embedding")).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"),
        quantised("embedding").alias("vector")), "topk_vectors")
    return top_k(held, held.where(F.col("vec_id") % every == 0), k)
