"""Helpers shared by the corpus operators: word counts, two-level ranks, components."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestry.session import discard, store

#: A word: a longest run without space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str = "text") -> Column:
    """Words in a text as long; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def bucket_count(rows: int, per_bucket: int) -> int:
    return max(1, math.ceil(rows / per_bucket))


def rank_in_group(df: DataFrame, group: list[str], salt: str, order: list[Column | str],
                  name: str = "rank", total: str | None = None) -> DataFrame:
    """A 0-based rank (or, with ``total``, the running sum of that column before the row)
    within ``group``, ordered by ``salt`` and then by ``order``.

    No group meets in one task: rows are ordered inside (group, salt), and what the salts
    before hold is added from an aggregate of one row per (group, salt).
    """
    keys = [*group, salt]
    step = F.col(total) if total else F.lit(1)
    held = df.groupBy(*keys).agg(F.sum(step).cast("long").alias("_held"))
    before = Window.partitionBy(*group).orderBy(salt).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = held.select(*keys, F.coalesce(F.sum("_held").over(before), F.lit(0))
                         .alias("_before"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(step).over(inside), F.lit(0))
    return (df.withColumn(name, own.cast("long")).join(starts, keys)
            .withColumn(name, F.col(name) + F.col("_before")).drop("_before"))


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of undirected links (``a``, ``b``: long): ``id`` and
    ``component``, the smallest id reachable; only ids that occur in ``links``.

    Alternates large-star and small-star steps until each vertex is a root or has one link, to
    a root: both steps leave such stars as they are. Each round aggregates per vertex the
    minimum of its neighbours, hence no vertex's links are ever collected, and writes
    the new links as a table, so that a lost executor repeats one round at most. Links that
    are stars already take no round.
    """
    edges = store(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        # Large star: each larger neighbour moves to the lowest of the vertex's neighbourhood.
        large = (both.join(lowest, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = store(large.where("a <> b").distinct(), label)
        # Small star: each vertex and its smaller neighbours move to the lowest of these.
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small_low, "a")
        small = store(
            moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small_low.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct(), label)
        discard(large)
        discard(edges)
        edges = small
    found = edges.groupBy("a").agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("id")).distinct().join(
        found.select(F.col("a").alias("id")), "id", "left_anti")
    return (found.select(F.col("a").alias("id"), "component")
            .unionByName(roots.select("id", F.col("id").alias("component"))))


def _stars(edges: DataFrame) -> bool:
    """Whether distinct links from larger ids (``a``) to smaller ones (``b``) are stars: no
    vertex has two links down, or one down and one from above."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("down")).unionByName(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("down")))
    met = ends.groupBy("id").agg(F.sum("down").alias("down"), F.count(F.lit(1)).alias("links"))
    return met.where("down > 0 and links > 1").isEmpty()
