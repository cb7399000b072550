"""Link-graph traversal: which pages a crawl reaches, and the items it finds there.

Unbranched stretches are contracted first, by doubling; then the joints that remain are
walked level by level with weighted links. So a long chain costs rounds by the logarithm of
its length wherever it stands, and only branching costs a round per level. A round writes what it
newly reached, below the shared folder; tables are dropped as they are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.session import discard, store


#: Links per bucket of the tables that are joined by URL; rounds merged into one table.
BUCKET_LINKS, MERGED = 1_000_000, 8


class Visited:
    """Pages reached so far: a table per round with only what that round reached (or reached by
    fewer links), bucketed by URL, so that a round neither shuffles nor rewrites the rest.
    ``MERGED`` tables of a size class become one of the next, so few are read at any time and a
    page is rewritten only a logarithmic number of times."""

    def __init__(self):
        self.classes: list[list[DataFrame]] = []

    def add(self, table: DataFrame, written, at: int = 0) -> None:
        if at == len(self.classes):
            self.classes.append([])
        self.classes[at].append(table)
        if len(self.classes[at]) == MERGED:
            merged = written(_least(self.classes[at]))
            # The round's own table is still to be read: the caller's ``fresh``.
            for old in self.classes[at]:
                if at or old is not table:
                    discard(old)
            self.classes[at] = []
            self.add(merged, written, at + 1)

    def least(self) -> DataFrame:
        """(url, depth) of all pages so far."""
        return _least([table for tables in self.classes for table in tables])

    def drop(self) -> None:
        for tables in self.classes:
            for table in tables:
                discard(table)


def _least(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables).groupBy("url").agg(F.min("depth").alias("depth"))


def _contracted(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(url, head, offset) of the pages within unbranched stretches: pages with one link in
    and one out that are no seeds. ``head`` is the joint the stretch starts from.

    Pointers double their reach each round. A round that resolves none leaves only circles
    without a joint, which nothing reaches.
    """
    one_out = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where("n = 1")
    one_in = edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("head"))
    inner = (one_in.where("n = 1").select(F.col("dst").alias("url"), "head")
             .join(one_out.select(F.col("src").alias("url")), "url")
             .join(seeds.select("url"), "url", "left_anti"))
    pointers = store(inner.withColumn("offset", F.lit(1).cast("long")), "reach_pointers")
    done = None
    while True:
        ahead = pointers.select(F.col("url").alias("head"), F.col("head").alias("_far"),
                                F.col("offset").alias("_more"))
        stepped = store(pointers.join(ahead, "head", "left").select(
            "url", F.coalesce("_far", "head").alias("head"),
            (F.col("offset") + F.coalesce("_more", F.lit(0))).alias("offset"),
            F.col("_far").isNull().alias("resolved")), "reach_pointers")
        discard(pointers)
        pointers = stepped
        resolved = stepped.agg(F.count_if("resolved"), F.count(F.lit(1))).first()
        if resolved[0] in (resolved[1], done):
            return stepped.where("resolved").drop("resolved")
        done = resolved[0]


def reach(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(url, depth) of all pages reachable from ``seeds`` (url) over ``edges`` (src, dst);
    depth is the least number of links."""
    seeds = store(seeds.select("url").distinct(), "reach_seeds")
    edges = store(edges.select("src", "dst").distinct(), "reach_edges")
    inner = _contracted(seeds, edges)
    inside = inner.select(F.col("url").alias("dst"))
    start = inner.select(F.col("url").alias("src"), "head", "offset")
    # Links into joints, from the head of the stretch that ends there.
    links = store(edges.join(inside, "dst", "left_anti").join(start, "src", "left").select(
        F.coalesce("head", "src").alias("src"), "dst",
        (F.coalesce("offset", F.lit(0)) + 1).cast("long").alias("length"))
        .groupBy("src", "dst").agg(F.min("length").alias("length")), "reach_links")
    buckets = max(1, -(-links.count() // BUCKET_LINKS))

    def written(rows: DataFrame) -> DataFrame:
        return store(rows, "reach_joints", "url", buckets)

    fresh = written(seeds.withColumn("depth", F.lit(0).cast("long")))
    visited = Visited()
    while not fresh.isEmpty():
        visited.add(fresh, written)
        landed = (fresh.join(links, fresh["url"] == links["src"])
                  .groupBy(links["dst"].alias("url"))
                  .agg(F.min(F.col("depth") + F.col("length")).alias("landed")))
        known = visited.least()
        fresh = written(landed.join(known, "url", "left").where(
            F.col("depth").isNull() | (F.col("landed") < F.col("depth"))).select(
            "url", F.col("landed").alias("depth")))
    joints = written(visited.least())
    visited.drop()
    stretches = inner.join(joints.select(F.col("url").alias("head"), "depth"), "head").select(
        "url", (F.col("depth") + F.col("offset")).alias("depth"))
    return joints.unionByName(stretches)


def crawl(seeds: DataFrame, follow: DataFrame, items: DataFrame) -> DataFrame:
    """(kind, url, depth): index pages reached over ``follow`` links, and each distinct page
    their ``items`` links name, one link further. ``items`` may be empty."""
    pages = reach(seeds, follow)
    found = (pages.join(items, pages["url"] == items["src"])
             .groupBy(items["dst"].alias("url")).agg((F.min("depth") + 1).alias("depth")))
    return (pages.select(F.lit("index").alias("kind"), "url", "depth")
            .unionByName(found.select(F.lit("item").alias("kind"), "url", "depth")))
