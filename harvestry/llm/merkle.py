"""Merkle manifest of a dataset: a tree per source, kept as a postorder append log.

Leaves are numbered in order, and a node's place in the log follows from its level, its number
and the count of leaves alone. Builders take aligned runs of leaves (a full subtree each), so
each writes a gap-free stretch of the log in the order nodes are completed, with no more than
the children of one open node per level in mind; further rounds of builders add the levels
above. Proofs go the other way: positions of siblings are computed, the stretch of the log
that holds them is looked up, and what lies above a stretch comes as one row per stretch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.operators.frontier import number_rows
from harvestry.session import ship_package, store

ARITY = 16
#: Levels that one builder completes, and the nodes it starts from.
LEVELS = 3
SEGMENT = ARITY ** LEVELS
#: Rows per Arrow batch of results.
AT_ONCE = 4096

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LOG = "tree long, n long, level int, index long, pos long, digest string"
PATH = "array<struct<before:string,after:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def top_level(n: int) -> int:
    """Level of the root above ``n`` leaves."""
    level = 0
    while ARITY ** level < n:
        level += 1
    return level


def position(level: int, index: int, n: int) -> int:
    """Place in the log of a node: all that is completed before it, and of what ends with the
    same leaf the levels below."""
    start = index * ARITY ** level
    end = min(start + ARITY ** level, n)
    below = sum(-(-end // ARITY ** j) for j in range(level + 1))
    above = sum(start // ARITY ** j for j in range(level + 1, top_level(n) + 1))
    return below + above - 1


def completed(base: int, first: int, digests: list[str], n: int) -> Iterator[tuple]:
    """(level, index, digest) of the given nodes of level ``base`` and of those above them up
    to the builder's height, in the order they are completed."""
    height = min(base + LEVELS, top_level(n))
    open_nodes: list[list[str]] = [[] for _ in range(LEVELS)]
    for index, value in enumerate(digests, first):
        level = base
        yield level, index, value
        while level < height:
            children = open_nodes[level - base]
            children.append(value)
            last = -(-n // ARITY ** level) - 1
            if len(children) < ARITY and index < last:
                break
            value = digest("".join(children))
            children.clear()
            level, index = level + 1, index // ARITY
            yield level, index, value


def stage_of(n: int) -> int:
    """The round of builders that completes a tree."""
    return max(0, -(-top_level(n) // LEVELS) - 1)


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple]:
    """Consecutive rows of equal ``keys``, as (key, list of rows)."""
    held, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != held and rows:
                yield held, rows
                rows = []
            held = key
            rows.append(row)
    if rows:
        yield held, rows


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == AT_ONCE:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def by_segment(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("tree", "segment").sortWithinPartitions("tree", "segment", *order)


def append_log(leaves: DataFrame, most: int) -> list[DataFrame]:
    """The log of every tree, one stored table per round of builders.

    ``leaves`` has ``tree`` (long), ``n`` (its number of leaves), ``index`` (from 0, without
    gaps) and ``digest``; ``most`` is the largest ``n``. A row of the log has ``tree``, ``n``,
    ``level``, ``index``, ``pos`` (its place in the tree's log) and ``digest``."""
    ship_package(leaves.sparkSession)
    schema = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("level", pa.int32()),
                        ("index", pa.int64()), ("pos", pa.int64()), ("digest", pa.string())])
    tables: list[DataFrame] = []
    nodes = leaves
    for stage in range(stage_of(most) + 1):
        base = stage * LEVELS

        def build(batches, base=base):
            def rows():
                for (tree, _), held in _groups(batches, "tree", "segment"):
                    n, first = held[0]["n"], held[0]["index"]
                    for level, index, value in completed(
                            base, first, [row["digest"] for row in held], n):
                        if level > base or not base:
                            yield {"tree": tree, "n": n, "level": level, "index": index,
                                   "pos": position(level, index, n), "digest": value}
            return _batches(rows(), schema)

        dealt = nodes.select("tree", "n", "index", "digest",
                             F.expr(f"index div {SEGMENT}").alias("segment"))
        tables.append(store(by_segment(dealt, "index").mapInArrow(build, LOG), "merkle_log"))
        nodes = tables[-1].where((F.col("level") == base + LEVELS)
                                 & (F.col("n") > ARITY ** (base + LEVELS)))
    return tables


def _siblings(level: int, index: int, n: int, log: dict[int, str]) -> tuple[str, str]:
    """Digests left and right of a node in its run, by their positions in the log."""
    first = index // ARITY * ARITY
    last = min(first + ARITY, -(-n // ARITY ** level))
    return tuple("".join(log[position(level, i, n)] for i in span)
                 for span in (range(first, index), range(index + 1, last)))


class _Stretch:
    """What one builder wrote, with the path above it."""

    def __init__(self, base: int, n: int, log: dict[int, str], above: list[tuple[str, str]]):
        self.base, self.n, self.log, self.above = base, n, log, above
        self.height = min(base + LEVELS, top_level(n))
        self.known: dict[tuple[int, int], list[tuple[str, str]]] = {}

    def path(self, level: int, index: int) -> list[tuple[str, str]]:
        """(left, right) siblings from a node up to the root."""
        if level == self.height:
            return self.above
        if (level, index) not in self.known:
            found = [_siblings(level, index, self.n, self.log),
                     *self.path(level + 1, index // ARITY)]
            if level == self.base:
                return found
            self.known[level, index] = found
        return self.known[level, index]


def _with_segments(nodes: DataFrame, base: int) -> DataFrame:
    """A stage's nodes below its heads, by the stretch they lie in."""
    inside = nodes.where((F.col("level") < base + LEVELS))
    up = F.pow(F.lit(float(ARITY)), F.lit(base + LEVELS) - F.col("level")).cast("long")
    return inside.withColumn("_up", up).withColumn("segment", F.expr("index div _up")).drop("_up")


def paths(log: list[DataFrame], trees: DataFrame, finish=None) -> DataFrame:
    """For every leaf its path: ``tree``, ``index``, ``path`` (its siblings' digests, those to
    the left and those to the right as one text each, level by level).

    ``trees`` has a row per tree: ``tree``, ``n`` and ``path``, what follows above its root.
    ``finish`` replaces the last step: it gets the stretches' log rows and path rows."""
    schema = pa.schema([("tree", pa.int64()), ("segment", pa.int64()), ("path", pa.list_(
        pa.struct([("before", pa.string()), ("after", pa.string())])))])
    heights = trees.withColumn("_stage", F.lit(0))
    for stage in range(1, len(log)):
        heights = heights.withColumn("_stage", F.when(
            F.col("n") > SEGMENT ** stage, stage).otherwise(F.col("_stage")))
    above = None
    for stage in reversed(range(len(log))):
        base = stage * LEVELS
        own = heights.where(F.col("_stage") == stage).select(
            "tree", F.lit(0).cast("long").alias("segment"), "path")
        above = own if above is None else own.unionByName(above)
        nodes = log[stage] if not stage else log[stage].unionByName(
            log[stage - 1].where((F.col("level") == base) & (F.col("n") > ARITY ** base)))
        held = _with_segments(nodes, base)
        if not stage and finish:
            return finish(held, above)

        def extract(batches, base=base):
            def rows():
                for (tree, _), stretch in stretches(batches, base):
                    for index in stretch.own:
                        yield {"tree": tree, "segment": index, "path": [
                            {"before": b, "after": a} for b, a in stretch.path(base, index)]}
            return _batches(rows(), schema)

        above = by_segment(_tagged(held, above), "kind", "pos").mapInArrow(
            extract, f"tree long, segment long, path {PATH}")
        if stage:
            above = store(above, "merkle_paths")
    return above.withColumnRenamed("segment", "index")


def _tagged(held: DataFrame, above: DataFrame) -> DataFrame:
    """Path rows ahead of log rows, in one shape; a path row may carry a digest."""
    carried = F.col("digest") if "digest" in above.columns else F.lit(None).cast("string")
    return above.select(
        "tree", "segment", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("n"),
        F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("index"),
        F.lit(-1).cast("long").alias("pos"), carried.alias("digest"),
        "path").unionByName(held.select(
            "tree", "segment", F.lit(1).alias("kind"), "n", "level", "index", "pos", "digest",
            F.lit(None).cast(PATH).alias("path")))


def stretches(batches: Iterator[pa.RecordBatch], base: int) -> Iterator[tuple]:
    for key, rows in _groups(batches, "tree", "segment"):
        top = rows[0]
        nodes = [r for r in rows if r["kind"] == 1]
        stretch = _Stretch(base, nodes[0]["n"], {r["pos"]: r["digest"] for r in nodes},
                           [(p["before"], p["after"]) for p in top["path"]])
        stretch.subroot = top["digest"]
        stretch.own = [r["index"] for r in nodes if r["level"] == base]
        stretch.rows = [r for r in rows if r["kind"] == 2]
        yield key, stretch


def leaf_digest(*fields: Column) -> Column:
    """H of the fields: ``-`` where null, else UTF-8 byte count, ``:`` and the value."""
    texts = [field.cast("string") for field in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(
        F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        for text in texts]), 256)


def manifest(documents: DataFrame, tampered: Column | None = None,
             text: Column | None = None) -> tuple[DataFrame, dict]:
    """Leaves in their places, and the logs: of each source's tree (``log``), of the tree
    above the sources (``root_log``), and ``trees`` with a row per source.

    ``documents`` has doc_id, source, lang, n_chars and text, nulls anywhere; other columns
    are not read. Sources stand in bytewise order, null first; leaves by doc_id, null first,
    rows of one id by their digest. Equal rows are leaves of their own. Rows for which
    ``tampered`` holds get a second digest, of the row with another ``text`` (``changed``, else
    null). No rows, no trees: all tables are empty then."""
    columns = [F.col(name) for name in FIELDS]
    altered = F.lit(None).cast("string") if tampered is None else F.when(
        tampered, leaf_digest(*columns[:-1], text))
    leaves = documents.select("doc_id", "source", leaf_digest(*columns).alias("digest"),
                              altered.alias("changed"))
    numbered = number_rows(leaves, [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"),
                                    F.asc("digest")])
    sources = numbered.groupBy("source").agg(
        (F.min("number") - 1).alias("tree"), F.count(F.lit(1)).alias("n"))
    sources = store(sources, "merkle_sources")
    placed = store(numbered.join(
        sources.withColumnRenamed("source", "_source"),
        F.col("source").eqNullSafe(F.col("_source"))).select(
        "tree", "n", (F.col("number") - 1 - F.col("tree")).alias("index"), "doc_id", "source",
        "digest", "changed"), "merkle_leaves")
    most = sources.agg(F.max("n"), F.count(F.lit(1))).first()
    log = append_log(placed, most[0] or 1)
    roots = None
    for stage, table in enumerate(log):
        height = F.lit(0)
        for level in range(1, (stage + 1) * LEVELS + 1):
            height = F.when(F.col("n") > ARITY ** (level - 1), level).otherwise(height)
        ended = F.col("n") <= ARITY ** ((stage + 1) * LEVELS)
        own = table.where(ended & (F.col("level") == height) & (F.col("index") == 0)).select(
            "tree", "n", "digest")
        roots = own if roots is None else roots.unionByName(own)
    # A tree's number counts the leaves before it, so it orders the sources.
    ordered = number_rows(roots, ["tree"])
    subroots = store(ordered.select(
        F.lit(0).cast("long").alias("tree"), F.lit(most[1]).cast("long").alias("n"),
        (F.col("number") - 1).alias("index"), "digest", F.col("tree").alias("source_tree"),
        F.col("n").alias("leaves")), "merkle_subroots")
    root_log = append_log(subroots, max(most[1], 1))
    return placed, {"log": log, "root_log": root_log, "subroots": subroots,
                    "n_sources": most[1]}


def root_of(logs: dict) -> DataFrame:
    """The root as one row (``root``)."""
    top = top_level(max(logs["n_sources"], 1))
    return logs["root_log"][stage_of(max(logs["n_sources"], 1))].where(
        (F.col("level") == top) & (F.col("index") == 0)).select(F.col("digest").alias("root"))


def _root_paths(logs: dict) -> DataFrame:
    """Per source's tree the path from its subroot to the root."""
    spark = logs["subroots"].sparkSession
    count = logs["n_sources"]
    if count <= 1:
        return logs["subroots"].select(
            F.col("source_tree").alias("tree"), F.col("leaves").alias("n"),
            F.col("digest").alias("subroot"), F.array().cast(PATH).alias("path"))
    whole = spark.range(1).select(F.lit(0).cast("long").alias("tree"),
                                  F.lit(count).cast("long").alias("n"),
                                  F.array().cast(PATH).alias("path"))
    found = paths(logs["root_log"], whole)
    return logs["subroots"].join(found.select("index", "path"), "index").select(
        F.col("source_tree").alias("tree"), F.col("leaves").alias("n"),
        F.col("digest").alias("subroot"), "path")


PROVEN = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


def proofs(placed: DataFrame, logs: dict) -> DataFrame:
    """Per leaf: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (H of its
    siblings up to the root), ``folded_root`` (from the changed leaf, where there is one, and
    the siblings) and ``verified``, whether that is the root."""
    ship_package(placed.sparkSession)
    schema = pa.schema([(f.split()[0], {"long": pa.int64(), "string": pa.string(),
                                        "boolean": pa.bool_()}[f.split()[1]])
                        for f in PROVEN.split(", ")])
    trees = store(_root_paths(logs), "merkle_root_paths")
    top = root_of(logs).first()
    root = top and top["root"]

    def finish(held: DataFrame, above: DataFrame) -> DataFrame:
        known = above.join(trees.select("tree", F.col("subroot").alias("digest")), "tree")
        rows = placed.select(
            "tree", F.expr(f"index div {SEGMENT}").alias("segment"), F.lit(2).alias("kind"),
            "n", F.lit(0).alias("level"), "index", F.col("index").alias("pos"), "digest",
            F.lit(None).cast(PATH).alias("path"), F.col("doc_id").cast("long"), "changed")
        together = _tagged(held, known).withColumns({
            "doc_id": F.lit(None).cast("long"), "changed": F.lit(None).cast("string")})

        def run(batches):
            def proven():
                for _, stretch in stretches(batches, 0):
                    yield from _proven(stretch, root)
            return _batches(proven(), schema)

        return by_segment(together.unionByName(rows), "kind", "pos").mapInArrow(run, PROVEN)

    return paths(logs["log"], trees, finish)


def _proven(stretch: _Stretch, root: str) -> Iterator[dict]:
    # What follows a leaf's own run is the same for all leaves of the run.
    run, shared = -1, ""
    for row in stretch.rows:
        path = stretch.path(0, row["index"])
        own = path[:1] if stretch.height else []
        if row["index"] // ARITY != run:
            run = row["index"] // ARITY
            shared = "".join(before + after for before, after in path[len(own):])
        folded = row["digest"] if row["changed"] is None else row["changed"]
        for before, after in path:
            folded = digest(before + folded + after)
        yield {"doc_id": row["doc_id"], "leaf": row["digest"], "subroot": stretch.subroot,
               "root": root, "folded_root": folded, "verified": folded == root,
               "proof_sha256": digest("".join(b + a for b, a in own) + shared)}
