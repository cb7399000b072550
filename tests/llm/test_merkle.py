"""The manifest next to a plain recursive tree, its log's order, and its SQL on planted rows."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from harvestry.llm import merkle

SCHEMA = ("doc_id long, source string, lang string, n_chars long, text string, digest string, "
          "tree string, index string")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_of(digests):
    levels = [list(digests)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i:i + 16])) for i in range(0, len(last), 16)])
    return levels


def path_of(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 16 * 16
        out.append((level[first:at], level[at + 1:first + 16]))
        at //= 16
    return out


def lowered(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                        "abcdefghijklmnopqrstuvwxyz"))


def plain(rows):
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree_of([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in order]
    top = tree_of([t[-1][0] for t in trees])
    out = []
    for at, source in enumerate(order):
        for i, (_, _, leaf, row) in enumerate(sorted(sources[source], key=lambda x: x[:3])):
            path = path_of(trees[at], i) + path_of(top, at)
            folded = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                folded = leaf_of((*row[:4], row[4] and lowered(row[4])))
            for before, after in path:
                folded = h("".join([*before, folded, *after]))
            out.append((row[0], leaf, trees[at][-1][0], top[-1][0],
                        h("".join("".join(b + a) for b, a in path)), folded,
                        folded == top[-1][0]))
    return sorted(out, key=repr)


def found(spark, rows):
    docs = spark.createDataFrame([(*row, "x", "y", "z") for row in rows], SCHEMA)
    picked = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    out = merkle.proofs(*merkle.manifest(docs, picked, F.translate(
        "text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"]
    return sorted(map(tuple, out.collect()), key=repr)


def rows_of(counts):
    return [(i * 3 + at, source, "en" if i % 3 else None, i, f"Text {i} of {source}")
            for at, (source, n) in enumerate(counts.items()) for i in range(n)]


@pytest.mark.parametrize("counts", [
    {"a": 1}, {"a": 2, None: 1}, {"a": 16, "b": 17, "c": 1}, {"one": 4097, "b": 273, None: 256},
    {f"s{i}": 1 + i % 3 for i in range(40)}])
def test_equals_plain(spark, counts):
    rows = rows_of(counts)
    got = found(spark, rows)
    assert got == plain(rows)
    untouched = [r for r in got if zlib.crc32(str(r[0]).encode()) % 5]
    assert all(r[-1] for r in untouched)


def test_nulls_ties_repeats_bytes_and_long_texts(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (7, "é", "x", 0, ""),
            (7, "é", "x", 0, ""), (7, "é", "x", 1, "Other"), (5, "z", None, None, "É" * 100_000),
            (6, "Z", "", -1, "A\nB"), (2**62, "", "-", 2, "-"), (None, "", "-", 2, "-"),
            (10, "z", "x", 3, "ABC"), (12, "z", "x", 3, "ABC")]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_tampering_is_seen(spark):
    rows = [(i, "s", "en", 3, "ABC" if i % 2 else "abc") for i in range(200)]
    for got in found(spark, rows):
        changed = zlib.crc32(str(got[0]).encode()) % 5 == 0 and got[0] % 2 == 1
        assert got[-1] is not changed


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4096, 4097, 5000])
def test_positions_are_those_of_a_postorder_log(n):
    log = []

    def visit(level, index):
        if level:
            below = -(-n // 16 ** (level - 1))
            for child in range(16 * index, min(16 * index + 16, below)):
                visit(level - 1, child)
        log.append((level, index))

    visit(merkle.top_level(n), 0)
    assert [merkle.position(level, index, n) for level, index in log] == list(range(len(log)))


def test_log_is_whole_and_in_the_order_of_completion(spark):
    rows = rows_of({"a": 4500, "b": 30})
    docs = spark.createDataFrame([(*row, "x", "y", "z") for row in rows], SCHEMA)
    placed, logs = merkle.manifest(docs)
    assert placed.count() == len(rows) and placed.where("changed is not null").isEmpty()
    assert len(logs["log"]) == 2
    whole = logs["log"][0].unionByName(logs["log"][1])
    for n in (4500, 30):
        own = whole.where(F.col("n") == n).orderBy("pos").collect()
        assert [r["pos"] for r in own] == list(range(len(own)))
        levels = tree_of([r["digest"] for r in own if r["level"] == 0])
        assert all(levels[r["level"]][r["index"]] == r["digest"] for r in own)
        assert len(own) == sum(map(len, levels))


def test_query_equals_its_sql(spark):
    from harvestry.llm.queries import ORACLE_SQL, QUERIES
    from tests.compare import difference
    name = "op12_merkle_manifest"
    assert difference(spark, "/root/testdata/sf0.001", QUERIES[name], ORACLE_SQL[name]) is None
