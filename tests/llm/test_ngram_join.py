"""The n-gram join next to all pairs compared in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from harvestry.llm import ngram_join

SCHEMA = "doc_id long, text string, n long, component string"


def plain_set(text, size=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def plain_components(rows, size=3, percent=90):
    """(doc_id, set size, smallest linked id) of (doc_id, text), by comparing all sets."""
    sets = [plain_set(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_set = {}
    for i, s in enumerate(sets):
        if s:
            parent[i] = root(by_set.setdefault(s, i))
    distinct = sorted(by_set.items(), key=lambda x: len(x[0]))
    for at, (a, i) in enumerate(distinct):
        for b, j in distinct[at + 1:]:
            if len(a) * 100 < percent * len(b):
                break
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                parent[root(i)] = root(j)
    lowest = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            lowest[root(i)] = min(lowest.get(root(i), name), name)
    return sorted(((name, len(sets[i]), lowest.get(root(i))) for i, (name, _) in
                   enumerate(rows)), key=repr)


def joined(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], SCHEMA)
    found = ngram_join.link_components(docs, **options)
    assert found.columns[:3] == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r)[:3] for r in found.collect()), key=repr)


def corpus(seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)] + ["The", "of"] * 200
    texts = []
    for length in (30, 60, 200, 700, 1500):
        base = [rng.choice(words) for _ in range(length)]
        texts.append(base)
        for edits in (0, 1, 2, 3, 5, 8, 12):  # up to and beyond the threshold
            for _ in range(2):
                copy = list(base)
                for _ in range(edits * length // 200 or min(edits, 1)):
                    copy[rng.randrange(length)] = rng.choice(words)
                texts.append(copy)
    step = [rng.choice(words) for _ in range(300)]
    for at in range(0, 60, 3):  # a chain: neighbours link, its ends do not
        step = step[:at] + [f"c{at}", f"d{at}"] + step[at + 2:]
        texts.append(list(step))
    passage = [rng.choice(words) for _ in range(80)]
    for _ in range(40):  # one passage in many documents
        texts.append([rng.choice(words) for _ in range(60)] + passage)
    rows = [" ".join(t) for t in texts]
    rows += [rows[3].upper(), rows[3], None, "", " \t\n", "one", "One", "one two", "a b c",
             "é b c d e f g h i j k", "É b c d e f g h i j k", "x" * 50_000]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(100 + i, rows[at]) for i, at in enumerate(order)]


def test_equals_brute_force(spark):
    rows = corpus() + [(None, corpus()[0][1]), (None, None), (101, "one two"), (101, None)]
    assert joined(spark, rows) == plain_components(rows)


def test_other_shingles_and_threshold(spark):
    rows = corpus(9)[:120]
    assert joined(spark, rows, size=5, percent=80) == plain_components(rows, 5, 80)


def test_large_group_of_near_copies(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(600):  # most link; some only through others; some not at all
        copy = list(base)
        for _ in range(rng.choice([1, 1, 2, 3, 6])):
            copy[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    assert joined(spark, rows) == plain_components(rows)


def groups_and_passages(seed=3):
    """Near copies that link step by step, and other texts that only share passages."""
    rng = random.Random(seed)
    rows = []
    for _ in range(4):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.choice([1, 2, 3, 4])):
                copy[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(copy))
    for _ in range(10):
        passage = [f"p{rng.randrange(10**6)}" for _ in range(60)]
        rows += [" ".join([f"y{rng.randrange(10**6)}" for _ in range(60)] + passage)
                 for _ in range(8)]
    return list(enumerate(rows))


def test_later_rounds_pass_settled_signatures_over(spark, monkeypatch):
    dealt, blocks = [], ngram_join.blocks

    def counted(placed, *others):
        dealt.append(placed.count())
        return blocks(placed, *others)

    monkeypatch.setattr(ngram_join, "blocks", counted)
    rows = groups_and_passages()
    assert joined(spark, rows) == plain_components(rows)
    assert len(dealt) == ngram_join.NEAREST + 1
    assert dealt[0] > dealt[1] >= dealt[2]


def test_sets_are_shuffled_once(spark, monkeypatch):
    plans, verified = [], ngram_join.verified

    def planned(*args):
        found = verified(*args)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(ngram_join, "verified", planned)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = corpus(6)[:100]
        assert joined(spark, rows) == plain_components(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans and all(p.count("Bucketed: true") == 2 for p in plans)


def test_far_sizes_share_no_signature():
    tokens, counts = [1 << 40, 1 << 41], [2, 2]
    near, far = ({*ngram_join._prefix(tokens, counts, 2, n, 90, n.bit_length() - 1)}
                 for n in (10, 1000))
    assert near and far and not near & far


def test_no_rows(spark):
    assert joined(spark, []) == []


def test_small_corpus_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = ngram_join.link_components(docs).collect()
    assert sorted((tuple(r)[:3] for r in found), key=repr) == plain_components(rows)


@pytest.mark.parametrize("seed", range(6))
def test_similar_sets_share_a_signature(seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "CLASSES", ((9, 3), (4, 2)))
    monkeypatch.setattr(ngram_join, "SPREAD", 8)
    rng = np.random.default_rng(seed)
    sets = []
    for n in (9, 12, 40, 90, 130, 260):
        base = rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)
        for _ in range(12):
            gone = rng.integers(0, n // 9 + 1)
            new = rng.integers(0, 1 << 64, rng.integers(0, n // 9 + 1), np.uint64)
            sets.append(np.unique(np.concatenate([rng.permutation(base)[gone:], new])))
    edge, windows = np.uint64(ngram_join.share_edge(90)), []
    for s in sets:
        n = len(s)
        reach = ngram_join.errors(n, 90) + 1 + 3 * ngram_join.groups_of(n.bit_length() - 1)
        windows.append(s[:max(int(np.searchsorted(s, edge)), reach)])
    df = Counter(int(t) for w in windows for t in w)
    signs = []
    for s, w in zip(sets, windows, strict=True):
        n, own = len(s), [int(t) for t in w if df[int(t)] > 1]
        levels = {n.bit_length() - 1, (-(-n * 90 // 100)).bit_length() - 1}
        signs.append({x for level in levels for x in ngram_join._prefix(
            own, [df[t] for t in own], int(np.searchsorted(s, edge)), n, 90, level)})
    linked = 0
    for i in range(len(sets)):
        for j in range(i):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            apart = len(a ^ b)
            maps = [ngram_join.parity(sets[k]) for k in (i, j)]
            if ngram_join.within(len(a), len(b), apart, 90):
                linked += 1
                assert a == b or signs[i] & signs[j]
                least = ngram_join._apart(len(a), len(b), *maps)
                assert least <= apart and ngram_join.within(len(a), len(b), least, 90)
    assert linked > 20


def test_shingles_equal_plain_words():
    texts = ["A b\tc\x0bd", " lead and trail ", "É ÉCOLE x", None, "", "a\x1cb c d", "a a a a a",
             "w " * 5000, "\n\n", "one two"]
    found = [len(s) for s in ngram_join.shingle_sets(pa.array(texts), 3)]
    assert found == [len(plain_set(t)) for t in texts]


def test_keep_one(spark):
    rows = corpus(4)[:150]
    rows += [(rows[0][0], rows[0][1])] * 2 + [(None, rows[1][1]), (None, "only here " * 20),
                                              (None, None), (5000, None), (5000, None), (5001, "")]
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], SCHEMA)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    sure = [(i, t) for i, t in rows if i is not None and plain_set(t, 5)]
    lowest = {c for _, n, c in plain_components(sure, 5, 80) if n}
    texts = dict(reversed(sure))
    want = [(i, texts[i]) for i in lowest] + [(None, "only here " * 20), (None, None)]
    want += [(5000, None)] * 2 + [(5001, "")] + [(i, t) for i, t in rows if i is not None
                                                 and i < 5000 and not plain_set(t, 5)]
    assert found == sorted(want, key=repr)
