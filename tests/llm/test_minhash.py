"""Near duplicates next to all pairs compared in plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from harvestry.llm import minhash
from tests.llm.test_ngram_join import plain_components, plain_set

SCHEMA = "doc_id long, text string, n long, component string, kept string"


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 7, "x", "y") for i, t in rows], SCHEMA)
    out = minhash.near_duplicates(docs, **options)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = out.collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return sorted((tuple(r)[:3] for r in rows), key=repr)


def edited(words, rng, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("seed, size", [(1, 2), (2, 2), (3, 5)])
def test_equals_all_pairs(spark, seed, size):
    """Groups of copies with more and fewer edits, a passage many share, short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    rows = []
    for base in range(6):
        words = rng.choices(vocabulary, k=rng.randrange(5, 200))
        for _ in range(rng.choice([1, 4, 30])):
            rows.append(" ".join(edited(words, rng, rng.randrange(len(words) // 8 + 2))))
    rows += [" ".join(passage + rng.choices(vocabulary, k=rng.randrange(0, 40)))
             for _ in range(60)]
    rows += [" ".join(rng.choices(vocabulary[:3], k=rng.randrange(0, 7))) for _ in range(60)]
    rows = list(enumerate(rows, 100))
    rng.shuffle(rows)
    assert found(spark, rows, size=size) == plain_components(rows, size, 80)


def test_nulls_repeats_ties_and_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "A b"), (5, "a B"), (5, "a b"),
            (6, "b a"), (None, "a\nb"), (None, "only here"), (7, "É x"), (8, "é x"),
            (9, long), (10, long + " more"), (11, "one"), (12, "ONE"), (13, "x\x00"), (14, "x"),
            (2**62, "y" * 200_000), (15, "y" * 200_000)]
    assert found(spark, rows, size=2) == plain_components(rows, 2, 80)
    assert found(spark, [], size=2) == []
    assert found(spark, [(1, None)], size=2) == [(1, 0, 1)]


def test_lower_similarity_is_refused(spark):
    with pytest.raises(ValueError):
        found(spark, [], percent=79)


def test_blocks_split_in_rooms_and_turns(spark, monkeypatch):
    """Buckets over the bound are dealt over several blocks: same links."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(edited(words, rng, rng.randrange(9)))) for i in range(150)]
    monkeypatch.setattr(minhash, "BLOCK_TOKENS", 700)
    assert found(spark, rows, size=2) == plain_components(rows, 2, 80)


def test_blocks_alone_find_all_links(spark, monkeypatch):
    """Without leaders all links come from the blocks."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(edited(words, rng, rng.randrange(9)))) for i in range(80)]
    monkeypatch.setattr(minhash, "stars", lambda sigs: sigs.select(
        sigs.id.alias("a"), sigs.id.alias("b")).where("false"))
    monkeypatch.setattr(minhash, "BLOCK_TOKENS", 1500)
    assert found(spark, rows, size=2) == plain_components(rows, 2, 80)


def test_words_are_those_of_the_pattern(monkeypatch):
    texts = ["a b", None, "", " lead", "tail ", "É x y", "a" * 50, "A\x0bB\x1cC",
             "x" * 30 + " " + "y" * 30, "Z"]
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    expected = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in lower]
    whole, edges = minhash.word_hashes(pa.array(texts))
    assert np.diff(edges).tolist() == [len(w) for w in expected]
    words = [w for t in expected for w in t]
    # Equal words and no others have equal hashes.
    assert len(set(words)) == len(set(whole.tolist())) == len(set(zip(words, whole.tolist())))
    for piece in (1, 7, 16):  # cut at any place the result is the same
        monkeypatch.setattr(minhash, "PIECE", piece)
        again, cut = minhash.word_hashes(pa.array(["skipped", *texts])[1:])
        assert again.tolist() == whole.tolist() and cut.tolist() == edges.tolist()


def test_sets_of_shingles():
    texts = ["a b c a b", "a", "", None, "A B", "a b c"]
    for size in (1, 2, 3, 5):
        got = [frozenset(s.tolist()) for s in minhash.shingle_sets(pa.array(texts), size)]
        want = [plain_set(t, size) for t in texts]
        assert [len(s) for s in got] == [len(s) for s in want]
        assert len(set(got)) == len(set(want))


def test_every_coordinate_fills_and_estimates():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 150, 5000):
        common = rng.integers(0, 2**63, n).astype(np.uint64)
        own = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        a = np.unique(np.concatenate([common, own[:n // 4]]))
        b = np.unique(np.concatenate([common, own[n:n + n // 4]]))
        sketch = minhash.sketches([a, b, a], 200)
        assert (sketch != np.iinfo(np.uint64).max).all()
        assert (sketch[0] == sketch[2]).all()
        jaccard = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((sketch[0] == sketch[1]).mean() - jaccard) < 0.15


def test_a_sketch_does_not_depend_on_its_neighbours():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 40, 3, 900)]
    together = minhash.sketches(sets, 64)
    for own, row in zip(sets, together, strict=True):
        assert (minhash.sketches([own], 64)[0] == row).all()
