"""Spelling variants next to all pairs of words in plain Python, and the query's SQL."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harvestry.llm import spelling

LETTERS = "".join(map(chr, spelling.ALPHABET))


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain(counts, ratio=10):
    near = {w: [x for x in counts if one_apart(w, x)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[word] = best if best and counts[best] >= ratio * counts[word] else None
    out = []
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), counts.get(form[word])))
    return sorted(out, key=repr)


def found(spark, counts, **options):
    words = spark.createDataFrame([(w, n, "x") for w, n in counts.items()],
                                  "word string, n long, form string")
    out = spelling.variants(words, **options)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, out.collect()), key=repr)


def family(rng, word, times):
    out = {word}
    for _ in range(times):
        w = rng.choice(sorted(out))
        i = rng.randrange(len(w) + 1)
        c = rng.choice(LETTERS)
        out.add(rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    words = set()
    for _ in range(8):
        words |= family(rng, "".join(rng.choices("aé", k=rng.randrange(1, 12))), 30)
    words |= {"a" * n for n in (61, 62, 63, 64, 65, 66, 500, 501)} | {"b" * 64 + "c", "b" * 65}
    counts = {w: rng.choice([2, 3, 20, 200, 2000, 20000]) for w in words if w}
    assert found(spark, counts) == plain(counts)
    # Several passes, each with filters of a bounded size, find the same.
    parts = spark.createDataFrame(list(counts.items()), "word string, n long")
    stored = spelling.store(parts, "words")
    whole = {tuple(r) for r in spelling.near_words(stored).collect()}
    assert {tuple(r) for r in spelling.near_words(stored, most_blocks=2).collect()} == whole
    assert spelling.near_words(stored, most_blocks=2).count() == len(whole)


def test_ties_chains_and_empty_tables(spark):
    counts = {"abcdefg": 2, "abcdefh": 20, "abcdefi": 20, "abcdehi": 200, "abcxehi": 2000,
              "alone": 5, "é": 10, "e": 100, "ab": 1}
    assert found(spark, counts) == plain(counts)
    assert found(spark, {}) == []
    assert found(spark, {"x": 1}) == [("x", None, "x", 1, 0, None)]
    words = spark.createDataFrame([(None, 5), ("", 9), ("a", 1)], "word string, n long")
    assert spelling.variants(words).count() == 1
    with pytest.raises(ValueError):
        spelling.variants(words, ratio=1)


def plain_words(rows, least_length, least_count, misspell):
    counts = Counter()
    for ident, text in rows:
        for raw in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if misspell and h % misspell == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return sorted((w, n) for w, n in counts.items() if len(w) >= least_length
                  and n >= least_count)


@pytest.mark.parametrize("misspell", [None, 2, 31])
def test_words_of_a_corpus(spark, misspell):
    rng = random.Random(9)
    vocabulary = ["straße", "STRASSE", "Énorme", "énorme", "naïveté", "wordÿword", "a×b÷c",
                  "Œuvre", "exactly", "sixsix", "seventy", "x" * 3000, "日本word日本語"]
    rows = [(rng.choice([None, 1, 2, 7, 2**60, -5]), rng.choice(
        [None, "", "12 _", " ".join(rng.choices(vocabulary, k=30)),
         "-".join(rng.choices(vocabulary, k=30))])) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, "w", 3) for i, t in rows],
                                 "doc_id long, text string, word string, n int")
    got = spelling.corpus_words(docs, misspell=misspell)
    assert sorted(map(tuple, got.collect())) == plain_words(rows, 7, 2, misspell)
    assert spelling.corpus_words(docs.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("abzé"), min_size=1, max_size=6), min_size=1, max_size=8))
def test_edits_are_hashed_as_they_are_spelled(words):
    seen = []

    def test(h, length):
        seen.append((length, h))
        return np.arange(len(h))

    spelled = list(spelling.edits(words, test))
    assert len(spelled) == sum(len(h) for _, h in seen) == len(set(spelled))
    at = 0
    for length, h in seen:
        for value in h:
            edit = spelled[at][1]
            assert len(edit) == length
            assert spelling.word_hash(spelling.letters([edit]))[0] == value if edit else True
            at += 1
    by_word = {}
    for row, edit in spelled:
        by_word.setdefault(row, set()).add(edit)
    for row, word in enumerate(words):
        want = {word[:i] + word[i + 1:] for i in range(len(word)) if len(word) > 1} | {
            word[:i] + c + word[i + 1:] for i in range(len(word)) for c in LETTERS if c > word[i]}
        assert by_word.get(row, set()) == want


def test_query_equals_its_sql(spark):
    from harvestry.llm.queries import ORACLE_SQL, QUERIES
    from tests.compare import difference
    name = "op13_spelling_variants"
    assert difference(spark, "/root/testdata/sf0.001", QUERIES[name], ORACLE_SQL[name]) is None
