"""Components next to a plain search, and the tables they write."""

import random

import pytest

from harvestry.llm import common


def plain(links):
    low = {v: v for link in links for v in link}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            return low


def found(spark, links, monkeypatch):
    """The components and the number of tables written for them."""
    labels, store = [], common.store
    monkeypatch.setattr(common, "store", lambda df, label: labels.append(label) or store(
        df, label))
    out = common.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len({r["id"] for r in out}) == len(out)
    return {r["id"]: r["component"] for r in out}, len(labels)


def test_stars_take_no_round(spark, monkeypatch):
    links = [(1, n) for n in range(2, 40)] + [(n, 50) for n in range(51, 60)] + [(2, 1), (7, 7)]
    want = plain([x for x in links if x[0] != x[1]])
    assert found(spark, links, monkeypatch) == (want, 1)


def test_rounds_end_with_the_first_stars(spark, monkeypatch):
    links = [(1, 2), (2, 3), (10, 30), (20, 30)]
    assert found(spark, links, monkeypatch) == (plain(links), 3)


@pytest.mark.parametrize("seed", range(4))
def test_equals_a_plain_search(spark, monkeypatch, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(12 * (seed + 1))]
    links += [(100 + n, 101 + n) for n in range(0, 25)] + [(500 - n, 499 - n) for n in range(9)]
    rng.shuffle(links)
    want = plain([x for x in links if x[0] != x[1]])
    assert found(spark, links, monkeypatch)[0] == want


def test_no_links(spark, monkeypatch):
    assert found(spark, [(3, 3), (None, 2)], monkeypatch) == ({}, 1)
