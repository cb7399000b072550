"""Packing: invariants, number of sequences, token files read back."""

import bisect
import math
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from harvestry.llm import packing, token_files
from harvestry.session import store

TOKENIZERS = {f: Tokenizer.from_file(public_tokenizers.path(f))
              for f in ("byte_bpe_50k.json", "word_bpe_49k.json")}
for one in TOKENIZERS.values():
    one.encode_special_tokens = True
SCHEMA = "doc_id long, text string, piece int, item string"


def ids_of(file, text):
    return [*TOKENIZERS[file].encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def corpus(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["the", "Straße", "x1", "naïve,", "end.\n"]) for _ in range(n))
             for n in [0, 1, 3, 50, 200, 700, 1023, 1500, 9000] + [rng.randrange(900)
                                                                   for _ in range(120)]]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    rows += [(500, None, 1, "x"), (None, "null id", 1, "x"), (3, texts[3], 1, "x"),
             (None, None, 1, "x"), (-7, "tab\tand  spaces\r\n", 1, None)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def check(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pack_documents(spark):
    rows, docs = corpus(spark)
    found = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                   keep_ids=True).collect()
    check(found, 1024)
    want = []
    for name, text, *_ in rows:
        ids = ids_of("byte_bpe_50k.json", text)
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(name, i, a, b - a, crc(ids[a:b]))
                 for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(crc(r["ids"]) == r["ids_crc32"] for r in found)


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.pack_documents(docs, path).collect() == []


def test_number_of_sequences(spark):
    rng = np.random.default_rng(4)
    for lengths in (rng.integers(1, 1025, 6000), rng.integers(300, 700, 3000),
                    rng.integers(1, 128, 5000), np.full(999, 513), rng.geometric(0.004, 4000)):
        lengths = np.minimum(lengths, 1024)
        items = store(spark.createDataFrame(list(enumerate(lengths.tolist())),
                                            "item long, length long"), "t")
        found = packing.pack_lengths(items).join(items, "item").collect()
        assert len(found) == len(lengths)
        used, bins = check(found, 1024), []
        for size in sorted(lengths.tolist(), reverse=True):  # best fit decreasing
            at = bisect.bisect_left(bins, size)
            free = bins.pop(at) if at < len(bins) else 1024
            bisect.insort(bins, free - size)
        assert used <= len(bins) * 1.006 + 1, (used, len(bins), sum(lengths) / 1024)


def test_linear_groups_and_configurations():
    counts = {s: 7 for s in range(129, 1024)}
    rounded = packing.linear_groups(counts, 50)
    assert all(rounded[s] >= s for s in counts) and len(set(rounded.values())) <= 50
    grouped = {}
    for s, n in counts.items():
        grouped[rounded[s]] = grouped.get(rounded[s], 0) + n
    left = dict(grouped)
    for content, times in packing.configurations(grouped, 1024):
        assert sum(s * n for s, n in content.items()) <= 1024
        for s, n in content.items():
            left[s] -= n * times
    assert not any(left.values())


def test_token_files(spark, tmp_path):
    rows, docs = corpus(spark)
    path = str(tmp_path / "tokens")
    token_files.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    found = token_files.read_documents(spark, path).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = sorted(((r[0], ids_of("word_bpe_49k.json", r[1])) for r in ordered), key=repr)
    assert sorted(((r["doc_id"], r["ids"]) for r in found), key=repr) == want
    found.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [r[0] for r in ordered]
    sizes = [len(r["ids"]) for r in found]
    assert [r["start"] for r in found] == [sum(sizes[:i]) for i in range(len(sizes))]
    short = token_files.read_documents(spark, path, token_files.ids_crc32, "long").collect()
    assert sorted((r["start"], r["n_tokens"], r["value"]) for r in short) == [
        (r["start"], len(r["ids"]), crc(r["ids"])) for r in found]


def test_no_token_files(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(spark.createDataFrame([], SCHEMA), path,
                                  public_tokenizers.path("word_bpe_49k.json"))
    assert token_files.read_documents(spark, path).collect() == []


def test_bound_of_whole_table(spark):
    from harvestry.llm.queries import op7_best_fit_packing
    found = op7_best_fit_packing(spark, "/root/testdata/sf0.01").collect()
    least = math.ceil(sum(r["length"] for r in found) / 1024)
    assert check(found, 1024) <= least * 1.01
