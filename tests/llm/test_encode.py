"""Token ids next to the library's own, and the Elias-Fano codes."""

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from harvestry.llm.encode import Encoder
from harvestry.llm.token_files import EliasFano, open_image, pack_image

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
CODERS = {f: Encoder(public_tokenizers.path(f)) for f in FILES}
PLAIN = {f: Tokenizer.from_file(public_tokenizers.path(f)) for f in FILES}
for one in PLAIN.values():
    one.encode_special_tokens = True

PARTS = st.sampled_from([
    "the", "Don't", "we'll", "ça", "É", "ñandú", "naïve", "é", "́", "日本語", "ﬁ", "İ", "ß",
    "1", "23", "½", "!", "...", "'s", "'", "''", "&amp;", "<|endoftext|>", "|", "$$$", " ", "  ",
    "\n", "\n\n", " \n", "\t", "\r\n", " ", " ", "​", "\x1c", "\x00", "\x85", "🙂", "-", "_"])


def ids_of(coder, texts):
    found = []
    for row, ids, lengths in coder.encode(pa.array(texts, pa.string())):
        assert row == len(found)
        found += [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
    return found


@pytest.mark.parametrize("file", FILES)
@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=12).map("".join), min_size=1, max_size=6))
def test_equal_to_the_library(file, texts):
    assert ids_of(CODERS[file], texts) == [
        PLAIN[file].encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("file", FILES)
def test_null_empty_and_long(file):
    texts = [None, "", "word " * 3000, None, "a"]
    want = [PLAIN[file].encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids_of(CODERS[file], texts) == want


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=700))
def test_elias_fano(steps):
    values = np.cumsum(np.array(steps, np.int64))
    coded = EliasFano(EliasFano.pack(values))
    assert coded.all().tolist() == values.tolist()
    assert [coded.select(i) for i in range(0, len(values), 7)] == values[::7].tolist()


def test_image_round_trip():
    lengths, ids = np.array([2, 1, 3]), np.array([5, 2, 2, 7, 8, 2], np.uint32)
    names, ends, found = open_image(pack_image(np.array([-4, 9]), 1, lengths, ids, 2))
    assert names == [None, -4, 9] and found.tolist() == ids.tolist()
    assert [ends.select(i) for i in range(3)] == [2, 3, 6]
    with pytest.raises(ValueError):
        open_image(b"x" * 60)


def test_documents_are_read_by_range_select(spark, tmp_path):
    from harvestry.llm import token_files
    rng = np.random.default_rng(9)
    values = np.cumsum(rng.integers(0, 90, 3000))
    coded = token_files.EliasFano(token_files.EliasFano.pack(values))
    for _ in range(200):
        a, b = sorted(rng.integers(0, 3001, 2).tolist())
        assert coded.between(a, b).tolist() == values[a:b].tolist()
    lengths = rng.integers(1, 4, 9000)
    image = token_files.pack_image(np.sort(rng.integers(-50, 10**12, 4000)), 5000, lengths,
                                   np.arange(lengths.sum()), 4)
    names, ends, _ = token_files.open_image(image)
    spark.createDataFrame([(0, 0, 9000, int(lengths.sum()), image)], token_files.IMAGES
                          ).write.parquet(str(tmp_path / "images"))
    rows = token_files.read_documents(spark, str(tmp_path / "images")).orderBy("start").collect()
    starts = [0, *ends.all().tolist()[:-1]]
    assert [(r["doc_id"], r["start"], r["ids"][0]) for r in rows] == list(
        zip(names, starts, starts, strict=True))
