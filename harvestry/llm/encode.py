"""Token ids of whole texts by a public tokenizer, encoding each distinct piece once.

Both byte-level and word-level pre-tokenisers cut a text at certain places whatever stands
around them: before white space that follows a non-space, and between a Latin letter and
ASCII punctuation. Texts are cut there, each distinct piece of a batch is encoded once by
the tokenizers library (results are kept in a bounded table), and the ids are laid out
again by numpy. A text with unusual white space or control characters is encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Where no pre-token can continue: a letter that is one in every Unicode version, then
#: ASCII punctuation.
LETTER_THEN_MARK = "([A-Za-zÀ-ÖØ-öø-ÿ])([!-/:-@\\[-`{-~])"
#: Texts that are encoded whole: a run of white space other than one space or line feed,
#: any control or non-ASCII space character.
UNUSUAL = re.compile(r"\s\s|[\x00-\x09\x0b-\x1f\x7f-\xa0]|[^\S \n]")
#: The same, as a quick test on a whole Arrow array; it may only err towards True.
UNUSUAL_ARROW = (r"[ \n][ \n]|[\x00-\x09\x0b-\x1f\x7f]|[\x{80}-\x{a0}\x{1680}\x{180e}"
                 r"\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{206f}\x{3000}\x{feff}]")
#: Text characters laid out at once, and pieces kept in the table of a Python worker.
BATCH_BYTES = 6_000_000
KEPT_PIECES = 1_200_000


class Encoder:
    """Encodes Arrow string arrays to (ids, lengths)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self._clear()

    def _clear(self):
        self.places: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)

    def _add(self, pieces: list[str]) -> None:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(
            pieces, add_special_tokens=False)]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ids = np.fromiter((i for one in encoded for i in one), np.uint32, int(sizes.sum()))
        first, count = len(self.places), len(pieces)
        while first + count > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.starts[first:first + count] = self.used + np.cumsum(sizes) - sizes
        self.lengths[first:first + count] = sizes
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.places.update(zip(pieces, range(first, first + count), strict=True))

    def _usual(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.replace_substring_regex(texts, LETTER_THEN_MARK, "\\1\0\\2")
        cut = pc.replace_substring(cut, " ", "\0 ")
        cut = pc.replace_substring(cut, "\n", "\0\n")
        lists = pc.split_pattern(cut, "\0")
        ends = lists.offsets.to_numpy().astype(np.int64)
        pieces = lists.flatten().dictionary_encode()
        words = pieces.dictionary.to_pylist()
        if len(self.places) + len(words) > KEPT_PIECES:
            self._clear()
        missing = [w for w in words if w not in self.places]
        if missing:
            self._add(missing)
        place = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        at = place[pieces.indices.to_numpy()]
        sizes = self.lengths[at]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        ids = self.flat[np.repeat(self.starts[at] - (stops - sizes), sizes)
                        + np.arange(total)]
        edges = np.concatenate([[0], stops])[ends - ends[0]]
        return ids, np.diff(edges)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: pa.Array):
        """Yields (first row, ids, lengths) for consecutive rows; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, UNUSUAL_ARROW).to_numpy(zero_copy_only=False)
        row, rows = 0, len(texts)
        while row < rows:
            if odd[row]:
                text = texts[row].as_py()
                if UNUSUAL.search(text):
                    ids = self._whole(text)
                    yield row, ids, np.array([len(ids)])
                else:
                    yield row, *self._usual(texts[row:row + 1])
                row += 1
                continue
            last, held = row, 0
            while last < rows and not odd[last] and (last == row or held < BATCH_BYTES):
                held += int(sizes[last])
                last += 1
            yield row, *self._usual(pa.concat_arrays([texts[row:last]]))
            row = last


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Free the pieces kept in this Python worker: workers outlive the operators they run, and
    what follows needs the memory."""
    _ENCODERS.clear()


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int):
    """The rows' ids, each followed by ``end_id``, and the new lengths."""
    stops = np.cumsum(lengths)
    return np.insert(ids, stops, end_id).astype(np.uint32), lengths + 1
