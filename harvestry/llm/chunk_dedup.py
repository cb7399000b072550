"""Substring deduplication by content-defined chunking.

A gear hash rolls over a text's bytes: the hash at a byte depends on the WINDOW bytes up to it
only. A chunk ends where bits of the hash are zero and no other such place lies less than
``least`` bytes before, so that chunk ends depend on nearby content alone and an insertion
moves only the chunks it touches. Stretches without such a place, periodic ones among them, are
cut at the lowest hash of each SPLIT places, so that no chunk is long. Chunks are deduplicated
by digest: the first occurrence, in order of document and place, stays. A later occurrence is
extended byte by byte along the first one; what is long enough then is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestry.session import ship_package, store

#: Bytes the hash looks back, mean gap of candidate ends in bytes, bytes between ends at least.
WINDOW, MEAN, LEAST = 16, 32, 16
#: Repeated bytes in a row that are reported and removed: longer than a line of stock words.
RUN = 120
#: Windows of places that get an end of their own where the hash names none, and bytes a match is
#: extended to either side: more than two chunks, hence past the ends of the passage.
SPLIT, EDGE = 32, 160
_X = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
GEAR = ((_X ^ _X >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(
    np.uint32)
AT_ONCE = 1 << 20

CHUNKS = "row long, doc_id long, chunk int, start int, length int, digest long"


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte, over it and the WINDOW - 1 bytes before."""
    out = GEAR[data]
    span = 1  # bytes the hash covers; WINDOW is a power of two
    while span < min(WINDOW, len(data)):
        wider = out.copy()
        wider[span:] += out[:-span] << np.uint32(span)
        out, span = wider, 2 * span
    return out


def chunk_ends(raw: bytes, mean: int = MEAN, least: int = LEAST) -> np.ndarray:
    """Ends of the chunks of ``raw``, its length the last; ends stand between characters."""
    data, found = np.frombuffer(raw, np.uint8), []
    mask = np.uint32((mean - 1) << (WINDOW - 5))
    for low in range(0, len(data), AT_ONCE):
        first = max(0, low - WINDOW + 1)
        hashes = gear(data[first:low + AT_ONCE])[low - first:]
        ends = np.flatnonzero((hashes & mask) == 0) + low + 1
        ends = ends[ends < len(data)]
        found.append(ends[data[ends] & 0xC0 != 0x80])
    ends = np.concatenate(found) if found else np.zeros(0, np.int64)
    if len(ends):
        ends = ends[np.diff(ends, prepend=-least) >= least]
    return np.append(ends, len(data)) if len(data) else ends


def split_ends(raw: bytes, ends: np.ndarray, least: int = LEAST, split: int = SPLIT) -> np.ndarray:
    """``ends`` and, in chunks longer than ``split`` + 2 * ``least``, the place of the lowest hash
    of every ``split`` places that lie ``least`` bytes off the chunk's ends. Of equal hashes, as
    in periodic text, only every last within ``split`` places is taken."""
    begins = np.concatenate([[0], ends[:-1]])
    long_ = np.flatnonzero(ends - begins >= split + 2 * least)
    if not len(long_):
        return ends
    data = np.frombuffer(raw, np.uint8)
    firsts, lasts = begins[long_] + least, ends[long_] - least - split + 1
    found, ranks = [], []
    for low in range(int(firsts[0]), int(lasts[-1]) + 1, AT_ONCE):
        high = min(low + AT_ONCE, int(lasts[-1]) + 1)  # windows of places from low to high - 1
        a, b = np.maximum(firsts, low), np.minimum(lasts + 1, high)
        a, b = a[a < b], b[a < b]
        if not len(a):
            continue
        # An end's hash is that of the byte before it.
        stop, first = high + split - 1, max(0, low - WINDOW)
        hashes = gear(data[first:stop])[low - 1 - first:stop - 1 - first]
        rank = (hashes * np.uint32(0x9E3779B1)).astype(np.uint64)
        rank[data[low:stop] & 0xC0 == 0x80] = 1 << 32
        key = rank << np.uint64(24) | np.arange(len(rank), 0, -1, dtype=np.uint64)
        span = 1
        while span < split:
            step = min(span, split - span)
            key, span = np.minimum(key[:-step], key[step:]), span + step
        at = np.repeat(a - low - np.cumsum(b - a) + (b - a), b - a)
        key = key[at + np.arange(len(at))]  # their places ascend
        key = key[np.append(True, key[1:] != key[:-1])]
        found.append(len(rank) - (key & np.uint64((1 << 24) - 1)).astype(np.int64) + low)
        ranks.append(key >> np.uint64(24))
    places, ranks = np.concatenate(found), np.concatenate(ranks)
    if len(found) > 1:  # a window of one block may name the place that one of the next names
        one = np.append(True, places[1:] != places[:-1])
        places, ranks = places[one], ranks[one]
    # No small chunks: of places nearer than ``least`` the lowest hash counts.
    while len(places) > 1:
        near = np.diff(places) < least
        spare = (np.append(near & (ranks[1:] < ranks[:-1]), False)
                 | np.insert(near & (ranks[:-1] < ranks[1:]), 0, False))
        if not spare.any():
            break
        places, ranks = places[~spare], ranks[~spare]
    if len(places) > 1 and (ranks[1:] == ranks[:-1]).any():
        kept, rank = [], None
        held, order = places.tolist(), ranks.tolist()
        for i, place in enumerate(held):
            spare = (rank == order[i] and i + 1 < len(held) and order[i + 1] == rank
                     and held[i + 1] - kept[-1] <= split)
            if not spare:
                kept.append(place)
                rank = order[i]
        places = np.array(kept)
    return np.sort(np.concatenate([ends, places]))


def numbered(documents: DataFrame) -> DataFrame:
    """``documents`` as a table of ``row`` (unique, in the table's order), ``doc_id``, ``text``."""
    return store(documents.select(F.monotonically_increasing_id().alias("row"),
                                  F.col("doc_id").cast("long"), "text"), "dedup_rows", codec="zstd")


def chunks(texts: DataFrame) -> DataFrame:
    """A row per chunk of every text (``row``, ``doc_id``, ``text``): place in bytes and a
    digest. A null or empty text has none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, names = batch.column(0), batch.column(1)
            owner, number, starts, lengths, digests = [], [], [], [], []

            def packed(owner=owner, number=number, starts=starts, lengths=lengths,
                       digests=digests, rows=rows, names=names):
                at = pa.array(np.repeat(*map(np.array, zip(*owner, strict=True))))
                out = pa.RecordBatch.from_arrays(
                    [rows.take(at), names.take(at), *(
                        pa.array(np.concatenate(x).astype(np.int32))
                        for x in (number, starts, lengths)),
                     pa.array(np.array(digests, np.uint64).view(np.int64))],
                    names=[f.split()[0] for f in CHUNKS.split(", ")])
                for held in (owner, number, starts, lengths, digests):
                    held.clear()
                return out

            for at, text in enumerate(batch.column(2).to_pylist()):
                if not text:
                    continue
                raw = text.encode("utf-8", "surrogatepass")
                ends = split_ends(raw, chunk_ends(raw))
                begins = np.concatenate([[0], ends[:-1]])
                owner.append((at, len(ends)))
                number.append(np.arange(len(ends)))
                starts.append(begins)
                lengths.append(ends - begins)
                digests += [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(
                    begins.tolist(), ends.tolist(), strict=True)]
                if len(digests) > 200_000:
                    yield packed()
            if owner:
                yield packed()

    ship_package(texts.sparkSession)
    return texts.select("row", "doc_id", "text").mapInArrow(run, CHUNKS)


def common_end(a: bytes, b: bytes) -> int:
    """Bytes at the ends of both that are equal."""
    most = min(len(a), len(b))
    for back in range(1, most + 1):
        if a[-back] != b[-back]:
            return back - 1
    return most


def extended(raw: bytes, start: int, length: int, left: bytes, right: bytes) -> tuple[int, int]:
    """(start, end) of a match in ``raw``, extended by the bytes it shares with those ``left`` and
    ``right`` of the first occurrence; both stand between characters."""
    end = start + length
    start -= common_end(raw[max(0, start - len(left)):start], left)
    end += common_end(raw[end:end + len(right)][::-1], right[:len(raw) - end][::-1])
    while start < end and raw[start] & 0xC0 == 0x80:
        start += 1
    while end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


def passages(raw: bytes, matches: list[dict], run: int) -> list[list]:
    """[start, end, chunks, first_doc_id] of what ``matches`` of one text cover: runs of chunks in
    a row, and matches as extended, of ``run`` bytes or more; joined where they meet."""
    matches = sorted(matches, key=lambda m: m["start"])
    rows, spans = [], []  # rows: runs of chunks in a row, whatever their first occurrences
    for m in matches:
        if rows and rows[-1][1] == m["start"]:
            rows[-1][1] += m["length"]
        else:
            rows.append([m["start"], m["start"] + m["length"]])
    at = 0
    for m in matches:
        while rows[at][1] <= m["start"]:
            at += 1
        start, end = extended(raw, m["start"], m["length"], m["left"], m["right"])
        if end - start >= run:
            spans.append([start, end, m["n"], m["first_doc_id"]])
        elif rows[at][1] - rows[at][0] >= run:
            spans.append([m["start"], m["start"] + m["length"], m["n"], m["first_doc_id"]])
    out: list[list] = []
    for span in sorted(spans, key=lambda s: s[:2]):
        if out and span[0] <= out[-1][1]:
            last = out[-1]
            if span[3] != last[3] and span[0] < last[1]:
                # Ends that differ by less than a chunk are chance: those of the longer count.
                longer = span[1] - span[0] > last[1] - last[0]
                if longer and span[0] - last[0] < LEAST:
                    last[0] = span[0]
                elif not longer and 0 < span[1] - last[1] < LEAST:
                    span[1] = last[1]
            last[1], last[2] = max(last[1], span[1]), last[2] + span[2]
            last[3] = min((x for x in (last[3], span[3]) if x is not None), default=None)
        else:
            out.append(span)
    return out


FOUND = "row long, doc_id long, start long, length long, n_chunks long, first_doc_id long"


def repeats(documents: DataFrame, run: int = RUN, within: bool = False) -> DataFrame:
    """Passages that stand in an earlier document (or, ``within``, earlier in their own): ``row``, ``doc_id``, ``start``, ``length``
    (bytes of the UTF-8 text), ``n_chunks``, ``first_doc_id`` (the first document
    with one of its chunks).

    Earlier is by (doc_id with nulls first, row, start): of equal texts the first is left
    alone. A match is a run of chunks that follow one another in the first occurrence too,
    extended by the equal bytes around it. Matches of ``run`` bytes or more, and runs of repeated
    chunks of so many bytes, make the passages. Repeated ids are separate documents.
    No rows, no passages; other columns are not read."""
    return repeats_of(numbered(documents), run, within)


def repeats_of(texts: DataFrame, run: int, within: bool) -> DataFrame:
    """``repeats`` of a stored table of ``row``, ``doc_id`` and ``text``."""
    held = store(chunks(texts), "dedup_chunks", codec="zstd")
    place = F.struct(F.col("doc_id").alias("doc_id"), F.col("row").alias("row"),
                     F.col("start").alias("start"))
    # A hot chunk arrives as one row per task; the table lets the join below split its rows.
    first = store(held.groupBy("digest").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "digest", "first"), "dedup_first", free=True)
    own = F.col("start") != F.col("first.start") if within else F.lit(False)
    later = held.join(first, "digest").where((F.col("row") != F.col("first.row")) | own)
    # Chunks in a row that keep their distance to the first occurrence share chunk number minus
    # rank among those of that distance.
    order = Window.partitionBy("row", "first_row", "apart").orderBy("chunk")
    later = later.select("row", "chunk", "start", "length",
                         F.col("first.doc_id").alias("first_doc_id"),
                         F.col("first.row").alias("first_row"),
                         (F.col("start") - F.col("first.start")).alias("apart"))
    later = later.withColumn("island", F.col("chunk") - F.row_number().over(order))
    matches = store(later.groupBy("row", "first_row", "apart", "island").agg(
        F.min("start").alias("start"), F.sum("length").alias("length"),
        F.count(F.lit(1)).alias("n"), F.min("first_doc_id").alias("first_doc_id")).select(
        "row", "start", "length", "n", "first_doc_id", "first_row",
        (F.col("start") - F.col("apart")).alias("first_start")), "dedup_matches", free=True)
    around = store(surroundings(texts, matches), "dedup_around", codec="zstd", free=True)
    matches = matches.join(around, ["first_row", "first_start", "length"]).groupBy("row").agg(
        F.collect_list(F.struct("start", "length", "n", "first_doc_id", "left", "right",
                                "whole")).alias("matches"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row, name, text, near = (c[at].as_py() for c in batch.columns)
                raw = text.encode("utf-8", "surrogatepass")
                # The short digest only proposes: the bytes of a match have a longer one.
                near = [m for m in near if m["whole"] == xxhash.xxh3_128_digest(
                    raw[m["start"]:m["start"] + m["length"]])]
                found = passages(raw, near, run)
                starts, ends, counts, firsts = zip(*found, strict=True) if found else [()] * 4
                yield pa.RecordBatch.from_arrays([
                    pa.array(x, pa.int64()) for x in (
                        [row] * len(found), [name] * len(found), starts,
                        [b - a for a, b in zip(starts, ends, strict=True)], counts, firsts)],
                    names=[f.split()[0] for f in FOUND.split(", ")])

    return texts.join(matches, "row").select("row", "doc_id", "text", "matches").mapInArrow(
        find, FOUND)


AROUND = ("first_row long, first_start long, length long, left binary, right binary, "
          "whole binary")
AROUND_NAMES = [field.split()[0] for field in AROUND.split(", ")]


def surroundings(texts: DataFrame, matches: DataFrame) -> DataFrame:
    """The EDGE bytes ``left`` and ``right`` of each distinct first occurrence, and a 128-bit
    digest of its bytes, ``whole``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                raw = batch.column(1)[at].as_py().encode("utf-8", "surrogatepass")
                spans = batch.column(2)[at].as_py()
                for low in range(0, len(spans), 10_000):
                    some = [(x["first_start"], x["length"]) for x in spans[low:low + 10_000]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([batch.column(0)[at].as_py()] * len(some), pa.int64()),
                        pa.array([a for a, _ in some], pa.int64()),
                        pa.array([n for _, n in some], pa.int64()),
                        pa.array([raw[max(0, a - EDGE):a] for a, _ in some], pa.binary()),
                        pa.array([raw[a + n:a + n + EDGE] for a, n in some], pa.binary()),
                        pa.array([xxhash.xxh3_128_digest(raw[a:a + n]) for a, n in some],
                                 pa.binary())], names=AROUND_NAMES)

    asked = matches.select("first_row", "first_start", "length").distinct().groupBy(
        F.col("first_row").alias("row")).agg(
        F.collect_list(F.struct("first_start", "length")).alias("spans"))
    return texts.join(asked, "row").select("row", "text", "spans").mapInArrow(
        cut, AROUND)


def remove_spans(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``raw`` without the (start, length) spans."""
    out, at = [], 0
    for start, length in sorted(spans):
        out.append(raw[at:start])
        at = start + length
    return b"".join([*out, raw[at:]])


def deduplicated(documents: DataFrame, run: int = RUN, within: bool = False) -> DataFrame:
    """``documents`` with repeated passages cut out of ``text``; all rows and columns stay."""
    kept = store(documents.select(
        F.monotonically_increasing_id().alias("place"),
        F.struct(*[F.col(f"`{n}`") for n in documents.columns]).alias("row")), "dedup_texts")
    # The place stands in for the id: it is unique and follows the table's order.
    spans = repeats_of(kept.select(F.col("place").alias("row"), F.col("place").alias("doc_id"),
                                   F.col("row.text").alias("text")), run, within).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "length")).alias("spans"))
    joined = kept.join(spans, F.col("place") == F.col("doc_id"), "left").select("row", "spans")

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd
        return pd.Series([
            t if t is None or s is None else remove_spans(
                t.encode("utf-8", "surrogatepass"), [(x["start"], x["length"]) for x in s])
            .decode("utf-8", "surrogatepass") for t, s in zip(texts, spans, strict=True)])

    return joined.select(*[
        cut("row.text", "spans").alias(n) if n == "text" else F.col(f"row.`{n}`")
        for n in documents.columns])
