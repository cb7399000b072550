"""Token-id files: concatenated ids with Elias-Fano coded document boundaries.

Documents are range-partitioned by id, each task encodes its texts in order and cuts them
into shards. A shard is one binary image: header, ids (2 bytes each where the vocabulary
allows, else 4), Elias-Fano coded document ends and Elias-Fano coded document ids. Images are
rows of a Parquet table, which Spark's committer writes atomically to any file system.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harvestry.llm.encode import encoder, with_end
from harvestry.session import ship_package

MAGIC = b"TOKIDS1\0"
HEADER = "<8sBQQQq"
#: A select structure keeps the place of every so many-th set bit.
SAMPLE = 256
SHARD_IDS = 2_000_000

IMAGES = "part int, shard int, n_docs long, n_ids long, image binary"


class EliasFano:
    """A non-decreasing sequence of non-negative integers in about 2 + log2(u / n) bits each:
    low bits packed, high bits in unary with sampled positions for select."""

    HEAD = "<QBQ"

    def __init__(self, image: bytes):
        self.n, self.low_bits, high_bytes = struct.unpack_from(self.HEAD, image)
        at = struct.calcsize(self.HEAD)
        low_bytes = (self.n * self.low_bits + 7) // 8
        samples = (self.n + SAMPLE - 1) // SAMPLE
        self.low = np.frombuffer(image, np.uint8, low_bytes, at)
        self.high = np.frombuffer(image, np.uint8, high_bytes, at + low_bytes)
        self.samples = np.frombuffer(image, "<u4", samples, at + low_bytes + high_bytes)

    @classmethod
    def pack(cls, values: np.ndarray) -> bytes:
        n = len(values)
        if not n:
            return struct.pack(cls.HEAD, 0, 0, 0)
        low_bits = max(0, int((int(values[-1]) + 1) // n).bit_length() - 1)
        low = ((values[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8)
        places = (values >> low_bits) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1, np.uint8)
        unary[places] = 1
        high = np.packbits(unary, bitorder="little")
        return b"".join((struct.pack(cls.HEAD, n, low_bits, len(high)),
                         np.packbits(low.ravel(), bitorder="little").tobytes(),
                         high.tobytes(), places[::SAMPLE].astype("<u4").tobytes()))

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, np.int64)
        start, stop = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[start // 8:(stop + 7) // 8], bitorder="little")
        bits = bits[start % 8:start % 8 + stop - start].reshape(-1, self.low_bits)
        return bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))

    def select(self, i: int) -> int:
        """The i-th value, reading from the sampled place before it."""
        start = int(self.samples[i // SAMPLE])
        wanted, byte = i % SAMPLE, start // 8
        skip = start % 8
        while True:
            bits = np.unpackbits(self.high[byte:byte + 64], bitorder="little")
            bits[:skip] = 0
            ones = np.flatnonzero(bits)
            if wanted < len(ones):
                place = byte * 8 + int(ones[wanted])
                return (place - i << self.low_bits) | int(self._low(i, i + 1)[0])
            wanted, byte, skip = wanted - len(ones), byte + 64, 0

    def between(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last`` - 1, reading between the sampled places around them."""
        if first >= last:
            return np.zeros(0, np.int64)
        start, after = int(self.samples[first // SAMPLE]), -(-last // SAMPLE)
        stop = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[start // 8:(stop + 7) // 8], bitorder="little")
        bits[:start % 8] = 0
        ones = np.flatnonzero(bits)[first % SAMPLE:][:last - first]
        return (ones + start // 8 * 8 - np.arange(first, last) << self.low_bits) | self._low(
            first, last)

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        return (places - np.arange(self.n) << self.low_bits) | self._low(0, self.n)


def pack_image(doc_ids: np.ndarray, n_null: int, lengths: np.ndarray, ids: np.ndarray,
               width: int) -> bytes:
    """``doc_ids``: ascending ids of all documents but the first ``n_null``."""
    first = int(doc_ids[0]) if len(doc_ids) else 0
    coded = ids.astype("<u2" if width == 2 else "<u4").tobytes()
    parts = [coded, EliasFano.pack(np.cumsum(lengths)), EliasFano.pack(doc_ids - first)]
    head = struct.pack(HEADER, MAGIC, width, len(lengths), n_null, len(ids), first)
    return head + b"".join(struct.pack("<Q", len(p)) + p for p in parts)


def open_parts(image: bytes):
    """(number of null doc ids, what to add to the others, these, document ends, ids) of a shard;
    the others and the ends Elias-Fano coded."""
    magic, width, n_docs, n_null, n_ids, first = struct.unpack_from(HEADER, image)
    if magic != MAGIC:
        raise ValueError("not a token-id shard")
    at, parts = struct.calcsize(HEADER), []
    for _ in range(3):
        size, = struct.unpack_from("<Q", image, at)
        parts.append(memoryview(image)[at + 8:at + 8 + size])
        at += 8 + size
    ids = np.frombuffer(parts[0], "<u2" if width == 2 else "<u4", n_ids)
    return n_null, first, EliasFano(bytes(parts[2])), EliasFano(bytes(parts[1])), ids


def open_image(image: bytes):
    """(doc ids with None for null, Elias-Fano document ends, ids) of a shard."""
    n_null, first, known, ends, ids = open_parts(image)
    known = known.all() + first if known.n else np.zeros(0, np.int64)
    return [None] * n_null + known.tolist(), ends, ids


def token_images(documents: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Shards of all documents (``doc_id``, ``text``) in ascending order of doc_id, nulls
    first, rows of one id by a hash of their text. A null text is empty; each document ends
    with ``end_id``, so none is without ids. No rows, no shards."""
    ordered = (documents.select("doc_id", "text", F.xxhash64("text").alias("tie"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text")
               .select("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        coder, part = encoder(tokenizer), TaskContext.get().partitionId()
        width = 2 if max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        held, count, shard = [], 0, 0

        def image():
            names = np.concatenate([h[0] for h in held])
            null = np.concatenate([h[1] for h in held])
            lengths = np.concatenate([h[2] for h in held])
            ids = np.concatenate([h[3] for h in held])
            packed = pack_image(names[~null], int(null.sum()), lengths, ids, width)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()),
                 pa.array([len(lengths)], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([packed], pa.binary())], names=IMAGE_NAMES)

        for batch in batches:
            names = batch.column(0)
            null = names.is_null().to_numpy(zero_copy_only=False)
            values = names.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for row, ids, lengths in coder.encode(batch.column(1)):
                span = slice(row, row + len(lengths))
                ids, lengths = with_end(ids, lengths, end_id)
                held.append((values[span], null[span], lengths, ids))
                count += len(ids)
                if count >= SHARD_IDS:
                    yield image()
                    held, count, shard = [], 0, shard + 1
        if held:
            yield image()

    ship_package(documents.sparkSession)
    return ordered.mapInArrow(write, IMAGES)


IMAGE_NAMES = [field.split()[0] for field in IMAGES.split(", ")]


def write_token_files(documents: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    token_images(documents, tokenizer, end_id).write.mode("overwrite").parquet(path)


def read_documents(spark: SparkSession, path: str, reduce=None, result: str | None = None,
                   ) -> DataFrame:
    """Documents back from the files: ``doc_id``, ``start`` (ids of all documents before) and
    ``ids``; or, with ``reduce`` (a function of a document's uint32 ids) and its SQL type
    ``result``, ``n_tokens`` and ``value`` in place of the ids."""
    files = spark.read.schema(IMAGES).parquet(path)
    tail = "value " + result if reduce else "ids array<long>"

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, image in zip(*(batch.column(i).to_pylist() for i in range(3)),
                                          strict=True):
                n_null, first, known, coded, ids = open_parts(image)
                start = 0
                for low in range(0, coded.n, 4096):
                    high = min(low + 4096, coded.n)
                    ends = coded.between(low, high)
                    starts = np.concatenate([[start], ends[:-1]])
                    start = int(ends[-1])
                    names = [None] * max(0, min(high, n_null) - low) + (first + known.between(
                        max(0, low - n_null), max(0, high - n_null))).tolist()
                    own = [ids[a:b].astype("<u4") for a, b in zip(
                        starts.tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * len(own), pa.int32()),
                         pa.array([shard] * len(own), pa.int32()),
                         pa.array(names, pa.int64()),
                         pa.array(starts, pa.int64()),
                         pa.array([len(o) for o in own], pa.int64()),
                         pa.array([reduce(o) for o in own]) if reduce else
                         pa.array([o.astype(np.int64) for o in own], pa.list_(pa.int64()))],
                        names=["part", "shard", "doc_id", "place", "n_tokens",
                               "value" if reduce else "ids"])

    ship_package(spark)
    rows = files.select("part", "shard", "image").mapInArrow(
        unpack, f"part int, shard int, doc_id long, place long, n_tokens long, {tail}")
    # Ids before a shard: a running sum over parts (one row each), then over a part's shards.
    sizes = files.select("part", "shard", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.select("part", "shard", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
                          .alias("shard_start")).join(parts, "part")
    return rows.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("part_start") + F.col("shard_start") + F.col("place")).alias("start"),
        "n_tokens", *(["value"] if reduce else ["ids"]))


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
