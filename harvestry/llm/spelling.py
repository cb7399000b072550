"""Spelling variants: words one edit apart, and the frequent form each rare word leads to.

Generated edits are probed against Bloom filters of the vocabulary, one shard of blocks per
word length, which travel to the tasks as a broadcast of bounded size; only what the filters
let through is shuffled, to an exact join with the vocabulary that removes false positives.
Being one edit apart is mutual, so a word probes its deletions, and of its replacements those
with a later letter; the pairs found stand for both directions.

A vocabulary whose filters pass the bound is probed in several passes, each with the shards
(or slices of a shard) that fit; nothing is left out. Hashes of edits come from prefix sums of
a polynomial hash, so an edit is only spelled out once a filter lets it through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.session import discard, ship_package, store

#: Letters of a word after lower-casing A-Z, and a run of them before it.
ALPHABET = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Filter bits per word; a block is 8 words of 64 bits, with one bit per key in each.
BITS, BLOCK = 16, 512
#: Most blocks in one broadcast (64 bytes each); words of this length or more share a shard.
MOST_BLOCKS, LONGEST = 1 << 19, 64
#: Edits hashed at once.
AT_ONCE = 1 << 20

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def corpus_words(documents: DataFrame, least_length: int = 7, least_count: int = 2,
                 misspell: int | None = None) -> DataFrame:
    """``word``, ``n``: runs of letters in the whole texts, A-Z lower-cased, of at least
    ``least_length`` letters and found at least ``least_count`` times.

    With ``misspell``, runs lose a letter where that number divides the crc32 of
    ``<doc_id>:<run>`` (a null id writes as nothing). A null or empty text has no words; rows
    that repeat an id are counted each; other columns are not read."""
    found = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                             F.explode(F.regexp_extract_all(
                                 "text", F.lit(f"{RUN}{{{least_length},}}"), F.lit(0)))
                             .alias("run"))
    runs = found.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    word = F.col("run") if misspell is None else shortened("run", "id", misspell)
    counted = runs.select(word.alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= least_count)
                         & (F.char_length("word") >= least_length))


def shortened(run: str, ident: str, every: int) -> Column:
    """The run without one letter, where ``every`` divides the crc32 of id, colon and run."""
    h = F.crc32(F.concat(F.col(ident), F.lit(":"), F.col(run)))
    place = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(F.col(run), F.lit(1), place),
                   F.substring(F.col(run), place + 2, F.char_length(run)))
    return F.when(h % every == 0, cut).otherwise(F.col(run))


def shard_of(length):
    return np.minimum(length, LONGEST)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(length: int) -> np.ndarray:
    out = np.full(max(length, 1), BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hash(codes: np.ndarray) -> np.ndarray:
    """Of words of one length, one per row of letters."""
    return (codes * powers(codes.shape[1])[:codes.shape[1]]).sum(axis=1, dtype=np.uint64)


class Filters:
    """Where a hash lies: its block among those of its length's shard, and its bit in each of
    the block's eight words."""

    def __init__(self, blocks: dict[int, int]):
        self.blocks, at = {}, 0
        for shard in sorted(blocks):
            self.blocks[shard] = (at, blocks[shard])
            at += blocks[shard]
        self.total = at

    def place(self, h: np.ndarray, shard: int) -> tuple[np.ndarray, np.ndarray]:
        first, count = self.blocks[shard]
        mixed = _mix(h)
        block = ((mixed >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        return block.astype(np.int64) + first, _mix(mixed)

    def bits(self, mixed: np.ndarray) -> Iterator[np.ndarray]:
        for j in range(8):
            yield np.uint64(1) << ((mixed >> np.uint64(6 * j)) & np.uint64(63))

    def test(self, table: np.ndarray, low: int, h: np.ndarray, shard: int) -> np.ndarray:
        """Indices of the hashes that the blocks of ``table`` (from block ``low``) let through."""
        if shard not in self.blocks or not len(h):
            return np.zeros(0, np.int64)
        block, mixed = self.place(h, shard)
        block -= low
        alive = np.flatnonzero((block >= 0) & (block < len(table)))
        for j in range(8):
            bit = np.uint64(1) << ((mixed[alive] >> np.uint64(6 * j)) & np.uint64(63))
            alive = alive[(table[block[alive], j] & bit) != 0]
        return alive


def by_length(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    held: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        held.setdefault(len(word), []).append(at)
    yield from held.items()


def letters(words: list[str]) -> np.ndarray:
    """Letters of words of one length, a row per word."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat.reshape(len(words), -1).astype(np.uint64)


def plan(words: DataFrame) -> Filters:
    """Blocks per shard, from the number of words of each length (at most ``LONGEST`` rows)."""
    counts = words.groupBy(F.least(F.char_length("word"), F.lit(LONGEST)).alias("shard")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    return Filters({row["shard"]: -(-row["n"] * BITS // BLOCK) for row in counts})


def filter_blocks(words: DataFrame, filters: Filters) -> DataFrame:
    """The filters as rows ``block``, ``w0`` to ``w7``: words combined before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_pylist()
            for length, rows in by_length(held):
                h = word_hash(letters([held[r] for r in rows]))
                block, mixed = filters.place(h, int(shard_of(length)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block), *(pa.array(b.view(np.int64)) for b in
                                        filters.bits(mixed))],
                    names=["block", *(f"w{j}" for j in range(8))])

    masks = words.select("word").mapInArrow(
        run, "block long, " + ", ".join(f"w{j} long" for j in range(8)))
    return masks.groupBy("block").agg(*[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(8)])


def loaded(blocks: DataFrame, low: int, high: int) -> np.ndarray:
    """Blocks ``low`` to ``high`` as one array, at most ``MOST_BLOCKS`` rows of it."""
    rows = blocks.where(F.col("block").between(low, high - 1)).toArrow()
    table = np.zeros((high - low, 8), np.uint64)
    at = rows.column("block").to_numpy() - low
    for j in range(8):
        table[at, j] = rows.column(f"w{j}").to_numpy().view(np.uint64)
    return table


def edits(words: list[str], test) -> Iterator[tuple[int, str]]:
    """(index of the word, edit) for the deletions and the replacements by a later letter of
    ``words`` that ``test`` (hashes, length) lets through; each distinct edit once."""
    alphabet = np.array(ALPHABET, np.uint64)
    for length, rows in by_length(words):
        if not length:
            continue
        power = powers(length + 1)
        step = max(1, AT_ONCE // (length * len(alphabet)))
        for low in range(0, len(rows), step):
            some = rows[low:low + step]
            codes = letters([words[r] for r in some])
            terms = codes * power[:length]
            total = terms.sum(axis=1, dtype=np.uint64)
            before = np.cumsum(terms, axis=1, dtype=np.uint64)
            if length > 1:
                # Of equal neighbours only the last one's deletion: the others spell the same.
                last = np.ones(codes.shape, bool)
                last[:, :-1] = codes[:, :-1] != codes[:, 1:]
                cut = (before - terms) + (total[:, None] - before) * np.uint64(INVERSE)
                own, place = np.nonzero(last)
                for at in test(cut[own, place], length - 1):
                    word, i = words[some[own[at]]], place[at]
                    yield some[own[at]], word[:i] + word[i + 1:]
            wide = max(1, AT_ONCE // (len(some) * len(alphabet)))
            for left in range(0, length, wide):
                part = codes[:, left:left + wide]
                own, place, letter = np.nonzero(alphabet[None, None, :] > part[:, :, None])
                h = total[own] + (alphabet[letter] - part[own, place]) * power[left + place]
                for at in test(h, length):
                    word, i = words[some[own[at]]], left + place[at]
                    yield some[own[at]], word[:i] + chr(ALPHABET[letter[at]]) + word[i + 1:]


def near_words(words: DataFrame, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``a``, ``na``, ``b``, ``nb``: all ordered pairs of ``words`` (``word`` distinct, ``n``; a
    stored table) that differ by exactly one inserted, deleted or replaced letter.

    ``most_blocks`` bounds what one pass broadcasts; the number of passes grows with the
    vocabulary instead."""
    spark = words.sparkSession
    ship_package(spark)
    filters = plan(words)
    blocks = store(filter_blocks(words, filters), "spelling_filters")
    found = None
    for low in range(0, filters.total, most_blocks):
        high = min(low + most_blocks, filters.total)
        sent = spark.sparkContext.broadcast(loaded(blocks, low, high))

        def probe(batches: Iterator[pa.RecordBatch], low=low, sent=sent):
            def test(h, length):
                return filters.test(sent.value, low, h, int(shard_of(length)))

            for batch in batches:
                held = batch.column(0).to_pylist()
                rows, spelled = [], []
                for at, edit in edits(held, test):
                    rows.append(at)
                    spelled.append(edit)
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(spelled, pa.string())], names=["a", "na", "edit"])

        lengths = [shard for shard, (at, count) in filters.blocks.items()
                   if at < high and at + count > low]
        length = F.least(F.char_length("word"), F.lit(LONGEST))
        reach = length.between(min(lengths), min(max(lengths) + 1, LONGEST))
        positive = store(words.where(reach).select("word", "n").repartition("word").mapInArrow(
            probe, "a string, na long, edit string"), "spelling_positives")
        sent.unpersist()
        exact = positive.join(words.select(F.col("word").alias("edit"),
                                           F.col("n").alias("nb")), "edit")
        pairs = exact.select("a", "na", F.col("edit").alias("b"), "nb")
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        found = words.select(F.col("word").alias("a"), F.col("n").alias("na"),
                             F.col("word").alias("b"), F.col("n").alias("nb")).where("false")
    return found.unionByName(found.select(
        F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"),
        F.col("na").alias("nb")))


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for the words of ``forms`` (``word``, ``form``): the last word on the
    way along the forms. Counts grow on that way, so it has no circles; the reach doubles."""
    reached = store(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = reached.join(ahead, "root", "left")
        moved = store(stepped.select("word", F.coalesce("further", "root").alias("root"),
                                     F.col("further").isNotNull().alias("moved")),
                      "spelling_roots")
        discard(reached)
        reached = moved
        if moved.where("moved").isEmpty():
            return moved.drop("moved")


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """Every word of ``words`` (``word`` distinct, ``n``) with its ``form``, ``root``, ``n``,
    ``n_near`` and ``form_n``.

    The form is the near word of largest ``n`` (ties: the smallest in code-point order), if
    that is at least ``ratio`` times the word's own, else null; the root is where forms lead,
    the word itself without one. Words are made of the letters of ``ALPHABET``, as
    :func:`corpus_words` gives them; a null or empty one is no word; no words, no rows.
    ``ratio`` must be above 1, so that forms lead upwards."""
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    words = store(words.where("word <> ''").select("word", "n"), "spelling_words")
    near = near_words(words)
    best = near.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(
        F.struct((-F.col("nb")).alias("down"), "b")).alias("best"))
    judged = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    form = F.when(-F.col("best.down") >= F.col("n") * ratio, F.col("best.b"))
    judged = store(judged.select(
        "word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long"))
        .alias("n_near"), F.when(form.isNotNull(), -F.col("best.down")).alias("form_n")),
        "spelling_forms")
    led = roots(judged.where("form is not null"))
    return judged.join(led, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
