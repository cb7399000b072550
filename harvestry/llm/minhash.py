"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A sketch has ``BANDS`` * ``ROWS`` coordinates. Round by round every token of a set is hashed to
a coordinate and a value that lies above all values of earlier rounds; each coordinate keeps
its least value. Sets of some size are done after a round or two; after as many rounds as
coordinates, round t + i sends all tokens to coordinate i, so each one fills whatever the set.
Coordinates of two sets agree with the probability of their Jaccard similarity, independently
enough for the usual concentration bounds. Sets that agree in one band are candidates: at a
similarity of 0.8 a pair is missed with a probability of 1.3e-7.

Equal sets are one class from the start. In each band's buckets the members first meet one
leader each, which joins nearly all of a large group; links are verified on the full sets and
contracted to components. Then all pairs of a bucket that still lie in different components
are verified in blocks, inside the tasks: the members of a bucket's largest component are
dealt over blocks, and only the others visit them. No candidate pair is emitted, dropped or
capped, and every pair is verified on its full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import bucket_count, components
from harvestry.session import discard, ship_package, store

ROWS, BANDS = 5, 40
#: Tokens in one side of a block; candidate sets in a bucket of their table, signatures too.
BLOCK_TOKENS, BUCKET, SIGNATURES = 2_000_000, 4000, 4_000_000
#: Bytes of text hashed at once.
PIECE = 1 << 22

_BYTE = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
_WORD = ~((_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13)))
_BASE = 0x9E3779B97F4A7C15
_EMPTY = np.iinfo(np.uint64).max


def mix(h: np.ndarray) -> np.ndarray:
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse, as many as the longest piece so far takes."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _pieces(data: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PIECE`` bytes that do not end inside a word."""
    while low < high:
        stop = min(low + PIECE, high)
        if stop < high:
            blank = np.flatnonzero(~_WORD[data[low:stop]])
            if len(blank):
                stop = low + int(blank[-1]) + 1
            else:
                while stop < high and _WORD[data[stop]]:
                    stop += 1
        yield low, stop
        low = stop


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order, and per text (and one past them) the
    number of words before it. A-Z are lower-cased, words are runs without ASCII white space;
    a null text has none."""
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
    _, ends, held = texts.buffers()
    edges = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for low, high in _pieces(data, int(edges[0]), int(edges[-1])):
        part = _LOWER[data[low:high]]
        inside = _WORD[part]
        own = edges[np.searchsorted(edges, low):np.searchsorted(edges, high)] - low
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[own] = inside[own]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        before = own[own > 0] - 1
        last[before] = inside[before]
        start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = _POWERS.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        # Bytes count from 1, so that a byte 0 is not lost at the end of a word.
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        hashes.append(mix((sums[stop] - sums[start]) * down[start]))
        places.append(start + low)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), edges)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams; of fewer words than ``size`` one
    of them all, of none none."""
    words, edges = word_hashes(texts)
    grams = _joined([words[i:len(words) - size + 1 + i] for i in range(size)]) \
        if len(words) >= size else words[:0]
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if high - low >= size:
            yield np.unique(grams[low:high - size + 1])
        elif high > low:
            yield _joined([words[i:i + 1] for i in range(low, high)])
        else:
            yield words[:0]


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    out = np.full_like(parts[0], len(parts))
    for part in parts:
        out = mix(out + part)
    return out


def sketches(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """A row of ``coordinates`` values per set; equal ones stand for the same token. Sets must
    not be empty."""
    out = np.full(len(sets) * coordinates, _EMPTY, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    for turn in range(2 * coordinates):
        if not len(flat):
            break
        h = mix(flat + np.uint64((turn + 1) * _BASE % (1 << 64)))
        if turn < coordinates:
            place = ((h >> np.uint64(32)) * np.uint64(coordinates)) >> np.uint64(32)
        else:
            place = np.uint64(turn - coordinates)
        value = np.uint64(turn << 32) | (h & np.uint64(0xFFFFFFFF))
        np.minimum.at(out, owner * coordinates + place.astype(np.int64), value)
        left = (out.reshape(-1, coordinates) == _EMPTY).any(axis=1)[owner]
        owner, flat = owner[left], flat[left]
    return out.reshape(-1, coordinates)


def band_signatures(sketch: np.ndarray) -> np.ndarray:
    """A signature per band and set, different bands apart."""
    parts = sketch.reshape(len(sketch), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for row in range(ROWS):
        out = mix(out + parts[:, :, row])
    return out


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``PIECE`` bytes of text."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size.astype(np.int64)) // PIECE
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    return zip(cuts[:-1], cuts[1:], strict=True)


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets),
                         np.int64).reshape(-1, 2)


def sketched(documents: DataFrame, size: int) -> DataFrame:
    """A row per document: its number ``row``, ``doc_id``, its set's size ``n`` and digest
    ``d1``, ``d2``, and the signature of each band (none of an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in _runs(batch.column(2)):
                part = batch.slice(low, high - low)
                sets = list(shingle_sets(part.column(2), size))
                n = np.array([len(s) for s in sets], np.int64)
                digest = _digests(sets)
                sigs = band_signatures(sketches([s for s in sets if len(s)], ROWS * BANDS))
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), pa.array(digest[:, 0]),
                     pa.array(digest[:, 1]), pa.ListArray.from_arrays(
                         pa.array(ends.astype(np.int32)),
                         pa.array(sigs.reshape(-1).view(np.int64)))],
                    names=["row", "doc_id", "n", "d1", "d2", "sigs"])

    ship_package(documents.sparkSession)
    return documents.select(F.monotonically_increasing_id().alias("row"),
                            F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "row long, doc_id long, n long, d1 long, d2 long, sigs array<long>")


def _sets_of(documents: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``id``, ``tokens`` of classes, made again from the text of one of their documents."""
    wanted = classes.select(F.col("doc_id").alias("name"), "id", "d1", "d2")
    texts = documents.select(F.col("doc_id").cast("long"), "text")
    held = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("name"))).select(
        "id", "d1", "d2", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in _runs(batch.column(3)):
                part = batch.slice(low, high - low)
                sets = list(shingle_sets(part.column(3), size))
                digest = _digests(sets)
                # Rows that repeat an id may have other texts.
                same = np.flatnonzero((digest[:, 0] == part.column(1).to_numpy())
                                      & (digest[:, 1] == part.column(2).to_numpy()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(same)),
                     pa.array([sets[i].view(np.int64) for i in same], pa.list_(pa.int64()))],
                    names=["id", "tokens"])

    return held.mapInArrow(run, "id long, tokens array<long>").dropDuplicates(["id"])


def _similar(common: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * common >= percent * (n_a + n_b - common)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) that link by their sets (a table bucketed by id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("ta", "tb"):
                column = batch.column(name)
                sides.append((column.values.to_numpy(), column.offsets.to_numpy()))
            (left, at_left), (right, at_right) = sides
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a = left[at_left[i]:at_left[i + 1]]
                b = right[at_right[i]:at_right[i + 1]]
                # The smaller size cannot exceed the intersection by more than this allows.
                if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    good[i] = _similar(common, len(a), len(b), percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def stars(sigs: DataFrame) -> DataFrame:
    """Each member (``a``) of a bucket with its leader (``b``). A set leads wherever it can, so
    most members meet few leaders."""
    lead = sigs.groupBy("sig").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id")).alias("lead"))
    return sigs.join(lead, "sig").where("id <> lead.id").select(
        F.col("id").alias("a"), F.col("lead.id").alias("b")).distinct()


def dealt(held: DataFrame, most: int) -> DataFrame:
    """The members of the buckets (``sig``, ``id``, ``component``, ``n``) that hold several
    components, dealt over blocks ``sig``, ``room``, ``turn``, with ``visits`` and ``guest``.

    Buckets with the same members are dealt once. A bucket's members are residents of one room
    each; those outside its largest component (guests) also visit all its rooms, themselves in
    turns. A room and a turn hold members of about ``most`` in ``n``."""
    per_part = held.groupBy("sig", "component").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens"),
        F.bit_xor(F.xxhash64("id")).alias("print"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("print2"))
    buckets = per_part.groupBy("sig").agg(
        F.sum("members").alias("members"), F.sum("tokens").alias("tokens"),
        F.bit_xor("print").alias("print"), F.bit_xor("print2").alias("print2"),
        F.count(F.lit(1)).alias("parts"),
        F.max(F.struct("members", "component", "tokens")).alias("main")).where("parts > 1")
    chosen = buckets.groupBy("members", "print", "print2").agg(F.min(F.struct(
        "sig", "tokens", F.col("main.component").alias("main"),
        (F.col("tokens") - F.col("main.tokens")).alias("guests"))).alias("b"))
    parts = store(chosen.select(
        "b.sig", "b.main", F.ceil(F.col("b.tokens") / most).cast("long").alias("rooms"),
        F.ceil(F.col("b.guests") / most).cast("long").alias("turns")), "minhash_buckets",
        free=True)
    members = held.join(parts, "sig").withColumns({
        "room": F.pmod(F.xxhash64("id"), F.col("rooms")),
        "turn": F.pmod(F.xxhash64("id", F.lit(1)), F.col("turns")),
        "guest": F.col("component") != F.col("main")})
    # One pass over the members: as resident of its room in all turns, as guest in all rooms.
    places = F.transform(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1),
                         lambda turn: F.struct("room", turn.alias("turn"),
                                               F.lit(False).alias("visits")))
    visits = F.transform(F.sequence(F.lit(0).cast("long"), F.col("rooms") - 1),
                         lambda room: F.struct(room.alias("room"), "turn",
                                               F.lit(True).alias("visits")))
    return members.select("sig", "id", "component", "guest", F.inline(
        F.when(F.col("guest"), F.concat(places, visits)).otherwise(places)))


def blocks(placed: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components that meet in a bucket: every pair of members of different
    components is verified; of a set's links into one component at least one is returned."""
    rows = dealt(placed.join(sizes, "id"), BLOCK_TOKENS).join(sets, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            found = list(_meet(*_arrays(block), percent))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for a, _ in found], pa.int64()),
                     pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return in_blocks(rows.select(*BLOCK, "visits", "guest", "id", "component", "tokens")
                     ).mapInArrow(run, "a long, b long").distinct()


BLOCK = ("sig", "room", "turn")


def in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition(*BLOCK).sortWithinPartitions(*BLOCK)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each block, which follow each other; the first columns are its key."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(len(BLOCK))])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(),
                batch.num_rows]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if high == low:
                continue
            own = tuple(keys[:, low].tolist())
            if own != key and held:
                yield held
                held = []
            key = own
            held.append(batch.slice(low, high - low))
    if held:
        yield held


def _arrays(parts: list[pa.RecordBatch]) -> tuple:
    whole = pa.Table.from_batches(parts)
    flags = [whole.column(i).to_numpy() for i in (3, 4, 5, 6)]
    tokens = []
    for chunk in whole.column(7).chunks:
        values, ends = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        tokens += [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return *flags, tokens


def _meet(visits, guest, ids, component, tokens, percent) -> Iterator[tuple[int, int]]:
    """Links of a block's visitors with its residents of other components; one per visitor and
    component. Two guests meet as visitor of smaller id and resident of larger one."""
    stay = np.flatnonzero(~visits)
    come = np.flatnonzero(visits)
    if not len(stay) or not len(come):
        return
    size = np.array([len(t) for t in tokens], np.int64)
    order = stay[np.argsort(size[stay], kind="stable")]
    flat = np.concatenate([tokens[i] for i in order])
    distinct, coded = np.unique(flat, return_inverse=True)
    n = size[order]
    ends = np.concatenate([[0], np.cumsum(n)])
    marked = np.zeros(len(distinct) + 1, np.int64)
    for i in come:
        # Only residents whose size allows the similarity.
        low = np.searchsorted(100 * n, percent * size[i], side="left")
        high = np.searchsorted(percent * n, 100 * size[i], side="right")
        if low >= high:
            continue
        place = np.searchsorted(distinct, tokens[i])
        place = place[distinct[np.minimum(place, len(distinct) - 1)] == tokens[i]]
        marked[place] = 1
        common = np.add.reduceat(marked[coded[ends[low]:ends[high]]], ends[low:high] - ends[low])
        marked[place] = 0
        others = order[low:high]
        good = (100 * common >= percent * (n[low:high] + size[i] - common)) & (
            component[others] != component[i]) & (~guest[others] | (ids[others] > ids[i]))
        linked = others[good]
        _, first = np.unique(component[linked], return_index=True)
        for j in linked[first]:
            yield int(ids[i]), int(ids[j])


def contracted(component: DataFrame, pairs: DataFrame) -> DataFrame:
    """``component`` (a stored table of ``id``, ``component``) after the links ``pairs`` (``a``,
    ``b``). Only components with new links are worked on; replaced tables are dropped."""
    ends = [component.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))
            for end in ("a", "b")]
    links = store(pairs.join(ends[0], "a").join(ends[1], "b").select(
        F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "minhash_links", free=True)
    moved = component
    if not links.isEmpty():
        joined = components(links).select(F.col("id").alias("component"),
                                          F.col("component").alias("_to"))
        moved = store(component.join(joined, "component", "left").select(
            "id", F.coalesce("_to", "component").alias("component")), "minhash_components",
            free=True)
        discard(component)
    discard(links)
    return moved


def linked(documents: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The documents as ``sketched`` makes them, without signatures (stored), and ``d1``,
    ``d2``, ``n``, ``component`` (a number shared by all linked sets) of every distinct set."""
    wide = store(sketched(documents, size), "minhash_sketches")
    rows = store(wide.drop("sigs"), "minhash_rows")
    classes = store(rows.where("n > 0").groupBy("d1", "d2", "n").agg(
        F.min("row").alias("id"), F.min("doc_id").alias("doc_id")), "minhash_classes")
    total = classes.count()
    one_each = wide.join(classes.select(F.col("id").alias("row")), "row", "left_semi")
    index = store(one_each.select(F.explode("sigs").alias("sig"), F.col("row").alias("id")),
                  "minhash_index", "sig", bucket_count(total * BANDS, SIGNATURES))
    discard(wide)
    alive = index.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    sigs = store(index.join(alive.select("sig"), "sig").select("sig", "id"), "minhash_buckets",
                 free=True)
    discard(index)
    ids = store(sigs.select("id").distinct(), "minhash_candidates")
    sets = store(_sets_of(documents, classes.join(ids, "id"), size), "minhash_tokens", "id",
                 min(10_000, bucket_count(ids.count(), BUCKET)), free=True)
    component = store(ids.select("id", F.col("id").alias("component")), "minhash_components")
    component = contracted(component, verified(stars(sigs), sets, percent))
    sizes = store(sets.select("id", F.size("tokens").cast("long").alias("n")), "minhash_sizes")
    component = contracted(component, blocks(sigs.join(component, "id"), sizes, sets, percent))
    for table in (sigs, sets, sizes, ids):
        discard(table)
    return rows, classes.join(component, "id", "left").select(
        "d1", "d2", "n", F.coalesce("component", "id").alias("component"))


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Every document (``doc_id``, ``text``) with ``n_shingles``, ``component_id`` and ``kept``.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of
    ``size``-word shingles; the bands are laid out for 80 or more. ``component_id`` is the
    smallest doc_id reachable by links, itself included; ``kept`` says that this is the
    document's own. A text without words, or null, has no shingles and links with nothing.
    Rows that repeat an id are separate documents; a null id stays null and is passed over for
    the smallest, and such a document is kept only where it is linked with no id. An empty
    table gives no rows; other columns are not read."""
    if percent < 80:
        raise ValueError("the bands are laid out for a similarity of 80 percent or more")
    rows, classes = linked(documents, size, percent)
    placed = store(rows.join(classes, ["d1", "d2", "n"], "left").select(
        "doc_id", "n", "component"), "minhash_placed")
    # Written, so that the join shuffles plain rows and a large component is split.
    lowest = store(placed.where("component is not null").groupBy("component").agg(
        F.min("doc_id").alias("component_id")), "minhash_lowest")
    found = placed.join(lowest, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
