"""Packing documents into sequences of bounded length by linear grouping.

1. Texts are encoded once; documents longer than a sequence are cut into full pieces, the
   first of them shorter. Full pieces are sequences of their own.
2. Lengths above ``small`` are sorted and dealt into groups of equal cardinality, each
   rounded up to its longest. The rounded sizes, at most ``groups``, are packed into
   configurations, each filled by a bounded subset-sum search and used as often as the
   groups allow. More groups round less: over 250,000 documents, 256 groups took 1.6 % more
   sequences than the sum of lengths asks for, 1024 groups 0.004 %.
3. Actual documents take the places of their group by rank, which frees what rounding added.
4. Small pieces go to the sequences they fit best, by their numbers per length.

The driver sees counts per length only (a sequence's length bounds these); documents are
ranked within a length in two levels, so that no length meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestry.llm.common import bucket_count, rank_in_group
from harvestry.llm.encode import encoder, with_end
from harvestry.llm.token_files import ids_crc32
from harvestry.session import ship_package, store

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Rows ranked in one task, about.
RANK_ROWS = 20_000


def encode_pieces(documents: DataFrame, tokenizer: str, capacity: int = 1024,
                  end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document; a null text is empty, an empty text is the end id alone.

    Columns: ``doc_id`` (may be null or repeat), ``piece`` from 0, ``start``, ``length``,
    ``ids_crc32`` and, with ``keep_ids``, ``ids``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            names = batch.column(0)
            for row, ids, lengths in coder.encode(batch.column(1)):
                ids, lengths = with_end(ids, lengths, end_id)
                count = -(-lengths // capacity)
                owner = np.repeat(np.arange(len(lengths)), count)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                first = lengths - (count - 1) * capacity
                length = np.where(piece == 0, first[owner], capacity)
                start = np.where(piece == 0, 0, first[owner] + (piece - 1) * capacity)
                stops = np.cumsum(length)
                own = np.split(ids, stops[:-1])
                columns = [names.slice(row, len(lengths)).take(pa.array(owner)),
                           pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(length, pa.int64()),
                           pa.array([ids_crc32(x) for x in own], pa.int64())]
                if keep_ids:
                    columns.append(pa.array(own, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=FIELDS[:len(columns)])

    ship_package(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, PIECES + (", ids array<long>" if keep_ids else ""))


FIELDS = [field.split()[0] for field in PIECES.split(", ")] + ["ids"]


def linear_groups(counts: dict[int, int], groups: int) -> dict[int, int]:
    """Length to rounded length: about ``groups`` groups of equal cardinality, cut between
    lengths, each rounded up to its longest."""
    total, seen, rounded, current = sum(counts.values()), 0, {}, (-1, 0)
    for size in sorted(counts, reverse=True):
        group = seen * groups // max(total, 1)
        if group != current[0]:
            current = (group, size)
        rounded[size] = current[1]
        seen += counts[size]
    return rounded


def configurations(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Sequences by content: ({size: pieces of it}, how many sequences).

    Takes the longest size left, completes it by the fullest subset of the others (a bit set
    holds the reachable sums; sizes are tried from the longest) and uses the result for half
    of what its scarcest size allows, so that later ones still find mates."""
    left, found = dict(counts), []
    while left:
        sizes = sorted(left, reverse=True)
        room, masks = capacity - sizes[0], [1]
        limit = (1 << room + 1) - 1
        for place, size in enumerate(sizes):
            reach = step = masks[-1]
            for _ in range(min(left[size] - (place == 0), room // size)):
                step = (step << size) & limit
                reach |= step
            masks.append(reach)
        at, content = masks[-1].bit_length() - 1, {sizes[0]: 1}
        for place in range(len(sizes) - 1, -1, -1):
            while at and not masks[place] >> at & 1:
                content[sizes[place]] = content.get(sizes[place], 0) + 1
                at -= sizes[place]
        most = min(left[size] // n for size, n in content.items())
        times = max(1, most // 2)
        found.append((content, times))
        for size, n in content.items():
            left[size] -= n * times
            if not left[size]:
                del left[size]
    return found


def best_fit(rooms: dict[int, int], counts: dict[int, int], capacity: int):
    """Small pieces into sequences by best fit, longest pieces first and in bulk.

    ``rooms``: free length to sequences. Yields (free length or None for new sequences,
    first rank among those of this free length, sequences, {size: pieces in each})."""
    held: dict[int, list] = {room: [[room, 0, n, {}]] for room, n in rooms.items() if n}
    opened = 0
    for size in sorted(counts, reverse=True):
        count = counts[size]
        while count:
            room = min((r for r in held if r >= size and held[r]), default=None)
            if room is None:
                each = capacity // size
                full, rest = divmod(count, each)
                for n, many in ((each, full), (rest, 1 if rest else 0)):
                    if many:
                        held.setdefault(capacity - n * size, []).append(
                            [None, opened, many, {size: n}])
                        opened += many
                break
            origin, first, many, content = held[room].pop()
            taken = min(many, count)
            if taken < many:
                held[room].append([origin, first + taken, many - taken, content])
            held.setdefault(room - size, []).append(
                [origin, first, taken, content | {size: content.get(size, 0) + 1}])
            count -= taken
    return [tuple(x) for blocks in held.values() for x in blocks if x[3]], opened


def pack_lengths(items: DataFrame, capacity: int = 1024, groups: int = 1024,
                 small: int | None = None) -> DataFrame:
    """``items`` (``item``: unique long, ``length``: 1 to ``capacity``) with ``sequence_id``
    and ``offset``: places in sequences of at most ``capacity``, gapless from 0.

    ``items`` is read several times: pass a stored table. Pieces up to ``small`` (an eighth
    of the capacity) fill what the longer ones leave. No items, no rows."""
    spark = items.sparkSession
    small = capacity // 8 if small is None else small
    items = items.select("item", "length")
    counts = {r["length"]: r["count"] for r in items.groupBy("length").count().collect()}
    full = counts.pop(capacity, 0)
    large = {s: n for s, n in counts.items() if s > small}
    rounded = linear_groups(large, groups)
    by_size: dict[int, int] = {}
    for size, n in large.items():
        by_size[rounded[size]] = by_size.get(rounded[size], 0) + n
    used, places, sequences = dict.fromkeys(by_size, 0), [], 0
    for content, times in configurations(by_size, capacity):
        for size, n in content.items():
            places.append((size, used[size], used[size] + n * times, sequences, times))
            used[size] += n * times
        sequences += times

    kinds = spark.createDataFrame(
        [(s, rounded.get(s, s)) for s in counts], "length long, kind long")
    salts = bucket_count(sum(counts.values()), RANK_ROWS)
    ranked = store(rank_in_group(
        items.where(F.col("length") < capacity).join(F.broadcast(kinds), "length")
        .withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(salts))),
        ["kind"], "salt", ["item"]).drop("salt"), "packing_ranks")
    # Bounded by the number of sizes and configurations, whatever the number of documents.
    table = F.broadcast(spark.createDataFrame(
        places, "kind long, low long, high long, base long, times long"))
    placed = ranked.where(F.col("length") > small).join(table, "kind").where(
        "rank >= low and rank < high").select(
        "item", "length", (F.col("base") + (F.col("rank") - F.col("low")) % F.col("times"))
        .alias("sequence_id"))

    rooms = placed.groupBy("sequence_id").agg(
        (F.lit(capacity) - F.sum("length")).alias("room"))
    rooms = store(rooms.where("room > 0"), "packing_rooms")
    room_counts = {r["room"]: r["count"] for r in rooms.groupBy("room").count().collect()}
    minor = {s: n for s, n in counts.items() if s <= small}
    blocks, _ = best_fit(room_counts, minor, capacity)
    used, fills = dict.fromkeys(minor, 0), []
    for room, first, many, content in blocks:
        for size, n in content.items():
            fills.append((size, used[size], used[size] + n * many, room, first, many))
            used[size] += n * many
    fill = F.broadcast(spark.createDataFrame(
        fills, "kind long, low long, high long, room long, first long, many long"))
    chosen = ranked.where(F.col("length") <= small).join(fill, "kind").where(
        "rank >= low and rank < high").select(
        "item", "length", "room", (F.col("first") + (F.col("rank") - F.col("low"))
                                   % F.col("many")).alias("rank"))
    open_rooms = rank_in_group(
        rooms.withColumn("salt", F.pmod(F.xxhash64("sequence_id"), F.lit(salts))),
        ["room"], "salt", ["sequence_id"]).select("room", "rank", "sequence_id")
    into = chosen.where("room is not null").join(open_rooms, ["room", "rank"]).select(
        "item", "length", "sequence_id")
    new = chosen.where("room is null").select(
        "item", "length", (F.col("rank") + sequences).alias("sequence_id"))
    alone = items.where(F.col("length") == capacity).select(
        "item", "length", (F.lit(-1) - F.col("item")).alias("sequence_id"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "item").rowsBetween(
        Window.unboundedPreceding, -1)
    shared = placed.unionByName(into).unionByName(new).select(
        "item", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0))
        .alias("offset"))
    return shared.unionByName(alone.select("item", "sequence_id", F.lit(0).cast("long")
                                           .alias("offset"))) if full else shared


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = 1024,
                   end_id: int = 2, keep_ids: bool = False, groups: int = 1024) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset`` there."""
    pieces = store(
        encode_pieces(documents, tokenizer, capacity, end_id, keep_ids)
        .withColumn("item", F.monotonically_increasing_id()), "packing_pieces")
    return pieces.join(pack_lengths(pieces, capacity, groups), "item").drop("item")
