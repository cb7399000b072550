"""Similarity self-join on word n-grams with token-combination prefixes.

Two sets x, y with Jaccard at least t differ from their intersection in at most
tau(x) = |x| - ceil(t |x|) tokens of x. Under one global order of tokens, prefixes that such
a number of errors cannot destroy must share a signature:

* the order puts the tokens whose hash falls in a fixed share of the hash space first, by
  document frequency, and the others after them by hash; so frequencies are counted for that
  share only, while the guarantee holds for whole sets;
* rare tokens are signatures by themselves, one for each level of sizes; tokens of frequent
  classes are dealt into small groups by hash and indexed by their k-combinations within a
  group. A group of n prefix tokens survives n - k errors, so the prefix is extended until the
  classes together survive tau + 1;
* tokens found in one set only survive as they are and need no index entry.

Sets equal to each other are one class from the start. Candidates are verified in stars: the
members of a signature against one leader each, followed by connected components. What then
still shares a signature across components is compared pair by pair in blocks, without emitting
pairs, on parity bitmaps whose Hamming distance never exceeds the sets' difference; a
signature's largest component is not compared with itself, and signatures of the same members
are compared once. In the first rounds of blocks each set only tries its nearest one, which
joins what is left of large groups; the last round tries all pairs. A signature none of whose
members tries another has no pair left, as components only merge: later rounds pass it over.
Only survivors are verified on the sets. No link is lost, and copies of one text never make
pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestry.llm.common import bucket_count
from harvestry.llm.encode import forget
from harvestry.llm.minhash import BLOCK, blocks_of, contracted, dealt, in_blocks, stars
from harvestry.session import discard, ship_package, store

#: Least document frequency of the classes indexed by 2- and 3-combinations.
CLASSES = ((4096, 3), (64, 2))
#: A set of 2^level to 2^(level+1) tokens deals frequent tokens into 2^level / SPREAD groups.
SPREAD = 64
#: Members of a signature in one side of a block; candidate sets in a bucket of their table.
ROOM, BUCKET = 8192, 4000
#: Rounds of blocks in which each visitor only tries its nearest resident.
NEAREST = 2
WORDS_AT_ONCE = 700_000
#: Rows of lists opened to Python objects at once.
ROWS_AT_ONCE = 64

SHINGLED = ("row long, doc_id long, t1 long, t2 long, n long, d1 long, d2 long, bits binary, "
            "window array<long>, shared int")


def share_edge(percent: int) -> int:
    """Tokens with hashes below this are ordered by frequency: a share of the range that holds
    somewhat more than the longest prefix takes of a set."""
    return (1 << 64) // max(1, round(70 / max(100 - percent, 1)))


def errors(n: int, percent: int) -> int:
    """Most tokens of a set of ``n`` outside a set similar to it."""
    return n - -(-n * percent // 100)


def groups_of(level: int) -> int:
    return max(1, (1 << level) // SPREAD)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct word n-grams.

    A-Z are lower-cased, words are runs without ASCII white space. Fewer words than ``size``
    make one shingle; no words, or a null text, none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(
        0, int(sizes.sum()) + 1, 6 * WORDS_AT_ONCE)[1:], side="left") + 1
    for low, high in itertools.pairwise([0, *np.unique(cuts[cuts < len(texts)]), len(texts)]):
        yield from _sets(pa.concat_arrays([texts[low:high]]), size)


def _sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    if not len(texts):
        return
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    ends = words.offsets.to_numpy().astype(np.int64)
    coded = words.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64,
                         len(distinct))
    if not len(distinct):
        hashes = np.zeros(1, np.uint64)
    index = coded.indices.to_numpy()
    real = np.array([bool(w) for w in distinct] or [False])[index]
    counted = np.concatenate([[0], np.cumsum(real)])
    edges = counted[ends - ends[0]]
    flat = hashes[index[real]]
    grams = mixed([flat[i:len(flat) - size + 1 + i] for i in range(size)]) \
        if len(flat) >= size else flat[:0]
    for low, high in itertools.pairwise(edges.tolist()):
        if high - low >= size:
            yield np.unique(grams[low:high - size + 1])
        elif high > low:
            yield mixed([flat[i:i + 1] for i in range(low, high)])
        else:
            yield flat[:0]


def mixed(parts) -> np.ndarray:
    """A 64-bit hash of a sequence of 64-bit hashes, by position."""
    with np.errstate(over="ignore"):
        out = np.full_like(parts[0], len(parts))
        for part in parts:
            out = (out ^ part) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
            out *= np.uint64(0xBF58476D1CE4E5B9)
            out ^= out >> np.uint64(32)
        return out


def parity(tokens: np.ndarray) -> bytes:
    """A bitmap of at least two bits per token, each the parity of the tokens on it."""
    width = max(64, 1 << (2 * max(len(tokens), 1) - 1).bit_length())
    counts = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(low, ROWS_AT_ONCE)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def shingled(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """A row per document: its set's size, digest, parity bitmap and window (all tokens of
    the ordered share, or as many of the lowest hashes as any prefix may take)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        edge = np.uint64(min(share_edge(percent), (1 << 64) - 1))
        for batch in batches:
            out = {name: [] for name in ("n", "d1", "d2", "bits", "window", "shared")}
            for tokens in shingle_sets(batch.column(4), size):
                n = len(tokens)
                digest = xxhash.xxh3_128_digest(tokens.tobytes())
                first, second = np.frombuffer(digest, np.int64)
                shared = int(np.searchsorted(tokens, edge))
                reach = errors(n, percent) + 1 + 3 * groups_of(max(n, 1).bit_length() - 1)
                for name, value in (("n", n), ("d1", first), ("d2", second),
                                    ("bits", parity(tokens)), ("shared", shared),
                                    ("window", _signed(tokens[:max(shared, reach)]))):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(out["n"], pa.int64()),
                 pa.array(out["d1"], pa.int64()), pa.array(out["d2"], pa.int64()),
                 pa.array(out["bits"], pa.binary()),
                 pa.array(out["window"], pa.list_(pa.int64())),
                 pa.array(out["shared"], pa.int32())],
                names=[f.split()[0] for f in SHINGLED.split(", ")])

    ship_package(documents.sparkSession)
    return documents.select(F.monotonically_increasing_id().alias("row"),
                            F.col("doc_id").cast("long"), *text_hash(), "text").mapInArrow(
        run, SHINGLED)


def text_hash():
    return (F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("text"), "text").alias("t2"))


def _prefix(tokens, frequency, shared: int, n: int, percent: int, level: int):
    """Signatures of one set at a level: ``tokens`` are those of its window found in several
    windows, ``frequency`` in how many, ``shared`` its tokens in the ordered share. The level
    is part of each, so that sets of far sizes do not meet."""
    edge = share_edge(percent)
    ordered = sorted((t >= edge, f if t < edge else 0, t, f)
                     for t, f in zip(tokens, frequency, strict=True))
    # Tokens of the share that no other set has come first and survive as singles.
    covered = shared - sum(not o[0] for o in ordered)
    need, count, held = errors(n, percent) + 1, groups_of(level), {}
    for _, _, token, found in ordered:
        if covered >= need:
            break
        k = next((k for least, k in CLASSES if found >= least), 1)
        if k == 1:
            covered += 1
            held.setdefault((1, token), [token])
        else:
            group = held.setdefault((k, (token >> 8) % count), [])
            group.append(token)
            covered += len(group) >= k
    for size in {k for k, _ in held}:
        found = [c for (k, _), group in held.items() if k == size
                 for c in itertools.combinations(sorted(group), k)]
        if found:
            columns = np.array(found, np.uint64).T
            yield from mixed([np.full(len(found), level, np.uint64), *columns]).tolist()


def signatures(frequent: DataFrame, percent: int) -> DataFrame:
    """``sig``, ``id`` of every class; ``frequent`` has the arrays per class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sigs, owners = [], []
            for row in batch.to_pylist():
                n = row["n"]
                tokens = [t["token"] & (1 << 64) - 1 for t in row["tokens"]]
                counts = [t["df"] for t in row["tokens"]]
                levels = {n.bit_length() - 1, (-(-n * percent // 100)).bit_length() - 1}
                own = {s for level in levels for s in _prefix(
                    tokens, counts, row["shared"], n, percent, level)}
                sigs += own
                owners += [row["id"]] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(np.array(sigs, np.uint64)), pa.int64()),
                 pa.array(owners, pa.int64())], names=["sig", "id"])

    return frequent.mapInArrow(run, "sig long, id long")


def _apart(n_a, n_b, bits_a, bits_b) -> int:
    """A number of tokens that the sets differ in at least."""
    a, b = np.frombuffer(bits_a, np.uint64), np.frombuffer(bits_b, np.uint64)
    size = min(len(a), len(b))
    apart = int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum())
    return max(apart, abs(n_a - n_b))


def within(n_a, n_b, apart, percent):
    """Whether sets of these sizes that differ in ``apart`` tokens are similar enough."""
    return (n_a + n_b) * (100 - percent) >= apart * (100 + percent)


def _nearest(pairs: DataFrame, light: DataFrame, percent: int) -> DataFrame:
    """Of each ``a`` the pair that is nearest by the bitmaps, if it may link."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = [_apart(*row) for row in zip(
                *(batch.column(name).to_pylist() for name in ("na", "nb", "ba", "bb")),
                strict=True)]
            good = [within(a, b, d, percent) for a, b, d in zip(
                batch.column("na").to_pylist(), batch.column("nb").to_pylist(), apart,
                strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(apart, pa.int64())],
                names=["a", "b", "apart"]).filter(pa.array(good, pa.bool_()))

    near = pairs.join(_side(light, "a"), "a").join(_side(light, "b"), "b")
    near = near.select("a", "b", "na", "nb", "ba", "bb").mapInArrow(
        keep, "a long, b long, apart long")
    return near.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("best")).select(
        "a", F.col("best.b").alias("b"))


def _side(df: DataFrame, end: str) -> DataFrame:
    return df.select(*[F.col(c).alias(end if c == "id" else c[0] + end) for c in df.columns])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) that link by their sets (a table bucketed by id)."""
    both = pairs.join(_side(sets, "a"), "a").join(_side(sets, "b"), "b")
    common = F.size(F.array_intersect("ta", "tb"))
    whole = F.size("ta") + F.size("tb")
    return both.where(whole * (100 - percent) >= (whole - common * 2) * (100 + percent)).select(
        "a", "b")


def blocks(placed: DataFrame, light: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs across components that share a signature and may link by their bitmaps: all of
    them, once each, or of each visitor the ``nearest`` one in each block, with its ``sig``."""
    rows = dealt(placed.withColumn("n", F.lit(1).cast("long")), ROOM).join(light, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            members = pa.Table.from_batches(block).to_pylist()
            guests = {m["id"] for m in members if m["visits"]}
            # Two guests that visit each other meet once, where the smaller one visits.
            found = [(a, b) for a, b in _near(
                [m for m in members if m["visits"]], [m for m in members if not m["visits"]],
                percent, nearest) if nearest or a < b or b not in guests]
            yield pa.RecordBatch.from_arrays(
                [pa.array([members[0]["sig"]] * len(found), pa.int64()),
                 pa.array([min(pair) for pair in found], pa.int64()),
                 pa.array([max(pair) for pair in found], pa.int64())], names=["sig", "a", "b"])

    pairs = in_blocks(rows.select(*BLOCK, "visits", "id", "component", "n", "bits")).mapInArrow(
        run, "sig long, a long, b long")
    return pairs if nearest else pairs.select("a", "b").distinct()


def _near(left, right, percent, nearest=False):
    sizes = sorted({len(m["bits"]) for m in left} | {len(m["bits"]) for m in right})
    for size in sizes:  # similar sets' bitmaps have the same size or one twice the other's
        near = [[m for m in side if len(m["bits"]) in (size, 2 * size)] for side in
                (left, right)]
        if not (near[0] and near[1]):
            continue
        maps = [np.stack([folded(np.frombuffer(m["bits"], np.uint64), size // 8)
                          for m in side]) for side in near]
        n, comp = ([np.array([m[key] for m in side]) for side in near]
                   for key in ("n", "component"))
        for at, member in enumerate(near[0]):
            apart = np.bitwise_count(maps[0][at] ^ maps[1]).sum(axis=1, dtype=np.int64)
            apart = np.maximum(apart, np.abs(n[1] - member["n"]))
            others = np.flatnonzero(within(member["n"], n[1], apart, percent)
                                    & (comp[1] != member["component"]))
            if nearest and len(others):
                others = others[[np.argmin(apart[others])]]
            for to in others:
                yield member["id"], near[1][to]["id"]


def _still(sigs: DataFrame, pairs: DataFrame) -> DataFrame:
    """What ``sigs`` (a stored table, dropped) has of the signatures of ``pairs``."""
    # Written, so that the join shuffles plain rows and a large signature is split.
    tried = store(pairs.select("sig").distinct(), "ngram_tried", free=True)
    left = store(sigs.join(tried, "sig", "left_semi"), "ngram_index", free=True)
    discard(tried)
    discard(sigs)
    return left


def linked(documents: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows as ``shingled`` makes them (stored), and ``d1``, ``d2``, ``n``, ``component``
    (a number shared by all linked sets) of every distinct set."""
    wide = store(shingled(documents, size, percent), "ngram_sets")
    rows = store(wide.drop("bits", "window", "shared"), "ngram_rows")
    classes = store(rows.where("n > 0").groupBy("d1", "d2", "n").agg(
        F.min("row").alias("id"), F.min("doc_id").alias("doc_id")), "ngram_classes", free=True)
    # Below 9 tokens nothing but an equal set is similar enough at 90; in general, the
    # smallest sum of sizes that allows a difference of one.
    least = -(-(100 + percent) // (100 - percent)) // 2 if percent < 100 else 1 << 62
    held = wide.join(classes.select("id"), wide["row"] == F.col("id"), "left_semi").where(
        F.col("n") >= least)
    windows = held.select(F.col("row").alias("id"), F.explode("window").alias("token"))
    df = windows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    several = windows.join(df, "token").groupBy("id").agg(
        F.collect_list(F.struct("token", "df")).alias("tokens"))
    per_class = several.join(held.select(F.col("row").alias("id"), "n", "shared"), "id")
    found = store(signatures(per_class, percent), "ngram_signatures", free=True)
    alive = found.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    sigs = store(found.join(alive.select("sig"), "sig").select("sig", "id"), "ngram_index", free=True)
    discard(found)
    ids = store(sigs.select("id").distinct(), "ngram_candidates", free=True)
    light = store(wide.select(F.col("row").alias("id"), "n", "bits").join(ids, "id"),
                  "ngram_bitmaps", free=True)
    discard(wide)  # the windows are the bulk of what is stored
    # Of fewer buckets than shuffle partitions Spark would shuffle the table for each join.
    buckets = min(10_000, max(bucket_count(ids.count(), BUCKET), int(
        documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    made, placed = _sets_of(documents, classes.join(ids, "id"), size, buckets)
    sets = store(placed, "ngram_tokens", "id", buckets, free=True, placed=True)
    discard(made)

    component = store(ids.select("id", F.col("id").alias("component")), "ngram_components")
    component = contracted(component, verified(_nearest(stars(sigs), light, percent), sets,
                                               percent))
    for turn in range(NEAREST + 1):
        pairs = store(blocks(sigs.join(component, "id"), light, percent, turn < NEAREST),
                      "ngram_pairs", free=True)
        component = contracted(component, verified(pairs.select("a", "b").distinct(), sets,
                                                   percent))
        if turn < NEAREST:
            sigs = _still(sigs, pairs)
        discard(pairs)
    for table in (sigs, ids, light, sets):
        discard(table)
    return rows, classes.join(component, "id", "left").select(
        "d1", "d2", "n", F.coalesce("component", "id").alias("component"))


def link_components(documents: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """Every document (``doc_id``, ``text``) with ``n_shingles`` and ``component_id``.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of
    ``size``-word shingles. ``component_id`` is the smallest doc_id reachable by links, itself
    included. A text without words, or null, has no shingles and links with nothing. Rows that
    repeat an id are separate documents; a null id stays null and is passed over for the
    smallest. An empty table gives no rows; other columns are not read."""
    rows, classes = linked(documents, size, percent)
    placed = rows.join(classes, ["d1", "d2", "n"], "left").select("doc_id", "n", "component")
    placed = store(placed, "ngram_placed")
    # Written, so that the join shuffles plain rows and a large component is split.
    lowest = store(placed.where("component is not null").groupBy("component").agg(
        F.min("doc_id").alias("component_id")), "ngram_lowest")
    return placed.join(lowest, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of linked ones, that of the smallest doc_id (null last), with
    all its columns; documents without words stay."""
    rows, classes = linked(documents, size, percent)
    placed = rows.select("row", "doc_id", "t1", "t2", "d1", "d2", "n").join(
        classes, ["d1", "d2", "n"], "left")
    first = placed.where("component is not null").groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "row", "t1", "t2")).alias("kept"))
    kept = first.select("kept.doc_id", "kept.t1", "kept.t2").unionByName(
        placed.where("component is null").select("doc_id", "t1", "t2")).distinct()
    kept = store(kept.select(F.col("doc_id").alias("name"), "t1", "t2"), "ngram_kept")
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("all"),
                            F.col("doc_id").cast("long").alias("own"), *text_hash(),
                            F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")).alias("words"))
    found = held.join(kept.select("name", F.col("t1").alias("k1"), F.col("t2").alias("k2")),
                      F.col("own").eqNullSafe(F.col("name")) & (F.col("t1") == F.col("k1"))
                      & (F.col("t2") == F.col("k2")), "left_semi")
    # Rows equal in id and text match the same winner: the first of them stays.
    same = Window.partitionBy("own", "t1", "t2").orderBy(F.lit(0))
    return found.withColumn("turn", F.row_number().over(same)).where(
        "turn = 1 or not coalesce(words, false)").select(*[F.col(f"all.`{c}`") for c in
                                                           documents.columns])


def _sets_of(documents: DataFrame, classes: DataFrame, size: int,
             buckets: int) -> tuple[DataFrame, DataFrame]:
    """The sets of classes, made again from the text of one of their documents: as a stored
    table, and from it partitioned by ``id``."""
    wanted = classes.select(F.col("doc_id").alias("name"), "id", "d1", "d2")
    texts = documents.select(F.col("doc_id").cast("long"), "text")
    held = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("name"))).select(
        "id", "d1", "d2", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            own, found = [], []
            names = batch.column(0).to_pylist()
            for at, tokens in enumerate(shingle_sets(batch.column(3), size)):
                if names[at] in seen:
                    continue
                digest = np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), np.int64)
                if (batch.column(1)[at].as_py(), batch.column(2)[at].as_py()) == tuple(
                        digest.tolist()):
                    seen.add(names[at])
                    own.append(at)
                    found.append(_signed(tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own, pa.int64())),
                 pa.array(found, pa.list_(pa.int64()))], names=["id", "tokens"])

    # Written, so that the texts' shuffle goes before the sets are shuffled.
    made = store(held.mapInArrow(run, "id long, tokens array<long>"), "ngram_made", free=True)
    # Rows that repeat an id and its text bring a class's set again: once per task, then once.
    return made, made.repartition(buckets, "id").dropDuplicates(["id"])
