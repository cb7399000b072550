"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are laid on a line in a shuffled order and cut into blocks of equal
numbers of words. Slot n of the schedule takes the n-th van der Corput point; the point falls
into one source's share of the cumulative weights, and the slot's rank among the source's
slots says which block it takes, going round the line again when it ends. Slots join blocks
on (source, block), so a source that holds a third of all rows is spread like any other.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harvestry.llm.common import WORD, bucket_count, rank_in_group, word_count
from harvestry.session import store

WEIGHTS = (5, 2, 1)
#: No source is taken more often than this many times its size.
MOST_TIMES = 3
#: Words of a block at most, and blocks of a source at least (of a word or more).
BLOCK, LEAST_BLOCKS = 1024, 1024
#: Rows ranked in one task, about; cells that cut [0, 1) for the interval join.
RANK_ROWS, CELLS = 5_000, 4096


def sized(documents: DataFrame, size: Column) -> DataFrame:
    """``row`` (unique), ``doc_id``, ``source``, ``size``; a null size counts as 0."""
    return documents.select("doc_id", "source", F.coalesce(size, F.lit(0)).cast("long")
                            .alias("size")).withColumn("row", F.monotonically_increasing_id())


def targets(rows: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Per source (by code point, null last): ``place``, ``weight``, ``source_size``,
    ``target``. Targets share the sum of all sizes by weight; none exceeds MOST_TIMES its
    source's size, and what is cut off is shared again among the others.

    The fixed point is a common level: sources sorted by size over weight are capped as long
    as filling all to that level takes no more than the total."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, 0)
    all_of = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    found = found.withColumn("place", F.row_number().over(by_name) - 1)
    found = found.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1)).cast("long"))
    found = found.withColumn("cap", F.col("source_size") * MOST_TIMES)
    found = found.withColumn("ratio", F.col("cap") / F.col("weight"))
    found = found.select("*", F.sum("cap").over(by_ratio).alias("caps"),
                         F.sum("weight").over(by_ratio).alias("weighed"),
                         F.sum("weight").over(all_of).alias("weigh_all"),
                         F.sum("source_size").over(all_of).alias("total"))
    capped = (F.col("caps") + F.col("ratio") * (F.col("weigh_all") - F.col("weighed"))
              <= F.col("total"))
    found = found.withColumn("capped", capped)
    taken = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(all_of), F.lit(0))
    free = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(all_of)
    level = (F.col("total") - taken) / free
    return found.select("source", "place", "weight", "source_size", F.when(
        F.col("capped"), F.col("cap").cast("double"))
        .otherwise(F.col("weight") * level).alias("target"))


def van_der_corput(n: Column) -> Column:
    """The n-th point of the base-2 sequence: the binary digits mirrored at the point."""
    digits = 40
    mirrored = F.conv(F.reverse(F.lpad(F.bin(n), digits, "0")), 2, 10).cast("double")
    return mirrored / float(1 << digits)


def block_size(size: Column) -> Column:
    """Words of a source's blocks."""
    return F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(size / LEAST_BLOCKS))).cast("long")


def schedule(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """``slot``, ``place`` (of the source), ``block``: what each slot takes, in order.

    ``sources`` (as ``targets`` returns) is read several times: pass a stored table."""
    order = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shares = sources.where("target > 0").withColumn(
        "blocks", F.ceil(F.col("source_size") / block_size(F.col("source_size"))))
    # The last block may be short: a draw yields the mean.
    shares = shares.withColumn("draws", F.col("target") * F.col("blocks")
                               / F.col("source_size"))
    shares = shares.select("place", "blocks", "draws", F.sum("draws").over(order).alias("upto"),
                           F.sum("draws").over(everything).alias("whole"))
    shares = store(shares.select(
        "place", "blocks", "whole", ((F.col("upto") - F.col("draws")) / F.col("whole"))
        .alias("low"), F.when(F.col("upto") == F.max("upto").over(everything), 1.0)
        .otherwise(F.col("upto") / F.col("whole")).alias("high")), "mixing_shares")
    slots = shares.agg(F.ceil(F.max("whole"))).first()[0] or 0
    cells = shares.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * CELLS),
        F.least(F.lit(CELLS - 1), F.floor(F.col("high") * CELLS)))))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), van_der_corput(F.col("id")).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * CELLS))
    hit = points.join(cells, "cell").where("low <= point and point < high").select(
        "slot", "place", "blocks", F.floor(F.col("slot") / RANK_ROWS).alias("salt"))
    ranked = rank_in_group(hit, ["place"], "salt", ["slot"])
    # Whole rounds of the line: a source's MOST_TIMES-th round is its last.
    return ranked.where(F.col("rank") < F.col("blocks") * MOST_TIMES).select(
        "slot", "place", (F.col("rank") % F.col("blocks")).alias("block"))


def blocks(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """The documents' parts by block: ``place``, ``block``, ``row``, ``doc_id``, ``start``
    (in the document) and ``length``; ``rows`` is a stored table."""
    salts = bucket_count(rows.count(), RANK_ROWS)
    rows = rows.join(sources.select("source", "place", "source_size"),
                     rows["source"].eqNullSafe(sources["source"])).select(
        "row", "doc_id", "size", "place", "source_size",
        F.xxhash64("doc_id").alias("shuffled"),
        F.pmod(F.xxhash64(F.lit("salt"), "doc_id"), F.lit(salts)).alias("salt"))
    laid = rank_in_group(rows.where("size > 0"), ["place"], "salt",
                         ["shuffled", "doc_id", "size", "row"], "at", total="size")
    width = block_size(F.col("source_size"))
    parts = laid.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("at") / width), F.floor((F.col("at") + F.col("size") - 1) / width))))
    low = F.greatest(F.col("at"), F.col("block") * width)
    high = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * width)
    return parts.select("place", "block", "row", "doc_id", (low - F.col("at")).alias("start"),
                        (high - low).alias("length"))


def mix(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """The mix in order: ``slot``, ``place``, ``row``, ``doc_id``, ``start`` and ``length`` in
    words of the document. Both arguments are stored tables (``sized``, ``targets``)."""
    return schedule(rows.sparkSession, sources).join(blocks(rows, sources), ["place", "block"])


def taken(documents: DataFrame, size: Column | None = None) -> DataFrame:
    """Every row of ``documents`` as ``doc_id``, ``source``, ``size``, ``source_size``,
    ``target`` and ``taken`` (words the mix takes of it, repeats counted).

    The order within a source hangs on doc_id alone, so reruns agree. Empty documents and
    null texts have size 0 and are taken 0 words of; a null source is a source; rows of one
    id are mixed separately; no rows, no result. Other columns are not read."""
    rows = store(sized(documents, word_count() if size is None else size), "mixing_sizes")
    sources = store(targets(rows), "mixing_targets")
    sums = mix(rows, sources).groupBy("row").agg(F.sum("length").alias("taken"))
    return (rows.join(sources.withColumnRenamed("source", "name"),
                      rows["source"].eqNullSafe(F.col("name"))).join(sums, "row", "left")
            .select("doc_id", "source", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed(documents: DataFrame) -> DataFrame:
    """The mix as documents: a row for each round of its source's line in which a document is
    taken, with all columns. Blocks are taken in the line's order, so a round takes a document
    whole but for one at the round's last block, whose text is cut to the words taken (joined
    by spaces). Documents the mix does not take, empty ones among them, go; ``n_chars``, where
    there is one, follows the text."""
    kept = store(documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("all"), "doc_id", "source",
        word_count().alias("size")).withColumn("row", F.monotonically_increasing_id()),
        "mixing_documents")
    sources = store(targets(kept), "mixing_targets")
    drawn = mix(kept.select("row", "doc_id", "source", "size"), sources)
    # The rounds that take a part: a part is taken once a round, and rounds go by the rank.
    parts = drawn.withColumn("round", F.row_number().over(Window.partitionBy(
        "row", "start").orderBy("slot")))
    rounds = parts.groupBy("row", "round").agg(F.min("start").alias("first"),
                                               F.sum("length").alias("length"))
    taken_rows = kept.join(rounds, "row")
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all("all.text", F.lit(WORD), F.lit(0)),
                                   (F.col("first") + 1).cast("int"),
                                   F.col("length").cast("int")))
    text = F.when(F.col("length") == F.col("size"), F.col("all.text")).otherwise(cut)
    out = {"text": text}
    if "n_chars" in documents.columns:
        out["n_chars"] = F.length(text).cast(documents.schema["n_chars"].dataType)
    return taken_rows.select(*[out.get(c, F.col(f"all.`{c}`")).alias(c)
                               for c in documents.columns])
