"""Line deduplication: lines whose normal form stands in many documents are dropped.

Lines are exploded as hashes of their keys with their places, distinct documents are counted
per hash, and each text is reassembled by position from the lines that stay. Texts are shuffled once;
everything else that moves is 16-byte hashes and places. Built-in functions only. Time is
in proportion to the lines, in one long document too (but for sorting its hashes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import text_or_empty
from harvestry.session import store

BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def _key_hash(line: Column, min_chars: int) -> Column:
    """A 128-bit hash of the key as text; null for keys that are too short to count."""
    key = line_key(line)
    return F.when(F.length(key) >= min_chars,
                  F.struct(F.xxhash64(key).alias("a"),
                           F.xxhash64(F.lit("line"), key).alias("b")))


def drop_common_lines(documents: DataFrame, min_docs: int = 10, min_chars: int = 1,
                      text: str = "text", key: str = "doc_id") -> DataFrame:
    """``documents`` with ``text`` replaced by what stays, plus ``n_lines`` (before) and
    ``n_dropped``.

    A line is what stands between line feeds; a null or empty text is one empty line and
    becomes the empty text. Keys of at least ``min_chars`` code points found in at least
    ``min_docs`` rows lose all their lines in every row. A row counts once for a key
    however often it repeats it; rows repeated in the table count as separate documents.
    ``key`` only spreads copies of one text over tasks; it may be null or repeat. Other
    columns pass unchanged, except columns named like the two added ones, which are replaced. A document that loses all its lines keeps its row with an empty text.
    """
    row = documents.select(
        F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("row"),
        text_or_empty(text).alias("text"))
    row = row.withColumn("copy", F.struct(
        F.col(f"row.`{key}`").alias("id"), F.xxhash64("text").alias("a"),
        F.xxhash64(F.lit("text"), "text").alias("b")))
    lines = F.split("text", "\n", -1)
    # In the order of their hashes, equal lines of a document are neighbours: the first one
    # counts the document. Sorting keeps the work of a long document near its length.
    hashes = F.sort_array(F.filter(F.transform(lines, lambda line, at: F.struct(
        _key_hash(line, min_chars).alias("hash"), at.alias("at"))),
        lambda line: line["hash"].isNotNull()))
    found = row.select("copy", hashes.alias("hashes")).select("copy", F.explode(F.transform(
        "hashes", lambda line, at: F.struct(
            line["hash"].alias("hash"), line["at"].alias("at"),
            (~F.get("hashes", at - 1)["hash"].eqNullSafe(line["hash"])).alias("first")))
    ).alias("line"))
    # Normalising lines is the cost here: once, for the counts and for what is lost.
    found = store(found.select("copy", "line.*"), "line_keys")
    # Written, so that the join shuffles plain rows and a line of many documents is split.
    common = store(found.groupBy("hash").agg(F.count_if("first").alias("n"))
                   .where(F.col("n") >= min_docs).select("hash"), "common_lines")
    # Rows of one id and text lose the same places, so the pair identifies what they lose.
    lost = (found.join(common, "hash").groupBy("copy")
            .agg(F.collect_set("at").alias("lost")))
    split = row.join(lost, row["copy"].eqNullSafe(lost["copy"]), "left").select(
        "row", lines.alias("lines"), "lost")
    split = split.withColumn("places", F.when(F.col("lost").isNotNull(), F.array_except(
        F.sequence(F.lit(0), F.size("lines") - 1), "lost")))
    split = split.withColumn("kept", F.when(F.col("lost").isNull(), F.col("lines")).otherwise(
        F.transform("places", lambda at: F.get("lines", at))))
    added = ("n_lines", "n_dropped")
    return split.select(
        *[F.array_join("kept", "\n").alias(text) if name == text
          else F.col(f"row.`{name}`") for name in documents.columns if name not in added],
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"))
