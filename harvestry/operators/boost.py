"""Which title words move prices: the shift of each word's mean price.

The same functions serve static and streaming items. Items carry ``title ARRAY<STRING>`` and
``price ARRAY<DOUBLE>``; element 0 of both counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestry.functions.text import distinct_words


def split_priced(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable items, rejected items with ``reason``): both title and price are needed."""
    reason = (F.when(F.get("title", F.lit(0)).isNull(), "no title")
              .when(F.get("price", F.lit(0)).isNull(), "no price"))
    judged = items.withColumn("reason", reason)
    return (judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL"))


def word_prices(items: DataFrame) -> DataFrame:
    """(word, price_sum, n). A word counts once per item and spelling; partial sums are
    combined before the shuffle, so a very common word costs one row per map task."""
    usable, _ = split_priced(items)
    return (usable
            .select(F.explode(distinct_words(F.get("title", F.lit(0)))).alias("word"),
                    F.get("price", F.lit(0)).cast("double").alias("price"))
            .groupBy("word")
            .agg(F.sum("price").alias("price_sum"), F.count(F.lit(1)).alias("n")))


def word_totals(prices: DataFrame) -> DataFrame:
    """One row (price_sum, n) over word rows: an item of k words weighs k times."""
    return prices.agg(F.sum("price_sum").alias("price_sum"), F.sum("n").alias("n"))


def price_shifts(prices: DataFrame) -> DataFrame:
    """(word, shift): (mean with the word - mean without it) / overall mean.

    The two totals come from one scalar subquery over the same word aggregate, whose shuffle
    Spark reuses. The only word of all is worth 1.0; an overall mean of zero is an error.
    """
    totals = word_totals(prices).select(
        F.array(F.col("price_sum"), F.col("n").cast("double")).alias("t")).scalar()
    joined = prices.select("word", "price_sum", F.col("n").cast("double").alias("n"),
                           totals.alias("t"))
    price_sum, n = F.col("price_sum"), F.col("n")
    all_sum, all_n = F.get("t", F.lit(0)), F.get("t", F.lit(1))
    without = (all_sum - price_sum) / (all_n - n)
    shift = F.when(all_n == n, F.lit(1.0)).otherwise(
        (price_sum / n - without) / (all_sum / all_n))
    return joined.select("word", shift.alias("shift"))


def top_bottom(shifts: DataFrame, k: int = 5) -> DataFrame:
    """(line, side, word, shift): the k highest, then the k lowest from high to low. Equal
    shifts are ordered by word; with fewer than 2k words the lists overlap."""
    top = shifts.orderBy(F.desc("shift"), "word").limit(k)
    low = shifts.orderBy("shift", "word").limit(k)
    # Both windows see at most k rows.
    ranked_top = top.select(
        F.row_number().over(Window.orderBy(F.desc("shift"), "word")).alias("line"),
        F.lit("top").alias("side"), "word", "shift")
    ranked_low = low.select(
        (F.lit(2 * k + 1) - F.row_number().over(Window.orderBy("shift", "word"))).alias("line"),
        F.lit("bottom").alias("side"), "word", "shift")
    return ranked_top.unionByName(ranked_low)
