"""Word-price analytics on parts and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.operators import boost
from harvestry.plans.registry import query, table, to6
from harvestry.session import spread


def part_items(spark, sf_dir) -> DataFrame:
    """Parts as priced titles."""
    return table(spark, sf_dir, "part").select(
        F.array("p_name").alias("title"), F.array("p_retailprice").alias("price"))


def document_items(spark, sf_dir) -> DataFrame:
    """Documents as titles, their length as the price."""
    documents = spread(table(spark, sf_dir, "documents").select("text", "n_chars"))
    return documents.select(
        F.array("text").alias("title"), F.array(F.col("n_chars").cast("double")).alias("price"))


def words_sql(source: str, title: str, price: str) -> str:
    return f"""
    words AS (
      SELECT lower(unnest(list_distinct(list_filter(
               string_split_regex({title}, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')))) AS word,
             CAST({price} AS DOUBLE) AS price
      FROM {source}),
    prices AS (
      SELECT word, sum(price) AS price_sum, count(*) AS n FROM words GROUP BY word),
    totals AS (SELECT sum(price_sum) AS s0, sum(n) AS n0 FROM prices),
    shifts AS (
      SELECT word, CASE WHEN n0 = n THEN 1.0
               ELSE (price_sum / n - (s0 - price_sum) / (n0 - n)) / (s0 / n0) END AS shift
      FROM prices, totals)"""


PART_WORDS = words_sql("part", "p_name", "p_retailprice")
SHIFTS_SQL = f"WITH {PART_WORDS} SELECT word, round(shift, 6) AS shift FROM shifts"


@query(SHIFTS_SQL)
def boost_words(spark, sf_dir):
    shifts = boost.price_shifts(boost.word_prices(part_items(spark, sf_dir)))
    return shifts.select("word", *to6("shift"))


@query(f"WITH {words_sql('documents', 'text', 'n_chars')} "
       "SELECT word, round(shift, 6) AS shift FROM shifts")
def boost_words_docs(spark, sf_dir):
    shifts = boost.price_shifts(boost.word_prices(document_items(spark, sf_dir)))
    return shifts.select("word", *to6("shift"))


@query(f"WITH {PART_WORDS} SELECT word, round(price_sum, 6) AS price_sum, n FROM prices")
def word_prices(spark, sf_dir):
    prices = boost.word_prices(part_items(spark, sf_dir))
    return prices.select("word", *to6("price_sum"), "n")


@query(f"WITH {PART_WORDS} "
       "SELECT round(s0, 6) AS price_sum, CAST(n0 AS BIGINT) AS n FROM totals")
def word_totals(spark, sf_dir):
    totals = boost.word_totals(boost.word_prices(part_items(spark, sf_dir)))
    return totals.select(*to6("price_sum"), "n")


@query(f"""WITH {words_sql('documents', 'text', 'n_chars')},
    top AS (SELECT CAST(row_number() OVER (ORDER BY shift DESC, word) AS INTEGER) AS line,
                   'top' AS side, word, shift FROM shifts),
    low AS (SELECT CAST(11 - row_number() OVER (ORDER BY shift, word) AS INTEGER) AS line,
                   'bottom' AS side, word, shift FROM shifts)
    SELECT line, side, word, round(shift, 6) AS shift FROM (
      SELECT * FROM top WHERE line <= 5 UNION ALL SELECT * FROM low WHERE line > 5)""")
def boost_top_bottom(spark, sf_dir):
    shifts = boost.price_shifts(boost.word_prices(document_items(spark, sf_dir)))
    # Ranked on rounded shifts would invite ties; rank first, round last.
    return boost.top_bottom(shifts).select("line", "side", "word", *to6("shift"))
