"""URL generators: dense ids, evenly spaced shards, and seeds into the page archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _name(folder: str, pattern: str, number: Column) -> Column:
    return F.concat(F.lit(folder), F.format_string(pattern, number))


def property_url(base: str, number: Column) -> Column:
    return _name(base, "property_%06d.html", number)


def index_url(base: str, number: Column) -> Column:
    return _name(base, "index_%05d.html", number)


def detail_requests(spark: SparkSession, base: str, total: int, step: int = 1) -> DataFrame:
    """(id, url) for ids 1, 1+step, … up to ``total``; a detail page lists ``step`` items."""
    return spark.range(1, total + 1, step).select(
        "id", F.concat(F.lit(base + "detail?id0="), F.col("id").cast("string")).alias("url"))


def index_shards(spark: SparkSession, base: str, pages: int, shards: int = 20) -> DataFrame:
    """(shard, page, url): the first pages of ``shards`` equal slices of the index."""
    page = F.expr(f"({pages}L * id) div {shards}L")
    return spark.range(shards).select(
        F.col("id").alias("shard"), page.alias("page"), index_url(base, page).alias("url"))


def index_page_count(total: int, details_per_index: int = 20, items_per_detail: int = 1) -> int:
    """How many index pages list ``total`` items, rounded up."""
    worth = details_per_index * items_per_detail
    return (total + worth - 1) // worth


def index_page_shards(spark: SparkSession, base: str, pages: int, shards: int = 1) -> DataFrame:
    """(page, url) of each slice's first page. Pages count from 1 and the upper bound is
    exclusive, so an index of one page has no shard."""
    length = max((pages + shards - 1) // shards, 1)
    return spark.range(1, max(pages, 1), length).select(
        F.col("id").alias("page"),
        F.concat(F.lit(base + "index?p="), F.col("id").cast("string")).alias("url"))


def seed_pages(seeds: DataFrame, archive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split seed URLs into archived pages and misses; both joins are on ``url``."""
    return seeds.join(archive, "url"), seeds.join(archive.select("url"), "url", "left_anti")
