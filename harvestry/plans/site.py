"""A property site rendered from the part table: detail pages, index pages, list pages.

The archived ``pages`` carry no microdata, so these give the item extractors pages of the
kind they expect, as many as there are parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.plans.registry import table
from harvestry.session import by_key, spread
from harvestry.sources.generate import index_url, property_url

BASE = "http://web:9312/properties/"
PER_INDEX = 30  # parts per index page
PER_LIST = 20  # entries per list page


def parts(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))


def _joined(*pieces: str | Column) -> Column:
    return F.concat(*[F.lit(piece) if isinstance(piece, str) else piece for piece in pieces])


def _price_text() -> Column:
    """Prices in thousands, so that they need their comma: 1900.5 is "1,900.50"."""
    return F.format_number(F.col("p_retailprice") * 10, 2)


def detail_pages(spark, sf_dir) -> DataFrame:
    """(p_partkey, url, html): one property page per part."""
    html = _joined(
        "<html><head><title>", F.col("p_name"), "</title></head><body>",
        '<h1 itemprop="name">  ', F.col("p_name"), " \n</h1>",
        '<p class="price">now only <span itemprop="price">&pound;', _price_text(), "pw</span>",
        '<div itemprop="description">', F.col("p_brand"), " <br> ", F.col("p_type"), "</div>",
        '<div itemscope itemtype="http://schema.org/Place"> Street ',
        F.col("p_size").cast("string"), " </div>",
        '<img itemprop="image" src="../images/i', (F.col("p_partkey") % 100).cast("string"),
        '.jpg">')
    return parts(spark, sf_dir).select(
        "p_partkey", property_url(BASE, F.col("p_partkey")).alias("url"), html.alias("html"))


def _card() -> Column:
    return _joined(
        '<li itemscope itemtype="http://schema.org/Product">',
        '<a itemprop="url" href="property_', F.format_string("%06d", F.col("p_partkey")),
        '.html"><img itemprop="image" src="/images/i',
        (F.col("p_partkey") % 100).cast("string"), '.jpg"></a>',
        '<h3 itemprop="name"> ', F.col("p_name"), "</h3>",
        '<span itemprop="price">', _price_text(), "</span>",
        '<p itemprop="description">', F.col("p_brand"), "</p>",
        '<div itemtype="http://schema.org/Place"><span>Street ',
        F.col("p_size").cast("string"), "</span></div></li>")


def index_pages(spark, sf_dir) -> DataFrame:
    """(page, url, html): index pages of PER_INDEX cards, each linking to the next."""
    page = F.expr(f"p_partkey div {PER_INDEX}")
    cards = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("p_partkey", "card"))), lambda c: c["card"]), "")
    html = _joined(
        '<html><body><a class="link next" href="', index_url("", F.col("page") + 1),
        '">Next</a><ul>', F.col("cards"), "</ul>")
    cards_of = parts(spark, sf_dir).select(page.alias("page"), "p_partkey", _card().alias("card"))
    return (by_key(cards_of, "page").groupBy("page").agg(cards.alias("cards"))
            .select("page", index_url(BASE, F.col("page")).alias("url"), html.alias("html")))


def list_pages(spark, sf_dir) -> DataFrame:
    """(page, url, html): list pages of PER_LIST numbered entries; an entry of size 13 has
    a word where its number belongs."""
    number = F.when(F.col("p_size") == 13, "unnumbered").otherwise(
        F.col("p_partkey").cast("string"))
    entry = _joined("<li><h3>item ", number, '</h3><div class="info">', F.col("p_name"),
                    "</div>")
    entries = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("p_partkey", "entry"))), lambda e: e["entry"]), "")
    entries_of = parts(spark, sf_dir).select(
        F.expr(f"p_partkey div {PER_LIST}").alias("page"), "p_partkey", entry.alias("entry"))
    return (by_key(entries_of, "page").groupBy("page").agg(entries.alias("entries"))
            .select("page", _joined(BASE + "detail?id0=", F.col("page").cast("string"))
                    .alias("url"),
                    _joined("<html><body><ul>", F.col("entries"), "</ul>").alias("html")))
