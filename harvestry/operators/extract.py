"""From archived pages to items: selector rules, multi-record pages and rule tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions import markup, text, urls

# Where a property page keeps each field.
DETAIL_RULES = {
    "title": '//*[@itemprop="name"][1]/text()',
    "price": './/*[@itemprop="price"][1]/text()',
    "description": '//*[@itemprop="description"][1]/text()',
    "address": '//*[@itemtype="http://schema.org/Place"][1]/text()',
    "image_urls": '//*[@itemprop="image"][1]/@src',
}

# The same fields inside one card of an index page.
CARD = '//*[@itemtype="http://schema.org/Product"]'
CARD_RULES = {
    "title": './/*[@itemprop="name"][1]/text()',
    "price": './/*[@itemprop="price"][1]/text()',
    "description": './/*[@itemprop="description"][1]/text()',
    "address": './/*[@itemtype="http://schema.org/Place"][1]/*/text()',
    "image_urls": './/*[@itemprop="image"][1]/@src',
    "url": './/*[@itemprop="url"][1]/@href',
}

# Links to the next index page and to the items of an index page.
NEXT_LINKS = '//*[contains(@class,"next")]//@href'
ITEM_LINKS = '//*[@itemprop="url"]/@href'

# List pages with a numbered heading per entry.
LIST_ENTRY = "//li"
LIST_RULES = {"heading": ".//h3/text()", "info": './/div[@class="info"]/text()'}


def select_fields(pages: DataFrame, rules: dict[str, str], html: str = "html") -> DataFrame:
    """Replace ``html`` by one array<string> column per rule, all from a single parse."""
    for path in rules.values():
        markup.compile_path(path)
    found = markup.select_texts(F.col(html), F.array(*map(F.lit, rules.values())))
    return (pages.withColumn("_found", found).drop(html)
            .withColumns({field: F.get("_found", F.lit(i)) for i, field in enumerate(rules)})
            .drop("_found"))


def select_cards(pages: DataFrame, card: str, rules: dict[str, str],
                 html: str = "html") -> DataFrame:
    """One row per node ``card`` selects, numbered from 0 by ``pos``, one column per rule."""
    found = markup.select_records(F.col(html), card, list(rules.values()))
    exploded = (pages.withColumn("_cards", found).drop(html)
                .select("*", F.posexplode("_cards").alias("pos", "_card")).drop("_cards"))
    return exploded.withColumns(
        {field: F.get("_card", F.lit(i)) for i, field in enumerate(rules)}).drop("_card")


def load_item(fields: DataFrame, page_url: str, own_url: bool = True) -> DataFrame:
    """Run the field processors over selected texts; empty fields become NULL.

    ``page_url`` is the column links are resolved against; with ``own_url`` it is also the
    item's URL, otherwise a selected ``url`` field is resolved and kept.
    """
    base = F.col(page_url)

    def absolute(field: str) -> Column:
        return text.each(F.col(field), lambda href: urls.join_url(base, href))

    processed = fields.withColumns({
        "title": text.each(F.col("title"), text.strip, text.title_case),
        "price": text.numbers(F.col("price")),
        "description": F.array(F.array_join(text.each(F.col("description"), text.strip), " ")),
        "address": text.each(F.col("address"), text.strip),
        "image_urls": absolute("image_urls"),
        "url": F.array(base) if own_url else absolute("url"),
    })
    # A step of its own: the test for emptiness must not process the values again.
    return processed.withColumns({
        field: text.none_if_empty(F.col(field))
        for field in ("title", "price", "address", "image_urls", "url")})


def detail_items(pages: DataFrame) -> DataFrame:
    """Pages (url, html, ...) to one item each; other columns are carried along."""
    fields = select_fields(pages.withColumnRenamed("url", "_page"), DETAIL_RULES)
    return load_item(fields, "_page").drop("_page")


def card_items(pages: DataFrame) -> DataFrame:
    """Index pages (url, html, ...) to one item per product card, without detail pages."""
    fields = select_cards(pages.withColumnRenamed("url", "_page"), CARD, CARD_RULES)
    return load_item(fields, "_page", own_url=False).drop("_page")


def list_entries(pages: DataFrame) -> DataFrame:
    """List pages to (…, pos, id, info); an id that is no number is NULL (see quarantine)."""
    entries = select_cards(pages, LIST_ENTRY, LIST_RULES)
    second_word = F.get(text.words(F.get("heading", F.lit(0))), F.lit(1))
    return entries.withColumn("id", second_word.try_cast("int")).drop("heading")


def page_links(pages: DataFrame, paths: list[str]) -> DataFrame:
    """(…, rule, url) for the hrefs each path selects; an earlier rule keeps a shared link.

    The claim is settled inside each page's own arrays, so no shuffle is needed.
    """
    fields = {f"_rule_{i}": path for i, path in enumerate(paths)}
    found = select_fields(pages, fields)
    return _claim(found, [F.col(field) for field in fields]).drop(*fields)


def _claim(found: DataFrame, hrefs: list[Column]) -> DataFrame:
    claimed, groups = None, []
    for rule, links in enumerate(hrefs):
        links = F.transform(links, lambda href: urls.join_url(F.col("url"), href))
        fresh = F.array_distinct(links) if claimed is None else F.array_except(links, claimed)
        claimed = links if claimed is None else F.concat(claimed, links)
        number = F.lit(rule).alias("rule")
        groups.append(F.transform(fresh, lambda link: F.struct(number, link.alias("link"))))
    # "outer" and a filter: a plain generator infers a filter that repeats the matching.
    return (found.withColumn("_links", F.concat(*groups))
            .select("*", F.inline_outer("_links")).drop("_links")
            .filter(F.col("rule").isNotNull()))


ANCHORS = "//a/@href"


def page_anchors(pages: DataFrame) -> DataFrame:
    """(…, pos, href) for the link of every anchor: any case and quoting, entities decoded,
    none from comments or scripts. Only ``html`` crosses to Python."""
    hrefs = F.get(markup.select_texts(F.col("html"), F.array(F.lit(ANCHORS))), F.lit(0))
    return (pages.withColumn("_hrefs", hrefs).drop("html")
            .select("*", F.posexplode_outer("_hrefs").alias("pos", "href")).drop("_hrefs")
            .filter(F.col("pos").isNotNull()))


def anchors_by_region(pages: DataFrame, regions: list[str | None]) -> DataFrame:
    """Like :func:`page_links` for regions given as tag names (None: the whole page)."""
    return page_links(pages, [f"//{tag}{ANCHORS}" if tag else ANCHORS
                              for tag in regions]).drop("html")


def rule_rows(rules: DataFrame, url: str = "url") -> DataFrame:
    """A wide rule table as (url, field, path) rows; blank cells are no rules."""
    fields = [field for field in rules.columns if field != url]
    return (rules.unpivot([url], fields, "field", "path")
            .filter(F.col("path").isNotNull() & (text.strip(F.col("path")) != "")))


def rule_items(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Apply each rule row to the page of its URL: (url, fields), fields being a map from
    field name to the selected values.

    ``rules`` is wide: ``url`` plus one path column per field. The join drops pages without
    rules before any parsing, a page is parsed once for all rules of its row, and the map is
    built inside the row, so nothing is grouped.
    """
    cells = F.filter(
        F.array(*[F.struct(F.lit(field).alias("field"), F.col(field).alias("path"))
                  for field in rules.columns if field != "url"]),
        lambda rule: rule["path"].isNotNull() & (text.strip(rule["path"]) != ""))
    todo = rules.select("url", cells.alias("_rules")).filter(F.size("_rules") > 0)
    return (pages.select("url", "html").join(todo, "url")
            .select("url", F.map_from_arrays(
                F.col("_rules.field"),
                markup.select_texts(F.col("html"), F.col("_rules.path"))).alias("fields")))


def rule_values(items: DataFrame) -> DataFrame:
    """Dynamic items in long form: (url, field, pos, value)."""
    return (items.select("url", F.explode("fields").alias("field", "_values"))
            .select("url", "field", F.posexplode("_values").alias("pos", "value")))
