"""URL frontier and link-graph queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.operators import frontier, reach
from harvestry.plans.registry import query, table
from harvestry.sources import generate
from harvestry.sources.documents import worker_urls

SITE = "http://web:9312/"
BATCH_SIZE = 100

# The workers that get the batches, and the rule whose requests are batched.
TARGETS = ["scrapyd1:6800", "scrapyd2:6800", "scrapyd3:6800"]
TARGET_RULE = 1


def part_total(spark, sf_dir) -> int:
    """The number of parts, from the parquet footers."""
    return table(spark, sf_dir, "part").count()


@query("""
    SELECT id, 'http://web:9312/detail?id0=' || id AS url
    FROM (SELECT unnest(range(1, (SELECT count(*) FROM part) + 1, 5)) AS id)""")
def url_generate(spark, sf_dir):
    """Detail requests, five items to a page, for as many items as there are parts."""
    return generate.detail_requests(spark, SITE, part_total(spark, sf_dir), 5)


@query("""
    WITH n AS (SELECT (count(*) + 29) // 30 AS pages FROM part),
    shards AS (SELECT s AS shard, (pages * s) // 20 AS page FROM n, range(20) t(s)),
    held AS (SELECT ((p_partkey // 30 + 1) * 20 - 1) // pages AS shard, count(*) AS items
             FROM part, n GROUP BY 1)
    SELECT shard, page, 'http://web:9312/index_' || format('{:05d}', page) || '.html' AS url,
           coalesce(items, 0) AS items
    FROM shards LEFT JOIN held USING (shard)""")
def index_shards(spark, sf_dir):
    """Twenty start pages spread over the index, and how many parts each shard lists."""
    pages = generate.index_page_count(part_total(spark, sf_dir), 30)
    shard = F.expr(f"((p_partkey div 30 + 1) * 20 - 1) div {pages}")
    held = (table(spark, sf_dir, "part").groupBy(shard.alias("shard"))
            .agg(F.count(F.lit(1)).alias("items")))
    return (generate.index_shards(spark, SITE, pages).join(held, "shard", "left")
            .select("shard", "page", "url", F.coalesce("items", F.lit(0)).alias("items")))


@query("""
    WITH n AS (SELECT (count(*) + 19) // 20 AS pages FROM part),
    w AS (SELECT pages, greatest((pages + 6) // 7, 1) AS width FROM n),
    held AS (SELECT (p_partkey // 20) // width * width + 1 AS page, count(*) AS items
             FROM part, w GROUP BY 1)
    SELECT page, 'http://web:9312/index?p=' || page AS url, items
    FROM (SELECT unnest(range(1, pages, width)) AS page FROM w) JOIN held USING (page)""")
def index_page_shards(spark, sf_dir):
    """The index cut into seven shards of whole pages."""
    pages = generate.index_page_count(part_total(spark, sf_dir), 20)
    width = max((pages + 6) // 7, 1)
    page = F.expr(f"(p_partkey div 20) div {width} * {width} + 1")
    held = (table(spark, sf_dir, "part").groupBy(page.alias("page"))
            .agg(F.count(F.lit(1)).alias("items")))
    return generate.index_page_shards(spark, SITE, pages, 7).join(held, "page")


def line_requests(spark, sf_dir) -> DataFrame:
    """One request per line item, (url, pos); popular parts are asked for many times."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(SITE + "item/"), F.col("l_partkey").cast("string")).alias("url"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"))


_FIRSTS = """
    firsts AS (SELECT 'http://web:9312/item/' || l_partkey AS url,
                      min(l_orderkey * 8 + l_linenumber) AS pos
               FROM lineitem GROUP BY l_partkey)"""

_BATCHES = f"""
    WITH {_FIRSTS},
    numbered AS (SELECT url, row_number() OVER (ORDER BY pos, url) AS number FROM firsts),
    batches AS (SELECT (number - 1) // {BATCH_SIZE} + 1 AS batch, count(*) AS n,
                       list(url ORDER BY number) AS links FROM numbered GROUP BY 1)"""

_TARGET = "'scrapyd' || ((batch - 1) % 3 + 1) || ':6800'"


@query(f"""
    WITH {_FIRSTS}
    SELECT url, pos FROM firsts
    WHERE url NOT IN (SELECT 'http://web:9312/item/' || p_partkey FROM part WHERE p_size < 10)""")
def url_dedup(spark, sf_dir):
    """New URLs at their first position; small parts were seen in an earlier run."""
    seen = table(spark, sf_dir, "part").filter("p_size < 10").select(
        F.concat(F.lit(SITE + "item/"), F.col("p_partkey").cast("string")).alias("url"))
    return frontier.first_seen(line_requests(spark, sf_dir), seen)


def batches(spark, sf_dir) -> DataFrame:
    return frontier.url_batches(
        frontier.first_seen(line_requests(spark, sf_dir)), BATCH_SIZE, TARGETS)


URL_BATCHES_SQL = f"""
    {_BATCHES} SELECT batch, {_TARGET} AS target, n,
      '["' || array_to_string(links, '","') || '"]' AS urls FROM batches"""


@query(URL_BATCHES_SQL)
def url_batches(spark, sf_dir):
    return batches(spark, sf_dir)


@query(f"""
    {_BATCHES} SELECT batch, {_TARGET} AS target, CAST(pos - 1 AS INTEGER) AS pos,
      links[pos] AS url, 1 AS rule
    FROM (SELECT *, unnest(range(1, len(links) + 1)) AS pos FROM batches)""")
def batch_unpack(spark, sf_dir):
    """What the workers receive, one row per URL."""
    return worker_urls(batches(spark, sf_dir), TARGET_RULE).select(
        "batch", "target", "pos", "url", "rule")


@query("""
    SELECT event_id, CASE WHEN event_type = 'click' THEN 'batch' ELSE 'pass' END AS route
    FROM events""")
def route_outputs(spark, sf_dir):
    """Purchases are items, the rest requests; clicks follow the target rule, views another,
    the remaining ones none."""
    outputs = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "purchase", "item").otherwise("request").alias("kind"),
        F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 0)
        .alias("rule"))
    return frontier.route(outputs, TARGET_RULE).select("event_id", "route")


@query("""
    SELECT event_id, priority, row_number() OVER (ORDER BY priority DESC, event_id) AS turn
    FROM (SELECT event_id, CAST(event_type = 'view' AS INTEGER) AS priority FROM events)""")
def frontier_order(spark, sf_dir):
    """Every request's turn: index requests (views) before the others."""
    requests = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "view", 1).otherwise(0).alias("priority"))
    return frontier.dispatch_order(requests, "event_id").select("event_id", "priority", "turn")


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'request not sent'
                          WHEN k >= 80 THEN 'request failed: ' || (400 + k)
                          WHEN k % 10 = 3 THEN 'operation error' END AS problem
    FROM (SELECT event_id, event_type, CAST(props::JSON->>'k' AS INTEGER) AS k FROM events)""")
def dispatch_triage(spark, sf_dir):
    k = F.col("_k")
    replies = table(spark, sf_dir, "events").withColumn(
        "_k", F.get_json_object("props", "$.k").cast("int")).select(
        "event_id", (F.col("event_type") != "error").alias("sent"),
        F.when(k >= 80, 400 + k).otherwise(200).alias("code"),
        F.when(k % 10 == 3, "error").otherwise("ok").alias("status"))
    return frontier.triage(replies).select("event_id", "problem")


def _page(kind: str, number) -> F.Column:
    return F.concat(F.lit(kind + "/"), number.cast("string"))


@query("""
    WITH RECURSIVE pages AS (
      SELECT p_partkey // 20 AS page FROM part GROUP BY 1),
    walk AS (
      SELECT 0 AS page, CAST(0 AS BIGINT) AS depth
      UNION ALL
      SELECT p.page, w.depth + 1 FROM walk w JOIN pages p ON p.page = w.page + 1)
    SELECT 'index' AS kind, 'index/' || page AS url, depth FROM walk
    UNION ALL
    SELECT 'item', 'item/' || p_partkey, depth + 1
    FROM walk JOIN part ON p_partkey // 20 = page""")
def crawl_reach(spark, sf_dir):
    """From the first index page along "next" links, collecting item links on the way. The
    chain is as long as the index."""
    part = table(spark, sf_dir, "part")
    page = F.expr("p_partkey div 20")
    follow = part.filter(page > 0).select(
        _page("index", page - 1).alias("src"), _page("index", page).alias("dst"))
    items = part.select(_page("index", page).alias("src"),
                        _page("item", F.col("p_partkey")).alias("dst"))
    seeds = part.filter("p_partkey = 0").select(_page("index", page).alias("url"))
    return reach.crawl(seeds, follow, items)


@query("""
    WITH RECURSIVE edges AS (
      SELECT 'region/' || n_regionkey AS src, 'nation/' || n_nationkey AS dst FROM nation
      UNION SELECT 'nation/' || n_nationkey, 'region/' || n_regionkey FROM nation
      UNION SELECT 'nation/' || c_nationkey, 'customer/' || c_custkey FROM customer
      UNION SELECT 'customer/' || o_custkey, 'order/' || o_orderkey FROM orders),
    walk AS (
      SELECT 'region/' || r_regionkey AS url, CAST(0 AS BIGINT) AS depth FROM region
      UNION
      SELECT e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.url WHERE w.depth < 4),
    reached AS (SELECT url, min(depth) AS depth FROM walk GROUP BY url)
    SELECT 'index' AS kind, url, depth FROM reached
    UNION ALL
    SELECT 'item', 'part/' || l_partkey, min(depth) + 1
    FROM reached JOIN lineitem ON url = 'order/' || l_orderkey GROUP BY l_partkey""")
def crawl_reach_tree(spark, sf_dir):
    """A branching site with links back: regions to nations to customers to orders, whose
    line items name the parts."""
    def links(name, src_kind, src, dst_kind, dst):
        return table(spark, sf_dir, name).select(
            _page(src_kind, F.col(src)).alias("src"), _page(dst_kind, F.col(dst)).alias("dst"))

    follow = (links("nation", "region", "n_regionkey", "nation", "n_nationkey")
              .unionByName(links("nation", "nation", "n_nationkey", "region", "n_regionkey"))
              .unionByName(links("customer", "nation", "c_nationkey", "customer", "c_custkey"))
              .unionByName(links("orders", "customer", "o_custkey", "order", "o_orderkey")))
    items = links("lineitem", "order", "l_orderkey", "part", "l_partkey")
    seeds = table(spark, sf_dir, "region").select(
        _page("region", F.col("r_regionkey")).alias("url"))
    return reach.crawl(seeds, follow, items)
