"""Item cleaning, checking and sink queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.functions.urls import image_path
from harvestry.operators import enrich, extract
from harvestry.operators import items as ops
from harvestry.plans.registry import query, table, to6
from harvestry.schemas import CORRUPT
from harvestry.session import scratch_path, spread
from harvestry.sinks import rows
from harvestry.sources.files import read_items
from harvestry.streaming.signals import observe_items


def part_items(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", "p_brand", F.array("p_name").alias("title"),
        F.array("p_retailprice").alias("price"))


@query("""
    SELECT CASE WHEN p_size <> 13 THEN p_name END AS title,
           CASE WHEN p_size <> 13 THEN p_retailprice END AS price,
           CASE WHEN p_size = 13 THEN '{"title": ["' || p_name END AS malformed
    FROM part""")
def items_scan(spark, sf_dir):
    """A JSON-lines feed written to shared storage and read back; parts of size 13 leave cut
    lines behind, which come back as malformed."""
    line = F.when(F.col("p_size") == 13, F.concat(F.lit('{"title": ["'), F.get("title", F.lit(0)))
                  ).otherwise(F.to_json(F.struct("title", "price")))
    path = scratch_path(spark, "items")
    part_items(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_items(spark, path).select(
        F.get("title", F.lit(0)).alias("title"), F.get("price", F.lit(0)).alias("price"),
        F.col(CORRUPT).alias("malformed"))


_DOCUMENT = "CAST(to_json(struct_pack(title := [p_name], price := [p_retailprice])) AS VARCHAR)"


@query(f"SELECT 'properties' AS collection, {_DOCUMENT} AS document FROM part")
def item_documents(spark, sf_dir):
    return rows.item_documents(part_items(spark, sf_dir).select("title", "price"), "properties")


@query(f"SELECT p_partkey // 100 AS batch, {_DOCUMENT} AS line FROM part")
def feed_rows(spark, sf_dir):
    """Feed lines by crawl batch."""
    items = part_items(spark, sf_dir)
    return items.select(F.expr("p_partkey div 100").alias("batch"),
                        F.to_json(F.struct("title", "price")).alias("line"))


@query("""
    SELECT p_partkey, 'properties' AS project, 'easy' AS spider, 'web1' AS server,
           '2016-01-02T03:04:05.000600' AS date FROM part""")
def item_lineage(spark, sf_dir):
    run_time = F.lit("2016-01-02 03:04:05.0006").cast("timestamp_ntz")
    items = ops.tidy_dates(ops.with_lineage(
        part_items(spark, sf_dir), "properties", "easy", "web1", run_time))
    return items.select("p_partkey", *[F.get(field, F.lit(0)).alias(field)
                                       for field in ("project", "spider", "server", "date")])


@query("""
    SELECT id, CASE WHEN microsecond(d) % 1000000 = 0 THEN strftime(d, '%Y-%m-%dT%H:%M:%S')
                    ELSE strftime(d, '%Y-%m-%dT%H:%M:%S.%f') END AS date
    FROM (SELECT event_id AS id, ts AS d FROM events
          UNION ALL SELECT -o_orderkey, o_orderdate FROM orders)""")
def tidy_dates(spark, sf_dir):
    """ISO text of moments with and without a fraction."""
    dated = (table(spark, sf_dir, "events")
             .select(F.col("event_id").alias("id"), F.array("ts").alias("date"))
             .unionByName(table(spark, sf_dir, "orders").select(
                 (-F.col("o_orderkey")).alias("id"), F.array("o_orderdate").alias("date"))))
    return ops.tidy_dates(dated).select("id", F.get("date", F.lit(0)).alias("date"))


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'Not good' END AS reason
    FROM events""")
def drop_items(spark, sf_dir):
    """Accepted items and, with their reason, dropped ones."""
    judged = ops.judge(table(spark, sf_dir, "events").select("event_id", "event_type"),
                       [(F.col("event_type") == "error", "Not good")])
    accepted, dropped = ops.split(judged)
    return (accepted.select("event_id", F.lit(None).cast("string").alias("reason"))
            .unionByName(dropped.select("event_id", "reason")))


@query("""
    SELECT p_partkey, CASE WHEN p_size IN (7, 8) THEN 'no address' END AS reason FROM part""")
def require_fields(spark, sf_dir):
    """Sizes 7 and 8 have a missing and an empty address."""
    address = (F.when(F.col("p_size") == 8, F.array().cast("array<string>"))
               .when(F.col("p_size") != 7, F.array("p_brand")))
    items = part_items(spark, sf_dir).withColumn("address", address)
    return ops.require(items, ["title", "address"]).select("p_partkey", "reason")


@query("""
    WITH seen AS (SELECT 'brand/' || p_brand AS url, count(*) AS n,
                         count(*) FILTER (p_size = 7) AS lacks
                  FROM part GROUP BY p_brand),
    asked AS (SELECT 'brand/' || p_brand AS url FROM part GROUP BY p_brand
              UNION ALL SELECT 'region/' || r_name FROM region)
    SELECT url, 'returns' AS "check", 'items 0' AS detail
    FROM asked WHERE url NOT IN (SELECT url FROM seen)
    UNION ALL
    SELECT url, 'scrapes', 'address' FROM seen WHERE lacks > 0""")
def contract_check(spark, sf_dir):
    """Contracts per brand page, and for region pages that yield no items."""
    address = F.when(F.col("p_size") != 7, F.array("p_brand"))
    items = part_items(spark, sf_dir).select(
        F.concat(F.lit("brand/"), "p_brand").alias("url"), "title", "price",
        address.alias("address"))
    asked = items.select("url").distinct().unionByName(
        table(spark, sf_dir, "region").select(F.concat(F.lit("region/"), "r_name").alias("url")))
    contracts = asked.select(
        "url", F.lit(1).alias("min_items"),
        F.array(F.lit("title"), F.lit("price"), F.lit("address")).alias("fields"))
    return ops.check_contracts(items, contracts, ["title", "price", "address"])


@query("""
    SELECT url, 'full/' || sha1(url) || '.jpg' AS path,
           'thumbs/small/' || sha1(url) || '.jpg' AS thumbnail
    FROM (SELECT url FROM pages
          UNION SELECT regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/logo.png' FROM pages)""")
def image_manifest(spark, sf_dir):
    """Every page as an image, and its site's logo, which many pages share."""
    logo = F.concat(F.regexp_extract("url", r"^(https?://[^/?#]*)", 1), F.lit("/logo.png"))
    items = table(spark, sf_dir, "pages").select(F.array(F.col("url"), logo).alias("image_urls"))
    return rows.image_manifest(items)


_PREFIX = "http://web:9312/" + "long-path/" * 8  # with a key of 5 or more digits over 100


UPSERT_SQL = f"""
    WITH rows AS (
      SELECT ('{_PREFIX}' || l_partkey)[1:100] AS url,
             ('order ' || l_orderkey || ' of line ' || l_linenumber || ' in all its length')[1:30]
               AS title, l_extendedprice AS price,
             (l_returnflag || ' ' || l_linestatus || ' kept until the ship date')[1:30]
               AS description, l_orderkey * 8 + l_linenumber AS seq
      FROM lineitem
      UNION ALL
      SELECT ('{_PREFIX}' || p_partkey)[1:100], p_name[1:30], p_retailprice, p_type[1:30], -1
      FROM part)
    SELECT url, title, price, description FROM (
      SELECT *, row_number() OVER (PARTITION BY url
        ORDER BY seq DESC, title DESC, price DESC, description DESC) AS r FROM rows)
    WHERE r = 1"""


def _versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Rows of the parts, and of the line items that replace them by cut URL."""
    def items(source, key, title, price, description, seq):
        return source.select(
            F.array(F.concat(F.lit(_PREFIX), F.col(key).cast("string"))).alias("url"),
            F.array(title).alias("title"), F.array(price).alias("price"),
            F.array(description).alias("description"), seq.alias("seq"))

    new = items(
        spread(table(spark, sf_dir, "lineitem").drop("l_suppkey", "l_quantity", "l_discount",
                                                     "l_tax", "l_shipdate")), "l_partkey",
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string"), F.lit(" of line "),
                 F.col("l_linenumber").cast("string"), F.lit(" in all its length")),
        F.col("l_extendedprice"),
        F.concat("l_returnflag", F.lit("\r\n"), "l_linestatus",
                 F.lit("\r\nkept until the ship date")),
        F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    old = items(table(spark, sf_dir, "part"), "p_partkey", F.col("p_name"),
                F.col("p_retailprice"), F.col("p_type"), F.lit(-1).cast("long"))
    return rows.upsert_rows(old, cut_key=True), rows.upsert_rows(new, cut_key=True)


@query(UPSERT_SQL)
def upsert_rows(spark, sf_dir):
    """Line items replace the parts' rows by cut URL, the latest version winning."""
    old, new = _versions(spark, sf_dir)
    return rows.upsert(old.drop("seq"), new).drop("key")


@query(UPSERT_SQL)
def upsert_table(spark, sf_dir):
    """The same into a written target: the parts' rows, then the line items in two runs, each
    replacing the key buckets it touches."""
    path = scratch_path(spark, "target")
    old, new = _versions(spark, sf_dir)
    rows.upsert_table(old, path)
    # Each key's latest rows come in the second run.
    newest = new.groupBy("key").agg(F.max("seq").alias("last"))
    run = new.join(newest, "key")
    rows.upsert_table(run.where(F.col("seq") < F.col("last")).drop("last"), path)
    rows.upsert_table(run.where(F.col("seq") == F.col("last")).drop("last"), path)
    return rows.read_table(spark, path).drop("key")


def legacy_sql(price: str) -> str:
    y = f"(1.2::DOUBLE * round({price}, 6))"
    return (f"CASE WHEN {y} = floor({y}) THEN {y} "
            f"ELSE CAST(format('{{:.6g}}', {y}) AS DOUBLE) END")


@query(f"""
    SELECT p_partkey, {legacy_sql('p_retailprice')} AS legacy,
           {legacy_sql('(p_retailprice + 1)')} AS chained, p_size AS second
    FROM part""")
def price_chain(spark, sf_dir):
    """The legacy calculator alone, and after the surcharge; only the first price changes."""
    items = table(spark, sf_dir, "part").select(
        "p_partkey", F.array("p_retailprice", F.col("p_size").cast("double")).alias("price"))
    legacy = enrich.legacy_pricing(items.withColumn("base", F.col("price")))
    chained = enrich.legacy_pricing(enrich.add_surcharge(
        legacy.withColumnRenamed("price", "alone").withColumnRenamed("base", "price")))
    return chained.select(
        "p_partkey", F.get("alone", F.lit(0)).alias("legacy"),
        F.get("price", F.lit(0)).alias("chained"),
        F.get("price", F.lit(1)).cast("int").alias("second")).select(
        "p_partkey", *to6("legacy", "chained"), "second")


@query("""
    SELECT 'full/' || sha1(url) || '.jpg' AS path, url, md5(min(html)) AS checksum
    FROM pages GROUP BY url""")
def image_checksums(spark, sf_dir):
    """The manifest's images with the checksums of the stored files: pages stand in for them."""
    pages = table(spark, sf_dir, "pages").groupBy("url").agg(F.min("html").alias("html"))
    manifest = rows.image_manifest(pages.select(F.array("url").alias("image_urls")))
    root = "store://images"
    files = pages.select(F.concat(F.lit(root + "/"), image_path(F.col("url"))).alias("path"),
                         F.encode("html", "UTF-8").alias("content"))
    return rows.image_records(manifest, files, root)


@query(f"""
    SELECT p_partkey, round({legacy_sql('(p_retailprice + 1)')}, 6) AS price,
           p_retailprice AS listed FROM part""")
def stages_off(spark, sf_dir):
    """Pipeline stages by number, two of them switched off."""
    items = table(spark, sf_dir, "part").select(
        "p_partkey", F.array("p_retailprice").alias("price"),
        F.col("p_retailprice").alias("listed"))
    done = ops.run_stages(items, [
        (300, enrich.legacy_pricing), (100, None), (200, enrich.add_surcharge), (400, None)])
    return done.select("p_partkey", F.round(F.get("price", F.lit(0)), 6).alias("price"),
                       "listed")


@query("""
    SELECT 'item_dropped' AS signal, count(*) FILTER (p_size IN (13, 7)) AS n FROM part
    UNION ALL SELECT 'item_scraped', count(*) FILTER (p_size NOT IN (13, 7)) FROM part""")
def observed_signals(spark, sf_dir):
    """Items scraped and dropped, counted by an observation while a sink reads them."""
    judged = ops.judge(part_items(spark, sf_dir), [
        (F.col("p_size") == 13, "unlucky"), (F.col("p_size") == 7, "lucky")])
    watched, counts = observe_items(judged)
    watched.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(counts.get.items()), "signal string, n long")


@query("""
    SELECT page_id, lower(url) AS url, count(*) AS links FROM (
      SELECT page_id, url, unnest(regexp_extract_all(html, '<a\\b[^>]*\\bhref="([^"]*)"', 1))
      FROM pages WHERE length(html) > 2000) GROUP BY ALL""")
def hooked_links(spark, sf_dir):
    """Extraction between hooks: short pages are held back before it; after it links are
    counted per page, then addresses put in lower case."""
    extracted = ops.with_hooks(
        extract.page_anchors, before=[lambda pages: pages.where("length(html) > 2000")],
        after=[lambda counted: counted.withColumn("url", F.lower("url")),
               lambda links: links.groupBy("page_id", "url").agg(
                   F.count(F.lit(1)).alias("links"))])
    return extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
