"""The whole way of an item: page, extraction, stages, rows of the target table, document."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.operators import enrich, extract
from harvestry.operators.items import run_stages, tidy_dates, with_lineage
from harvestry.plans import site
from harvestry.plans.extraction import _TITLE
from harvestry.plans.items import legacy_sql
from harvestry.plans.registry import query
from harvestry.session import store
from harvestry.sinks import rows

_STREETS = """
    streets AS (SELECT p_size, 'Street ' || p_size AS address, p_size < 15 AS cached,
                       p_size < 40 AS known
                FROM part GROUP BY p_size),
    items AS (SELECT * FROM part JOIN streets USING (p_size))"""

_PRICE = legacy_sql("(round(p_retailprice * 10, 2) + 1)")


def streets(spark, sf_dir):
    """The distinct addresses of the site with their size number."""
    return site.parts(spark, sf_dir).select("p_size", F.concat(
        F.lit("Street "), F.col("p_size").cast("string")).alias("address")).distinct()


def finished_items(spark, sf_dir):
    """Property pages through extraction and all stages, stored once for all sinks. Streets
    below 15 are cached; the replies know none from 40."""
    known = streets(spark, sf_dir)
    size = F.col("p_size").cast("double")
    cache = known.filter("p_size < 15").select(
        enrich.cache_key(F.col("address")).alias("key"),
        F.to_json(F.struct(size.alias("lat"), (-size).alias("lon"))).alias("value"))
    point = F.struct(F.struct(F.struct((size / 2).alias("lat"), size.alias("lng"))
                              .alias("location")).alias("geometry"))
    found = F.col("p_size") < 40
    replies = known.select("address", F.lit(0).alias("attempt"), F.to_json(F.struct(
        F.when(found, "OK").otherwise("ZERO_RESULTS").alias("status"),
        F.when(found, F.array(point)).alias("results"))).alias("body"))
    settled = enrich.settle_replies(replies)
    pages = site.detail_pages(spark, sf_dir).withColumnRenamed("p_partkey", "seq")
    items = with_lineage(extract.detail_items(pages), "properties", "easy", "web1",
                         F.lit("2016-01-02 03:04:05").cast("timestamp_ntz"))
    location = F.lit(None).cast("struct<lat:double,lon:double>")
    finished = run_stages(items.withColumn("location", location), [
        (100, tidy_dates),
        (200, enrich.with_address),
        (300, lambda frame: enrich.from_cache(frame, cache)),
        (400, lambda frame: enrich.from_replies(frame, settled)),
        (450, enrich.without_address),
        (500, enrich.add_surcharge),
        (600, enrich.legacy_pricing),
    ])
    return store(finished, "items")


@query(f"""
    SELECT 'http://web:9312/properties/property_' || format('{{:06d}}', p_partkey) || '.html'
             AS url, ({_TITLE})[1:30] AS title, {_PRICE} AS price,
           (p_brand || ' ' || p_type)[1:30] AS description
    FROM part""")
def published_rows(spark, sf_dir):
    """What the target table receives."""
    return rows.upsert_rows(finished_items(spark, sf_dir)).drop("key", "seq")


@query(f"""
    WITH {_STREETS}
    SELECT p_partkey AS seq, {_TITLE} AS title, {_PRICE} AS price, address,
           CASE WHEN cached THEN 'already_set' WHEN known THEN 'found' ELSE 'error' END AS geo,
           CASE WHEN cached THEN CAST(p_size AS DOUBLE) WHEN known THEN p_size / 2 END AS lat,
           CASE WHEN cached THEN CAST(-p_size AS DOUBLE)
                WHEN known THEN CAST(p_size AS DOUBLE) END AS lon,
           'easy' AS spider, '2016-01-02T03:04:05' AS date
    FROM items""")
def published_documents(spark, sf_dir):
    """What the document index receives, read back from its JSON."""
    items = finished_items(spark, sf_dir)
    documents = rows.item_documents(items, "properties")
    back = documents.select(F.from_json("document", items.schema).alias("d")).select("d.*")
    return back.select(
        "seq", *[F.get(field, F.lit(0)).alias(field)
                 for field in ("title", "price", "address")],
        "geo", "location.lat", "location.lon",
        *[F.get(field, F.lit(0)).alias(field) for field in ("spider", "date")])
