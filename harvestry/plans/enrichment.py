"""Cache, geocode and translation queries: orders as items, their customer's name as the
address, recorded replies derived from the customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.operators import enrich
from harvestry.operators.items import run_stages, tidy_dates
from harvestry.plans.items import legacy_sql
from harvestry.plans.registry import query, table
from harvestry.sources.documents import cached_location, geocode_location, geocode_status


def order_items(spark, sf_dir) -> DataFrame:
    """Finished orders come with a location."""
    location = F.when(F.col("o_orderstatus") == "F", F.struct(
        F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon")))
    name = F.concat(F.lit("Customer#"), F.format_string("%09d", "o_custkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.array(name).alias("address"), location.alias("location"),
        F.array("o_orderdate").alias("date"), F.array("o_totalprice").alias("price"))


def cache(spark, sf_dir) -> DataFrame:
    """Customers with a balance over 3000, at a place of their own."""
    value = F.to_json(F.struct(F.col("c_acctbal").alias("lat"),
                               F.col("c_nationkey").cast("double").alias("lon")))
    return table(spark, sf_dir, "customer").filter("c_acctbal > 3000").select(
        enrich.cache_key(F.col("c_name")).alias("key"), value.alias("value"))


def replies(spark, sf_dir) -> DataFrame:
    """Recorded replies: some segments run into the quota first, some names are unknown."""
    point = F.struct(F.struct(F.struct(
        (F.col("c_nationkey") * 1.5).alias("lat"), F.col("c_acctbal").alias("lng"),
    ).alias("location")).alias("geometry"))
    unknown = F.col("c_mktsegment") == "MACHINERY"
    final = F.to_json(F.struct(
        F.when(unknown, "ZERO_RESULTS").otherwise("OK").alias("status"),
        F.when(~unknown, F.array(point)).alias("results")))
    quota = F.to_json(F.struct(F.lit(enrich.QUOTA).alias("status")))
    tries = F.when(F.col("c_mktsegment") == "BUILDING", F.array(quota, quota, final)
                   ).otherwise(F.array(final))
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("address"), F.posexplode(tries).alias("attempt", "body"))


_ITEMS = """
    items AS (SELECT o.*, o_orderstatus = 'F' AS placed, c_acctbal, c_nationkey, c_mktsegment,
                     c_custkey IS NOT NULL AS known
              FROM orders o LEFT JOIN customer ON c_custkey = o_custkey)"""

_CACHED = "known AND c_acctbal > 3000"
_FOUND = "known AND c_mktsegment <> 'MACHINERY'"


@query(f"""
    WITH {_ITEMS}
    SELECT o_orderkey, CASE WHEN placed THEN 1.0 WHEN {_CACHED} THEN c_acctbal END AS lat,
           CASE WHEN placed THEN 2.0 WHEN {_CACHED} THEN CAST(c_nationkey AS DOUBLE) END AS lon
    FROM items""")
def cache_lookup(spark, sf_dir):
    items = enrich.from_cache(order_items(spark, sf_dir), cache(spark, sf_dir))
    return items.select("o_orderkey", "location.lat", "location.lon")


@query(f"""
    WITH {_ITEMS},
    fresh AS (
      SELECT 'ADDRESS_CACHE:Customer#' || format('{{:09d}}', o_custkey) AS key, o_orderkey,
             CASE WHEN placed THEN 1.0 ELSE c_nationkey * 1.5 END AS lat,
             CASE WHEN placed THEN 2.0 ELSE c_acctbal END AS lon
      FROM items WHERE placed OR {_FOUND}),
    entries AS (
      SELECT key, o_orderkey AS seq, lat, lon FROM fresh
      UNION ALL
      SELECT 'ADDRESS_CACHE:' || c_name, -1, c_acctbal, CAST(c_nationkey AS DOUBLE)
      FROM customer WHERE c_acctbal > 3000)
    SELECT key, lat, lon FROM (
      SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS r FROM entries)
    WHERE r = 1""")
def cache_merge(spark, sf_dir):
    """The cache after the run: geocoded and preset locations overwrite older values."""
    settled = enrich.settle_replies(replies(spark, sf_dir))
    done = enrich.from_replies(order_items(spark, sf_dir), settled)
    merged = enrich.merge_cache(cache(spark, sf_dir),
                                enrich.cache_rows(done, seq="o_orderkey"))
    place = cached_location(F.col("value"))
    return merged.select("key", place["lat"].alias("lat"), place["lon"].alias("lon"))


@query("""
    WITH tries AS (
      SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 3 ELSE 1 END AS n FROM customer)
    SELECT c_name AS address, CAST(a AS INTEGER) AS attempt,
           CASE WHEN a < n - 1 THEN 'OVER_QUERY_LIMIT'
                WHEN c_mktsegment = 'MACHINERY' THEN 'ZERO_RESULTS' ELSE 'OK' END AS status,
           CASE WHEN a = n - 1 AND c_mktsegment <> 'MACHINERY'
                THEN CAST(c_nationkey * 1.5 AS DOUBLE) END AS lat,
           CASE WHEN a = n - 1 AND c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS lon
    FROM (SELECT *, unnest(range(n)) AS a FROM tries)""")
def geo_parse(spark, sf_dir):
    place = geocode_location(F.col("body"))
    return replies(spark, sf_dir).select(
        "address", "attempt", geocode_status(F.col("body")).alias("status"),
        place["lat"].alias("lat"), place["lon"].alias("lon"))


_GEO = f"""
    WITH {_ITEMS},
    cached AS (SELECT *, placed OR ({_CACHED}) AS had FROM items)"""


def _cached_items(spark, sf_dir) -> DataFrame:
    """With the lookup column kept, as further lookups follow."""
    return enrich.from_cache(enrich.with_address(order_items(spark, sf_dir)),
                             cache(spark, sf_dir))


@query(f"""
    {_GEO}
    SELECT o_orderkey,
           CASE WHEN had THEN 'already_set' WHEN {_FOUND} THEN 'found' ELSE 'error' END AS geo,
           CASE WHEN placed THEN 1.0 WHEN had THEN c_acctbal
                WHEN {_FOUND} THEN c_nationkey * 1.5 END AS lat,
           CASE WHEN placed THEN 2.0 WHEN had THEN CAST(c_nationkey AS DOUBLE)
                WHEN {_FOUND} THEN c_acctbal END AS lon
    FROM cached""")
def geo_enrich(spark, sf_dir):
    """Cache first, then one settled reply per distinct address."""
    settled = enrich.settle_replies(replies(spark, sf_dir))
    items = enrich.from_replies(_cached_items(spark, sf_dir), settled)
    return items.select("o_orderkey", "geo", "location.lat", "location.lon")


@query(f"""
    WITH {_ITEMS}
    SELECT o_orderkey,
           CASE WHEN placed THEN 'already_set'
                WHEN {_FOUND} AND c_mktsegment <> 'BUILDING' THEN 'found' ELSE 'error' END AS geo
    FROM items""")
def geo_single(spark, sf_dir):
    """One call per item and no retry: running into the quota is an error."""
    settled = enrich.settle_replies(replies(spark, sf_dir), retry=False)
    return enrich.from_replies(order_items(spark, sf_dir), settled).select("o_orderkey", "geo")


@query(f"""
    {_GEO},
    cold AS (SELECT o_custkey, any_value(c_mktsegment) AS segment FROM cached
             WHERE NOT had GROUP BY o_custkey)
    SELECT (SELECT count(*) FROM cached WHERE had) AS already_set,
           (SELECT count(*) FROM cold) AS misses,
           (SELECT 2 * count(*) FROM cold WHERE segment = 'BUILDING') AS retries,
           (SELECT count(*) FROM cached WHERE NOT had AND NOT ({_FOUND})) AS errors""")
def geo_counters(spark, sf_dir):
    settled = enrich.settle_replies(replies(spark, sf_dir))
    return enrich.geo_counters(_cached_items(spark, sf_dir), settled)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN p_size > 40 THEN 'second ' || p_name WHEN p_size > 20 THEN 'first ' || p_name
                ELSE 'calculated-part ' || l_partkey END AS translation
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def translate_enrich(spark, sf_dir):
    """Two translation services over a calculated default; the later service wins."""
    text = F.concat(F.lit("part "), F.col("p_partkey").cast("string"))
    part = table(spark, sf_dir, "part")
    sources = tuple(
        part.filter(F.col("p_size") > size).select(
            text.alias("text"), F.concat(F.lit(name + " "), "p_name").alias("translation"))
        for name, size in (("first", 20), ("second", 40)))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    asked = F.concat(F.lit("part "), F.col("l_partkey").cast("string"))
    return enrich.translate(items, asked, calculated=True, sources=sources)


@query(f"""
    {_GEO}
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS date,
           CASE WHEN had THEN 'already_set' WHEN {_FOUND} THEN 'found' ELSE 'error' END AS geo,
           CASE WHEN placed THEN 1.0 WHEN had THEN c_acctbal
                WHEN {_FOUND} THEN c_nationkey * 1.5 END AS lat,
           {legacy_sql('(o_totalprice + 1)')} AS price
    FROM cached""")
def staged_items(spark, sf_dir):
    """All stages in their configured order: dates, cache, geocode, surcharge, legacy price."""
    settled = enrich.settle_replies(replies(spark, sf_dir))
    known = cache(spark, sf_dir)
    # The stages' order numbers.
    done = run_stages(order_items(spark, sf_dir), [
        (600, enrich.legacy_pricing),
        (500, enrich.add_surcharge),
        (400, lambda items: enrich.from_replies(items, settled)),
        (300, lambda items: enrich.from_cache(items, known)),
        (200, enrich.with_address),
        (100, tidy_dates),
    ])
    return done.select("o_orderkey", F.get("date", F.lit(0)).alias("date"), "geo", "location.lat",
                       F.get("price", F.lit(0)).alias("price"))
