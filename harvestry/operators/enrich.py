"""Enrichment joins: location cache, recorded geocode replies, translations, prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions import pricing
from harvestry.schemas import GEOCODE
from harvestry.sources.documents import cached_location

# The cache's default name space, the reply worth asking again for, and the
# text of an item nobody translated.
NAMESPACE = "ADDRESS_CACHE"
QUOTA = "OVER_QUERY_LIMIT"
UNTRANSLATED = "N/A"


def cache_key(address: Column, namespace: str = NAMESPACE) -> Column:
    """NULL for a NULL address."""
    return F.concat(F.lit(namespace + ":"), address)


def first_address() -> Column:
    return F.get("address", F.lit(0))


# The lookup column. Stages that find it on the items use and keep it; otherwise each adds
# and drops its own.
ADDRESS = "_address"


def with_address(items: DataFrame) -> DataFrame:
    """Add the lookup column ahead of several address lookups."""
    return items.withColumn(ADDRESS, first_address())


def without_address(items: DataFrame) -> DataFrame:
    return items.drop(ADDRESS)


def _rebuilt(key: Column) -> Column:
    """The same key to the join, another expression to the planner."""
    return F.concat(key, F.lit(""))


def _look_up(items: DataFrame, found: DataFrame, fill) -> DataFrame:
    """Left join on the address with ``found`` (_address, _found), then ``fill``.

    Every row joins, also those that need no lookup: NULLed keys would all meet in one
    partition. Both sides join on a key built here, which neither is partitioned by: so both
    are plain shuffles, and AQE splits the partition of a very common address without any
    setting. (Sharing one shuffle between lookups would keep it whole.)
    """
    keyed = items if ADDRESS in items.columns else with_address(items)
    keyed = keyed.withColumn("_key", _rebuilt(F.col(ADDRESS)))
    found = found.select(_rebuilt(F.col(ADDRESS)).alias("_key"), "_found")
    done = fill(keyed.join(found, "_key", "left")).drop("_found", "_key")
    return done.select(*[c for c in done.columns if c != ADDRESS or c in items.columns])


def from_cache(items: DataFrame, cache: DataFrame, namespace: str = NAMESPACE) -> DataFrame:
    """Fill ``location`` from ``cache`` (key, value) where it is missing. Of a key that
    repeats, the largest value holds, so that no item is multiplied. Values are decoded ahead
    of the join, once per entry."""
    prefix = cache_key(F.lit(""), namespace)
    entries = cache.filter(F.startswith("key", prefix)).groupBy("key").agg(
        F.max("value").alias("value")).select(
        F.substring("key", len(namespace) + 2, 2**31 - 1).alias(ADDRESS),
        cached_location(F.col("value")).alias("_found"))
    return _look_up(items, entries, lambda joined: joined.withColumn(
        "location", F.coalesce("location", "_found")))


def cache_rows(items: DataFrame, namespace: str = NAMESPACE, seq: str = "seq") -> DataFrame:
    """(key, value, seq) for every finished item with a location, which is kept as JSON."""
    return items.filter(F.col("location").isNotNull() & first_address().isNotNull()).select(
        cache_key(first_address(), namespace).alias("key"),
        F.to_json("location").alias("value"), F.col(seq).alias("seq"))


def cache_entries(items: DataFrame, namespace: str = NAMESPACE, seq: str = "seq") -> DataFrame:
    """The last one of :func:`cache_rows` per key."""
    return latest_entries(cache_rows(items, namespace, seq))


def latest_entries(entries: DataFrame) -> DataFrame:
    """Per key the entry with the highest ``seq``; equal ones are settled by value.

    Of all entries the numbers are aggregated, by hash; texts only of those that are latest."""
    newest = entries.groupBy("key").agg(F.max("seq").alias("seq"))
    last = entries.join(newest, ["key", "seq"])
    return last.groupBy("key").agg(F.max("value").alias("value"),
                                   F.first("seq").alias("seq"))


def merge_cache(cache: DataFrame, rows: DataFrame) -> DataFrame:
    """The cache after a run: the run's last row per key overwrites an older value (the
    largest one, of a key that repeats)."""
    fresh = latest_entries(rows).select("key", "value")
    kept = cache.join(fresh.select("key"), "key", "left_anti").groupBy("key").agg(
        F.max("value").alias("value"))
    return kept.unionByName(fresh)


def settle_replies(replies: DataFrame, retry: bool = True) -> DataFrame:
    """(address, found, retries) from recorded (address, attempt, body).

    With ``retry`` over-quota replies are counted and the first other one is final, success
    or not; without, the first reply is final.
    """
    reply = F.col("_reply")
    point = F.get(reply["results"], F.lit(0))["geometry"]["location"]
    good = reply["status"] == "OK"
    parsed = replies.withColumn("_reply", F.from_json("body", GEOCODE)).select(
        "address", "attempt", (reply["status"] == QUOTA).alias("over"),
        F.when(good, point["lat"]).alias("lat"), F.when(good, point["lng"]).alias("lon"))
    over = F.coalesce("over", F.lit(False))
    final = F.when(~over, F.col("attempt")) if retry else F.col("attempt")
    parsed = parsed.withColumn("_final", final)
    # Numbers, not a struct: these aggregate by hash, without sorting all replies.
    settled = parsed.groupBy("address").agg(
        F.min("_final").alias("_final"),
        (F.count_if(over) if retry else F.lit(0).cast("long")).alias("retries"))
    # Of replies with the same attempt one is taken whole: that with the lowest place.
    place = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct("lat", "lon"))
    found = parsed.join(settled.select("address", "_final"), ["address", "_final"]).groupBy(
        "address").agg(F.min(place).alias("found"))
    return settled.join(found, "address", "left").select("address", "found", "retries")


def from_replies(items: DataFrame, settled: DataFrame) -> DataFrame:
    """Fill ``location`` from settled replies and say in ``geo`` how: already_set, found or
    error. Each distinct address has one reply row, so items share a single lookup, and a
    failure reaches all of them."""
    replies = settled.select(F.col("address").alias(ADDRESS), F.col("found").alias("_found"))
    state = (F.when(F.col("location").isNotNull(), "already_set")
             .when(F.col("_found").isNotNull(), "found").otherwise("error"))
    return _look_up(items, replies, lambda joined: joined.withColumns({
        "geo": state, "location": F.coalesce("location", "_found")}))


def geo_counters(items: DataFrame, settled: DataFrame) -> DataFrame:
    """One row (already_set, misses, retries, errors): items that had a location, distinct
    addresses looked up, over-quota replies, and items left without. Items shrink to one
    row per address before the join."""
    cold = F.col("location").isNull()
    address = F.col(ADDRESS) if ADDRESS in items.columns else first_address()
    per_address = items.groupBy(address.alias("address")).agg(
        F.count_if(~cold).alias("had"), F.count_if(cold).alias("cold"))
    asked = F.col("cold") > 0
    return per_address.join(settled, "address", "left").agg(
        F.coalesce(F.sum("had"), F.lit(0)).alias("already_set"),
        F.count_if(asked).alias("misses"),
        F.coalesce(F.sum(F.when(asked, F.col("retries"))), F.lit(0)).alias("retries"),
        F.coalesce(F.sum(F.when(F.col("found").isNull(), F.col("cold"))), F.lit(0))
        .alias("errors"))


def translate(items: DataFrame, text: Column, calculated: bool = False,
              sources: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Add ``translation``: the last of ``sources`` (text, translation; the largest one of a
    text that repeats) that knows the item's text, else "calculated-<text>" if asked for, else "N/A"."""
    items = items.withColumn("_text", text)
    names = []
    for i, source in enumerate(sources):
        names.insert(0, f"_t{i}")
        # A key of its own for each source: plain shuffles, which AQE splits at hot texts.
        known = source.groupBy("text").agg(F.max("translation").alias(f"_t{i}")).select(
            _rebuilt(F.col("text")).alias("_key"), f"_t{i}")
        items = items.withColumn("_key", _rebuilt(F.col("_text"))).join(
            known, "_key", "left").drop("_key")
    if calculated:
        items = items.withColumn("_calculated", F.concat(F.lit("calculated-"), F.col("_text")))
        names.append("_calculated")
    return (items.withColumn("translation", F.coalesce(*names, F.lit(UNTRANSLATED)))
            .drop("_text", *names))


def add_surcharge(items: DataFrame) -> DataFrame:
    first = pricing.surcharge(pricing.first(F.col("price")))
    return items.withColumn("price", pricing.with_first(F.col("price"), first))


def legacy_pricing(items: DataFrame) -> DataFrame:
    priced = pricing.legacy_price(items.withColumn("_x", pricing.first(F.col("price"))), "_x")
    return (priced.withColumn("price", pricing.with_first(F.col("price"), F.col("_x")))
            .drop("_x"))
