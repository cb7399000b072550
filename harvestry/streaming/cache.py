"""Streaming enrichment against a location cache that the stream itself extends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from harvestry.operators.enrich import cache_entries, cache_key, first_address, from_cache
from harvestry.streaming.runs import KeyedRuns

ENTRY = T.StructType([T.StructField("key", T.StringType()),
                      T.StructField("value", T.StringType())])


def cache_runs(path: str, buckets: int = 16, fan: int = 4) -> KeyedRuns:
    """The cache (key, value) as runs. Run 0 is the seed, the stream's batch N is run N + 1."""
    return KeyedRuns(path, ENTRY, buckets=buckets, fan=fan)


def seed_cache(cache: KeyedRuns, entries: DataFrame) -> None:
    """The entries the stream starts from, one per key; call it once, with no rows for none."""
    cache.write(entries, 0)


def read_cache(spark: SparkSession, cache: KeyedRuns, before: int) -> DataFrame:
    """The cache (key, value) as it was ahead of the stream's batch ``before``."""
    return cache.before(spark, before + 1)


def start_cached(items: DataFrame, locate, cache: KeyedRuns, out: str, checkpoint: str,
                 **trigger) -> StreamingQuery:
    """Per micro-batch: fill locations from the cache, ``locate`` the rest (DataFrame ->
    DataFrame), write the items to ``<out>/batch_id=N`` and the batch's own entries to the
    cache, so that later batches find them. Only the buckets of addresses without a location
    are read. The items are written before their entries are derived from them, so a
    repeated batch rewrites the same folders.
    """
    def publish(batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, f"{out}/batch_id={batch_id}"
        cache.merge(spark, batch_id + 1)
        cold = batch.where("location is null").select(cache_key(first_address()).alias("key"))
        known = cache.before(spark, batch_id + 1, touched=cold)
        done = locate(from_cache(batch, known))
        done.write.mode("overwrite").parquet(path)
        written = spark.read.schema(done.schema).parquet(path)
        cache.write(cache_entries(written).select("key", "value"), batch_id + 1)

    return (items.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())
