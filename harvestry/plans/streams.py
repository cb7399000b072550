"""Streaming queries, each run over all its input to the end.

Sinks and checkpoints live in the shared folder. Streams run in a session of their own, so
their settings leave the caller's alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestry.functions.time import moment
from harvestry.operators import enrich
from harvestry.plans.analytics import SHIFTS_SQL, part_items
from harvestry.plans.enrichment import _ITEMS, cache, order_items, replies
from harvestry.plans.frontier import BATCH_SIZE, TARGETS, URL_BATCHES_SQL, line_requests
from harvestry.plans.monitoring import (
    GAUGES, HOUR, INFLIGHT_SQL, MINUTE, rates_sql, sums_sql, with_lifecycle)
from harvestry.plans.registry import query, stamp, table, to6
from harvestry.schemas import PRICED_TITLE
from harvestry.session import scratch_path, ship_package
from harvestry.sinks.files import write_feed
from harvestry.sources.files import stream_items, stream_table
from harvestry.streaming import boost, frontier, lookups, metrics
from harvestry.streaming.cache import cache_runs, seed_cache, start_cached

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FEED_BATCHES = 4


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for streams, in UTC, with state on disk and at most two state partitions per
    task slot: each costs a commit per micro-batch, however little it holds."""
    session = spark.newSession()
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.shuffle.partitions",
                     min(wanted, 2 * spark.sparkContext.defaultParallelism))
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return session


@query(SHIFTS_SQL)
def boost_words_stream(spark, sf_dir):
    """A JSON feed of parts, streamed file by file into running word prices; the shifts after
    the last micro-batch equal those of the whole table."""
    root = scratch_path(spark, "boost")
    feed = f"{root}/feed"
    write_feed(part_items(spark, sf_dir).withColumn(
        "batch", F.pmod(F.xxhash64("title", "price"), F.lit(FEED_BATCHES))), feed, "batch")
    session = stream_session(spark)
    files = len(spark.read.schema(PRICED_TITLE).json(feed).inputFiles())
    items = stream_items(session, f"{feed}/*", PRICED_TITLE,
                         files_per_trigger=-(-files // FEED_BATCHES))
    running = boost.start_boost(items, f"{root}/out", f"{root}/checkpoint", availableNow=True)
    running.awaitTermination()
    last = running.lastProgress["batchId"]
    shifts = spark.read.parquet(f"{root}/out/shifts/batch_id={last}")
    return shifts.select("word", *to6("shift"))


@query(f"""WITH {sums_sql(HOUR)} {rates_sql(HOUR, 'sums')}""")
def interval_metrics_stream(spark, sf_dir):
    """Hourly metrics of events that arrive in several batches and in no order of time."""
    root = scratch_path(spark, "intervals")
    events = table(spark, sf_dir, "events")
    events.withColumn("batch", F.pmod(F.xxhash64("event_id"), F.lit(FEED_BATCHES))).repartition(
        FEED_BATCHES, "batch").write.parquet(f"{root}/events")
    session = stream_session(spark)
    feed = stream_table(session, f"{root}/events", events.schema, files_per_trigger=1)
    # Windows need instants; the stream's session takes the zone-less moments as UTC.
    items = with_lifecycle(feed).withColumns({
        name: F.col(name).cast("timestamp")
        for name in ("schedule_time", "received_time", "scraped_time")})
    running = metrics.start_intervals(items, f"{root}/out", f"{root}/checkpoint", HOUR,
                                      availableNow=True)
    running.awaitTermination()
    found = metrics.read_intervals(session, f"{root}/out", HOUR).withColumn(
        "start", moment(F.unix_micros("start"), T.TimestampNTZType()))
    return found.select(stamp("start").alias("start"), "items",
                        *to6("rate", "latency", "pipeline"))


@query("SELECT DISTINCT 'http://web:9312/item/' || l_partkey AS url FROM lineitem")
def url_dedup_stream(spark, sf_dir):
    """Requests per line item in several batches, each URL passed on once."""
    root = scratch_path(spark, "dedup")
    session = stream_session(spark)
    source = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    source.repartition(FEED_BATCHES, "l_orderkey").write.parquet(f"{root}/lines")
    lines = stream_table(session, f"{root}/lines", source.schema, files_per_trigger=1)
    requests = lines.select(F.concat(F.lit("http://web:9312/item/"),
                                     F.col("l_partkey").cast("string")).alias("url"))
    frontier.start_dedup(requests, f"{root}/out", f"{root}/checkpoint",
                         availableNow=True).awaitTermination()
    return spark.read.parquet(f"{root}/out")


def arrivals(rows: DataFrame, path: str, turn, batches: int = FEED_BATCHES) -> int:
    """Write ``rows`` as files that arrive in ``batches`` turns (``turn`` is a column from 0);
    the number of files per turn."""
    files = max(1, rows.rdd.getNumPartitions() // batches)
    for at in range(batches):
        rows.where(turn == at).repartition(files).write.mode("append").parquet(path)
    return files


_TURN = f"CAST(o_orderkey % {FEED_BATCHES} AS INT)"


_DAY = 86400


@query(f"""
    WITH RECURSIVE asked AS (
      SELECT 'http://web:9312/item/' || l_partkey AS url, CAST(l_orderkey % {FEED_BATCHES} AS INT)
               AS turn, CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT) AS second
      FROM lineitem),
    own AS (SELECT url, turn, min(second) AS second, max(second) AS newest
            FROM asked GROUP BY url, turn),
    walk AS (
      SELECT DISTINCT url, -1 AS turn, CAST(NULL AS BIGINT) AS last, CAST(NULL AS BIGINT) AS second,
             false AS passes FROM asked
      UNION ALL
      SELECT w.url, w.turn + 1, greatest(w.last, o.newest), o.second,
             o.turn IS NOT NULL AND (w.last IS NULL OR o.second - w.last > {30 * _DAY})
      FROM walk w LEFT JOIN own o ON o.url = w.url AND o.turn = w.turn + 1
      WHERE w.turn < {FEED_BATCHES - 1})
    SELECT url, second FROM walk WHERE passes""")
def bounded_dedup_stream(spark, sf_dir):
    """Requests per line item in several micro-batches, in no order of time: a URL passes again
    30 days after it was last asked for, and late ones pass if they were not seen."""
    root = scratch_path(spark, "bounded")
    session = stream_session(spark)
    requests = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("http://web:9312/item/"), F.col("l_partkey").cast("string")).alias("url"),
        F.unix_date(F.col("l_shipdate").cast("date")).cast("long").alias("day"), "l_orderkey")
    requests = requests.withColumn("second", F.col("day") * _DAY)
    files = arrivals(requests, f"{root}/in", F.col("l_orderkey") % FEED_BATCHES)
    feed = stream_table(session, f"{root}/in", requests.schema, files_per_trigger=files)
    frontier.start_bounded_dedup(feed, frontier.seen_runs(f"{root}/seen", 30 * _DAY),
                                 f"{root}/out", f"{root}/checkpoint",
                                 availableNow=True).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("url", "second")


@query(f"""
    WITH RECURSIVE {_ITEMS},
    lived AS (
      SELECT *, {_TURN} AS turn,
             CASE WHEN known AND c_mktsegment <> 'MACHINERY' THEN c_nationkey * 1.5 END AS reply
      FROM items),
    turns AS (
      SELECT o_custkey, turn, any_value(reply) AS reply, bool_or(placed) AS some_placed,
             arg_max(placed, o_orderkey) AS last_placed
      FROM lived GROUP BY o_custkey, turn),
    keys AS (
      SELECT DISTINCT o_custkey, CASE WHEN known AND c_acctbal > 3000 THEN c_acctbal END AS lat
      FROM items),
    cached AS (
      SELECT o_custkey, 0 AS turn, lat FROM keys
      UNION ALL
      SELECT c.o_custkey, c.turn + 1,
             CASE WHEN t.turn IS NULL THEN c.lat
                  WHEN coalesce(c.lat, t.reply) IS NOT NULL
                  THEN CASE WHEN last_placed THEN 1.0 ELSE coalesce(c.lat, t.reply) END
                  WHEN some_placed THEN 1.0 END
      FROM cached c LEFT JOIN turns t USING (o_custkey, turn)
      WHERE c.turn < {FEED_BATCHES - 1})
    SELECT o_orderkey, CASE WHEN placed THEN 1.0 ELSE coalesce(c.lat, reply) END AS lat,
           CASE WHEN placed OR c.lat IS NOT NULL THEN 'already_set'
                WHEN reply IS NOT NULL THEN 'found' ELSE 'error' END AS geo
    FROM lived JOIN cached c USING (o_custkey, turn)""")
def cached_items_stream(spark, sf_dir):
    """Items enriched from a cache that the stream itself extends, over several micro-batches:
    what one batch located or brought along serves the next ones."""
    root = scratch_path(spark, "cached")
    session = stream_session(spark)
    cached = cache_runs(f"{root}/cache")
    seed_cache(cached, cache(spark, sf_dir))
    orders = order_items(spark, sf_dir).withColumn("seq", F.col("o_orderkey"))
    files = arrivals(orders, f"{root}/items", F.col("o_orderkey") % FEED_BATCHES)
    items = stream_table(session, f"{root}/items", orders.schema, files_per_trigger=files)

    def locate(batch):
        cold = batch.where("location is null").select(
            enrich.first_address().alias("address")).distinct()
        asked = replies(batch.sparkSession, sf_dir).join(cold, "address", "left_semi")
        return enrich.from_replies(batch, enrich.settle_replies(asked))

    start_cached(items, locate, cached, f"{root}/out", f"{root}/checkpoint",
                 availableNow=True).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("o_orderkey", "location.lat", "geo")


@query(URL_BATCHES_SQL)
def url_batches_stream(spark, sf_dir):
    """Requests in several micro-batches: URLs numbered over all of them, cut into batches,
    the open batch carried along and closed at the end."""
    root = scratch_path(spark, "batches")
    session = stream_session(spark)
    requests = line_requests(spark, sf_dir)
    edge = requests.agg(F.max("pos")).first()[0] or 0
    files = arrivals(requests, f"{root}/requests",
                     F.expr(f"pos div {edge // FEED_BATCHES + 1}"))
    feed = stream_table(session, f"{root}/requests", requests.schema, files_per_trigger=files)
    batches = frontier.UrlBatches(f"{root}/out", BATCH_SIZE, TARGETS)
    running = batches.start(feed, f"{root}/checkpoint", availableNow=True)
    running.awaitTermination()
    return batches.read(spark, running.lastProgress["batchId"])


@query(INFLIGHT_SQL)
def inflight_gauges_stream(spark, sf_dir):
    """What was in flight at every full minute, from events that arrive in several batches and
    in no order of time."""
    root = scratch_path(spark, "gauges")
    session = stream_session(spark)
    events = table(spark, sf_dir, "events")
    files = arrivals(events, f"{root}/events", F.pmod(F.xxhash64("event_id"), F.lit(FEED_BATCHES)))
    items = with_lifecycle(stream_table(session, f"{root}/events", events.schema,
                                        files_per_trigger=files))
    metrics.start_gauges(items, GAUGES, f"{root}/out", f"{root}/checkpoint", MINUTE,
                         availableNow=True).awaitTermination()
    return metrics.read_gauges(spark, f"{root}/out", GAUGES)


@query(f"""
    WITH {_ITEMS}
    SELECT o_orderkey, CASE WHEN placed THEN 1.0 WHEN c_mktsegment <> 'MACHINERY'
                            THEN c_nationkey * 1.5 END AS lat,
           CASE WHEN placed THEN 'already_set' WHEN c_mktsegment <> 'MACHINERY' THEN 'found'
                ELSE 'error' END AS geo
    FROM items WHERE placed OR known""")
def pending_items_stream(spark, sf_dir):
    """Items and replies as two streams in several micro-batches: items wait for the reply to
    their address, replies to later attempts may come first. Items nobody answers (unknown
    customers) wait on."""
    root = scratch_path(spark, "pending")
    session = stream_session(spark)
    ship_package(spark)
    orders, answers = order_items(spark, sf_dir).drop("date", "price"), replies(spark, sf_dir)
    files = arrivals(orders, f"{root}/items", F.col("o_orderkey") % FEED_BATCHES)
    several = arrivals(answers, f"{root}/replies", F.pmod(
        F.xxhash64("address", "attempt"), F.lit(FEED_BATCHES)))
    lookups.start_pending(
        stream_table(session, f"{root}/items", orders.schema, files_per_trigger=files),
        stream_table(session, f"{root}/replies", answers.schema, files_per_trigger=several),
        f"{root}/out", f"{root}/checkpoint", availableNow=True).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("o_orderkey", "location.lat", "geo")
