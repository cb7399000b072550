"""Lookups that items on a stream share while the reply is pending."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from harvestry.operators.enrich import QUOTA, first_address
from harvestry.schemas import GEOCODE
from harvestry.streaming.runs import KeyedRuns, RunLog

_ADDRESS = T.StructField("address", T.StringType())
_PLACE = [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]
SETTLED = T.StructType([_ADDRESS, *_PLACE])
HEARD = T.StructType([_ADDRESS, T.StructField("attempt", T.IntegerType()),
                      T.StructField("over", T.BooleanType()), *_PLACE])


@dataclass(frozen=True)
class Pending:
    """By address: the settled replies, the attempts heard of addresses that are not settled,
    and the items that wait. Tables of keyed runs, so a micro-batch reads the buckets it needs
    and rewrites little."""

    settled: KeyedRuns
    heard: RunLog
    waiting: RunLog

    def merge(self, spark: SparkSession, batch: int) -> None:
        self.settled.merge(spark, batch)
        for log in (self.heard, self.waiting):
            log.merge(spark, batch, self.settled)


def pending_runs(path: str, items: T.StructType, salts: int = 2, buckets: int = 16,
                 fan: int = 4) -> Pending:
    """The state of lookups for items of this schema."""
    waiting = T.StructType([_ADDRESS, T.StructField("deal", T.LongType()),
                            T.StructField("item", items)])
    grow = {"key": "address", "buckets": buckets, "fan": fan}
    return Pending(KeyedRuns(f"{path}/settled", SETTLED, **grow),
                   RunLog(f"{path}/heard", HEARD, **grow),
                   RunLog(f"{path}/waiting", waiting, **grow, deal="deal", files=salts))


def _best(heard: DataFrame) -> DataFrame:
    """One reply per address and attempt: of several one that is not over the quota, with a
    place, the lowest."""
    order = F.struct("over", F.col("lat").isNull(), "lat", "lon")
    return heard.groupBy("address", "attempt").agg(F.min(order).alias("best")).select(
        "address", "attempt", "best.over", "best.lat", "best.lon")


def settled_replies(heard: DataFrame) -> DataFrame:
    """(address, lat, lon) of the addresses whose reply is known from ``heard`` (address,
    attempt, over, lat, lon).

    Attempts count from 0 and may arrive in any order. The reply is settled by the first
    attempt that is not over the quota, once all before it are known to be: so the result does
    not depend on the order of arrival."""
    turns = Window.partitionBy("address").orderBy("attempt")
    known = _best(heard.where("attempt >= 0")).withColumns({
        "turn": F.row_number().over(turns) - 1,
        "finals": F.count_if(~F.col("over")).over(turns)})
    return known.where("not over and finals = 1 and turn = attempt").select(
        "address", "lat", "lon")


def pending_events(items: DataFrame, replies: DataFrame) -> DataFrame:
    """Both streams as one: items as a struct with their address and a hash, and what is heard
    of an address."""
    # What a hash can be made of; it only deals rows.
    plain = [f"`{f.name}`" for f in items.schema.fields
             if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    asking = items.select(
        first_address().alias("address"), F.xxhash64(*plain).alias("deal"),
        F.struct(*[F.col(f"`{name}`") for name in items.columns]).alias("item"))
    reply = F.col("_reply")
    point = F.get(reply["results"], F.lit(0))["geometry"]["location"]
    good = (reply["status"] == "OK") & point["lat"].isNotNull() & point["lng"].isNotNull()
    heard = replies.withColumn("_reply", F.from_json("body", GEOCODE)).select(
        "address", F.col("attempt").cast("int").alias("attempt"),
        F.coalesce(reply["status"] == QUOTA, F.lit(False)).alias("over"),
        F.when(good, point["lat"]).cast("double").alias("lat"),
        F.when(good, point["lng"]).cast("double").alias("lon"))
    return heard.where("address is not null").unionByName(asking, allowMissingColumns=True)


def _answer(asking: DataFrame, settled: DataFrame, salts: int, how: str = "inner") -> DataFrame:
    """Items next to their address's reply; a common address is dealt over ``salts`` tasks."""
    replies = settled.select("address", "lat", "lon", F.lit(True).alias("answered"), F.explode(
        F.array(*map(F.lit, range(salts)))).alias("salt"))
    return asking.withColumn("salt", F.pmod("deal", F.lit(salts)).cast("int")).join(
        replies, ["address", "salt"], how)


def serve(events: DataFrame, state: Pending, batch: int, salts: int) -> DataFrame:
    """The items that a batch of :func:`pending_events` answers, in their own columns and
    ``geo``; what it settles and leaves waiting goes to ``state``."""
    spark = events.sparkSession
    state.merge(spark, batch)
    ready = F.col("item.location").isNotNull() | F.col("address").isNull()
    passing = events.where(F.col("item").isNotNull() & ready)
    asking = events.where(F.col("item").isNotNull() & ~ready).select("address", "deal", "item")
    replies = events.where("item is null").select(*HEARD.fieldNames())
    before = state.settled.before(spark, batch, touched=events.where(
        F.col("item").isNull() | ~ready).select("address"))

    fresh = replies.join(before, "address", "left_anti")
    earlier = state.heard.before(spark, batch, touched=fresh.select("address")).join(
        fresh.select("address"), "address", "left_semi")
    state.settled.write(settled_replies(earlier.unionByName(fresh)), batch)
    now = state.settled.written(spark, batch)
    state.heard.write(_best(fresh.join(now, "address", "left_anti")), batch)

    asked = _answer(asking, before.unionByName(now), salts, "left")
    state.waiting.write(asked.where("answered is null"), batch)
    waited = _answer(state.waiting.before(spark, batch, touched=now.select("address")), now, salts)
    answered = asked.where("answered").unionByName(waited)

    item = events.schema["item"].dataType
    located = F.when(F.col("lat").isNotNull(), F.struct("lat", "lon")).cast(
        item["location"].dataType)
    own = [F.col("item")[name].alias(name) for name in item.fieldNames()]
    filled = [located.alias(c) if c == "location" else F.col("item")[c].alias(c)
              for c in item.fieldNames()]
    return passing.select(*own, F.when(F.col("item.location").isNotNull(), "already_set")
                          .otherwise("error").alias("geo")).unionByName(answered.select(
                              *filled, F.when(F.col("lat").isNull(), "error").otherwise("found")
                              .alias("geo")))


def start_pending(items: DataFrame, replies: DataFrame, out: str, checkpoint: str,
                  salts: int = 2, **trigger) -> StreamingQuery:
    """Streams of items (``address``, ``location`` and more) and of replies (address, attempt,
    body): write the items, as they are answered, with ``location`` filled and ``geo``:
    already_set, found or error, to ``<out>/batch_id=N``.

    Items wait until the reply to their address is settled; all that wait are served by the one
    reply, later ones at once. Items with a location, or without an address, do not wait. What
    waits and what is settled is kept below ``checkpoint``; a repeated batch finds what it read
    the first time and rewrites the same folders."""
    state = pending_runs(f"{checkpoint}/pending", items.schema, salts)

    def publish(events: DataFrame, batch: int) -> None:
        serve(events, state, batch, salts).write.mode("overwrite").parquet(
            f"{out}/batch_id={batch}")

    return (pending_events(items, replies).writeStream.foreachBatch(publish)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())
