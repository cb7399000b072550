"""URL dedup and URL batches over a stream of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from harvestry.operators.frontier import batch_rows, first_seen, number_rows, with_target
from harvestry.streaming.runs import KeyedRuns

URL = T.StructType([T.StructField("key", T.StringType())])
NUMBERED = T.StructType([T.StructField("number", T.LongType()),
                         T.StructField("url", T.StringType())])

#: Folders that open batches take in turn.
SLOTS = 4


def new_urls(requests: DataFrame, url: str = "url", ts: str | None = None,
             within: str | None = None) -> DataFrame:
    """Each URL once. The set of seen URLs is kept for good, or with ``ts`` and ``within``
    only as long as repeats are expected; requests later than that are dropped then, which
    :func:`start_bounded_dedup` does not do."""
    if ts and within:
        return requests.withWatermark(ts, within).dropDuplicatesWithinWatermark([url])
    return requests.dropDuplicates([url])


def start_dedup(requests: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    return (new_urls(requests).writeStream.outputMode("append").format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start(out))


LAST_SEEN = T.StructType([T.StructField("key", T.StringType()),
                          T.StructField("last", T.LongType())])


def seen_runs(path: str, within: int, buckets: int = 16, fan: int = 4) -> KeyedRuns:
    """URLs with the second they were last asked for, dropped ``within`` seconds later."""
    return KeyedRuns(path, LAST_SEEN, buckets=buckets, fan=fan, age="last", keep=within)


def start_bounded_dedup(requests: DataFrame, seen: KeyedRuns, out: str, checkpoint: str,
                        **trigger) -> StreamingQuery:
    """Pass a URL of (url, second) on, to ``<out>/batch_id=N``, unless it was asked for at most
    ``seen.keep`` seconds before.

    What expires are seen URLs, by the time of the requests: their number stays bounded. A
    request is never too late: a URL that has not been seen, or whose entry has expired, passes
    however old the request is. Within a micro-batch a URL passes once, at its first second."""
    def publish(batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, f"{out}/batch_id={batch_id}"
        seen.merge(spark, batch_id)
        own = batch.where("url is not null").groupBy(F.col("url").alias("key")).agg(
            F.min("second").alias("second"), F.max("second").alias("newest"))
        known = seen.before(spark, batch_id, touched=own.select("key"))
        judged = own.join(known, "key", "left").select(
            "key", "second", F.greatest("newest", "last").alias("last"),
            (F.col("last").isNull() | (F.col("second") - F.col("last") > seen.keep))
            .alias("passes"))
        # The seen set comes first; a repeated batch reads the state before it again.
        seen.write(judged.select("key", "last"), batch_id)
        judged.where("passes").select(F.col("key").alias("url"), "second").write.mode(
            "overwrite").parquet(path)

    return (requests.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


class UrlBatches:
    """URL batches of a stream below ``path``: the URLs seen (keyed runs), the batches that
    each micro-batch completed, and the URLs of the batch that is still open (of the last few
    micro-batches, in folders taken in turn).

    Within a micro-batch new URLs go by ``pos``; numbers continue over micro-batches, so the
    batches are the same wherever the stream is cut."""

    def __init__(self, path: str, size: int, targets: list[str], buckets: int = 16, fan: int = 4):
        self.path, self.size, self.targets = path, size, targets
        self.seen = KeyedRuns(f"{path}/seen", URL, buckets=buckets, fan=fan)

    def _open(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """URLs numbered but in no full batch after a micro-batch, fewer than ``size``."""
        return spark.read.schema(NUMBERED).parquet(self._slot("open", batch_id))

    def _slot(self, name: str, batch_id: int) -> str:
        return f"{self.path}/{name}/slot={batch_id % SLOTS}"

    def publish(self, requests: DataFrame, batch_id: int) -> None:
        """One micro-batch of (url, pos); a repeated one rewrites its folders."""
        spark = requests.sparkSession
        self.seen.merge(spark, batch_id)
        firsts = first_seen(requests.where("url is not null"))
        known = self.seen.before(spark, batch_id, touched=firsts.select(
            F.col("url").alias("key")))
        new = firsts.join(known, firsts["url"] == known["key"], "left_anti")
        numbered = number_rows(new, ["pos", "url"]).select("number", "url")
        waiting, done = None, 0
        if batch_id:
            waiting = self._open(spark, batch_id - 1)
            done = spark.read.schema("done long").parquet(
                self._slot("count", batch_id - 1)).first()["done"]
            numbered = numbered.withColumn("number", F.col("number") + F.lit(done))
        path = self._slot("numbered", batch_id)
        numbered.write.mode("overwrite").parquet(path)
        numbered = spark.read.schema(NUMBERED).parquet(path)
        total = numbered.agg(F.max("number")).first()[0] or done
        full = total // self.size * self.size
        rows = numbered if waiting is None else waiting.unionByName(numbered)
        complete = batch_rows(rows.where(F.col("number") <= full), self.size)
        complete.write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")
        rows.where(F.col("number") > full).coalesce(1).write.mode("overwrite").parquet(
            self._slot("open", batch_id))
        spark.range(1).select(F.lit(total).cast("long").alias("done")).write.mode(
            "overwrite").parquet(self._slot("count", batch_id))
        self.seen.write(numbered.select(F.col("url").alias("key")), batch_id)

    def start(self, requests: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return (requests.writeStream.foreachBatch(self.publish)
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": "5 seconds"})).start())

    def read(self, spark: SparkSession, last: int, flush: bool = True) -> DataFrame:
        """(batch, target, n, urls) up to micro-batch ``last``; with ``flush`` the open batch
        closes as it is."""
        found = spark.read.schema("batch long, n long, urls string, batch_id long").parquet(
            f"{self.path}/batches").where(F.col("batch_id") <= last).drop("batch_id")
        if flush:
            found = found.unionByName(batch_rows(self._open(spark, last), self.size))
        return with_target(found, self.targets).select("batch", "target", "n", "urls")
