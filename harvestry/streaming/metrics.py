"""Interval metrics and gauges over a stream of finished items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harvestry.operators.metrics import (
    Gauge, gauge_changes, gauge_levels, interval_rates, interval_sums)
from harvestry.session import cut_lineage


def start_intervals(items: DataFrame, out: str, checkpoint: str, seconds: int,
                    **trigger) -> StreamingQuery:
    """Publish the sums of every interval that a micro-batch touches, as one folder per batch.

    No item is too late: it raises its interval's sums, and the next batch folder holds the
    new ones. The state is one row per interval, whatever the number of items. A repeated
    batch rewrites its folder with the same rows.
    """
    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (interval_sums(items, seconds).writeStream.outputMode("update")
            .foreachBatch(publish).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{seconds} seconds"})).start())


def read_intervals(spark: SparkSession, out: str, seconds: int) -> DataFrame:
    """The metrics of every interval so far, open ones included, from the published sums."""
    published = spark.read.parquet(out)
    last = published.groupBy("start").agg(F.max("batch_id").alias("batch_id"))
    return interval_rates(published.join(last, ["start", "batch_id"]), seconds)


def start_gauges(items: DataFrame, wanted: list[Gauge], out: str, checkpoint: str, seconds: int,
                 **trigger) -> StreamingQuery:
    """Publish the signed change of every gauge at each tick that a micro-batch touches, one
    folder per batch.

    The state is a sum per gauge and tick. An item that comes late changes past ticks: they are
    published again, and levels read from then on are corrected."""
    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (gauge_changes(items, wanted, seconds).writeStream.outputMode("update")
            .foreachBatch(publish).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{seconds} seconds"})).start())


def read_gauges(spark: SparkSession, out: str, wanted: list[Gauge],
                before: int | None = None) -> DataFrame:
    """(tick, gauge, value) of every tick so far, or as it was ahead of batch ``before``."""
    published = spark.read.schema("gauge string, tick long, change long, batch_id long").parquet(
        out)
    if before is not None:
        published = published.where(published["batch_id"] < before)
    last = published.groupBy("gauge", "tick").agg(F.max("batch_id").alias("batch_id"))
    return gauge_levels(cut_lineage(published.join(last, ["gauge", "tick", "batch_id"]).select(
        "gauge", "tick", "change")), wanted)
