"""File sinks. Each is one independent write of an item table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from harvestry.sinks.rows import item_documents


def write_feed(items: DataFrame, path: str, batch: str | None = None) -> None:
    """Append items as JSON lines, one sub-folder per value of ``batch``."""
    writer = items.write.mode("append")
    (writer.partitionBy(batch) if batch else writer).json(path)


def stream_feed(items: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The feed as an exactly-once streaming file sink."""
    return (items.writeStream.format("json").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**trigger).start(path))


def write_documents(items: DataFrame, path: str, collection: str = "properties") -> None:
    """Append one JSON document per line, partitioned by collection."""
    (item_documents(items, collection).write.mode("append")
     .partitionBy("collection").text(path))
