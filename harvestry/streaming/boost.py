"""Running price shifts over a stream of items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from harvestry.operators.boost import price_shifts, top_bottom, word_prices


def start_boost(items: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep (price_sum, n) per word over the whole stream and write, for every micro-batch,
    the word prices to ``<out>/words/batch_id=N``, their shifts to
    ``<out>/shifts/batch_id=N`` and the highest and lowest shifts to
    ``<out>/report/batch_id=N``.

    The per-word state is never dropped. A second aggregate cannot follow the first on a
    stream, so the shifts are a batch query on the written word prices: the state is
    evaluated once, and a repeated micro-batch overwrites its own folder.
    """
    def publish(words: DataFrame, batch_id: int) -> None:
        def written(frame: DataFrame, name: str) -> DataFrame:
            path = f"{out}/{name}/batch_id={batch_id}"
            frame.write.mode("overwrite").parquet(path)
            return frame.sparkSession.read.schema(frame.schema).parquet(path)

        shifts = written(price_shifts(written(words, "words")), "shifts")
        written(top_bottom(shifts), "report")

    return (word_prices(items).writeStream.outputMode("complete").foreachBatch(publish)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())
