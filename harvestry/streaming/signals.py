"""Lifecycle signals: of streams through a listener, of item counts through observations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class SignalListener(StreamingQueryListener):
    """Calls ``receive(signal, run id)`` as streams open, progress, idle, fail and close.
    Register with ``spark.streams.addListener``."""

    def __init__(self, receive: Callable[[str, str], None]):
        self.receive = receive

    def onQueryStarted(self, event) -> None:
        self.receive("opened", str(event.runId))

    def onQueryProgress(self, event) -> None:
        self.receive("progress", str(event.progress.runId))

    def onQueryIdle(self, event) -> None:
        self.receive("idle", str(event.runId))

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.receive("error", str(event.runId))
        self.receive("closed", str(event.runId))


def observe_items(judged: DataFrame, name: str = "items") -> tuple[DataFrame, Observation]:
    """Count scraped and dropped items (by ``reason``) while some action runs over them, at
    no extra pass: ``observation.get`` has both afterwards."""
    observation = Observation(name)
    return judged.observe(
        observation, F.count_if(F.col("reason").isNull()).alias("item_scraped"),
        F.count_if(F.col("reason").isNotNull()).alias("item_dropped")), observation
