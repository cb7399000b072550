"""The URL frontier: dedup, exact global numbering, batching, routing and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestry.functions.urls import in_domain
from harvestry.session import cut_lineage

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in 33 bits


def allowed(requests: DataFrame, domains: list[str], url: str = "url") -> DataFrame:
    """Requests whose host is one of the domains or below one; no domains allow all."""
    return requests.filter(in_domain(F.col(url), domains))


def first_seen(requests: DataFrame, seen: DataFrame | None = None, url: str = "url",
               pos: str = "pos") -> DataFrame:
    """(url, pos): each new URL once, at its first position. Duplicates collapse before the
    shuffle, so one URL may fill a large part of the input."""
    firsts = requests.groupBy(url).agg(F.min(pos).alias(pos))
    return firsts if seen is None else firsts.join(seen.select(url), url, "left_anti")


def number_rows(rows: DataFrame, order: list[str | Column], name: str = "number") -> DataFrame:
    """Number all rows from 1 in a total order, without ever sorting in one task.

    Rows are range-partitioned and sorted on the (unique) order columns, numbered inside
    their partition, and shifted by the sizes of the partitions before. The partitioning is
    materialised once: sampled again, its bounds could differ between the two uses.
    """
    placed = cut_lineage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))))
    # One row per partition, so the global window and the broadcast are small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
               .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_skip")))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_skip") + F.col("_row") + 1)
            .drop("_part", "_row", "_skip"))


def with_target(batches: DataFrame, targets: list[str], batch: str = "batch") -> DataFrame:
    """Deal batches to targets in turn."""
    turn = ((F.col(batch) - 1) % len(targets)).cast("int")
    return batches.withColumn("target", F.get(F.array(*map(F.lit, targets)), turn))


def batch_rows(numbered: DataFrame, size: int) -> DataFrame:
    """(batch, n, urls) of numbered URLs; ``urls`` is a JSON array of at most ``size``."""
    batch = F.expr(f"(number - 1) div {int(size)} + 1")
    ordered = F.array_sort(F.collect_list(F.struct("number", "url")))
    return numbered.groupBy(batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("n"),
        F.to_json(F.transform(ordered, lambda row: row["url"])).alias("urls"))


def url_batches(firsts: DataFrame, size: int, targets: list[str]) -> DataFrame:
    """(batch, target, n, urls): distinct URLs in first-seen order cut into batches of
    ``size``, the last one possibly smaller."""
    numbered = number_rows(firsts.select("url", "pos"), ["pos", "url"])
    return with_target(batch_rows(numbered, size), targets).select("batch", "target", "n", "urls")


def route(outputs: DataFrame, target_rule: int) -> DataFrame:
    """Add ``route``: items pass, requests of the target rule are batched, others pass."""
    return outputs.withColumn(
        "route", F.when((F.col("kind") == "request") & F.col("rule").eqNullSafe(target_rule),
                        "batch").otherwise("pass"))


def dispatch_order(requests: DataFrame, pos: str = "pos") -> DataFrame:
    """Add ``turn``: higher priority first, then by position (unique)."""
    return number_rows(requests, [F.desc("priority"), F.asc(pos)], "turn")


def triage(replies: DataFrame) -> DataFrame:
    """Add ``problem``, the first that applies to a dispatch reply (sent, code, status)."""
    return replies.withColumn(
        "problem",
        F.when(~F.col("sent"), "request not sent")
        .when(F.col("code") != 200, F.concat(F.lit("request failed: "), F.col("code")))
        .when(F.col("status") != "ok", F.concat(F.lit("operation "), F.col("status"))))
