"""Interval metrics of item lifecycles: throughput, latency, in-flight gauges, rates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestry.functions.time import micros, moment
from harvestry.session import by_key, cut_lineage

_BLOCK = 4096  # ticks numbered or summed together


def _latency(n: Column, total: Column) -> Column:
    """Mean of ``n`` latencies adding up to ``total`` microseconds, in seconds; 0 for none."""
    return F.when(n > 0, total / n / 1000000).otherwise(F.lit(0.0))


def interval_sums(items: DataFrame, seconds: int) -> DataFrame:
    """(start, items, latency_us, pipeline_us) per tumbling interval of the scrape time.

    Items carry schedule_time, received_time and scraped_time. Works on streams, given a
    watermark on scraped_time. Integer sums keep the result free of summation order.
    """
    scraped = micros(items, "scraped_time")
    timed = items.select(
        F.col("scraped_time"),
        (scraped - micros(items, "schedule_time")).alias("latency"),
        (scraped - micros(items, "received_time")).alias("pipeline"))
    return (timed.groupBy(F.window("scraped_time", f"{seconds} seconds").alias("w"))
            .agg(F.count(F.lit(1)).alias("items"), F.sum("latency").alias("latency_us"),
                 F.sum("pipeline").alias("pipeline_us"))
            .select(F.col("w.start").alias("start"), "items", "latency_us", "pipeline_us"))


def interval_rates(sums: DataFrame, seconds: int) -> DataFrame:
    """(start, items, rate, latency, pipeline): items per second and mean seconds."""
    return sums.select(
        "start", "items", (F.col("items") / F.lit(float(seconds))).alias("rate"),
        _latency(F.col("items"), F.col("latency_us")).alias("latency"),
        _latency(F.col("items"), F.col("pipeline_us")).alias("pipeline"))


def _ticks(bounds: DataFrame) -> DataFrame:
    """All integers from ``lo`` to ``hi`` of a one-row frame, as ``tick``, made block-wise so
    that neither an array nor a task grows with the span."""
    blocks = by_key(bounds.filter("lo IS NOT NULL").select(
        "lo", "hi", F.explode(F.sequence("lo", "hi", F.lit(_BLOCK))).alias("first")), "first")
    last = F.least("hi", F.col("first") + (_BLOCK - 1))
    return blocks.select(F.explode(F.sequence("first", last)).alias("tick"))


def fill_intervals(sums: DataFrame, seconds: int) -> DataFrame:
    """Add zero rows for the empty intervals between the first and the last one. The sums
    are materialised, so the items behind them are read once."""
    step = seconds * 1000000
    numbered = cut_lineage(sums.withColumn("tick", micros(sums, "start"))
                           .withColumn("tick", F.expr(f"tick div {step}")))
    ticks = _ticks(numbered.agg(F.min("tick").alias("lo"), F.max("tick").alias("hi")))
    start = moment(F.col("tick") * step, sums.schema["start"].dataType)
    zero = F.lit(0).cast("long")
    return (ticks.join(numbered.drop("start"), "tick", "left")
            .select(start.alias("start"),
                    *[F.coalesce(name, zero).alias(name)
                      for name in ("items", "latency_us", "pipeline_us")]))


def report_line() -> Column:
    """The metrics row as a log line."""
    return F.format_string(
        "Scraped %d items at %.1f items/s, avg latency: %.2f s and avg time in pipelines: "
        "%.2f s", "items", "rate", "latency", "pipeline")


@dataclass(frozen=True)
class Gauge:
    """What is sampled: items between two moments (an open end accumulates), each counting
    1 or ``weight``."""

    name: str
    start: str
    end: str | None = None
    weight: str | None = None


def gauge_changes(items: DataFrame, wanted: list[Gauge], seconds: int) -> DataFrame:
    """(gauge, tick, change): a +/- pair per item and gauge, summed per tick. The first sample
    at or after a moment sees the change."""
    step = seconds * 1000000
    moments = sorted({m for gauge in wanted for m in (gauge.start, gauge.end) if m})
    items = items.withColumns({
        f"_at_{m}": F.ceil((micros(items, m)) / step) for m in moments})

    def change(name: str, at: str, amount: Column) -> Column:
        return F.struct(F.lit(name).alias("gauge"), F.col(f"_at_{at}").alias("tick"),
                        amount.alias("change"))

    changes = []
    for gauge in wanted:
        amount = F.lit(1).cast("long") if gauge.weight is None else F.col(gauge.weight)
        changes.append(change(gauge.name, gauge.start, amount))
        if gauge.end:
            changes.append(change(gauge.name, gauge.end, -amount))
    return (items.select(F.inline(F.array(*changes)))
            .groupBy("gauge", "tick").agg(F.sum("change").alias("change")))


def gauges(items: DataFrame, wanted: list[Gauge], seconds: int) -> DataFrame:
    """(tick, gauge, value) sampled every ``seconds``; a tick is epoch seconds / ``seconds``.
    The changes are materialised, so the items are read once."""
    return gauge_levels(cut_lineage(gauge_changes(items, wanted, seconds)), wanted)


def gauge_levels(per_tick: DataFrame, wanted: list[Gauge]) -> DataFrame:
    """(tick, gauge, value) from written (gauge, tick, change). The running sum goes by blocks
    of ticks with the sums of earlier blocks added, so no task sees all ticks."""
    names = F.array(*[F.lit(gauge.name) for gauge in wanted])
    dense = (_ticks(per_tick.agg(F.min("tick").alias("lo"), F.max("tick").alias("hi")))
             .select("tick", F.explode(names).alias("gauge"))
             .join(per_tick, ["gauge", "tick"], "left")
             .select("gauge", "tick", F.expr(f"tick div {_BLOCK}").alias("block"),
                     F.coalesce("change", F.lit(0)).alias("change")))
    before = (Window.partitionBy("gauge").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = (per_tick.groupBy("gauge", F.expr(f"tick div {_BLOCK}").alias("block"))
               .agg(F.sum("change").alias("change")))
    span = _ticks(carried.agg(F.min("block").alias("lo"), F.max("block").alias("hi")))
    carried = (span.select(F.col("tick").alias("block"), F.explode(names).alias("gauge"))
               .join(carried, ["gauge", "block"], "left")
               .select("gauge", "block", F.coalesce(F.sum("change").over(before), F.lit(0))
                       .alias("carried")))
    inside = (Window.partitionBy("gauge", "block").orderBy("tick")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (dense.join(carried, ["gauge", "block"])
            .select("tick", "gauge",
                    (F.col("carried") + F.sum("change").over(inside)).alias("value")))


def gauge_table(values: DataFrame, wanted: list[Gauge]) -> DataFrame:
    """One row per tick with a column per gauge, and the sample as a log ``line``."""
    names = [gauge.name for gauge in wanted]
    wide = values.groupBy("tick").agg(
        *[F.max(F.when(F.col("gauge") == name, F.col("value"))).alias(name) for name in names])
    return wide.withColumn("line", F.format_string(
        "%8d" * (len(names) - 1) + "%10d", *names))


def rate_bursts(calls: DataFrame, key: str, ts: str, limit: int, seconds: int = 1,
                slots: int = 64) -> DataFrame:
    """(key, ts, calls) of the calls that come less than ``seconds`` after the one ``limit``
    places before: the moments at which a caller went over its limit, wherever a clock would
    cut. ``calls`` counts those within ``seconds`` up to and with the moment.

    A key's calls are dealt into time ranges of ``slots`` intervals, each with the interval
    before it as well, so a hot key is split over many tasks and no burst is cut."""
    at = micros(calls, ts)
    span, width = seconds * 1000000, seconds * 1000000 * slots
    dealt = calls.select(key, F.col(ts).alias("_ts"), at.alias("_at")).where(
        "_at is not null").withColumn("_own", F.expr(f"(_at - pmod(_at, {width})) div {width}"))
    # The end of a range is also the start of the next one.
    late = F.col("_at") - F.col("_own") * width >= width - span
    dealt = dealt.withColumn("_range", F.explode(F.when(
        late, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
    order = Window.partitionBy(key, "_range").orderBy("_at")
    within = order.rangeBetween(-span + 1, 0)
    return (dealt.withColumn("_before", F.lag("_at", limit).over(order))
            .withColumn("calls", F.count(F.lit(1)).over(within))
            .where((F.col("_own") == F.col("_range")) & (F.col("_at") - F.col("_before") < span))
            .select(key, F.col("_ts").alias(ts), "calls"))


def rate_violations(calls: DataFrame, key: str, ts: str, limit: int,
                    seconds: int = 1) -> DataFrame:
    """(key, start, calls) of the clock intervals with more than ``limit`` calls; a burst over
    an interval's end is seen by :func:`rate_bursts`."""
    return (calls.groupBy(key, F.window(ts, f"{seconds} seconds").alias("w"))
            .agg(F.count(F.lit(1)).alias("calls")).filter(F.col("calls") > limit)
            .select(key, F.col("w.start").alias("start"), "calls"))


def signal_counts(events: DataFrame, signal: str = "event_type") -> DataFrame:
    return events.groupBy(signal).agg(F.count(F.lit(1)).alias("n"))
