"""Item-level operators: lineage, drops, presence checks, contracts and stage order."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.text import iso_text

Stage = Callable[[DataFrame], DataFrame]


def with_lineage(items: DataFrame, project: str, spider: str, server: str,
                 run_time: Column | None = None) -> DataFrame:
    """Add the housekeeping fields, each a one-element list. ``run_time`` defaults to the
    query's start, which is the same for every row."""
    moment = F.current_timestamp() if run_time is None else run_time
    return items.withColumns({
        "project": F.array(F.lit(project)),
        "spider": F.array(F.lit(spider)),
        "server": F.array(F.lit(server)),
        "date": F.array(moment),
    })


def tidy_dates(items: DataFrame) -> DataFrame:
    """Turn the ``date`` timestamps into ISO text."""
    return items.withColumn("date", F.transform("date", iso_text))


def judge(items: DataFrame, rules: Iterable[tuple[Column, str]]) -> DataFrame:
    """Add ``reason``: that of the first rule whose condition holds, NULL for good items."""
    reason = F.lit(None).cast("string")
    for condition, text in reversed(list(rules)):
        reason = F.when(condition, F.lit(text)).otherwise(reason)
    return items.withColumn("reason", reason)


def split(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with ``reason``)."""
    return (judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL"))


def missing(field: str, is_list: bool = True) -> Column:
    """Whether an item lacks a field; an empty list is a lack too."""
    absent = F.col(field).isNull()
    return absent | (F.size(field) == 0) if is_list else absent


def require(items: DataFrame, fields: Iterable[str], strict: bool = False) -> DataFrame:
    """Presence check. Strict: a lacking item fails the query; else it gets a ``reason``."""
    rules = [(missing(field), f"no {field}") for field in fields]
    judged = judge(items, rules)
    if not strict:
        return judged
    return judged.filter(F.when(F.col("reason").isNull(), True)
                         .otherwise(F.raise_error(F.col("reason")).cast("boolean"))).drop("reason")


def check_contracts(items: DataFrame, contracts: DataFrame, fields: list[str],
                    url: str = "url") -> DataFrame:
    """Violations (url, check, detail) of contracts (url, min_items, fields).

    A contract asks for at least ``min_items`` items of its URL, all having every listed
    field. Items shrink to one row of counters per URL before they meet the contracts, so a
    URL with very many items is no burden.
    """
    seen = items.groupBy(url).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(missing(field)).alias(f"_no_{field}") for field in fields])
    lacks = F.filter(
        F.array(*[F.struct(F.lit(field).alias("field"), F.col(f"_no_{field}").alias("n"))
                  for field in fields]),
        lambda lack: (lack["n"] > 0) & F.array_contains("fields", lack["field"]))
    broken = F.concat(
        F.when(F.coalesce("_n", F.lit(0)) < F.col("min_items"), F.array(F.struct(
            F.lit("returns").alias("check"),
            F.concat(F.lit("items "), F.coalesce("_n", F.lit(0)).cast("string")).alias("detail"))))
        .otherwise(F.array().cast("array<struct<check:string,detail:string>>")),
        F.transform(lacks, lambda lack: F.struct(
            F.lit("scrapes").alias("check"), lack["field"].alias("detail"))))
    return contracts.join(seen, url, "left").select(url, F.inline(broken))


def run_stages(items: DataFrame, stages: Iterable[tuple[int, Stage | None]]) -> DataFrame:
    """Apply stages in ascending order of their number; None is a stage switched off."""
    for _, stage in sorted(((n, s) for n, s in stages if s is not None), key=lambda p: p[0]):
        items = items.transform(stage)
    return items


def with_hooks(extract: Stage, before: Iterable[Stage] = (), after: Iterable[Stage] = ()) -> Stage:
    """``extract`` between hooks: ``before`` sees the pages (requests) first to last, ``after``
    the items it makes, last to first, as nested layers do."""
    def hooked(pages: DataFrame) -> DataFrame:
        for hook in before:
            pages = pages.transform(hook)
        items = pages.transform(extract)
        for hook in reversed(list(after)):
            items = items.transform(hook)
        return items
    return hooked
