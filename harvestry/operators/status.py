"""Crawl targets: configuration with inherited defaults, and job status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.sources.documents import job_counts

# Job states, and the sections that describe targets.
STATES = ("running", "finished", "pending")
BASE_SECTION = "deploy"
TARGET_PREFIX = "deploy:"


def target_config(settings: DataFrame) -> DataFrame:
    """(target, key, value) from (section, key, value) and, where there is one, ``pos``.

    Every ``deploy:<name>`` section is a target that starts from the base section's keys and
    overrides them. The base itself is the target "default" if it has a ``url``. Of a key
    that a section repeats, the one of the highest ``pos`` holds (the largest value, without
    positions or at equal ones). The base section is one small map, read as a scalar subquery.
    """
    pos = F.col("pos") if "pos" in settings.columns else F.lit(0)
    settings = settings.groupBy("section", "key").agg(
        F.max_by("value", F.struct(pos, F.col("value"))).alias("value"))
    pairs = F.map_from_entries(F.collect_list(F.struct("key", "value")))
    base = settings.filter(F.col("section") == BASE_SECTION)
    defaults = base.agg(pairs.alias("m")).select("m").scalar()
    named = (settings.filter(F.startswith("section", F.lit(TARGET_PREFIX)))
             .groupBy("section").agg(pairs.alias("own"))
             .select(F.substring("section", len(TARGET_PREFIX) + 1, 2**31 - 1).alias("target"),
                     "own", defaults.alias("base")))
    inherited = F.map_filter("base", lambda key, _: ~F.map_contains_key("own", key))
    merged = named.select("target", F.explode(F.map_concat(inherited, "own"))
                          .alias("key", "value"))
    default = base.filter(F.map_contains_key(defaults, "url")).select(
        F.lit("default").alias("target"), "key", "value")
    return merged.unionByName(default)


def job_status(replies: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(target, running, finished, pending, line) from (target, code, body) replies, sorted
    by target; targets whose reply is not a 200 are left out. ``wanted`` (target) keeps the
    requested ones."""
    if wanted is not None:
        replies = replies.join(wanted.select("target"), "target", "left_semi")
    counted = job_counts(replies.filter(F.col("code") == 200).select("target", "body"))
    line = F.format_string("%-20s running: %d, finished: %d, pending: %d", "target", *STATES)
    return counted.withColumn("line", line).orderBy("target")


def wanted_targets(config: DataFrame, names: list[str]) -> DataFrame:
    """The configured targets among ``names``; asking for none of them is an error."""
    found = config.select("target").filter(F.col("target").isin(names)).distinct()
    if found.isEmpty():
        raise ValueError("nothing to monitor")
    return found


def asked_targets(config: DataFrame, asked: DataFrame) -> DataFrame:
    """The configured targets among those of a table (target), however many."""
    return config.select("target").join(asked.select("target"), "target",
                                        "left_semi").distinct()


def jobs_by_state(jobs: DataFrame, states: tuple[str, ...] = STATES) -> DataFrame:
    """(target, one count per state) from (target, state) rows."""
    return jobs.groupBy("target").agg(
        *[F.count_if(F.col("state") == state).alias(state) for state in states])
