"""JSON documents carried in string columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.schemas import CORRUPT, GEOCODE, INDEX_ENTRIES, JOB_STATUS, LOCATION

_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def index_entries(indexes: DataFrame, base_url: str, body: str = "body") -> DataFrame:
    """A JSON array of {id, title} per row to one (…, id, title, url) row per entry."""
    entries = F.from_json(F.col(body), INDEX_ENTRIES)
    return (indexes.select("*", F.inline(entries)).drop(body)
            .withColumn("url", F.concat(
                F.lit(base_url), F.format_string("property_%06d.html", "id"))))


def geocode_location(body: Column) -> Column:
    """The first result's point of an OK geocode reply as {lat, lon}, else NULL."""
    reply = F.from_json(body, GEOCODE)
    point = F.get(reply["results"], F.lit(0))["geometry"]["location"]
    return F.when(
        (reply["status"] == "OK") & point.isNotNull(),
        F.struct(point["lat"].alias("lat"), point["lng"].alias("lon")))


def geocode_status(body: Column) -> Column:
    return F.from_json(body, GEOCODE)["status"]


def cached_location(value: Column) -> Column:
    """A cache value back to {lat, lon}; an empty value is a miss."""
    return F.when(value != "", F.from_json(value, LOCATION))


def job_counts(replies: DataFrame, body: str = "body") -> DataFrame:
    """Replace the status document by the number of jobs it lists per state; a missing list
    counts 0."""
    empty = F.array().cast(JOB_STATUS["running"].dataType)
    return (replies.withColumn("_status", F.from_json(F.col(body), JOB_STATUS)).drop(body)
            .withColumns({state: F.size(F.coalesce(f"_status.{state}", empty)).cast("long")
                          for state in JOB_STATUS.fieldNames()}).drop("_status"))


def worker_urls(batches: DataFrame, rule: int, urls: str = "urls") -> DataFrame:
    """A worker's JSON array of URLs to one (…, pos, url, rule) row per URL."""
    return (batches
            .select("*", F.posexplode(F.from_json(F.col(urls), "array<string>"))
                    .alias("pos", "url"))
            .drop(urls).withColumn("rule", F.lit(rule)))
