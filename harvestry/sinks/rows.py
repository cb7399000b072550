"""What the sinks receive: feed lines, documents, upserts, image manifests."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.functions.text import fits, one_line
from harvestry.functions.urls import image_path, thumbnail_path
from harvestry.session import cut_lineage

# The widths of the target table's text columns.
URL_WIDTH, TEXT_WIDTH = 100, 30


def item_documents(items: DataFrame, collection: str | None = None) -> DataFrame:
    """One JSON document per item (absent fields omitted, non-ASCII text kept as it is)."""
    documents = items.select(F.to_json(F.struct("*")).alias("document"))
    return documents if collection is None else documents.withColumn(
        "collection", F.lit(collection))


ROW = "key string, url string, title string, price double, description string"


def upsert_rows(items: DataFrame, seq: str = "seq", cut_key: bool = False) -> DataFrame:
    """(key, url, title, price, description, seq): items cut to the table's widths. Items
    lacking any of the four are skipped. The key is the whole URL, or with ``cut_key`` what
    the table's column holds of it, as where that column is the key."""
    def first(field):
        return F.get(field, F.lit(0))

    cut = fits(first("url"), URL_WIDTH)
    rows = items.select(
        (cut if cut_key else first("url")).alias("key"), cut.alias("url"), fits(first("title"), TEXT_WIDTH).alias("title"),
        first("price").alias("price"),
        fits(one_line(first("description")), TEXT_WIDTH).alias("description"),
        F.col(seq).alias("seq"))
    return rows.dropna(subset=["url", "title", "price", "description"])


def upsert(target: DataFrame, rows: DataFrame) -> DataFrame:
    """The target after replacing by ``key``: of the new rows the one with the highest
    ``seq`` (equal ones are settled by a hash of the row), else the target's own.

    The target only loses the keys that are written. Of the new rows the numbers are
    aggregated, by hash and before the shuffle; the winning row is joined to them."""
    columns = ["key", "url", "title", "price", "description"]
    rows = rows.withColumn("_tie", F.xxhash64(*columns))
    newest = rows.groupBy("key").agg(F.max("seq").alias("seq"))
    latest = rows.join(newest, ["key", "seq"])
    chosen = latest.groupBy("key").agg(F.max("_tie").alias("_tie"))
    new = latest.join(chosen, ["key", "_tie"]).select(*columns).distinct()
    kept = target.select(*columns).join(newest.select("key"), "key", "left_anti")
    return kept.unionByName(new)


def upsert_table(rows: DataFrame, path: str, buckets: int = 64) -> list[int]:
    """:func:`upsert` into a written target, a folder of ``buckets`` key buckets (the same
    number for the target's life; a missing folder is an empty target). Only the buckets that
    hold a written key are read and replaced, the files of all others stay; their numbers are
    returned. Writing the same rows again changes nothing, so a failed run is repeated."""
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")
    rows = cut_lineage(rows.where("key is not null"))
    touched = [r[0] for r in rows.select(bucket).distinct().collect()]  # at most ``buckets``
    if not touched:
        return []
    try:
        target = spark.read.schema(ROW + ", bucket int").parquet(path).where(
            F.col("bucket").isin(touched))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        target = spark.createDataFrame([], ROW)
    (upsert(target, rows).withColumn("bucket", bucket).repartition("bucket")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(path))
    return sorted(touched)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """(key, url, title, price, description) of a target."""
    return spark.read.schema(ROW + ", bucket int").parquet(path).drop("bucket")


def image_manifest(items: DataFrame) -> DataFrame:
    """(url, path, thumbnail) per distinct image."""
    return (items.select(F.explode("image_urls").alias("url")).distinct()
            .select("url", image_path(F.col("url")).alias("path"),
                    thumbnail_path(F.col("url")).alias("thumbnail")))


def image_records(manifest: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """(url, path, checksum) of the manifest's images among binary files (path, content)
    stored below ``root``."""
    stored = files.select(
        F.substring_index("path", root.rstrip("/") + "/", -1).alias("path"),
        F.md5("content").alias("checksum"))
    return manifest.select("url", "path").join(stored, "path").select("url", "path", "checksum")
