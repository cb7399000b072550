"""File sources: item feeds, rule tables and table streams."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestry.schemas import CORRUPT, ITEM

# A section with its lines, and a "key = value" or "key: value" line.
_SECTION = r"(?m)^\[([^\]\r\n]+)\][^\r\n]*((?:\R(?!\[).*)*)"
_SETTING = r"(?m)^([^#;=:\s][^=:\r\n]*)[=:]([^\r\n]*)$"


def read_items(spark: SparkSession, path: str, schema: T.StructType = ITEM,
               strict: bool = False) -> DataFrame:
    """One item per JSON line. Malformed lines fail the read when strict; otherwise they
    come back in the extra column ``_corrupt_record``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    tolerant = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(tolerant).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def stream_items(spark: SparkSession, path: str, schema: T.StructType = ITEM,
                 files_per_trigger: int | None = None) -> DataFrame:
    """New files of a feed folder as a stream, oldest first."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A rule table: header row, one URL per row, one path expression per further column.
    Any line ends; a quote inside a quoted cell is doubled."""
    return (spark.read.option("header", True).option("escape", '"')
            .option("inferSchema", False).csv(path))


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    """A sectioned settings file as (section, key, value, pos); comment lines are skipped.
    ``pos`` orders the settings of a file: sections and keys may repeat."""
    text = spark.read.text(path, wholetext=True)
    sections = text.select(F.posexplode(F.arrays_zip(
        F.regexp_extract_all("value", F.lit(_SECTION), 1).alias("section"),
        F.regexp_extract_all("value", F.lit(_SECTION), 2).alias("body"))).alias("at", "part"))
    lines = sections.select("at", "part.section", F.posexplode(F.arrays_zip(
        F.regexp_extract_all("part.body", F.lit(_SETTING), 1).alias("key"),
        F.regexp_extract_all("part.body", F.lit(_SETTING), 2).alias("value")))
        .alias("line", "own"))
    return lines.select("section", F.lower(F.trim("own.key")).alias("key"),
                        F.trim("own.value").alias("value"), F.struct("at", "line").alias("pos"))


def stream_table(spark: SparkSession, path: str, schema: T.StructType,
                 files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a stream; the table may be a folder or a single file."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    folder, name = os.path.split(path.rstrip("/"))
    files = spark.read.schema(schema).parquet(path).inputFiles()
    if len(files) == 1 and os.path.basename(files[0]) == name:
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)
