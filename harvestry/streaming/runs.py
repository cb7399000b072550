"""A keyed table that grows by micro-batches: runs of rows in key buckets, merged step by step.

Every batch writes its rows as a run of level 0. Ahead of each ``fan``-th batch the last
``fan`` runs of a level become one run of the next level, with each key's latest row. A state is
then a few runs per level, a row is rewritten once per level however long the stream runs, and
a batch reads only the buckets its keys fall into.

A level's runs take ``2 * fan`` folders in turn, so merged runs are overwritten by later ones:
what is stored stays in proportion to the table. A folder is only taken again once the batch
that merged its run is long done, so a repeated batch finds all it read the first time and
rewrites the same folders.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH, BUCKET = "batch_id", "bucket"


def covering(n: int, fan: int) -> list[tuple[int, int]]:
    """(level, number) of the runs that together hold the first ``n`` batches."""
    out, start, level = [], 0, 0
    while fan ** (level + 1) <= n:
        level += 1
    for at in range(level, -1, -1):
        while n - start >= fan ** at:
            out.append((at, start // fan ** at))
            start += fan ** at
    return out


@dataclass(frozen=True)
class KeyedRuns:
    """``schema`` (with ``key``, without the columns added here) at ``path``; ``buckets`` and
    ``fan`` hold for the table's life. Batches count from 0; one can be a table's seed."""

    path: str
    schema: T.StructType
    key: str = "key"
    buckets: int = 16
    fan: int = 4
    #: A numeric column by which rows expire, and how far behind the largest one they are kept.
    age: str | None = None
    keep: int = 0

    def folder(self, level: int, number: int) -> str:
        return f"{self.path}/level={level}/slot={number % (2 * self.fan)}"

    def bucket(self, key: str):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _columns(self) -> list[str]:
        return [field.name for field in self.schema.fields]

    def _write(self, rows: DataFrame, level: int, number: int) -> None:
        """One file per bucket."""
        (rows.withColumn(BUCKET, self.bucket(self.key)).repartition(BUCKET)
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(BUCKET).parquet(self.folder(level, number)))

    def _read(self, spark: SparkSession, runs: list[tuple[int, int]]) -> DataFrame:
        whole = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType()),
                              T.StructField(BUCKET, T.IntegerType())])
        parts = [spark.read.schema(whole).parquet(self.folder(*run)) for run in runs]
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], whole)

    def _latest(self, rows: DataFrame) -> DataFrame:
        """Numbers are aggregated, by hash; a key has one row per batch."""
        last = rows.groupBy(self.key).agg(F.max(BATCH).alias(BATCH))
        return rows.join(last, [self.key, BATCH])

    def write(self, rows: DataFrame, batch: int) -> None:
        """The rows of a batch, at most one per key."""
        self._write(rows.select(*self._columns(), F.lit(batch).cast("long").alias(BATCH)),
                    0, batch)

    def merge(self, spark: SparkSession, batch: int) -> None:
        """Call ahead of ``batch``."""
        for level, number, children in self._due(batch):
            rows = self._read(spark, children)
            if self.age:
                # The children's own latest moment: never ahead of the stream's.
                newest = rows.agg(F.max(self.age)).first()[0]
                rows = self._latest(rows).where(F.col(self.age) >= (newest or 0) - self.keep)
            else:
                rows = self._latest(rows)
            self._write(rows.select(*self._columns(), BATCH), level, number)

    def _due(self, batch: int) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
        """Level and number of the runs to merge ahead of ``batch``, and the runs they are of."""
        level = 1
        while batch and batch % self.fan ** level == 0:
            number = batch // self.fan ** level - 1
            yield level, number, [(level - 1, number * self.fan + i) for i in range(self.fan)]
            level += 1

    def written(self, spark: SparkSession, batch: int) -> DataFrame:
        """The rows of ``batch`` itself."""
        return self._read(spark, [(0, batch)]).select(*self._columns())

    def before(self, spark: SparkSession, batch: int,
               touched: DataFrame | None = None) -> DataFrame:
        """Each key's latest row ahead of ``batch``; with ``touched`` (a column of the keys'
        name) only the buckets that hold those keys are read."""
        rows = self._read(spark, covering(batch, self.fan))
        if touched is not None:
            wanted = [r[0] for r in touched.where(F.col(self.key).isNotNull()).select(
                self.bucket(self.key)).distinct().collect()]  # at most one row per bucket
            rows = rows.where(F.col(BUCKET).isin(wanted))
        return self._latest(rows).select(*self._columns())


@dataclass(frozen=True)
class RunLog(KeyedRuns):
    """Runs that hold every row of their batches, any number per key, until the key is done.

    ``deal``, a long column, spreads a bucket's rows over ``files`` files, so that a common key
    is not written by one task."""

    deal: str | None = None
    files: int = 1

    def _write(self, rows: DataFrame, level: int, number: int) -> None:
        spread = [F.pmod(F.col(self.deal), F.lit(self.files))] if self.deal else []
        (rows.withColumn(BUCKET, self.bucket(self.key)).repartition(BUCKET, *spread)
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(BUCKET).parquet(self.folder(level, number)))

    def _latest(self, rows: DataFrame) -> DataFrame:
        return rows

    def merge(self, spark: SparkSession, batch: int, done: KeyedRuns) -> None:
        """Call ahead of ``batch``, after ``done.merge``. Rows whose key has come into ``done``
        (of the same batches and ``fan``) since they were written are left out: a key that is
        done gets no more rows."""
        for level, number, children in self._due(batch):
            rows = self._read(spark, children).join(
                done._read(spark, children).select(self.key), self.key, "left_anti")
            self._write(rows.select(*self._columns(), BATCH), level, number)
