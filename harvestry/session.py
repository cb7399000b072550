"""Session defaults and the shared scratch folder used for checkpoints and written tables."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; pass ``master`` for local runs only."""
    builder = SparkSession.builder.appName("harvestry")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a local master uses the context's checkpoint folder, or a
    temporary one; a cluster without the setting is refused, because a machine-local folder
    would be lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root and not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="run-"))
    return root or context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for what a caller keeps."""
    return f"{shared_root(spark).rstrip('/')}/harvestry/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later steps neither recompute nor re-sample it."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, label: str, bucket: str | None = None, buckets: int = 1,
          codec: str | None = None, free: bool = False, placed: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read that: for results several sinks
    use, each reading only its columns. With ``bucket`` the table is bucketed by that column,
    so that joins on it do not shuffle the table; ``placed`` says that ``df`` is partitioned by it
    into so many parts already. ``codec`` compresses other than the session does.
    With ``free`` the shuffle files of the write go as it ends, not when the driver happens to
    collect its garbage. ``discard`` deletes the table again."""
    spark = df.sparkSession
    if free:
        before = spark.conf.get(FREE_SHUFFLES, None)
        spark.conf.set(FREE_SHUFFLES, "true")
        try:
            return store(df, label, bucket, buckets, codec, placed=placed)
        finally:
            if before is None:
                spark.conf.unset(FREE_SHUFFLES)
            else:
                spark.conf.set(FREE_SHUFFLES, before)
    root = f"{shared_root(spark).rstrip('/')}/harvestry"
    database = f"harvestry_{hashlib.md5(root.encode()).hexdigest()[:12]}"
    if not spark.catalog.databaseExists(database):  # a look, where a statement stays in the driver
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    name = f"{database}.{re.sub('[^a-z0-9]', '_', label.lower())}_{uuid.uuid4().hex}"
    options = {"compression": codec} if codec else {}
    if bucket:
        rows = df if placed else df.repartition(buckets, bucket)
        rows.write.format("parquet").options(**options).bucketBy(
            buckets, bucket).saveAsTable(name)
    else:
        df.write.format("parquet").options(**options).saveAsTable(name)
    stored = spark.table(name)
    stored.scratch_table = name
    return stored


def discard(df: DataFrame) -> None:
    """Delete a table made by ``store``, once nothing lazy reads it any more."""
    name = getattr(df, "scratch_table", None)
    if name:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's modules along with the application, once, so that Python workers can
    import them wherever they run. Call it ahead of functions that run in workers."""
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="run-")) / "harvestry_modules.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, f"{package.name}/{module.relative_to(package)}")
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition into the configured number of partitions, also where they are small:
    adaptive coalescing goes by bytes and would leave CPU-heavy work to a few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per task slot, for CPU-heavy work on a table as read.

    A large table has more scan partitions than slots and passes unchanged; only a table of
    a few files pays for a shuffle. Select the needed columns first.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)
