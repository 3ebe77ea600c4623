"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: what the operators rely on: UTC days, splitting a hot join key even where that
#: costs another shuffle, and limits of ranked groups that reach below the shuffle
#: for every k
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
}

#: bytes a task reads at most, of a table and of a shuffle. Spark's own sizes follow the compressed bytes and the
#: number of cores, and sorted keys take two or three bytes each: a task then sorts and hashes tens of millions of rows
CEILINGS = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 4 << 20,
}
#: rows and bytes of a batch that a Python worker gets at most. Spark's own are 10,000 rows or 64 MB, of which a worker holds
#: several copies, and it keeps that memory through the stages that follow
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20,
}
#: parts of a shuffle before adaptive execution merges what is small
LEAST_PARTS = 400


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere; smaller tasks than ours are left as they are."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key, ceiling in CEILINGS.items():
        spark.conf.set(key, str(min(ceiling, _bytes(spark.conf.get(key)))))
    parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    named = spark.conf.get(parts, None) or spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(parts, str(max(LEAST_PARTS, int(named))))
    return spark


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of Python workers from here on; smaller ones than ours are left as they are."""
    for key, ceiling in BATCHES.items():
        now = _bytes(spark.conf.get(key))
        spark.conf.set(key, str(min(ceiling, now) if now > 0 else ceiling))  # none or less is no limit


def _bytes(size: str) -> int:
    """A size as Spark writes it: ``134217728b``, ``64MB``, ``4k``."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)b?\s*", size.lower()).groups()
    return int(number) << (10 * " kmgtp".index(unit or " "))


def local_session(cores: int = 8, name: str = "tallywright") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names, visible to every executor.

    Without that setting a session on one machine, as in tests, uses its own
    warehouse; anywhere else it is an error, since files would be lost.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tallywright-stored"


#: the folder of the run in progress, if any
_RUN: ContextVar[str | None] = ContextVar("run_folder", default=None)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Frames stored inside go to one folder, which is removed at the end.

    Write or collect what is built from them before leaving: they are gone then.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        remove_folder(spark, folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: whether Spark removes the shuffle files of a statement when it ends; else they lie until the driver happens to
#: collect its garbage, so that the files of a run's steps add up
FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written or collected inside leaves no shuffle files behind. For statements whose result is read back
    from elsewhere: a frame that is collected again shuffles again."""
    before = spark.conf.get(FREEING, "false")
    spark.conf.set(FREEING, "true")
    try:
        yield
    finally:
        spark.conf.set(FREEING, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later reads prune columns, survive lost executors and never repeat the work.
    Inside ``run_folder`` the files go when the run ends; otherwise they stay until
    the shared folder is cleaned.
    """
    folder = _RUN.get() or shared_folder(df.sparkSession)
    path = f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
