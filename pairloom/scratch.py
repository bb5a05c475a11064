"""Intermediate tables in the cluster's shared checkpoint folder.

A staged table cuts lineage: a lost executor costs the tasks it ran, not the jobs
before them. It also gives an exact row count, which is what the broadcast checks use.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its rows times its row width stay below this.
BROADCAST_BYTES = 64 * 1024 * 1024

# Arrow batches that go to Python tasks hold about this much at most, or one row.
BATCH_BYTES = 4 * 1024 * 1024

# Row groups of tables with large rows hold about this much, or one row.
ROW_GROUP_BYTES = 4 * 1024 * 1024

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# Folder of the job that runs, below the application's; empty outside of a job.
_job: ContextVar[str] = ContextVar("job", default="")


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables."""
    base = spark.conf.get(_CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder that every executor can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/pairloom/{spark.sparkContext.applicationId}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="pairloom-")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name for one intermediate table."""
    return f"{scratch_root(spark)}{_job.get()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Give the intermediate tables of a job a folder of their own and remove it when the job ends.

    For jobs whose results are written; tables that are still read afterwards must not be inside.
    """
    folder = f"/job-{uuid.uuid4().hex}"
    token = _job.set(folder)
    try:
        yield
    finally:
        _job.reset(token)
        delete(spark, scratch_root(spark) + folder)


def kept_result(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``build`` gives, written and read again; the intermediate tables that it wrote are removed."""
    path = scratch_folder(spark, name)
    with job_scratch(spark):
        df = build()
        schema = df.schema
        df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class Staged:
    """A written intermediate table."""

    df: DataFrame
    path: str

    def count(self) -> int:
        return self.df.count()

    def drop(self) -> None:
        delete(self.df.sparkSession, self.path)


def stage(df: DataFrame, name: str, large_rows: bool = False) -> Staged:
    """Write ``df`` to the scratch folder and return the table read back from there."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    writer = df.write.mode("errorifexists")
    if large_rows:
        writer = of_large_rows(writer)
    writer.parquet(path)
    return Staged(spark.read.schema(df.schema).parquet(path), path)


def of_large_rows(writer: DataFrameWriter) -> DataFrameWriter:
    """A writer for rows of megabytes: row groups of one row or a few, as readers hold a whole row group at once.

    The writer looks at its buffer after each row instead of every hundred.
    """
    writer = writer.option("parquet.page.size.row.check.min", 1).option("parquet.block.size.row.check.min", 1)
    return writer.option("parquet.block.size", ROW_GROUP_BYTES)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast when the counted size is below the limit; else leave the shuffle join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bound the Arrow batches of tables that are written meanwhile by bytes, as ten thousand long rows are a large batch.

    Both the executor and the Python process hold a batch, and neither gives all of that memory back. A bound that the session
    has stays. Tables that are only described inside, and read later, have the session's batches.
    """
    if spark.conf.get(_BATCH_BYTES, None) is not None:
        yield
        return
    with session_conf(spark, _BATCH_BYTES, str(BATCH_BYTES)):
        yield


@contextmanager
def session_conf(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Set an entry of the session meanwhile."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def clear_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table of this application. Call when its results are written."""
    delete(spark, scratch_root(spark))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files that no table refers to any more.

    It does when the driver collects garbage, of which a driver that only starts jobs has little: once in half an hour.
    """
    gc.collect()
    spark._jvm.System.gc()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Finished tables directly below a folder, in order; none when it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    found = [entry.getPath() for entry in system.listStatus(target) if entry.isDirectory()]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(p.toString() for p in found if system.exists(done(p, "_SUCCESS")))
