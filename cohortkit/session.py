"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Broadcast only what was measured to be below these bounds.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Above this many rows an ordered running total is spread over range partitions.
SINGLE_TASK_ROWS = 1_000_000


@dataclass
class _Job:
    folder: str
    kept: list[DataFrame] = field(default_factory=list)
    last: list[Callable[[], None]] = field(default_factory=list)


_JOB: ContextVar[_Job | None] = ContextVar("cohortkit_job", default=None)


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with the settings this package is tuned for."""
    builder = SparkSession.builder.appName("cohortkit")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # A whole job compiles more classes than the default cache of 100 holds.
        "spark.sql.codegen.cache.maxEntries": "3000",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a local session, where driver and executors are one machine, may fall
    back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is a folder of one machine; executors must share it")
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="cohortkit-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A job whose intermediate tables go when it ends.

    Tables that operators write inside are deleted on leaving, and cached aggregates freed,
    so results must be written or collected inside. Jobs may be nested.
    """
    job = _Job(f"{shared_folder(spark)}/cohortkit-job-{uuid.uuid4().hex}")
    outer = _JOB.set(job)
    try:
        yield job.folder
    finally:
        _JOB.reset(outer)
        for df in job.kept:
            df.unpersist()
        for function in job.last:
            function()
        path = spark._jvm.org.apache.hadoop.fs.Path(job.folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later passes scan only the columns they need, Spark knows the size on disk,
    and a lost executor costs a re-read instead of the whole lineage. The reader is given
    the schema, so no file has to be opened to find it. A folder without files, which the
    reader cannot see, is an error and not an empty table. Inside ``scratch`` the table
    goes when the job ends.
    """
    spark, job = df.sparkSession, _JOB.get()
    path = f"{job.folder if job else shared_folder(spark)}/cohortkit-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    if not any(f.getPath().getName().startswith("part-") for f in files):
        raise RuntimeError(f"no files of the written table can be seen in {path}")
    return spark.read.schema(df.schema).parquet(path)


def at_end(function: Callable[[], None]) -> None:
    """Call ``function`` when the job of ``scratch`` that is under way ends (never without one)."""
    job = _JOB.get()
    if job:
        job.last.append(function)


def keep(df: DataFrame) -> DataFrame:
    """Reuse a small aggregate in several actions; lost blocks are recomputed."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    job = _JOB.get()
    if job:
        job.kept.append(kept)
    return kept
