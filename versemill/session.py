"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "versemill", master: str | None = None) -> SparkSession:
    """A session with adaptive execution on; `master` is given only for local runs."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        cores = master.partition("[")[2].rstrip("]")
        partitions = cores if cores.isdigit() else str(os.cpu_count() or 8)
        builder = (
            builder.master(master)
            .config("spark.sql.shuffle.partitions", partitions)
            .config("spark.driver.memory", "12g")
            .config("spark.ui.enabled", "false")
            .config("versemill.spread", partitions)
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir` of the session.

    Only a local session without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    current = context.getCheckpointDir()
    if current is None:
        current = tempfile.mkdtemp(prefix="versemill-")
        context.setCheckpointDir(current)
    return current.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created until a job writes there."""
    return f"{shared_root(spark)}/versemill/{name}-{uuid.uuid4().hex}"


#: Whether Spark removes the shuffle files of an action when it ends, in plain sessions and in others.
CLEANUP = ["spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.shuffleDependency.fileCleanup.enabled"]


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is moved by an action in here goes from the disk as the action ends. Otherwise it stays until
    the driver happens to collect its garbage, which a long chain of jobs cannot wait for."""
    before = {key: spark.conf.get(key, None) for key in CLEANUP}
    for key in CLEANUP:
        spark.conf.set(key, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def cut_lineage(df):
    """The rows as a written table in the shared folder: a lost executor costs no recomputation,
    and later plans know the size of the table and read only the columns they need."""
    spark = df.sparkSession
    path = work_folder(spark, "table")
    with shuffles_removed(spark):
        df.write.parquet(path)
    for paths in _written.paths[-1:]:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def discard(table: DataFrame | None) -> None:
    """Delete what `cut_lineage` has written, once nothing reads it any more."""
    for file in table.inputFiles()[:1] if table is not None else []:
        _delete(table.sparkSession, file.rpartition("/")[0])


class _Written(threading.local):
    """The tables that this thread has written within each `settled` it is in, the innermost last."""

    def __init__(self):
        self.paths: list[list[str]] = []


_written = _Written()


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """The rows of `make()` as a written table. The tables that were written on the way there are
    deleted, so nothing else that `make` worked out may be read afterwards."""
    _written.paths.append([])
    try:
        df = make()
    finally:
        inner = _written.paths.pop()
    out = cut_lineage(df)
    for path in inner:
        _delete(df.sparkSession, path)
    return out


def spread(df, *keys: str):
    """Give an input of few splits to all cores, where the session asks for it.

    A small file can be one row group, hence one task, however many cores there are. The setting
    `versemill.spread` names the number of partitions; without it nothing is shuffled.
    """
    n = df.sparkSession.conf.get("versemill.spread", None)
    return df.repartition(int(n), *keys) if n else df
