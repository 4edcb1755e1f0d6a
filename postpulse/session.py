"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_STATE = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Arbitrary-state processors keep several column families per key.
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE)
        # Python state processors talk to the JVM over a socket file, not a port.
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it. Only where
    it names none and all runs in one process, as in a test, a folder is made."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        named = context.getCheckpointDir()
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/postpulse/{label}-{uuid.uuid4().hex}"


def stage(rows: DataFrame, label: str) -> DataFrame:
    """Rows stored once in the shared folder and read back, for several users.

    It cuts the lineage like a checkpoint: what comes after does not repeat the
    scan behind it, and a lost executor costs nothing already stored. Unlike a
    checkpoint the rows keep a known size, by which Spark decides whether to
    broadcast them, and readers take only the columns they need.
    """
    path = scratch_path(rows.sparkSession, label)
    if _staged.get() is not None:
        _staged.get().append(path)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def dropping_staged(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables staged inside when the block ends, for jobs whose
    results are written by then."""
    token = _staged.set([])
    try:
        yield
    finally:
        for path in _staged.get():
            delete_folder(spark, path)
        _staged.reset(token)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
