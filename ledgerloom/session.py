"""The local session for tests and bench, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "ledgerloom", **conf: str) -> SparkSession:
    """A session on this machine; a cluster brings its own session and settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session on one machine may do without the setting; it then gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


# Folders staged within ``scratch``.
_kept: ContextVar[list[str] | None] = ContextVar("kept", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Discards on leaving, also by an error, what ``stage`` put into folders of its own meanwhile.

    For work whose result is written by then: frames that read such folders end with them.
    """
    paths: list[str] = []
    token = _kept.set(paths)
    try:
        yield
    finally:
        _kept.reset(token)
        for path in paths:
            discard(spark, path)


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from the files.

    Cuts the lineage (a lost executor costs a re-read, not a recomputation) and lets several
    branches of a plan each read only the columns they need. Who names a ``fresh_path`` may
    ``discard`` it when nothing reads it any more.
    """
    if path is None:
        path = fresh_path(df.sparkSession, label)
        if (kept := _kept.get()) is not None:
            kept.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged folder."""
    if not path.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"{path} is not in the shared folder")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
