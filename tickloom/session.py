"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import tempfile
import uuid
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", name: str = "tickloom") -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which every executor sees.

    Where the setting is absent, a temporary folder is taken, but in local mode only: on a
    cluster the executors could not read each other's files there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _owned.get().append((spark, folder))
    return folder


#: What scratch_folder has given out: to the block that owns it, else to the program.
_leftover: list[tuple[SparkSession, str]] = []
_owned: ContextVar[list[tuple[SparkSession, str]]] = ContextVar("owned", default=_leftover)


@contextmanager
def scratch_tables():
    """A block that owns every scratch folder made within: they are deleted at its end.

    A result must be written or collected inside the block, as the tables that it reads go with it. What is
    made outside of any block is deleted when the program ends.
    """
    mine: list[tuple[SparkSession, str]] = []
    token = _owned.set(mine)
    try:
        yield
    finally:
        _owned.reset(token)
        _delete_all(mine)


def _delete_all(folders: list[tuple[SparkSession, str]]) -> None:
    while folders:
        spark, folder = folders.pop()
        delete_folder(spark, folder)


@atexit.register
def _delete_leftovers() -> None:
    if _leftover and SparkSession.getActiveSession() is not None:
        with suppress(Exception):  # the JVM may be gone already
            _delete_all(_leftover)


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tickloom-")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared scratch folder and read it again: cuts lineage, survives executors."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Scratch:
    """Materialised tables of one operator: each goes as soon as the operator says that it is done with.

    A table that a returned, not yet computed DataFrame reads must stay until its owner's end (scratch_tables).
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, {}

    def write(self, df: DataFrame, name: str, arrow_rows: int | None = None, plain: bool = False) -> DataFrame:
        """The table written and read again; arrow_rows bounds the batches that its Python workers get meanwhile.

        plain tables, of digests say, are not compressed: a codec's buffers would be all that it costs.
        """
        folder = scratch_folder(self.spark, name)
        with arrow_batches(self.spark, arrow_rows):
            (df.write.option("compression", "none") if plain else df.write).parquet(folder)
        out = self.spark.read.schema(df.schema).parquet(folder)
        self.folders[id(out)] = (out, folder)
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete these tables' files; what this object has not written is left alone."""
        for table in tables:
            if id(table) in self.folders:
                delete_folder(self.spark, self.folders.pop(id(table))[1])


@contextmanager
def arrow_batches(spark: SparkSession, rows: int | None):
    """Batches of at most so many rows for Python workers; the session's own setting comes back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        if rows:
            spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
        yield
    finally:
        if rows:
            spark.conf.set(key, before)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder through the file system that its path names."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
