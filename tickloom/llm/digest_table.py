"""A persistent table keyed by digest: bucketed and sorted by it, appended to batch by batch."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.session import delete_folder, scratch_folder

BUCKET_ROWS = 2_000_000


def buckets_for(rows: int) -> int:
    """A power of two by the number of digests expected, 32 at least."""
    return max(32, 1 << (-(-rows // BUCKET_ROWS) - 1).bit_length() if rows else 32)


class DigestTable:
    """A Parquet table in `folder`; opening a folder that has one goes on with it. Digests are not compressed.

    columns are SQL (name type) beside the key `digest BINARY`; parts are the names of the text columns
    that partition it, the last of which is the batch. The number of buckets is stored in the folder when
    the table is first written (a file named _buckets_N) and read back ever after: a table that is opened
    again has the buckets that it was written with, whatever is asked for, and files that lie there
    without that number are refused. Without a folder the table lives in the scratch folder until close.
    """

    def __init__(self, spark: SparkSession, columns: str, parts: tuple[str, ...] = ("batch",), folder: str | None = None, buckets: int = 32, name: str = "digests"):
        self.spark, self.columns, self.parts, self.own = spark, columns, parts, folder is None
        self.folder, self.buckets = folder or scratch_folder(spark, "digests"), buckets
        self.name = f"{name}_{uuid.uuid4().hex}"
        self.ready = False

    def _files(self) -> tuple[object, object]:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(context._jsc.hadoopConfiguration()), path

    def _stored_buckets(self) -> int:
        files, path = self._files()
        files.mkdirs(path)
        names = [s.getPath().getName() for s in files.listStatus(path)]
        stored = [int(m[1]) for n in names if (m := re.fullmatch(r"_buckets_(\d+)", n))]
        if len(stored) > 1 or (not stored and any("=" in n for n in names)):
            raise ValueError(f"{self.folder} holds digests, but not in how many buckets they lie")
        if not stored:
            files.create(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"_buckets_{self.buckets}"), False).close()
        return stored[0] if stored else self.buckets

    def open(self) -> DigestTable:
        if not self.ready:
            self.buckets = self._stored_buckets()
            parts = ", ".join(f"{p} STRING" for p in self.parts)
            self.spark.sql(
                f"CREATE TABLE {self.name} (digest BINARY, {self.columns}, {parts}) USING parquet OPTIONS (compression 'none') PARTITIONED BY ({', '.join(self.parts)}) "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.folder}'"
            )
            self.spark.catalog.recoverPartitions(self.name)  # a table that is there already
            self.ready = True
        return self

    def rows(self) -> DataFrame:
        return self.open().spark.table(self.name)

    def put(self, rows: DataFrame, **parts: str) -> None:
        """Write one partition; a given partition is overwritten by itself, whatever the session's overwrite mode."""
        self.open()
        where = ", ".join(f"{p} = :{p}" for p in self.parts)
        columns = [c for c in self.rows().columns if c not in self.parts]
        # dealt by bucket, so that a bucket has one file however many tasks there are
        put = rows.select(*columns).repartition(self.buckets, F.pmod(F.hash("digest"), F.lit(self.buckets)))
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({where}) SELECT * FROM {{put}}", args=parts, put=put)

    def close(self) -> None:
        """Forget the table's name; its files stay, unless the caller named no folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.ready = False
        if self.own:
            delete_folder(self.spark, self.folder)
