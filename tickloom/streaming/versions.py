"""Tables of one folder that are committed together, copy on write by bucket of key."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BUCKET = "bucket"


class VersionedTables:
    """Files lie at table/v=version/bucket=number; commit n, a small file in _commits, says for each table
    and bucket of which versions it consists. A commit appears as a whole, by a rename, so that a batch that
    is lost between writing files and committing them leaves what was there before, and one that comes again
    after its commit changes nothing. Files that no commit of the last `keep` names are deleted.

    The number of buckets is stored with the first commit and stays.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32, keep: int = 2):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        last = self.newest()
        self.buckets = last["buckets"] if last else buckets

    def _fs(self, path: str) -> tuple[object, object]:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _names(self, path: str) -> list[str]:
        files, where = self._fs(path)
        return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []

    def numbers(self) -> list[int]:
        """Commits that are there, in order."""
        return sorted(int(n[:-5]) for n in self._names(f"{self.path}/_commits") if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, number: int) -> dict:
        files, where = self._fs(f"{self.path}/_commits/{number:012d}.json")
        stream = files.open(where)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def newest(self, below: int | None = None) -> dict | None:
        """The last commit (of those below a number, if given); None without any."""
        made = [n for n in self.numbers() if below is None or n < below]
        return self._load(made[-1]) if made else None

    def bucket_of(self, keys: Iterable[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def read(self, table: str, schema: T.StructType, buckets: Iterable[int] | None = None, below: int | None = None) -> DataFrame:
        """The rows of a table (or of some of its buckets) as of the last commit."""
        parts = ((self.newest(below) or {}).get("tables", {})).get(table, {})
        wanted = parts if buckets is None else {str(b) for b in buckets} & parts.keys()
        paths = [f"{self.path}/{table}/v={v}/{BUCKET}={b}" for b in sorted(wanted) for v in parts[b]]
        return self.files(schema, *paths) if paths else self.spark.createDataFrame([], schema)

    def files(self, schema: T.StructType, *paths: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths).select(*schema.names)  # the bucket in the path is no column

    def write(self, table: str, number: int, rows: DataFrame, keys: list[str]) -> list[int]:
        """Write rows as version `number` of their buckets, one file each; gives the buckets. Not seen before commit."""
        folder = f"{self.path}/{table}/v={number}"
        rows.withColumn(BUCKET, self.bucket_of(keys)).repartition(self.buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        return sorted(int(n.split("=")[1]) for n in self._names(folder) if n.startswith(f"{BUCKET}="))

    def commit(self, number: int, replaced: dict[str, Iterable[int]] | None = None, added: dict[str, Iterable[int]] | None = None, whole: dict[str, Iterable[int]] | None = None) -> None:
        """Make version `number` seen: in place of the buckets replaced, beside what added ones hold, or as a whole table."""
        tables = (self.newest(number) or {}).get("tables", {})
        for table, buckets in (whole or {}).items():
            tables[table] = {str(b): [number] for b in buckets}
        for table, buckets in (replaced or {}).items():
            tables.setdefault(table, {}).update({str(b): [number] for b in buckets})
        for table, buckets in (added or {}).items():
            parts = tables.setdefault(table, {})
            for b in buckets:
                parts[str(b)] = [*parts.get(str(b), []), number]
        text = json.dumps({"buckets": self.buckets, "tables": tables})
        files, draft = self._fs(f"{self.path}/_commits/.{number:012d}.draft")
        out = files.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not files.rename(draft, self._fs(f"{self.path}/_commits/{number:012d}.json")[1]):
            files.delete(draft, False)  # the same batch has been committed meanwhile
        self._collect()

    def _collect(self) -> None:
        """Delete commits before the last ones, and files that no commit names."""
        made = self.numbers()
        for n in made[: -self.keep]:
            files, where = self._fs(f"{self.path}/_commits/{n:012d}.json")
            files.delete(where, False)
        made = made[-self.keep :]
        used = {(t, v, b) for n in made for t, parts in self._load(n)["tables"].items() for b, versions in parts.items() for v in versions}
        for table in {t for t, _, _ in used}:
            for name in self._names(f"{self.path}/{table}"):
                version = int(name[2:]) if name.startswith("v=") else None
                if version is None or version > made[-1]:  # a batch that is being written
                    continue
                kept = {b for t, v, b in used if t == table and v == version}
                folders = [f.split("=")[1] for f in self._names(f"{self.path}/{table}/{name}") if f.startswith(f"{BUCKET}=")]
                for gone in [f"{name}/{BUCKET}={b}" for b in folders if b not in kept] if kept else [name]:
                    files, where = self._fs(f"{self.path}/{table}/{gone}")
                    files.delete(where, True)
