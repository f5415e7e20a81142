"""A slowly changing dimension in a folder: open rows are rewritten by a merge, closed ones stay where they are."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, types as T

from tickloom.operators.scd import scd2_merge
from tickloom.streaming.versions import VersionedTables


class StoredDimension:
    """Rows (ticker, tracked columns, effective_from, effective_to, version) in two tables that are committed together.

    The merge of a day reads the open rows only, writes them anew, and appends those that it closes; files of
    rows that were closed before are not touched. The day is the number of the commit: the same day once more
    changes nothing, a day before the last one is refused, and a merge that is lost before its commit leaves
    the dimension as it was.
    """

    def __init__(self, spark: SparkSession, path: str, track: T.StructType, key: T.DataType | None = None, buckets: int = 32):
        self.tables = VersionedTables(spark, path, buckets)
        spans = [T.StructField("effective_from", T.DateType()), T.StructField("effective_to", T.DateType()), T.StructField("version", T.IntegerType())]
        self.schema, self.track = T.StructType([T.StructField("ticker", key or T.StringType()), *track.fields, *spans]), track.names

    def merge(self, current: DataFrame, day: str, close_absent: bool = False) -> None:
        """Bring in the snapshot of a day (ticker and tracked columns, a row a ticker)."""
        number, made = dt.date.fromisoformat(day).toordinal(), self.tables.numbers()
        if number in made:
            return
        if made and number < made[-1]:
            raise ValueError(f"{day} is before the last day merged, {dt.date.fromordinal(made[-1])}")
        merged = scd2_merge(self.open_rows(), current, day, self.track, close_absent).select(*self.schema.names)
        opened = self.tables.write("open", number, merged.filter("effective_to is null"), ["ticker"])
        closed = self.tables.write("closed", number, merged.filter("effective_to is not null"), ["ticker"])
        self.tables.commit(number, whole={"open": opened}, added={"closed": closed})

    def open_rows(self) -> DataFrame:
        return self.tables.read("open", self.schema)

    def rows(self) -> DataFrame:
        """The whole history."""
        return self.open_rows().unionByName(self.tables.read("closed", self.schema))
