"""Reading and writing datasets: partitioned Parquet, delimited text, vendor JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.expressions import by


def read_parquet_tree(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """All files under root; keys in directory names become columns."""
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(root)


def read_range(spark: SparkSession, root: str, first: str, last: str, columns: list[str] | None = None, date: str = "date") -> DataFrame:
    """Rows of a date range; the filter and the columns reach the scan."""
    df = read_parquet_tree(spark, root)
    kind = df.schema[date].dataType
    df = df.filter(F.col(date).between(F.lit(first).cast(kind), F.lit(last).cast(kind)))
    return df.select(*columns) if columns else df


def guess_separator(head: str) -> str:
    """The commonest of comma, tab and pipe in the first line."""
    line = head.split("\n", 1)[0]
    return max(",\t|", key=line.count)


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, schema: str | None = None) -> DataFrame:
    """Text with a header; cells that do not fit their type become null."""
    if sep is None:
        head = spark.read.text(path).limit(1).collect()
        sep = guess_separator(head[0][0]) if head else ","
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


#: The members of the vendors' bars, in the order open, high, low, close, volume.
KEYED = ("1. open", "2. high", "3. low", "4. close", "5. volume")
NAMED = ("open", "high", "low", "close", "volume")
SERIES = "$['Time Series (1min)']"


def vendor_bars(df: DataFrame, vendor: str, column: str = "value") -> DataFrame:
    """JSON documents -> ts, o, h, l, c, v as strings, as the vendor gives them; epoch times as ISO with zone.

    alphavantage: {"Time Series (1min)": {time: {"1. open": ...}}}; twelvedata: {"values": [{"datetime" or
    "date": ..., "open": ...}]}; polygon: {"results": [{"t": nanoseconds, "o": ...}]}; fmp: [{"date": ...,
    "open": ...}]; any other: a list, or {"data": a list}, with timestamp, datetime, date or time.
    A document of another shape gives no rows.
    """
    j = F.col(column)
    if vendor == "alphavantage":
        rows = df.select(F.explode(F.from_json(F.get_json_object(j, SERIES), "map<string, map<string, string>>")).alias("ts", "b"))
        return rows.select("ts", *[F.col("b")[n].alias(a) for n, a in zip(KEYED, "ohlcv", strict=True)])
    if vendor == "polygon":
        kind = "array<struct<t: bigint, " + ", ".join(f"{c}: string" for c in "ohlcv") + ">>"
        rows = df.select(F.inline(F.from_json(F.get_json_object(j, "$.results"), kind)))
        at = F.date_format(F.to_utc_timestamp(F.timestamp_micros(F.expr("t div 1000")), F.current_timezone()), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return rows.select(F.concat(at, F.lit("Z")).alias("ts"), *"ohlcv")
    times = {"twelvedata": ("datetime", "date"), "fmp": ("date",)}.get(vendor, ("t", "timestamp", "datetime", "date", "time"))
    kind = "array<struct<" + ", ".join(f"{c}: string" for c in (*times, *NAMED)) + ">>"
    inner = {"twelvedata": F.get_json_object(j, "$.values"), "fmp": j}.get(vendor, F.coalesce(F.get_json_object(j, "$.data"), j))
    rows = df.select(F.inline(F.from_json(inner, kind)))
    return rows.select(F.coalesce(*times).alias("ts"), *[F.col(n).alias(a) for n, a in zip(NAMED, "ohlcv", strict=True)])


def read_vendor_json(spark: SparkSession, path: str, vendor: str) -> DataFrame:
    return vendor_bars(spark.read.text(path, wholetext=True), vendor)


FILE_ROWS = 5_000_000


def write_partitioned(df: DataFrame, path: str, keys: list[str], file_rows: int = FILE_ROWS, mode: str = "overwrite") -> None:
    """Parquet by key, zstd: a key of up to file_rows rows is one file, a hot key as many as it needs.

    Rows are counted by key first. Keys beyond file_rows, of which there are no more than rows / file_rows, get
    salts; their table alone is joined to the rows. No file has more than file_rows rows.
    """
    hot = df.groupBy(*keys).agg(F.count("*").alias("rows_")).filter(F.col("rows_") > file_rows)
    hot = hot.select(F.struct(*keys).alias("key_"), F.ceil(F.col("rows_") / file_rows).alias("files_"))
    salted = df.withColumn("key_", F.struct(*keys)).join(F.broadcast(hot), "key_", "left").drop("key_")
    salt = F.coalesce(F.pmod(F.xxhash64(*df.columns), F.col("files_")), F.lit(0))
    dealt = salted.withColumn("files_", salt).repartition(*[F.col(k) for k in keys], "files_").drop("files_")
    options = {"compression": "zstd", "partitionOverwriteMode": "dynamic", "maxRecordsPerFile": str(file_rows)}
    dealt.write.mode(mode).options(**options).partitionBy(*keys).parquet(path)


def merge_idempotent(old: DataFrame, new: DataFrame, keys: list[str], newest: list[Column] | None = None) -> DataFrame:
    """Rows of both, one per key: those of new go first, then by the order given."""
    both = old.withColumn("age_", F.lit(1)).unionByName(new.withColumn("age_", F.lit(0)), allowMissingColumns=True)
    return both.withColumn("rank_", F.row_number().over(by(keys, "age_", *(newest or keys)))).filter("rank_ = 1").drop("age_", "rank_")


def pending_partitions(expected: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(done.select(*keys).distinct(), keys, "left_anti")


def write_csv_topk(df: DataFrame, path: str, order: list[Column], k: int) -> None:
    df.orderBy(*order).limit(k).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def manifest(df: DataFrame, date: str = "date", measure: str | None = None) -> DataFrame:
    """One row on a dataset: rows, tickers, days, range and coverage of a measure."""
    share = (F.count(measure) * 100.0 / F.count("*")) if measure else F.lit(100.0)
    return df.agg(F.count("*").alias("rows"), F.countDistinct("ticker").alias("tickers"), F.countDistinct(date).alias("days"), F.min(date).alias("first_day"), F.max(date).alias("last_day"), share.alias("coverage_pct"))
