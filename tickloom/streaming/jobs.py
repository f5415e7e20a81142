"""Structured Streaming jobs: incremental versions of the batch operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickloom.functions.expressions import by, ratio
from tickloom.operators.bars import OPEN, extend_bars
from tickloom.operators.sliding import sliding_extreme
from tickloom.streaming.versions import BUCKET, VersionedTables

TICKS = "ticker string, date date, seq long, t_raw long, p double, s long, ts timestamp"


def stream_ticks(spark: SparkSession, path: str, schema: str = TICKS, files_per_trigger: int = 1000) -> DataFrame:
    """New files of a folder, each once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_once(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Handle what is there now, exactly once, and stop."""
    df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start().awaitTermination()


def stream_minute_bars(ticks: DataFrame, late: str = "5 minutes") -> DataFrame:
    """OHLCV and VWAP of each minute, once its time is past the watermark."""
    at = F.struct("t_raw", "seq")
    bars = ticks.withWatermark("ts", late).groupBy("ticker", F.window("ts", "1 minute").alias("w")).agg(
        F.min_by("p", at).alias("o"), F.max("p").alias("h"), F.min("p").alias("l"), F.max_by("p", at).alias("c"), F.sum("s").alias("v"), F.count("*").alias("n"), F.sum(F.col("p") * F.col("s")).alias("dollar")
    )
    return bars.select("ticker", F.col("w.start").alias("minute"), "o", "h", "l", "c", "v", "n", "dollar", ratio(F.col("dollar"), F.col("v")).alias("vw"))


def stream_dedup(rows: DataFrame, keys: list[str], ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """The first row of each key; state is kept for the watermark's time only."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def merge_newest(rows: DataFrame, path: str, keys: list[str], checkpoint: str, order: list[str], buckets: int = 32) -> StreamingQuery:
    """The last row of each key in the given order: every batch is merged into the table at path.

    Rows lie in buckets by a hash of the keys. A batch reads and rewrites the buckets of its own keys only,
    and its commit makes them seen together; a batch that comes again after its commit changes nothing.
    """

    def merge(batch: DataFrame, number: int) -> None:
        tables = VersionedTables(batch.sparkSession, path, buckets)
        if number in tables.numbers():
            return
        batch.persist()
        touched = [r[0] for r in batch.select(tables.bucket_of(keys)).distinct().collect()]  # as many as there are buckets, at most
        if touched:
            both = batch.unionByName(tables.read("rows", batch.schema, touched, below=number))
            merged = both.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), F.struct(*order)).alias("r")).select("r.*").select(*batch.columns)
            tables.commit(number, replaced={"rows": tables.write("rows", number, merged, keys)})
        batch.unpersist()

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest_version(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """The rows that merge_newest has committed, before a batch number if given; None without any."""
    tables = VersionedTables(spark, path)
    last = tables.newest(below)
    if last is None:
        return None
    bucket, versions = next(iter(last["tables"]["rows"].items()))
    schema = spark.read.parquet(f"{path}/rows/v={versions[0]}/{BUCKET}={bucket}").schema
    return tables.read("rows", schema, below=below)


@contextmanager
def state_store(spark: SparkSession):
    """The custom stateful jobs keep their state in RocksDB; the session's own choice comes back afterwards."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class FirstTrigger(StatefulProcessor):
    """Per ticker-day: open and running dollars; emits the first bar that meets the test."""

    def __init__(self, change: float, dollars: float, low: float, high: float, zone: str):
        self.test, self.zone = (change, dollars, low, high), zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "open double, dollars double, done boolean")
        self.handle = handle

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        opened, before, done = self.state.get() if self.state.exists() else (None, 0.0, False)
        change, least, low, high = self.test
        part = pd.concat(list(rows)).sort_values("t", kind="stable")
        opened = float(part["o"].iloc[0]) if opened is None else opened
        c = part["c"].to_numpy(float)
        dollars = before + np.cumsum(part["v"].to_numpy(float) * c)
        moved = c / opened - 1 if opened else np.zeros(len(c))
        hits = np.flatnonzero((np.abs(moved) >= change) & (dollars >= least) & (low <= c) & (c <= high) & bool(opened))
        if len(hits) and not done:
            i, done = hits[0], True
            yield pd.DataFrame({"ticker": [key[0]], "date": [key[1]], "t": [int(part["t"].iloc[i])], "c": [c[i]], "cum_dollar": [dollars[i]], "pct_open": [moved[i]]})
        self.state.update((opened, float(dollars[-1]), done))
        self.handle.registerTimer(day_end(key[1], self.zone))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()  # the day is over and its late rows are dropped
        return iter([])

    def close(self) -> None:
        pass


EXCHANGE = "America/New_York"


def day_end(day, zone: str) -> int:
    """Milliseconds of the midnight after a day, on the clock of the zone that the days are of."""
    after = dt.date(day.year, day.month, day.day) + dt.timedelta(days=1)
    return int(dt.datetime(after.year, after.month, after.day, tzinfo=ZoneInfo(zone)).timestamp() * 1000)


TRIGGERS = "ticker string, date date, t long, c double, cum_dollar double, pct_open double"


def stream_triggers(minutes: DataFrame, change: float = 0.15, dollars: float = 5e6, low: float = 0.2, high: float = 20.0, ts: str = "ts", late: str = "5 minutes", zone: str = EXCHANGE) -> DataFrame:
    """The first trigger of each ticker-day; rows later than the watermark are dropped, the others go in order of t within a batch.

    A day is over at midnight in zone, the one by which the rows' dates were made.
    """
    rows = minutes.withWatermark(ts, late).groupBy("ticker", "date")
    return rows.transformWithStateInPandas(FirstTrigger(change, dollars, low, high, zone), TRIGGERS, "append", "eventtime")


class DollarBars(StatefulProcessor):
    """Per ticker-day the open bar; a bar goes out with the tick that closes it, the tail when the day is over."""

    def __init__(self, target: float, zone: str):
        self.target, self.zone = target, zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        kinds = dict(zip(OPEN, ("long", "long", "long", "double", "double", "double", "double", "long", "long", "double", "double", "double", "double"), strict=True))
        self.state = handle.getValueState("bar", ", ".join(f"{n} {k}" for n, k in kinds.items()))
        self.handle = handle

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(rows)).sort_values(["t_raw", "seq"], kind="stable")
        size = part["s"].to_numpy(np.int64)
        money = part["p"].to_numpy(float) * size
        sums, limit = (part["cents"].to_numpy(np.int64) * size, self.target * 100) if "cents" in part else (money, self.target)
        closed, carry = extend_bars(self.state.get() if self.state.exists() else None, part, sums.astype(float), limit, money)
        self.state.update(carry)
        self.handle.registerTimer(day_end(key[1], self.zone))
        if len(closed):
            yield self.rows(key, closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        carry = self.state.get() if self.state.exists() else None
        self.state.clear()
        if carry and carry[8]:
            yield self.rows(key, pd.DataFrame([tuple(carry)], columns=list(OPEN)))

    def rows(self, key, bars: pd.DataFrame) -> pd.DataFrame:
        return bars.assign(ticker=key[0], date=key[1])[["ticker", "date", "bar_no", "t_open", "t_close", "o", "h", "l", "c", "v", "n", "dollar"]]

    def close(self) -> None:
        pass


BARS = "ticker string, date date, bar_no long, t_open long, t_close long, o double, h double, l double, c double, v long, n long, dollar double"


def stream_dollar_bars(ticks: DataFrame, target: float = 300_000, ts: str = "ts", late: str = "5 minutes", zone: str = EXCHANGE) -> DataFrame:
    """Closed bars as they close, and each day's last one once the watermark has passed its end in zone.

    Ticks later than the watermark are dropped; the others of a batch are taken in order of their time. With a column
    cents (whole prices) sums are exact, so that a bar closes where it reaches the target exactly.
    """
    return ticks.withWatermark(ts, late).groupBy("ticker", "date").transformWithStateInPandas(DollarBars(target, zone), BARS, "append", "eventtime")


class Spikes(StatefulProcessor):
    """Per ticker one pane a minute; a window goes out once the watermark has passed its end.

    One timer stands for the next window to end. When it fires, all windows that have ended are swept
    through the panes, and panes that no later window holds are let go.
    """

    PANE = ("minute", "t", "seq", "o", "h", "l")

    def __init__(self, length: int, step: int, up: float, down: float):
        self.length, self.step, self.up, self.down = length, step, up, down

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.panes = handle.getListState("panes", "minute long, t long, seq long, o double, h double, l double")
        self.done = handle.getValueState("done", "end long")
        self.handle = handle

    def load(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.panes.get()) if self.panes.exists() else [], columns=list(self.PANE))

    def wait(self, panes: pd.DataFrame, done: int) -> None:
        """Let the timer stand at the end of the first window after `done` that holds a pane."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(panes):
            first = max(done + 1, int(panes["minute"].iloc[0]) + 1)
            self.handle.registerTimer(-(-first // self.step) * self.step * 60_000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        panes = self.load()
        for part in rows:  # a delivery's rows come in pieces, and only their panes are kept
            minute = part["ts"].astype("datetime64[us]").astype("int64") // 60_000_000
            new = pd.DataFrame({"minute": minute, "t": part["t_raw"], "seq": part["seq"], "o": part["p"], "h": part["p"], "l": part["p"]})
            both = (pd.concat([panes, new]) if len(panes) else new).sort_values(["minute", "t", "seq"], kind="stable").groupby("minute", as_index=False)
            panes = both.agg({"t": "first", "seq": "first", "o": "first", "h": "max", "l": "min"})
        self.panes.put([tuple(x) for x in panes[list(self.PANE)].astype(object).to_numpy().tolist()])
        self.wait(panes, self.done.get()[0] if self.done.exists() else -1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        panes, now = self.load(), timerValues.getCurrentWatermarkInMs() // 60_000 // self.step * self.step
        done = self.done.get()[0] if self.done.exists() else -1
        minute = panes["minute"].to_numpy(np.int64)
        out = self.swept(key[0], panes, minute, max(done + 1, int(minute[0]) + 1), int(now))
        panes = panes[minute >= now + 1 - self.length]
        self.done.update((int(now),))
        if len(panes):
            self.panes.put([tuple(x) for x in panes.astype(object).to_numpy().tolist()])
        else:
            self.panes.clear()
        self.wait(panes, int(now))
        if len(out):
            yield out

    def swept(self, ticker: str, panes: pd.DataFrame, minute: np.ndarray, first: int, last: int) -> pd.DataFrame:
        """Windows that end from first to last, of those that hold a pane."""
        ends = np.arange(-(-first // self.step) * self.step, last + 1, self.step)
        low, high = np.searchsorted(minute, ends - self.length), np.searchsorted(minute, ends)
        ends, low, high = (x[low < high] for x in (ends, low, high))
        o = panes["o"].to_numpy(float)[low]
        top, bottom = (sliding_extreme(panes[c].to_numpy(float), low, high, c == "h") for c in "hl")
        with np.errstate(divide="ignore", invalid="ignore"):
            rise, fall = np.where(o == 0, np.nan, (top - o) / o), np.where(o == 0, np.nan, (bottom - o) / o)
        hit = (rise >= self.up) | (fall <= self.down)
        start = pd.to_datetime((ends[hit] - self.length) * 60_000_000, unit="us")
        return pd.DataFrame({"ticker": ticker, "start": start, "spike_up": rise[hit], "spike_down": fall[hit]})

    def close(self) -> None:
        pass


def stream_spike(ticks: DataFrame, late: str = "5 minutes", up: float = 0.2, down: float = -0.3, length: int = 120, step: int = 1) -> DataFrame:
    """Sliding windows (length and step in minutes, starts at multiples of the step) whose high or low is far from their first price.

    State is a pane a minute and ticker, not a copy of each tick a window; ticks later than the watermark are dropped.
    """
    rows = ticks.withWatermark("ts", late).groupBy("ticker")
    return rows.transformWithStateInPandas(Spikes(length, step, up, down), "ticker string, start timestamp, spike_up double, spike_down double", "append", "eventtime")


def eod_update(days: DataFrame, cache_path: str, checkpoint: str, rows: int = 30) -> StreamingQuery:
    """Append each batch of new days (ticker, trading_day, close_d, vol_d) to the cache with its features,
    reading only the trailing rows of the tickers in the batch."""
    from tickloom.operators.windows import cache_features, last_n

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # the number in the path makes a repeated batch overwrite itself
        old = spark.read.schema(f"{_ddl(batch)}, pctchg_d double, return_d double, rvol30 double, batch long").parquet(cache_path).filter(F.col("batch") < number) if number else None
        both = batch
        if old is not None:
            tail = last_n(old.join(batch.select("ticker").distinct(), "ticker", "left_semi"), rows, "trading_day")
            both = batch.unionByName(tail.select(*batch.columns))
        fresh = cache_features(both, rows).join(batch.select("ticker", "trading_day"), ["ticker", "trading_day"], "left_semi")
        fresh.write.mode("overwrite").parquet(f"{cache_path}/batch={number}")

    return days.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


EOD = ("cache", "watchlist", "topn")
WINDOW = 252


def eod_tables(days: DataFrame, path: str, checkpoint: str, rows: int = 30, k: int = 1000, thresholds: dict | None = None, buckets: int = 32) -> StreamingQuery:
    """Bring the daily cache, the watchlist and the ranking up to date with each batch of new days, in one commit.

    days: ticker, trading_day, close_d, vol_d, dollar_vol_d. The cache grows by the batch's days with their
    features and tests, the watchlist by those that are information-rich; both are appended. Per ticker the
    last 252 rows are held (tails) and a count of the rich ones among them: a batch adds its own and takes off
    those that leave, and rewrites the buckets of its own tickers only. The ranking is made of the counts.
    A day that is not after its ticker's last one is left out; of equal days the first by the other columns
    counts. A batch that comes again after its commit changes nothing.
    """
    from tickloom.operators.universe import info_rich
    from tickloom.operators.windows import cache_features

    def refresh(batch: DataFrame, number: int) -> None:
        tables = VersionedTables(batch.sparkSession, path, buckets)
        if number in tables.numbers():
            return
        given = ["ticker", "trading_day", "close_d", "vol_d", "dollar_vol_d"]
        batch = batch.select(*given).persist()
        touched = [r[0] for r in batch.select(tables.bucket_of(["ticker"])).distinct().collect()]
        tail_kind = T.StructType([*batch.schema.fields, T.StructField("rich", T.IntegerType())])
        count_kind = T.StructType([batch.schema["ticker"], T.StructField("days_rich", T.LongType()), batch.schema["trading_day"]])
        tails, counts = tables.read("tails", tail_kind, touched, below=number), tables.read("counts", count_kind, touched, below=number)
        known = counts.withColumnRenamed("trading_day", "last_day")
        fresh = batch.join(known.select("ticker", "last_day"), "ticker", "left").filter(F.col("last_day").isNull() | (F.col("trading_day") > F.col("last_day")))
        fresh = fresh.groupBy("ticker", "trading_day").agg(F.min(F.struct(*given[2:])).alias("r")).select("ticker", "trading_day", "r.*")
        both = fresh.withColumn("rich", F.lit(None).cast("int")).unionByName(tails.join(batch.select("ticker").distinct(), "ticker", "left_semi")).withColumn("new", F.col("rich").isNull())
        made = info_rich(cache_features(both, rows), thresholds).withColumn("rich", F.coalesce("rich", F.col("info_rich").cast("int"), F.lit(0)))
        made = made.withColumn("place", F.row_number().over(by("ticker", F.desc("trading_day")))).persist()
        cache = made.filter("new").drop("new", "rich", "place")
        # what a batch adds, less what leaves the window: rows that were in it, and new ones that are past it already
        stays, was = F.col("place") <= WINDOW, ~F.col("new")
        change = made.groupBy("ticker").agg(F.sum(F.when(stays & ~was, F.col("rich")).when(~stays & was, -F.col("rich")).otherwise(0)).alias("change"), F.max("trading_day").alias("last_seen"))
        new_counts = known.join(change, "ticker", "full").select("ticker", (F.coalesce("days_rich", F.lit(0)) + F.coalesce("change", F.lit(0))).cast("long").alias("days_rich"), F.coalesce("last_seen", "last_day").alias("trading_day"))
        kept_tails = tails.join(batch.select("ticker").distinct(), "ticker", "left_anti").unionByName(made.filter(stays).select(*given, "rich"))
        added = {"cache": tables.write("cache", number, cache, ["ticker"]), "watchlist": tables.write("watchlist", number, cache.filter("info_rich"), ["ticker"])}
        replaced = {"tails": tables.write("tails", number, kept_tails, ["ticker"]), "counts": tables.write("counts", number, new_counts, ["ticker"])}
        others = sorted(set(range(tables.buckets)) - set(touched))
        every = tables.read("counts", count_kind, others, below=number).unionByName(tables.files(count_kind, f"{path}/counts/v={number}") if replaced["counts"] else new_counts)
        ranking = every.withColumnRenamed("trading_day", "last_seen").orderBy(F.desc("days_rich"), F.desc("last_seen"), "ticker").limit(k)
        whole = {"topn": tables.write("topn", number, ranking, ["ticker"])}
        tables.commit(number, replaced=replaced, added=added, whole=whole)
        made.unpersist()
        batch.unpersist()

    return days.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_eod(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One of the tables that eod_tables keeps (cache, watchlist, topn), as of its last commit."""
    flags = "r_rvol boolean, r_chg boolean, r_dvol boolean, r_px boolean, info_rich boolean"
    days = f"ticker string, trading_day date, close_d double, vol_d double, dollar_vol_d double, pctchg_d double, return_d double, rvol30 double, {flags}"
    kinds = {"cache": days, "watchlist": days, "topn": "ticker string, days_rich long, last_seen date"}
    return VersionedTables(spark, path).read(table, T._parse_datatype_string(kinds[table]))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{n} {t}" for n, t in df.dtypes)
