"""Registered queries of the streaming jobs: each takes all that is there now, stops, and reads what it has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.plans import adapters as A
from tickloom.plans.market import query, rounded
from tickloom.plans.research import RICH, RICH_SQL
from tickloom.session import scratch_folder
from tickloom.streaming import jobs


def landed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """df as files of a landing folder, read as a stream."""
    folder = scratch_folder(spark, "landing")
    df.write.parquet(folder)
    return jobs.stream_ticks(spark, folder, df.schema)


def tick_stream(spark: SparkSession, d: str) -> DataFrame:
    return landed(spark, A.ticks(spark, d).select("ticker", "date", "seq", "t_raw", "p", "s", "cents", F.col("ts").cast("timestamp").alias("ts")))


def minute_stream(spark: SparkSession, d: str) -> DataFrame:
    return landed(spark, A.minutes(spark, d).select("ticker", "date", "t", "o", "c", "v", F.timestamp_micros("t").alias("ts")))


def result(spark: SparkSession, stream: DataFrame) -> DataFrame:
    out = scratch_folder(spark, "stream")
    jobs.run_once(stream, out, scratch_folder(spark, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


def stateful(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    with jobs.state_store(spark):
        return result(spark, make())


query("st1_stream_ticks", lambda s, d: result(s, tick_stream(s, d)).groupBy("ticker").agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"), F.sum("s").alias("s")), """
SELECT ticker, count(*) AS n, sum(seq)::BIGINT AS seqs, sum(s)::BIGINT AS s FROM ticks GROUP BY 1""")
query("st2_stream_minute_bars", lambda s, d: rounded(result(s, jobs.stream_minute_bars(tick_stream(s, d))).select("ticker", F.unix_micros("minute").alias("t"), "o", "h", "l", "c", "v", "n", "vw")), """
SELECT ticker, epoch_us(date_trunc('minute', ts)) AS t, round(arg_min(p, seq), 6) AS o, round(max(p), 6) AS h, round(min(p), 6) AS l, round(arg_max(p, seq), 6) AS c, sum(s)::BIGINT AS v, count(*) AS n, round(sum(p * s) / sum(s), 6) AS vw
FROM ticks WHERE date_trunc('minute', ts) + INTERVAL 6 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) FROM ticks) GROUP BY ticker, date_trunc('minute', ts)""")
twice = lambda s, d: landed(s, A.ticks(s, d).select("ticker", F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("ts"), "p").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))))
query("st3_stream_dedup", lambda s, d: result(s, jobs.stream_dedup(twice(s, d), ["ticker", "ts"])).select("ticker", F.unix_micros("ts").alias("t")), """
SELECT DISTINCT ticker, epoch_us(date_trunc('minute', ts)) AS t FROM ticks""")


def newest(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_folder(spark, "newest")
    jobs.merge_newest(tick_stream(spark, d), out, ["ticker", "date"], scratch_folder(spark, "checkpoint"), ["t_raw", "seq"]).awaitTermination()
    return jobs.newest_version(spark, out)


query("st3_merge_newest", lambda s, d: newest(s, d).select("ticker", "date", "seq", "p"), """
SELECT ticker, date, arg_max(seq, t_raw) AS seq, arg_max(p, t_raw) AS p FROM ticks GROUP BY 1, 2""")
query("st4_stream_triggers", lambda s, d: rounded(stateful(s, lambda: jobs.stream_triggers(minute_stream(s, d), dollars=5e3, high=1e4, zone="UTC")).select("ticker", "date", "t", "c", "cum_dollar", "pct_open"), 9), """
SELECT ticker, date, min(t) AS t, round(arg_min(c, t), 9) AS c, round(arg_min(cum, t), 9) AS cum_dollar, round(arg_min(move, t), 9) AS pct_open FROM (
  SELECT *, sum(v * c) OVER w AS cum, c / first(o) OVER w - 1 AS move FROM minutes WINDOW w AS (PARTITION BY ticker, date ORDER BY t))
WHERE abs(move) >= 0.15 AND cum >= 5e3 AND c BETWEEN 0.2 AND 1e4 GROUP BY 1, 2""")
query("st5_stream_dollar_bars", lambda s, d: rounded(stateful(s, lambda: jobs.stream_dollar_bars(tick_stream(s, d), A.TARGET, zone="UTC")).select("ticker", "date", "bar_no", "t_open", "t_close", "o", "h", "l", "c", "v", "n")), """,
closed AS (SELECT *, sum(dollar) OVER (PARTITION BY ticker, date, bar_no) >= {target} AS whole FROM bars)
SELECT ticker, date, bar_no, t_open, t_close, round(o, 6) AS o, round(h, 6) AS h, round(l, 6) AS l, round(c, 6) AS c, v, n FROM closed WHERE whole OR date < (SELECT max(date) FROM ticks)""".replace("{target}", str(A.TARGET)))
SPIKES = """,
mins AS (SELECT ticker, date_trunc('minute', ts) AS m, arg_min(p, seq) AS o, max(p) AS h, min(p) AS l FROM ticks GROUP BY 1, 2),
wide AS (SELECT ticker, m, o, h, l, start FROM (SELECT *, unnest(range(0, 120, {step})) AS k FROM mins),
  LATERAL (SELECT time_bucket(INTERVAL {step} MINUTE, m) - INTERVAL 1 MINUTE * k AS start)),
win AS (SELECT ticker, start, arg_min(o, m) AS o, max(h) AS h, min(l) AS l FROM wide GROUP BY 1, 2)
SELECT ticker, epoch_us(start) AS t, round((h - o) / nullif(o, 0), 9) AS spike_up, round((l - o) / nullif(o, 0), 9) AS spike_down FROM win
WHERE ((h - o) / nullif(o, 0) >= 0.2 OR (l - o) / nullif(o, 0) <= -0.3)
  AND start + INTERVAL 125 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) FROM ticks)"""
spikes = lambda s, d, step: rounded(stateful(s, lambda: jobs.stream_spike(tick_stream(s, d), step=step)).select("ticker", F.unix_micros("start").alias("t"), "spike_up", "spike_down"), 9)
query("st6_stream_spike", lambda s, d: spikes(s, d, 1), SPIKES.replace("{step}", "1"))
query("st6_stream_spike_half_hours", lambda s, d: spikes(s, d, 30), SPIKES.replace("{step}", "30"))


def updated(spark: SparkSession, d: str) -> DataFrame:
    days = A.daily_li(spark, d).select("ticker", F.col("date").alias("trading_day"), F.col("c").alias("close_d"), F.col("v").alias("vol_d"))
    out = scratch_folder(spark, "cache")
    jobs.eod_update(landed(spark, days), out, scratch_folder(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out)


query("st7_eod_update", lambda s, d: rounded(updated(s, d).select("ticker", "trading_day", "close_d", "pctchg_d", "rvol30")), """
SELECT ticker, trading_day, round(close_d, 6) AS close_d, round(pctchg_d, 6) AS pctchg_d, round(rvol30, 6) AS rvol30 FROM cache""")


def refreshed(spark: SparkSession, d: str, table: str) -> DataFrame:
    """The days in three deliveries, each brought into all tables at once."""
    days = A.cache_li(spark, d).select("ticker", "trading_day", "close_d", F.col("vol_d").cast("double").alias("vol_d"), "dollar_vol_d")
    inbox, out, checkpoint = (scratch_folder(spark, n) for n in ("landing", "eod", "checkpoint"))
    for years in ((0, 1994), (1995, 1996), (1997, 9999)):
        days.filter(F.year("trading_day").between(*years)).write.mode("append").parquet(inbox)
        jobs.eod_tables(jobs.stream_ticks(spark, inbox, days.schema), out, checkpoint, thresholds=RICH, buckets=4).awaitTermination()
    return jobs.read_eod(spark, out, table)


RICH_DAYS = RICH_SQL + "SELECT ticker, trading_day, round(close_d, 6) AS close_d, round(pctchg_d, 6) AS pctchg_d, round(rvol30, 6) AS rvol30, info_rich FROM rich"
days_of = lambda s, d, table: rounded(refreshed(s, d, table).select("ticker", "trading_day", "close_d", "pctchg_d", "rvol30", "info_rich"))
query("st7_eod_cache", lambda s, d: days_of(s, d, "cache"), RICH_DAYS)
query("st7_eod_watchlist", lambda s, d: days_of(s, d, "watchlist"), RICH_DAYS + " WHERE info_rich")
query("st7_eod_topn", lambda s, d: refreshed(s, d, "topn"), RICH_SQL + """
SELECT ticker, sum(coalesce(info_rich, false)::INT)::BIGINT AS days_rich, max(trading_day) AS last_seen
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trading_day DESC) AS k FROM rich) WHERE k <= 252 GROUP BY 1""")
