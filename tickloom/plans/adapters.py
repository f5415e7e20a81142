"""The driver's tables as ticks, minutes, days, dimensions and filings: DataFrames, and the same as DuckDB CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators.daily import ohlcv, ticks_to_minute
from tickloom.operators.windows import cache_features
from tickloom.operators.scd import scd2_from_snapshots


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def ticks(spark: SparkSession, d: str, tickers: int = 20) -> DataFrame:
    """events as trades; prices are whole cents, so their sums are exact."""
    e = table(spark, d, "events")
    return e.select(
        F.concat(F.lit("T"), (F.col("user_id") % tickers).cast("string")).alias("ticker"), F.to_date("ts").alias("date"), F.col("event_id").alias("seq"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("t_raw"), F.lit("us").alias("t_unit"), F.col("value").alias("p"), (1 + F.col("event_id") % 97).alias("s"),
        F.round(F.col("value") * 100).cast("long").alias("cents"), "ts",
    )


def daily(spark: SparkSession, d: str) -> DataFrame:
    return ohlcv(ticks(spark, d), ["ticker", "date"], "t_raw", "p", "s")


def hourly(spark: SparkSession, d: str) -> DataFrame:
    """Long runs: hours as the days of 10 tickers (date is a timestamp)."""
    return ohlcv(ticks(spark, d, 10).withColumn("date", F.date_trunc("hour", "ts")), ["ticker", "date"], "t_raw", "p", "s")


def minutes(spark: SparkSession, d: str) -> DataFrame:
    """Hours as minutes, with vw, n and t."""
    return ticks_to_minute(ticks(spark, d), "hour")


def daily_li(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(
        F.concat(F.lit("S"), (F.col("l_suppkey") % 10).cast("string")).alias("ticker"), F.to_date("l_shipdate").alias("date"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"),
        F.col("l_quantity").alias("s"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice").alias("at"),
    )
    return ohlcv(li, ["ticker", "date"], "at", "p", "s")


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    caps = o.groupBy(F.concat(F.lit("S"), (F.col("o_custkey") % 10).cast("string")).alias("ticker"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("as_of")).agg(
        F.floor(F.max("o_totalprice") / 100_000).cast("double").alias("cap"), F.count("*").alias("k")
    )
    return caps.select("ticker", "as_of", F.when(F.col("k") % 7 != 0, F.col("cap")).alias("market_cap"), (F.col("k") % 5).cast("double").alias("shares_outstanding"))


def customer_caps(spark: SparkSession, d: str, year: int) -> DataFrame:
    """Caps and share counts of the customers with orders in a year."""
    o = table(spark, d, "orders").filter(F.year("o_orderdate") == year)
    return o.groupBy(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker")).agg(F.floor(F.max("o_totalprice") / 100_000).cast("double").alias("market_cap"), F.count("*").cast("double").alias("shares_outstanding"))


def cap_dim(spark: SparkSession, d: str) -> DataFrame:
    return scd2_from_snapshots(snapshots(spark, d))


def cache_li(spark: SparkSession, d: str) -> DataFrame:
    """daily_li as a daily cache."""
    days = daily_li(spark, d).select(
        "ticker", F.col("date").alias("trading_day"), F.col("c").alias("close_d"), F.col("v").alias("vol_d"), F.col("dollar").alias("dollar_vol_d"), F.col("n").alias("session_rows")
    )
    return cache_features(days)


def universe(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"), F.when(F.col("c_mktsegment") == "BUILDING", "CS").otherwise(F.col("c_mktsegment")).alias("type"),
        F.when(F.col("c_nationkey") % 2 == 0, "XNAS").otherwise("XASE").alias("primary_exchange"), (F.col("c_acctbal") > 0).alias("active"), F.col("c_name").alias("name"),
    )


def details(spark: SparkSession, d: str) -> DataFrame:
    """Details of the customers in debt or with more than 1,000; the others have none."""
    c = table(spark, d, "customer").filter("c_acctbal < 0 or c_acctbal > 1000")
    return c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal") * 1000).alias("market_cap"), F.col("c_custkey").cast("string").alias("cik"))


def form_of(doc_id):
    return F.element_at(F.array(*map(F.lit, ("S-3", "424B5", "8-K", "424B3", "424B"))), (doc_id % 5 + 1).cast("int"))


def filing_day(doc_id):
    return F.date_add(F.lit("1995-01-01").cast("date"), (doc_id % 2500).cast("int"))


FORM_SQL = "['S-3', '424B5', '8-K', '424B3', '424B'][doc_id % 5 + 1]"
FILING_DAY_SQL = "(DATE '1995-01-01' + (doc_id % 2500)::INT)"


def filings(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select(F.concat(F.lit("S"), (F.col("doc_id") % 10).cast("string")).alias("ticker"), form_of(F.col("doc_id")).alias("form"), filing_day(F.col("doc_id")).alias("filing_date"))


CTE = """WITH RECURSIVE ticks AS (SELECT 'T' || (user_id % 20) AS ticker, ts::DATE AS date, event_id AS seq, epoch_us(ts) AS t_raw, value AS p, 1 + event_id % 97 AS s, round(value * 100)::BIGINT AS cents, ts FROM events),
daily AS (SELECT ticker, date, arg_min(p, t_raw) AS o, max(p) AS h, min(p) AS l, arg_max(p, t_raw) AS c, sum(s)::BIGINT AS v, count(*) AS n, sum(p * s) AS dollar FROM ticks GROUP BY ALL),
hourly AS (SELECT 'T' || (user_id % 10) AS ticker, date_trunc('hour', ts)::TIMESTAMP AS date, arg_min(value, ts) AS o, max(value) AS h, min(value) AS l, arg_max(value, ts) AS c, sum(1 + event_id % 97)::BIGINT AS v, count(*) AS n FROM events GROUP BY 1, 2),
minutes AS (SELECT ticker, date, date_trunc('hour', ts)::TIMESTAMP AS minute, epoch_us(date_trunc('hour', ts)) AS t, arg_min(p, seq) AS o, max(p) AS h, min(p) AS l, arg_max(p, seq) AS c, sum(s)::BIGINT AS v, count(*) AS n, sum(p * s) AS dollar, sum(p * s) / sum(s) AS vw FROM ticks GROUP BY 1, 2, 3, 4),
li AS (SELECT 'S' || (l_suppkey % 10) AS ticker, l_shipdate::DATE AS date, l_extendedprice / l_quantity AS p, l_quantity AS s, l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_quantity AS k4, l_extendedprice AS k5 FROM lineitem),
daily_li AS (SELECT ticker, date, first(p ORDER BY k1, k2, k3, k4, k5) AS o, max(p) AS h, min(p) AS l, last(p ORDER BY k1, k2, k3, k4, k5) AS c, sum(s) AS v, count(*) AS n, sum(p * s) AS dollar FROM li GROUP BY ALL),
snapshots AS (SELECT ticker, as_of, CASE WHEN k % 7 <> 0 THEN cap END AS market_cap, (k % 5)::DOUBLE AS shares_outstanding FROM (SELECT 'S' || (o_custkey % 10) AS ticker, date_trunc('month', o_orderdate)::DATE AS as_of, floor(max(o_totalprice) / 100000) AS cap, count(*) AS k FROM orders GROUP BY 1, 2)),
marked AS (SELECT *, row_number() OVER w = 1 OR market_cap IS DISTINCT FROM lag(market_cap) OVER w OR shares_outstanding IS DISTINCT FROM lag(shares_outstanding) OVER w AS fresh FROM snapshots WINDOW w AS (PARTITION BY ticker ORDER BY as_of)),
cap_dim AS (SELECT ticker, as_of AS effective_from, coalesce(lead(as_of) OVER (PARTITION BY ticker ORDER BY as_of), DATE '2099-12-31') AS effective_to, market_cap, shares_outstanding FROM marked WHERE fresh),
cache AS (SELECT ticker, date AS trading_day, c AS close_d, v AS vol_d, dollar AS dollar_vol_d, n AS session_rows, (c - lag(c) OVER w) / nullif(lag(c) OVER w, 0) AS pctchg_d, ln(c / nullif(lag(c) OVER w, 0)) AS return_d, v / nullif(avg(v) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 0) AS rvol30 FROM daily_li WINDOW w AS (PARTITION BY ticker ORDER BY date)),
universe AS (SELECT 'C' || c_custkey AS ticker, CASE WHEN c_mktsegment = 'BUILDING' THEN 'CS' ELSE c_mktsegment END AS type, CASE WHEN c_nationkey % 2 = 0 THEN 'XNAS' ELSE 'XASE' END AS primary_exchange, c_acctbal > 0 AS active, c_name AS name FROM customer),
details AS (SELECT 'C' || c_custkey AS ticker, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal * 1000 END AS market_cap, c_custkey::VARCHAR AS cik FROM customer WHERE c_acctbal < 0 OR c_acctbal > 1000),
filings AS (SELECT 'S' || (doc_id % 10) AS ticker, {form} AS form, {filing_day} AS filing_date FROM documents),
runs AS (SELECT *, row_number() OVER w AS r, lag(c) OVER w AS prev_c FROM {days} WINDOW w AS (PARTITION BY ticker ORDER BY date)),
stops AS (SELECT *, r - coalesce(max(CASE WHEN NOT c > o THEN r END) OVER u, 0) AS green_run, r - coalesce(max(CASE WHEN NOT c < o THEN r END) OVER u, 0) AS red_run,
  v / nullif(CASE WHEN count(*) OVER f = 20 THEN avg(v) OVER f END, 0) AS rvol FROM runs WINDOW u AS (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY ticker ORDER BY date ROWS 19 PRECEDING)),
feats AS (SELECT *, coalesce(lag(green_run) OVER w, 0) AS prev_green, coalesce(lag(red_run) OVER w, 0) AS prev_red FROM stops WINDOW w AS (PARTITION BY ticker ORDER BY date)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY t_raw, seq) AS r FROM ticks),
folded AS (SELECT ticker, date, r, cents * s AS acc, 0::BIGINT AS bar_no FROM ranked WHERE r = 1 UNION ALL
  SELECT k.ticker, k.date, k.r, CASE WHEN f.acc >= {target} * 100 THEN 0 ELSE f.acc END + k.cents * k.s, f.bar_no + CASE WHEN f.acc >= {target} * 100 THEN 1 ELSE 0 END FROM folded f JOIN ranked k ON k.ticker = f.ticker AND k.date = f.date AND k.r = f.r + 1),
signed AS (SELECT *, coalesce(sign(p - lag(p) OVER (PARTITION BY ticker, date ORDER BY t_raw, seq)), 0)::INT AS sign FROM ranked),
bars AS (SELECT ticker, date, bar_no, min(t_raw) AS t_open, max(t_raw) AS t_close, arg_min(p, r) AS o, max(p) AS h, min(p) AS l, arg_max(p, r) AS c, sum(s)::BIGINT AS v, count(*) AS n, sum(cents * s) / 100 AS dollar, avg(sign) AS imbalance_score FROM signed JOIN folded USING (ticker, date, r) GROUP BY ALL),
vols AS (SELECT *, avg(a) OVER (PARTITION BY ticker, date ORDER BY bar_no ROWS 49 PRECEDING) AS vol FROM (SELECT *, coalesce(abs(ln(c / lag(c) OVER (PARTITION BY ticker, date ORDER BY bar_no))), 0) AS a FROM bars)),
hits AS (SELECT a.ticker, a.date, a.bar_no, min(CASE WHEN b.h >= a.c * (1 + 3 * greatest(1e-8, a.vol)) THEN b.bar_no END) AS up, min(CASE WHEN b.l <= a.c * (1 - 2 * greatest(1e-8, a.vol)) THEN b.bar_no END) AS down, max(b.bar_no) AS last FROM vols a LEFT JOIN vols b ON a.ticker = b.ticker AND a.date = b.date AND b.bar_no > a.bar_no AND b.bar_no <= a.bar_no + 120 GROUP BY ALL),
ends AS (SELECT *, coalesce(up <= down OR (up IS NOT NULL AND down IS NULL), false) AS pt_hit, coalesce(down < up OR (down IS NOT NULL AND up IS NULL), false) AS sl_hit, coalesce(least(up, down), last, bar_no) AS end_bar FROM hits),
labels_ AS (SELECT e.ticker, e.date, e.bar_no, a.t_close AS anchor_ts, e.end_bar, b.t_close AS t1, e.pt_hit, e.sl_hit, CASE WHEN e.pt_hit THEN 1 WHEN e.sl_hit THEN -1 ELSE 0 END AS label, b.c / a.c - 1 AS ret_at_outcome, greatest(1e-8, a.vol) AS vol_at_anchor FROM ends e JOIN vols a USING (ticker, date, bar_no) JOIN vols b ON b.ticker = e.ticker AND b.date = e.date AND b.bar_no = e.end_bar),
open_ AS (SELECT a.*, greatest(1, count(b.bar_no)) AS concurrency FROM labels_ a LEFT JOIN labels_ b ON a.ticker = b.ticker AND a.date = b.date AND b.bar_no <= a.bar_no AND a.bar_no <= b.end_bar GROUP BY ALL),
weights_ AS (SELECT ticker, date, bar_no, anchor_ts, concurrency, abs(ret_at_outcome) / concurrency / greatest(1e-12, sum(abs(ret_at_outcome) / concurrency) OVER (PARTITION BY ticker, date)) AS weight FROM open_)
"""
TARGET = 8000


#: The label chain on exponential volatility: its last value carries on within a day.
EMA_VOLS = """moves AS (SELECT *, coalesce(abs(ln(c / lag(c) OVER (PARTITION BY ticker, date ORDER BY bar_no))), 0) AS a FROM bars),
carried AS (SELECT ticker, date, bar_no, a AS x FROM moves WHERE bar_no = 0 UNION ALL SELECT m.ticker, m.date, m.bar_no, 2.0 / 51 * m.a + 49.0 / 51 * e.x FROM carried e JOIN moves m ON m.ticker = e.ticker AND m.date = e.date AND m.bar_no = e.bar_no + 1),
vols AS (SELECT m.*, x AS vol FROM moves m JOIN carried USING (ticker, date, bar_no)),
"""


def ema_sql(body: str) -> str:
    """The same with the labels' volatility exponential, as the operators have it by default."""
    start, end = CTE.index("vols AS ("), CTE.index("hits AS (")
    return sql(body).replace(CTE[start:end], EMA_VOLS)


def sql(body: str, days: str = "daily") -> str:
    """A DuckDB query over the adapters; only what it names is computed."""
    return CTE.replace("{days}", days).replace("{target}", str(TARGET)).replace("{form}", FORM_SQL).replace("{filing_day}", FILING_DAY_SQL) + body
