"""Registered queries of all detectors together, their reports, and the label chain on its default volatility."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import detectors as E, fusion as V, labels as L, reports as R, universe as U
from tickloom.plans import adapters as A
from tickloom.plans.market import FEATS, FUNCTIONS, NAMES, SQL, WATCH, bars_of, found, long_, query, rounded, watch
from tickloom.session import materialise

# ---- all detectors in one pass --------------------------------------------------------------------
EVERY = tuple(E.EVENTS)
LOOSE = {"rvol_threshold": 2.0, "volume_bounce_rvol": 1.5, "parabolic": 0.8}
TESTS = {
    "E1": "rvol >= 2", "E2": "(o - prev_c) / nullif(prev_c, 0) >= 0.1", "E3": "o > 0 AND (h - o) / nullif(o, 0) >= 0.2", "E6": "green_run >= 3", "E8": "(o - prev_c) / nullif(prev_c, 0) <= -0.15",
    "E9": "o > 0 AND (l - o) / nullif(o, 0) <= -0.3", "E10": "c > o AND prev_red >= 3", "E11": "rvol >= 1.5 AND c > o AND prev_red >= 2",
}
EVERY_SQL = " UNION ALL ".join(f"SELECT ticker, date, '{E.EVENTS[e]}' AS event_type, NULL::BIGINT AS days FROM feats WHERE {w}" for e, w in TESTS.items()) + """
UNION ALL SELECT ticker, date_end, 'E4_Parabolic', days FROM (
  SELECT ticker, unnest([1, 2, 3, 4, 5])::BIGINT AS days, unnest([lead(date, 1) OVER w, lead(date, 2) OVER w, lead(date, 3) OVER w, lead(date, 4) OVER w, lead(date, 5) OVER w]) AS date_end,
    unnest([lead(c, 1) OVER w / nullif(o, 0) - 1, lead(c, 2) OVER w / nullif(o, 0) - 1, lead(c, 3) OVER w / nullif(o, 0) - 1, lead(c, 4) OVER w / nullif(o, 0) - 1, lead(c, 5) OVER w / nullif(o, 0) - 1]) AS rise
  FROM daily_li WINDOW w AS (PARTITION BY ticker ORDER BY date)) WHERE rise >= 0.8
UNION ALL SELECT ticker, date, 'E5_BreakoutATH', NULL FROM (
  SELECT ticker, date, c, CASE WHEN count(*) OVER f = 252 THEN max(c) OVER f END AS m FROM daily_li WINDOW f AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)) WHERE c >= m
UNION ALL SELECT f.ticker, f.date, 'E7_FirstRedDay', NULL FROM feats f JOIN feats g ON g.ticker = f.ticker AND g.r BETWEEN f.r - f.prev_green AND f.r - 1
  WHERE f.c < f.o AND f.prev_green >= 3 GROUP BY f.ticker, f.date HAVING (max(g.h) - arg_min(g.o, g.r)) / arg_min(g.o, g.r) >= 0.5"""
query("ev1_detect_every", lambda s, d: long_(E.detect_all(A.daily_li(s, d), EVERY, "end", **LOOSE).select("ticker", "date", "event_type", "days"), "days"), EVERY_SQL, "daily_li")

# ---- reports on events ----------------------------------------------------------------------------
query("ev7_combinations", lambda s, d: V.combinations(watch(s, d)), WATCH + """
SELECT list_aggregate(events, 'string_agg', ',') AS combination, count(*) AS days FROM watch WHERE len(events) > 1 GROUP BY 1 ORDER BY days DESC, combination LIMIT 10""")
suggested = lambda s, d: found(s, d).groupBy("event_type").agg(F.count("*").alias("n")).filter("n % 3 <> 0").select("event_type", (-(F.col("n") % 4)).alias("first_day"), (F.col("n") % 3).alias("last_day"))
query("ev8_signal_windows", lambda s, d: V.export_signals(watch(s, d), bars_of(s, d), suggested(s, d)), WATCH + """,
w AS (SELECT event_type, count(*) AS n FROM ev GROUP BY 1),
f AS (SELECT ticker, date, event_type, min(t_open) AS t_open, arg_min(c, bar_no) AS close FROM (SELECT DISTINCT * FROM ev) JOIN bars USING (ticker, date) GROUP BY 1, 2, 3)
SELECT ticker, date, f.event_type, t_open, close, CASE WHEN n % 3 <> 0 THEN '[' || CASE WHEN n % 4 = 0 THEN '+0' ELSE '-' || (n % 4) END || ',+' || (n % 3) || ']' ELSE 'N/A' END AS window_suggested FROM f JOIN w USING (event_type)""")
query("ag8_distinct_lists", lambda s, d: R.distinct_lists(A.table(s, d, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"], 5), """
SELECT 'o_orderstatus' AS "column", count(DISTINCT o_orderstatus) AS n_distinct, CASE WHEN count(DISTINCT o_orderstatus) <= 5 THEN string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) END AS "values" FROM orders
UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority), CASE WHEN count(DISTINCT o_orderpriority) <= 5 THEN string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) END FROM orders
UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey), NULL FROM orders""")
query("ag11_top_outliers", lambda s, d: rounded(R.top_outliers(A.cache_li(s, d), "rvol30", ["ticker", "trading_day"])), """
SELECT ticker, trading_day, round(rvol30, 6) AS rvol30 FROM cache WHERE rvol30 IS NOT NULL ORDER BY cache.rvol30 DESC, ticker, trading_day LIMIT 20""")
query("ag13_hit_rates", lambda s, d: rounded(R.hit_rates(found(s, d), A.daily(s, d))), WATCH + """
SELECT event_type, count(*) AS n, count(DISTINCT ticker) AS tickers, round(count(*) * 100.0 / (SELECT count(*) FROM daily), 6) AS hit_rate_pct, round(count(*) / count(DISTINCT ticker), 6) AS per_ticker FROM ev GROUP BY 1""")
#: The ticks spread over a year, so that some lie in summer time; in 2024 New York's began on 10 March at 07:00 and ended on 3 November at 06:00 UTC.
spread = lambda s, d: A.ticks(s, d).withColumn("ts", F.expr("timestamp_micros(t_raw + (seq % 330) * 86400000000)"))
query("fp5_rth_over_the_year", lambda s, d: U.rth_filter(spread(s, d)).select("ticker", "seq"), """,
far AS (SELECT ticker, seq, ts + INTERVAL 1 DAY * (seq % 330) AS u FROM ticks),
ny AS (SELECT *, u - CASE WHEN u >= TIMESTAMP '2024-03-10 07:00:00' AND u < TIMESTAMP '2024-11-03 06:00:00' THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END AS t FROM far)
SELECT ticker, seq FROM ny WHERE hour(t) * 60 + minute(t) BETWEEN 570 AND 960""")
query("fp5_rth_new_york", lambda s, d: U.rth_filter(A.ticks(s, d)).select("ticker", "seq"), """
SELECT ticker, seq FROM ticks WHERE hour(ts - INTERVAL 5 HOUR) * 60 + minute(ts - INTERVAL 5 HOUR) BETWEEN 570 AND 960""")


# ---- labels, weights and the training set on exponential volatility -------------------------------
def chain(s, d):
    """Bars and labels, each written once."""
    bars = materialise(bars_of(s, d), "bars")
    return bars, materialise(L.triple_barrier(L.bar_vol(bars)), "labels")


def default_dataset(s, d):
    bars, labels = chain(s, d)
    return L.build_dataset(bars, labels, L.sample_weights(labels))


def ema_query(name, run, body):
    FUNCTIONS[name], SQL[name] = run, A.ema_sql(body)


ema_query("lb2_default_labels", lambda s, d: rounded(chain(s, d)[1].select("ticker", "date", "bar_no", "anchor_ts", "t1", "pt_hit", "sl_hit", "label", "ret_at_outcome")), """
SELECT ticker, date, bar_no, anchor_ts, t1, pt_hit, sl_hit, label, round(ret_at_outcome, 6) AS ret_at_outcome FROM labels_""")
ema_query("wt2_default_weights", lambda s, d: rounded(long_(L.sample_weights(chain(s, d)[1]), "concurrency")), """
SELECT ticker, date, bar_no, anchor_ts, concurrency, round(weight, 6) AS weight FROM weights_""")
ema_query("ds1_default_dataset", lambda s, d: rounded(default_dataset(s, d).select("ticker", "date", "bar_no", "label", "weight", *NAMES), 4), FEATS + f"""
SELECT ticker, date, bar_no, label, round(weight, 4) AS weight, {', '.join(f'round({c}, 4) AS {c}' for c in NAMES)} FROM labels_ JOIN fe USING (ticker, date, bar_no) JOIN weights_ USING (ticker, date, bar_no)""")
