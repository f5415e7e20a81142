"""Registered queries of the market operators: function and SQL side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tickloom.operators import bars as B, daily as D, detectors as E, fusion as V, labels as L, reports as R, universe as U, windows as W
from tickloom.plans import adapters as A
from tickloom.session import materialise

FUNCTIONS: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, run: Callable, body: str | None = None, days: str = "daily") -> None:
    FUNCTIONS[name] = run
    if body is not None:
        SQL[name] = A.sql(body, days)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def r9(*columns: str) -> str:
    """For values with few binary places, which six decimals would cut at a half."""
    return ", ".join(f"round({c}, 9) AS {c}" for c in columns)


# ---- flagship -------------------------------------------------------------------------------------
def gap_watchlist(spark, d):
    return V.fuse_watchlist(E.detect_all(A.daily(spark, d), ("E2", "E8"))).select("ticker", "date", F.array_join("events", "+").alias("events"), F.col("event_count").cast("long").alias("event_count"))


query("gap_watchlist", gap_watchlist, f"""
SELECT ticker, date, string_agg(e, '+' ORDER BY e) AS events, count(*) AS event_count FROM (
  SELECT ticker, date, '{E.EVENTS['E2']}' AS e FROM runs WHERE (o - prev_c) / prev_c >= 0.10 UNION ALL
  SELECT ticker, date, '{E.EVENTS['E8']}' FROM runs WHERE (o - prev_c) / prev_c <= -0.15) GROUP BY 1, 2""")

# ---- aggregations (AG1-AG5, AG21) -----------------------------------------------------------------
OHLCV = f"ticker, date, {r('o', 'h', 'l', 'c')}, v, n, {r('dollar')}"
query("ag1_minute_to_daily", lambda s, d: rounded(D.minute_to_daily_ohlcv(A.minutes(s, d))), f"""
SELECT {OHLCV} FROM (SELECT ticker, date, arg_min(o, t) AS o, max(h) AS h, min(l) AS l, arg_max(c, t) AS c, sum(v)::BIGINT AS v, sum(n)::BIGINT AS n, sum(v * c) AS dollar FROM minutes GROUP BY 1, 2)""")
query("ag2_daily_cache", lambda s, d: rounded(D.daily_cache_agg(A.minutes(s, d)), 9), f"""
SELECT ticker, date AS trading_day, round(arg_max(c, t), 9) AS close_d, sum(v)::BIGINT AS vol_d, round(sum(v * vw), 9) AS dollar_vol_d, count(n) AS session_rows, round(sum(v * vw) / nullif(sum(v), 0), 9) AS vwap_d, count(n) < 390 AS has_gaps FROM minutes GROUP BY 1, 2""")
query("ag3_ticks_to_minute", lambda s, d: rounded(D.ticks_to_minute(A.ticks(s, d)).drop("minute")), f"""
SELECT ticker, date, epoch_us(date_trunc('minute', ts)) AS t, arg_min(p, seq) AS o, max(p) AS h, min(p) AS l, arg_max(p, seq) AS c, sum(s)::BIGINT AS v, count(*) AS n, round(sum(p * s), 6) AS dollar, round(sum(p * s) / sum(s), 6) AS vw FROM ticks GROUP BY 1, 2, 3""")
bars_of = lambda s, d: B.dollar_bars(A.ticks(s, d), A.TARGET)
query("ag4_bars_to_minute", lambda s, d: D.bars_to_minute(bars_of(s, d), "hour").withColumn("minute", F.unix_micros("minute")), """
SELECT ticker, t_close // 3600000000 * 3600000000 AS minute, arg_min(o, date::VARCHAR || lpad(bar_no::VARCHAR, 9, '0')) AS o, max(h) AS h, min(l) AS l, arg_max(c, date::VARCHAR || lpad(bar_no::VARCHAR, 9, '0')) AS c, sum(v)::BIGINT AS v FROM bars GROUP BY 1, 2""")
query("ag5_day_features", lambda s, d: rounded(D.day_features(bars_of(s, d))), """
SELECT ticker, date, round(avg((c - o) / nullif(o, 0)), 6) AS ret_mean, round(avg((h - l) / nullif(o, 0)), 6) AS range_mean, sum(v)::BIGINT AS vol_sum, round(sum(dollar), 6) AS dollar_sum, round(avg(imbalance_score), 6) AS imbalance_mean, sum(n)::BIGINT AS n_sum FROM bars GROUP BY 1, 2""")
query("ag21_daily_quality", lambda s, d: rounded(D.daily_quality(A.minutes(s, d))), """
SELECT ticker, count(*) AS days, sum(m)::BIGINT AS minutes, min(m) AS min_per_day, round(avg(m), 6) AS avg_per_day, max(m) AS max_per_day, sum(v)::BIGINT AS volume, min(l) AS low, max(h) AS high, sum(k - m)::BIGINT AS repeated, coalesce(sum(gap::INT), 0)::BIGINT AS gaps
FROM (SELECT *, date - lag(date) OVER (PARTITION BY ticker ORDER BY date) > 7 AS gap FROM (SELECT ticker, date, count(*) AS k, count(DISTINCT minute) AS m, min(l) AS l, max(h) AS h, sum(v) AS v FROM minutes GROUP BY 1, 2)) GROUP BY 1""")

# ---- windows (WN1-WN15) ---------------------------------------------------------------------------
query("wn1_prev_close", lambda s, d: W.prev_close(A.daily_li(s, d)).select("ticker", "date", F.round("prev_c", 9).alias("prev_c")), "SELECT ticker, date, round(lag(c) OVER (PARTITION BY ticker ORDER BY date), 9) AS prev_c FROM daily_li")
query("wn2_cache_features", lambda s, d: rounded(A.cache_li(s, d), 9), f"SELECT ticker, trading_day, {r9('close_d', 'vol_d', 'dollar_vol_d')}, session_rows, {r9('pctchg_d', 'return_d', 'rvol30')} FROM cache")
query("wn3_rvol_strict", lambda s, d: W.rvol_strict(A.daily_li(s, d)).select("ticker", "date", F.round("rvol", 6).alias("rvol")), "SELECT ticker, date, round(rvol, 6) AS rvol FROM stops", "daily_li")
query("wn3_rvol_previous_days", lambda s, d: W.rvol_strict(A.daily_li(s, d), 20, False).select("ticker", "date", F.round("rvol", 6).alias("rvol")), """
SELECT ticker, date, round(v / CASE WHEN count(*) OVER f = 20 THEN avg(v) OVER f END, 6) AS rvol FROM daily_li WINDOW f AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)""")
query("wn4_forward_returns", lambda s, d: rounded(W.forward_returns(A.daily_li(s, d)).select("ticker", "date", *R.HORIZONS)), f"SELECT ticker, date, {', '.join(f'round(lead(c, {k}) OVER w / c - 1, 6) AS ret_{k}d' for k in (1, 3, 5, 10))} FROM daily_li WINDOW w AS (PARTITION BY ticker ORDER BY date)")
query("wn5_rolling_max_prev", lambda s, d: rounded(W.rolling_max_prev(A.daily_li(s, d)).select("ticker", "date", "max_prev")), "SELECT ticker, date, round(CASE WHEN count(*) OVER f = 252 THEN max(c) OVER f END, 6) AS max_prev FROM daily_li WINDOW f AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)")
query("wn6_rolling_zscore", lambda s, d: rounded(W.rolling_zscore(A.daily_li(s, d), "v").select("ticker", "date", "v_z"), 5), "SELECT ticker, date, round(coalesce(CASE WHEN count(*) OVER f = 20 AND stddev_samp(v) OVER f > 0 THEN (v - avg(v) OVER f) / (stddev_samp(v) OVER f + 1e-12) END, 0), 5) AS v_z FROM daily_li WINDOW f AS (PARTITION BY ticker ORDER BY date ROWS 19 PRECEDING)")
query("wn7_streaks", lambda s, d: W.streaks(A.hourly(s, d)).select("ticker", F.unix_micros(F.col("date").cast("timestamp")).alias("at"), F.col("green_run").cast("long").alias("green_run"), F.col("red_run").cast("long").alias("red_run")), "SELECT ticker, epoch_us(date) AS at, green_run, red_run FROM stops", "hourly")
query("wn8_cumulative", lambda s, d: rounded(W.cumulative(A.minutes(s, d)).select("ticker", "date", "t", "cum_v", "cum_dollar", "pct_open")), "SELECT ticker, date, t, (sum(v) OVER w)::BIGINT AS cum_v, round(sum(v * c) OVER w, 6) AS cum_dollar, round(c / nullif(first(o) OVER w, 0) - 1, 6) AS pct_open FROM minutes WINDOW w AS (PARTITION BY ticker, date ORDER BY t ROWS UNBOUNDED PRECEDING)")
query("wn9_first_trigger", lambda s, d: rounded(W.first_trigger(A.minutes(s, d), dollars=10_000.0, high=200.0)), """
SELECT ticker, date, t, c, round(cum_dollar, 6) AS cum_dollar, round(pct_open, 6) AS pct_open FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY t) AS k FROM (
 SELECT ticker, date, t, c, sum(v * c) OVER w AS cum_dollar, c / nullif(first(o) OVER w, 0) - 1 AS pct_open FROM minutes WINDOW w AS (PARTITION BY ticker, date ORDER BY t ROWS UNBOUNDED PRECEDING)) WHERE abs(pct_open) >= 0.15 AND cum_dollar >= 10000 AND c BETWEEN 0.2 AND 200) WHERE k = 1""")
query("wn10_last_n", lambda s, d: W.last_n(A.daily_li(s, d), 252).select("ticker", "date"), "SELECT ticker, date FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS k FROM daily_li) WHERE k <= 252")
query("wn11_ema", lambda s, d: rounded(W.ema(bars_of(s, d).select("ticker", "date", "bar_no", "c"), "c", 10).select("ticker", "date", "bar_no", "c_ema10")), """,
e AS (SELECT ticker, date, bar_no, c AS ema FROM bars WHERE bar_no = 0 UNION ALL SELECT b.ticker, b.date, b.bar_no, 2.0 / 11 * b.c + 9.0 / 11 * e.ema FROM e JOIN bars b ON b.ticker = e.ticker AND b.date = e.date AND b.bar_no = e.bar_no + 1)
SELECT ticker, date, bar_no, round(ema, 6) AS c_ema10 FROM e""")
query("wn12_scd_next", lambda s, d: W.scd_next(A.snapshots(s, d)).select("ticker", "as_of", "effective_to"), "SELECT ticker, as_of, lead(as_of) OVER (PARTITION BY ticker ORDER BY as_of) AS effective_to FROM snapshots")
query("wn13_percentile_score", lambda s, d: rounded(W.percentile_score(A.daily(s, d).groupBy("ticker").agg(F.sum("n").alias("ticks"), F.sum("v").alias("volume"), F.sum("dollar").alias("dollars")), {"ticks": 0.5, "volume": 0.3, "dollars": 0.2}).select("ticker", "score", "class")), """,
t AS (SELECT ticker, sum(n) AS ticks, sum(v) AS volume, sum(dollar) AS dollars FROM daily GROUP BY 1),
p AS (SELECT a.ticker, (SELECT count(*) FROM t) AS k, (SELECT count(*) FROM t b WHERE b.ticks <= a.ticks) AS x, (SELECT count(*) FROM t b WHERE b.volume <= a.volume) AS y, (SELECT count(*) FROM t b WHERE b.dollars <= a.dollars) AS z FROM t a),
q AS (SELECT ticker, ((x - 1) * 0.5 + (y - 1) * 0.3 + (z - 1) * 0.2) * 100.0 / (k - 1) AS score FROM p)
SELECT ticker, round(score, 6) AS score, CASE WHEN round(score, 6) >= 70 THEN 'heavy' WHEN round(score, 6) >= 40 THEN 'medium' ELSE 'light' END AS class FROM q""")
query("wn14_gap_days", lambda s, d: W.gap_days(A.daily_li(s, d), 1).select("ticker", "date", F.col("gap").cast("long").alias("gap")), "SELECT ticker, date, gap FROM (SELECT ticker, date, date - lag(date) OVER (PARTITION BY ticker ORDER BY date) AS gap FROM daily_li) WHERE gap > 1")
query("wn15_range_spike", lambda s, d: rounded(W.rolling_range_spike(A.minutes(s, d)).select("ticker", "date", "t", "spike_up", "spike_down"), 9), "SELECT ticker, date, t, round(max(h) OVER w / nullif(first(o) OVER w, 0) - 1, 9) AS spike_up, round(min(l) OVER w / nullif(first(o) OVER w, 0) - 1, 9) AS spike_down FROM minutes WINDOW w AS (PARTITION BY ticker, date ORDER BY t RANGE BETWEEN 7200000000 PRECEDING AND CURRENT ROW)")

# ---- detectors (E0-E11, E13, EV*) -----------------------------------------------------------------
days_at = lambda df: df.withColumn("date", F.unix_micros(F.col("date").cast("timestamp")) if dict(df.dtypes)["date"].startswith("timestamp") else F.col("date"))


def detector(name: str, event: str, source: Callable, where: str, value: str, days: str, **options) -> None:
    date = "epoch_us(date) AS date" if days == "hourly" else "date"
    query(name, lambda s, d: rounded(days_at(E.detect(source(s, d), event, **options))), f"SELECT ticker, {date}, '{E.EVENTS[event]}' AS event_type, round(({value})::DOUBLE, 6) AS value FROM feats WHERE {where}", days)


detector("e1_volume_explosion", "E1", A.daily_li, "rvol >= 5", "rvol", "daily_li")
detector("e1_volume_explosion_2x", "E1", A.daily_li, "rvol >= 2", "rvol", "daily_li", rvol_threshold=2.0)
detector("e2_gap_up", "E2", A.daily, "(o - prev_c) / nullif(prev_c, 0) >= 0.1", "(o - prev_c) / prev_c", "daily")
detector("e3_intraday_spike", "E3", A.daily, "o > 0 AND (h - o) / nullif(o, 0) >= 0.2", "(h - o) / o", "daily")
detector("e6_green_run", "E6", A.hourly, "green_run >= 3", "green_run", "hourly")
detector("e8_gap_down", "E8", A.daily, "(o - prev_c) / nullif(prev_c, 0) <= -0.15", "(o - prev_c) / prev_c", "daily")
detector("e9_intraday_crash", "E9", A.daily, "o > 0 AND (l - o) / nullif(o, 0) <= -0.3", "(l - o) / o", "daily")
detector("e10_green_bounce", "E10", A.hourly, "c > o AND prev_red >= 3", "prev_red", "hourly")
detector("e11_volume_bounce", "E11", A.daily_li, "rvol >= 3 AND c > o AND prev_red >= 2", "rvol", "daily_li")
detector("e11_volume_bounce_1_5x", "E11", A.daily_li, "rvol >= 1.5 AND c > o AND prev_red >= 2", "rvol", "daily_li", volume_bounce_rvol=1.5)
query("e0_info_rich", lambda s, d: E.info_rich_days(U.info_rich(A.cache_li(s, d), {"dvol": 1e5, "rvol": 1.2, "max_price": 1e5})), "SELECT ticker, trading_day, 'E0_InfoRich' AS event_type FROM cache WHERE rvol30 >= 1.2 AND abs(pctchg_d) >= 0.15 AND dollar_vol_d >= 1e5 AND close_d BETWEEN 0.2 AND 1e5")
query("e0_baseline", lambda s, d: E.baseline_days(A.daily(s, d)), "SELECT ticker, date, 'E0_baseline' AS event_type FROM daily WHERE v > 0")
query("e4_parabolic", lambda s, d: rounded(E.detect(A.daily_li(s, d), "E4")).withColumn("days", F.col("days").cast("long")), f"""
SELECT ticker, date, '{E.EVENTS['E4']}' AS event_type, round(value, 6) AS value, date_end, days FROM ({' UNION ALL '.join(f"SELECT ticker, date, lead(c, {k}) OVER w / nullif(o, 0) - 1 AS value, lead(date, {k}) OVER w AS date_end, {k}::BIGINT AS days FROM daily_li WINDOW w AS (PARTITION BY ticker ORDER BY date)" for k in range(1, 6))}) WHERE value >= 0.5""")
query("e5_breakout", lambda s, d: rounded(E.detect(A.daily_li(s, d), "E5")), f"""
SELECT ticker, date, '{E.EVENTS['E5']}' AS event_type, round(c / m, 6) AS value FROM (SELECT ticker, date, c, CASE WHEN count(*) OVER f = 252 THEN max(c) OVER f END AS m FROM daily_li WINDOW f AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)) WHERE c >= m""")
query("e7_first_red_day", lambda s, d: rounded(days_at(E.detect(A.hourly(s, d), "E7"))), f"""
SELECT f.ticker, epoch_us(f.date) AS date, '{E.EVENTS['E7']}' AS event_type, round((max(g.h) - arg_min(g.o, g.r)) / nullif(arg_min(g.o, g.r), 0), 6) AS value
FROM feats f JOIN feats g ON g.ticker = f.ticker AND g.r BETWEEN f.r - f.prev_green AND f.r - 1 WHERE f.c < f.o AND f.prev_green >= 3 GROUP BY f.ticker, f.date HAVING (max(g.h) - arg_min(g.o, g.r)) / nullif(arg_min(g.o, g.r), 0) >= 0.5""", "hourly")
query("e13_offering_pricing", lambda s, d: E.offering_pricing(A.filings(s, d)), "SELECT ticker, filing_date AS date, 'E13_OfferingPricing' AS event_type, form FROM filings WHERE form IN ('424B5', '424B2', '424B3')")
ALL_SQL = " UNION ALL ".join(
    f"SELECT ticker, date, '{E.EVENTS[e]}' AS event_type FROM feats WHERE {w}"
    for e, w in {
        "E2": "(o - prev_c) / nullif(prev_c, 0) >= 0.1", "E3": "o > 0 AND (h - o) / nullif(o, 0) >= 0.2", "E6": "green_run >= 3", "E8": "(o - prev_c) / nullif(prev_c, 0) <= -0.15",
        "E9": "o > 0 AND (l - o) / nullif(o, 0) <= -0.3", "E10": "c > o AND prev_red >= 3",
    }.items()
)
SHORT = ("E2", "E3", "E6", "E8", "E9", "E10")
found = lambda s, d: E.detect_all(A.daily(s, d), SHORT)
watch = lambda s, d: V.fuse_watchlist(found(s, d))
WATCH = f", ev AS ({ALL_SQL}), watch AS (SELECT ticker, date, list_sort(list_distinct(list(event_type))) AS events, count(DISTINCT event_type) AS event_count FROM ev GROUP BY 1, 2)\n"
flat = lambda df, c="events": df.withColumn(c, F.array_join(c, "+"))
long_ = lambda df, *cs: df.withColumns({c: F.col(c).cast("long") for c in cs})
query("ev1_detect_all", lambda s, d: found(s, d).select("ticker", "date", "event_type"), WATCH + "SELECT * FROM ev")
query("ev2_fuse_details", lambda s, d: V.fuse_details(found(s, d)).select("ticker", "date", "event_type", F.round(F.get_json_object("details_json", "$.value").cast("double"), 5).alias("value")), WATCH + """
SELECT ticker, date, event_type, round(CASE left(event_type, 3) WHEN 'E2_' THEN (o - prev_c) / prev_c WHEN 'E8_' THEN (o - prev_c) / prev_c WHEN 'E3_' THEN (h - o) / o WHEN 'E9_' THEN (l - o) / o WHEN 'E6_' THEN green_run ELSE prev_red END, 5) AS value FROM ev JOIN feats USING (ticker, date)""")
query("ev3_fuse_days", lambda s, d: long_(flat(V.fuse_days(V.fuse_details(found(s, d))), "event_types").withColumn("details", F.size("details")), "num_events", "details"), WATCH + "SELECT ticker, date, array_to_string(events, '+') AS event_types, event_count AS num_events, event_count AS details FROM watch")
query("ev4_ml_flags", lambda s, d: V.ml_flags(V.fuse_days(V.fuse_details(found(s, d))), {k: E.EVENTS[k] for k in SHORT}).select("ticker", "date", *[f"has_{k.lower()}" for k in SHORT], "event_combination", "is_multi_event"), WATCH + f"SELECT ticker, date, {', '.join(f'''list_contains(events, '{E.EVENTS[k]}') AS has_{k.lower()}''' for k in SHORT)}, array_to_string(list_transform(events, lambda e: split_part(e, '_', 1)), '_') AS event_combination, event_count > 1 AS is_multi_event FROM watch")
query("ev5_fuse_watchlist", lambda s, d: long_(flat(watch(s, d)), "event_count"), WATCH + "SELECT ticker, date, array_to_string(events, '+') AS events, event_count FROM watch")
query("ev6_watchlist_summary", lambda s, d: V.watchlist_summary(watch(s, d)), WATCH + """
SELECT 'days' AS section, 'total' AS item, count(*) AS n FROM watch UNION ALL SELECT 'days', 'single', count(*) FROM watch WHERE event_count = 1 UNION ALL SELECT 'days', 'multi', count(*) FROM watch WHERE event_count > 1
UNION ALL SELECT 'type', event_type, count(*) FROM (SELECT DISTINCT * FROM ev) GROUP BY 2 UNION ALL (SELECT 'combination', array_to_string(events, '+'), count(*) AS n FROM watch GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10)""")
query("ev7_simultaneous", lambda s, d: long_(V.simultaneous(watch(s, d)), "event_count"), WATCH + "SELECT event_count, count(*) AS days FROM watch GROUP BY 1")
query("ev8_export_signals", lambda s, d: V.export_signals(watch(s, d), bars_of(s, d)).drop("window_suggested"), WATCH + "SELECT ticker, date, event_type, min(t_open) AS t_open, arg_min(c, bar_no) AS close FROM (SELECT DISTINCT * FROM ev) JOIN bars USING (ticker, date) GROUP BY 1, 2, 3")
WINDOW_DAYS = {"E2": 1, "E3": 2, "E8": 3}
config = lambda s: s.createDataFrame([(E.EVENTS[k], n) for k, n in WINDOW_DAYS.items()], "event_type string, days int")
CONFIG = ", config AS (" + " UNION ALL ".join(f"SELECT '{E.EVENTS[k]}' AS event_type, {n} AS days" for k, n in WINDOW_DAYS.items()) + ")\n"
query("so6_explode_events", lambda s, d: long_(V.explode_events(watch(s, d)), "event_count"), WATCH + "SELECT ticker, date, unnest(events) AS event_type, event_count FROM watch")
query("so7_expand_event_window", lambda s, d: V.expand_event_window(watch(s, d), config(s)), WATCH + CONFIG + """SELECT DISTINCT ticker, (date + unnest(range(-w, w + 1))::INT)::DATE AS day FROM (SELECT ticker, date, coalesce(max(days), 0) AS w FROM ev LEFT JOIN config USING (event_type) GROUP BY 1, 2)""")
query("ag26_download_plan", lambda s, d: V.download_plan(watch(s, d), config(s)), WATCH + CONFIG + "SELECT event_type, count(*) AS occurrences, count(*) * (2 * coalesce(any_value(days), 0) + 1) AS ticker_days FROM (SELECT DISTINCT * FROM ev) LEFT JOIN config USING (event_type) GROUP BY 1")

# ---- bars, labels, weights, features --------------------------------------------------------------
query("br1_tick_rule", lambda s, d: B.tick_rule(A.ticks(s, d)).select("ticker", "seq", "sign"), "SELECT ticker, seq, sign FROM signed")
BAR = "ticker, date, bar_no, t_open, t_close, o, h, l, c, v, n, round(dollar, 6) AS dollar, round(imbalance_score, 6) AS imbalance_score"
query("br2_dollar_bars", lambda s, d: rounded(bars_of(s, d)), f"SELECT {BAR} FROM bars")


def folded(name: str, run: Callable, size: str, target: int, keys: str = "ticker, date") -> None:
    on = " AND ".join(f"k.{c} = f.{c}" for c in keys.split(", "))
    mine = ", ".join(f"k.{c}" for c in keys.split(", "))
    query(name, lambda s, d: rounded(run(s, d)), f""",
rk AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY t_raw, seq) AS q, coalesce(sign(p - lag(p) OVER (PARTITION BY {keys} ORDER BY t_raw, seq)), 0) AS sg FROM ticks),
fo AS (SELECT {keys}, q, ({size}) AS acc, 0::BIGINT AS bar_no FROM rk k WHERE q = 1 UNION ALL
  SELECT {mine}, k.q, CASE WHEN f.acc >= {target} THEN 0 ELSE f.acc END + {size}, f.bar_no + CASE WHEN f.acc >= {target} THEN 1 ELSE 0 END FROM fo f JOIN rk k ON {on} AND k.q = f.q + 1)
SELECT {keys}, bar_no, min(t_raw) AS t_open, max(t_raw) AS t_close, arg_min(p, q) AS o, max(p) AS h, min(p) AS l, arg_max(p, q) AS c, sum(s)::BIGINT AS v, count(*) AS n, round(sum(cents * s) / 100, 6) AS dollar, round(avg(sg), 6) AS imbalance_score FROM rk JOIN fo USING ({keys}, q) GROUP BY {keys}, bar_no""")


folded("br3_volume_bars", lambda s, d: B.volume_bars(A.ticks(s, d), 200), "k.s", 200)
folded("br4_dollar_bars_multi_day", lambda s, d: B.dollar_bars_multi_day(A.ticks(s, d), 50_000), "k.cents * k.s", 5_000_000, "ticker")
folded("br5_volume_bars_multi_day", lambda s, d: B.volume_bars_multi_day(A.ticks(s, d), 1000), "k.s", 1000, "ticker")
query("br6_imbalance_bars", lambda s, d: rounded(B.imbalance_bars(A.ticks(s, d), "dollar", 8000)), """,
im AS (SELECT ticker, date, r, sign * cents * s AS g, cents * s AS acc, abs(sign)::DOUBLE AS e, 0::BIGINT AS bar_no FROM signed WHERE r = 1 UNION ALL
 SELECT k.ticker, k.date, k.r, CASE WHEN z THEN 0 ELSE f.g END + k.sign * k.cents * k.s, CASE WHEN z THEN 0 ELSE f.acc END + k.cents * k.s, 0.2 * abs(k.sign) + 0.8 * f.e, f.bar_no + z::INT
 FROM (SELECT *, abs(g) >= greatest(1, e * 800000) OR acc >= 800000 AS z FROM im) f JOIN signed k ON k.ticker = f.ticker AND k.date = f.date AND k.r = f.r + 1)
SELECT ticker, date, bar_no, min(t_raw) AS t_open, max(t_raw) AS t_close, round(arg_min(p, r), 6) AS o, round(max(p), 6) AS h, round(min(p), 6) AS l, round(arg_max(p, r), 6) AS c, count(*) AS n, sum(s)::BIGINT AS v, round(sum(cents * s) / 100, 6) AS dollar, round(avg(sign), 6) AS imbalance_score FROM im JOIN signed USING (ticker, date, r) GROUP BY 1, 2, 3""")
query("br6_imbalance_volume_bars", lambda s, d: rounded(B.imbalance_bars(A.ticks(s, d), "volume", 100)), """,
im AS (SELECT ticker, date, r, sign * s AS g, s AS acc, abs(sign)::DOUBLE AS e, 0::BIGINT AS bar_no FROM signed WHERE r = 1 UNION ALL
 SELECT k.ticker, k.date, k.r, CASE WHEN z THEN 0 ELSE f.g END + k.sign * k.s, CASE WHEN z THEN 0 ELSE f.acc END + k.s, 0.2 * abs(k.sign) + 0.8 * f.e, f.bar_no + z::INT
 FROM (SELECT *, abs(g) >= greatest(1, e * 100) OR acc >= 100 AS z FROM im) f JOIN signed k ON k.ticker = f.ticker AND k.date = f.date AND k.r = f.r + 1)
SELECT ticker, date, bar_no, min(t_raw) AS t_open, max(t_raw) AS t_close, round(arg_min(p, r), 6) AS o, round(max(p), 6) AS h, round(min(p), 6) AS l, round(arg_max(p, r), 6) AS c, count(*) AS n, sum(s)::BIGINT AS v, round(sum(cents * s) / 100, 6) AS dollar, round(avg(sign), 6) AS imbalance_score FROM im JOIN signed USING (ticker, date, r) GROUP BY 1, 2, 3""")
query("br7_imbalance_reset", lambda s, d: rounded(B.imbalance_bars_reset(A.ticks(s, d), 4000)), """,
im AS (SELECT ticker, date, r, sign * cents * s AS g, 0::BIGINT AS bar_no FROM signed WHERE r = 1 UNION ALL
 SELECT k.ticker, k.date, k.r, CASE WHEN abs(f.g) >= 400000 THEN 0 ELSE f.g END + k.sign * k.cents * k.s, f.bar_no + (abs(f.g) >= 400000)::INT FROM im f JOIN signed k ON k.ticker = f.ticker AND k.date = f.date AND k.r = f.r + 1)
SELECT ticker, date, bar_no, min(t_raw) AS t_open, max(t_raw) AS t_close, round(arg_min(p, r), 6) AS o, round(max(p), 6) AS h, round(min(p), 6) AS l, round(arg_max(p, r), 6) AS c, count(*) AS n, sum(s)::BIGINT AS v, round(sum(cents * s) / 100, 6) AS dollar, round(avg(sign), 6) AS imbalance_score, round(sum(sign * cents * s) / 100, 6) AS imbalance, round(sum(cents * s) / 100 / sum(s), 6) AS vwap FROM im JOIN signed USING (ticker, date, r) GROUP BY 1, 2, 3""")
query("br8_imbalance_running", lambda s, d: rounded(B.imbalance_bars_running(A.ticks(s, d), 4000), 9), """
SELECT ticker, date, bar_no, arg_min(p, r) AS o, max(p) AS h, min(p) AS l, arg_max(p, r) AS c, sum(s)::BIGINT AS v, count(*) AS n, round(sum(cents * s) / 100 / sum(s), 9) AS vwap, round((max(t_raw) - min(t_raw)) / 1e6, 9) AS duration_sec
FROM (SELECT *, coalesce(sum((abs(run) >= 4000)::INT) OVER (PARTITION BY ticker, date ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS bar_no FROM (SELECT *, sum(sign * cents * s / 100) OVER (PARTITION BY ticker, date ORDER BY r) AS run FROM signed)) GROUP BY 1, 2, 3""")
query("br9_minute_as_ticks", lambda s, d: B.minute_as_ticks(A.minutes(s, d)), "SELECT ticker, date, t AS t_raw, 'us' AS t_unit, t AS seq, c AS p, v AS s FROM minutes")
query("br10_bar_anomalies", lambda s, d: rounded(B.bar_anomalies(bars_of(s, d)).select("ticker", "date", "bar_no", "range_pct")), "SELECT ticker, date, bar_no, round((h - l) / nullif(o, 0), 6) AS range_pct FROM bars WHERE (h - l) / nullif(o, 0) > 0.05")
query("br10_largest_imbalance", lambda s, d: rounded(B.largest_imbalance(bars_of(s, d))), "SELECT ticker, date, bar_no, round(imbalance_score, 6) AS imbalance_score FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY abs(imbalance_score) DESC, bar_no) AS k FROM bars) WHERE k = 1")
query("br11_bar_stats", lambda s, d: rounded(B.bar_stats(bars_of(s, d), A.TARGET)), f"""
SELECT ticker, date, count(*) AS bars, round(quantile_cont(dollar, 0.25), 6) AS dollar_p25, round(quantile_cont(dollar, 0.5), 6) AS dollar_p50, round(quantile_cont(dollar, 0.75), 6) AS dollar_p75, round(avg(n), 6) AS ticks_per_bar, round(avg((dollar BETWEEN {0.8 * A.TARGET} AND {1.5 * A.TARGET})::INT), 6) AS near_target,
 count(*) FILTER (imbalance_score > 0.1) AS buying, count(*) FILTER (imbalance_score < -0.1) AS selling, count(*) FILTER (abs(imbalance_score) <= 0.1) AS neutral FROM bars GROUP BY 1, 2""")
vols = lambda s, d: L.bar_vol(bars_of(s, d), "sma")
labels_of = lambda s, d: L.triple_barrier(vols(s, d))
query("lb1_bar_vol_sma", lambda s, d: rounded(vols(s, d).select("ticker", "date", "bar_no", "vol")), "SELECT ticker, date, bar_no, round(vol, 6) AS vol FROM vols")
query("lb1_bar_vol_ema", lambda s, d: rounded(L.bar_vol(bars_of(s, d)).select("ticker", "date", "bar_no", "vol")), """,
e AS (SELECT ticker, date, bar_no, a AS x FROM vols WHERE bar_no = 0 UNION ALL SELECT b.ticker, b.date, b.bar_no, 2.0 / 51 * b.a + 49.0 / 51 * e.x FROM e JOIN vols b ON b.ticker = e.ticker AND b.date = e.date AND b.bar_no = e.bar_no + 1)
SELECT ticker, date, bar_no, round(x, 6) AS vol FROM e""")
query("lb2_triple_barrier", lambda s, d: rounded(labels_of(s, d)), f"SELECT ticker, date, bar_no, anchor_ts, end_bar, t1, pt_hit, sl_hit, label, {r('ret_at_outcome', 'vol_at_anchor')} FROM labels_")
stored_labels = lambda s, d: materialise(labels_of(s, d), "labels")  # noqa: E731  bars and labels are computed once, then read
weights_of = lambda s, d: L.sample_weights(stored_labels(s, d))
query("wt1_concurrency", lambda s, d: L.concurrency(stored_labels(s, d)).select("ticker", "date", "bar_no", F.col("concurrency").cast("long").alias("concurrency")), "SELECT ticker, date, bar_no, concurrency FROM open_")
query("wt2_sample_weights", lambda s, d: rounded(long_(weights_of(s, d), "concurrency")), f"SELECT ticker, date, bar_no, anchor_ts, concurrency, {r('weight')} FROM weights_")
query("wt3_time_decay", lambda s, d: rounded(L.time_decay(A.daily(s, d).select("ticker", "date"), 10.0)), "SELECT ticker, date, round(pow(0.5, (max(date) OVER (PARTITION BY ticker) - date) / 10.0), 6) AS decay FROM daily")
query("br10_top_label", lambda s, d: rounded(B.top_label(labels_of(s, d))), "SELECT ticker, date, bar_no, label, round(ret_at_outcome, 6) AS ret_at_outcome FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY abs(ret_at_outcome) DESC, bar_no) AS k FROM labels_) WHERE k = 1")
EMAS = [(x, n) for x, spans in L.EMA_SPANS.items() for n in spans]
FEATS = f""", f0 AS (SELECT ticker, date, bar_no, t_close, coalesce(ln(c / lag(c) OVER w), 0) AS ret_1, (h - l) / (abs(coalesce(lag(c) OVER w, c)) + 1e-12) AS range_norm, v::DOUBLE AS vol_f, dollar AS dollar_f, imbalance_score AS imb_f, n,
 CASE WHEN count(*) OVER z = 20 AND stddev_samp(v) OVER z > 0 THEN (v - avg(v) OVER z) / (stddev_samp(v) OVER z + 1e-12) ELSE 0 END AS vol_z20, CASE WHEN count(*) OVER z = 20 AND stddev_samp(dollar) OVER z > 0 THEN (dollar - avg(dollar) OVER z) / (stddev_samp(dollar) OVER z + 1e-12) ELSE 0 END AS dollar_z20
 FROM bars WINDOW w AS (PARTITION BY ticker, date ORDER BY bar_no), z AS (PARTITION BY ticker, date ORDER BY bar_no ROWS 19 PRECEDING)),
fe AS (SELECT f0.*, {', '.join(f'{x} AS {x}_ema{n}' for x, n in EMAS)} FROM f0 WHERE bar_no = 0 UNION ALL SELECT f0.*, {', '.join(f'2.0 / {n + 1} * f0.{x} + {n - 1}.0 / {n + 1} * fe.{x}_ema{n}' for x, n in EMAS)} FROM fe JOIN f0 ON f0.ticker = fe.ticker AND f0.date = fe.date AND f0.bar_no = fe.bar_no + 1)
"""
NAMES = ("ret_1", "range_norm", "vol_f", "dollar_f", "imb_f", *[f"{x}_ema{n}" for x, n in EMAS], "vol_z20", "dollar_z20")
query("ft1_bar_features", lambda s, d: rounded(L.bar_features(bars_of(s, d)), 4), FEATS + f"SELECT ticker, date, bar_no, t_close, n, {', '.join(f'round({c}, 4) AS {c}' for c in NAMES)} FROM fe")


def dataset(s, d):
    """Bars and labels are written once; features, weights and the set read them."""
    bars = materialise(bars_of(s, d), "bars")
    labels = materialise(L.triple_barrier(L.bar_vol(bars, "sma")), "labels")
    return L.build_dataset(bars, labels, L.sample_weights(labels))


def twice(s, d):
    whole = dataset(s, d)
    return L.global_dataset([whole.filter("bar_no = 0").drop("weight"), whole.filter("bar_no > 0")])


SMALL = ("ticker", "date", "bar_no", "anchor_ts", "label", "ret_1_ema10", "weight")
query("ds1_build_dataset", lambda s, d: rounded(dataset(s, d).select(*SMALL), 5), FEATS + "SELECT ticker, date, bar_no, l.anchor_ts, label, round(ret_1_ema10, 5) AS ret_1_ema10, round(weight, 5) AS weight FROM labels_ l JOIN fe USING (ticker, date, bar_no) JOIN weights_ USING (ticker, date, bar_no)")


def assembled(s, d):
    """Bars and labels are written once; weights of first bars are left out."""
    bars = materialise(bars_of(s, d), "bars")
    labels = materialise(L.triple_barrier(L.bar_vol(bars, "sma")), "labels")
    return L.assemble(labels, L.bar_features(bars), L.sample_weights(labels).filter("bar_no > 0"))


query("jn3_assemble", lambda s, d: rounded(assembled(s, d).select(*SMALL), 5), FEATS + """
SELECT ticker, date, bar_no, l.anchor_ts, label, round(ret_1_ema10, 5) AS ret_1_ema10, round(CASE WHEN bar_no > 0 THEN weight ELSE 1 END, 5) AS weight
FROM labels_ l JOIN fe USING (ticker, date, bar_no) JOIN weights_ USING (ticker, date, bar_no)""")
query("ds2_global_dataset", lambda s, d: twice(s, d).select("ticker", "date", "bar_no", "label", F.round("weight", 5).alias("weight")), "SELECT ticker, date, bar_no, label, round(CASE WHEN bar_no > 0 THEN weight ELSE 1 END, 5) AS weight FROM labels_ JOIN weights_ USING (ticker, date, bar_no)")
query("ds3_walk_forward", lambda s, d: L.walk_forward_split(labels_of(s, d)).select("ticker", "date", "bar_no", F.col("idx").cast("long").alias("idx"), "part"), """
SELECT ticker, date, bar_no, idx, CASE WHEN idx < greatest(n * 4 // 5 - 50, 0) THEN 'train' WHEN idx >= n * 4 // 5 THEN 'valid' ELSE 'purged' END AS part FROM (SELECT *, row_number() OVER (ORDER BY anchor_ts, ticker, date, bar_no) - 1 AS idx, count(*) OVER () AS n FROM labels_)""")
query("ds4_dataset_meta", lambda s, d: L.dataset_meta(L.walk_forward_split(labels_of(s, d)).withColumn("weight", F.lit(1.0))), """
SELECT part, count(*) AS rows, min(anchor_ts) AS first_ts, max(anchor_ts) AS last_ts, sum(1.0)::DOUBLE AS weight FROM (SELECT anchor_ts, CASE WHEN idx < greatest(n * 4 // 5 - 50, 0) THEN 'train' WHEN idx >= n * 4 // 5 THEN 'valid' ELSE 'purged' END AS part FROM (SELECT *, row_number() OVER (ORDER BY anchor_ts, ticker, date, bar_no) - 1 AS idx, count(*) OVER () AS n FROM labels_)) GROUP BY 1""")
