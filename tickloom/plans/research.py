"""Registered queries of universe, dimension, join, report, statistics, quality and shaping operators."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tickloom.operators import detectors as E, information as I, joins as J, quality as Q, reports as R, scd as S, universe as U
from tickloom.operators.boosting import window_models
from tickloom.operators.fusion import duplicated_rows
from tickloom.operators.labels import walk_forward_split
from tickloom.operators.stored_scd import StoredDimension
from tickloom.operators.windows import forward_returns
from tickloom.plans import adapters as A
from tickloom.plans.market import SHORT, WATCH, bars_of, found, labels_of, long_, query, rounded, watch
from tickloom.session import materialise, scratch_folder
from tickloom.sources import io, normalize as N

RICH = {"rvol": 1.2, "pctchg": 0.15, "dvol": 1e5, "max_price": 1e5}
rich = lambda s, d: U.info_rich(A.cache_li(s, d), RICH)
RICH_SQL = ", rich AS (SELECT *, rvol30 >= 1.2 AS r_rvol, abs(pctchg_d) >= 0.15 AS r_chg, dollar_vol_d >= 1e5 AS r_dvol, close_d BETWEEN 0.2 AND 1e5 AS r_px, (rvol30 >= 1.2) AND (abs(pctchg_d) >= 0.15) AND (dollar_vol_d >= 1e5) AND (close_d BETWEEN 0.2 AND 1e5) AS info_rich FROM cache)\n"
FLAGS = "r_rvol, r_chg, r_dvol, r_px"

# ---- filters, rankings, sets ----------------------------------------------------------------------
query("fp1_select_universe", lambda s, d: U.select_universe(A.universe(s, d), A.details(s, d), 5e6).select("ticker", "market_cap"), "SELECT ticker, market_cap FROM universe JOIN details USING (ticker) WHERE type = 'CS' AND primary_exchange IN ('XNAS', 'XNYS') AND market_cap < 5e6")
query("fp2_cap_filter", lambda s, d: U.cap_filter(A.details(s, d).withColumnRenamed("market_cap", "market_cap_d"), 5e6).select("ticker"), "SELECT ticker FROM details WHERE market_cap IS NULL OR market_cap <= 5e6")
query("fp3_info_rich", lambda s, d: rich(s, d).select("ticker", "trading_day", "r_rvol", "r_chg", "r_dvol", "r_px", "info_rich"), RICH_SQL + f"SELECT ticker, trading_day, {FLAGS}, info_rich FROM rich")
query("fp4_filter_hits", lambda s, d: long_(U.filter_hits(A.cache_li(s, d), RICH).select("ticker", "trading_day", "num_filters", "combination"), "num_filters"), RICH_SQL + "SELECT ticker, trading_day, coalesce(r_rvol, false)::INT + coalesce(r_chg, false)::INT + coalesce(r_dvol, false)::INT + coalesce(r_px, false)::INT::BIGINT AS num_filters, concat_ws('+', CASE WHEN r_rvol THEN 'F1' END, CASE WHEN r_chg THEN 'F2' END, CASE WHEN r_dvol THEN 'F3' END, CASE WHEN r_px THEN 'F4' END) AS combination FROM rich")
query("fp5_rth_filter", lambda s, d: U.rth_filter(A.ticks(s, d), tz=None).select("ticker", "seq"), "SELECT ticker, seq FROM ticks WHERE hour(ts) * 60 + minute(ts) BETWEEN 570 AND 960")
query("fp6_date_window", lambda s, d: U.date_window(A.daily(s, d), "2024-01-05", "2024-01-12").select("ticker", "date"), "SELECT ticker, date FROM daily WHERE date BETWEEN '2024-01-05' AND '2024-01-12'")
query("fp7_price_bins", lambda s, d: U.price_bins(A.daily(s, d).withColumn("c", F.col("c") / F.when(F.col("n") % 2 == 0, 100).otherwise(1)), "c"), """
SELECT CASE WHEN x < 0.5 THEN '$0.20-$0.50 (penny)' WHEN x < 1 THEN '$0.50-$1.00' WHEN x < 5 THEN '$1.00-$5.00' WHEN x < 10 THEN '$5.00-$10.00' WHEN x <= 20 THEN '$10.00-$20.00' ELSE '>$20.00 (ERROR!)' END AS bin, count(*) AS n
FROM (SELECT c / CASE WHEN n % 2 = 0 THEN 100 ELSE 1 END AS x FROM daily) GROUP BY 1""")
query("fp7_cap_bins", lambda s, d: U.cap_bins(A.snapshots(s, d).withColumn("market_cap", F.col("market_cap") * 5e8)), """
SELECT CASE WHEN x < 5e7 THEN '< $50M (Nano)' WHEN x < 3e8 THEN '$50M-$300M (Micro)' WHEN x < 2e9 THEN '$300M-$2B (Small)' WHEN x < 1e10 THEN '$2B-$10B (Mid)' ELSE '> $10B (Large)' END AS bin, count(*) AS n
FROM (SELECT market_cap * 5e8 AS x FROM snapshots) WHERE x IS NOT NULL GROUP BY 1""")
query("tk1_topn_12m", lambda s, d: U.topn_12m(rich(s, d).withColumn("info_rich", F.coalesce("info_rich", F.lit(False)))), RICH_SQL + "SELECT ticker, sum(coalesce(info_rich, false)::INT)::BIGINT AS days_rich, max(trading_day) AS last_seen FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trading_day DESC) AS k FROM rich) WHERE k <= 252 GROUP BY 1")
TOP = 'SELECT "asof", ticker, sum(coalesce(info_rich, false)::INT)::BIGINT AS days_rich, max(trading_day) AS last_seen FROM {asofs} JOIN rich ON trading_day > "asof" - 252 AND trading_day <= "asof" GROUP BY 1, 2'
RANKED = 'SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "asof" ORDER BY days_rich DESC, last_seen DESC, ticker) AS rank FROM ({top})) WHERE rank <= 5'
query("tk2_topn_asof", lambda s, d: long_(U.topn_asof(rich(s, d), "1998-12-31", 5), "rank"), RICH_SQL + RANKED.format(top=TOP.format(asofs='(SELECT DATE \'1998-12-31\' AS "asof")')))
query("tk3_topn_snapshots", lambda s, d: long_(U.topn_snapshots(rich(s, d), U.calendar(rich(s, d)), 5), "rank"), RICH_SQL + ', span AS (SELECT min(trading_day) AS a, max(trading_day) AS b FROM rich), cal AS (SELECT last_day(m::DATE) AS "asof", b FROM span, unnest(generate_series(date_trunc(\'month\', a), date_trunc(\'month\', b), INTERVAL 1 MONTH)) AS g(m) WHERE last_day(m::DATE) BETWEEN a AND b)\n' + RANKED.format(top=TOP.format(asofs="cal")))
query("tk4_top_k", lambda s, d: U.top_k(A.filings(s, d), "form", 3), "SELECT form, count(*) AS n FROM filings GROUP BY 1 ORDER BY n DESC, form LIMIT 3")
query("tk5_top_k_per_group", lambda s, d: long_(U.top_k_per_group(A.daily_li(s, d).withColumn("year", F.year("date").cast("long")).select("ticker", "year", "date", "v"), ["year"], [F.desc("v"), F.col("ticker"), F.col("date")], 5), "rank"), "SELECT ticker, year, date, v, rank FROM (SELECT ticker, year(date) AS year, date, v, row_number() OVER (PARTITION BY year(date) ORDER BY v DESC, ticker, date) AS rank FROM daily_li) WHERE rank <= 5")
ACTIVITY = WATCH + ", act AS (SELECT a.*, u AS n_unique, u * ln(n_days) AS diversity FROM (SELECT ticker, count(*) AS n_days, sum(event_count)::BIGINT AS total_events, min(date) AS first_day, max(date) AS last_day FROM watch GROUP BY 1) a JOIN (SELECT ticker, count(DISTINCT event_type) AS u FROM ev GROUP BY 1) USING (ticker))\n"
query("ag16_ticker_activity", lambda s, d: rounded(long_(R.ticker_activity(watch(s, d)), "span_days")), ACTIVITY + "SELECT ticker, n_days, total_events, first_day, last_day, n_unique, last_day - first_day AS span_days, round(diversity, 6) AS diversity FROM act")
query("tk6_stratified_pick", lambda s, d: long_(U.stratified_pick(R.ticker_activity(watch(s, d)), {"high": 3, "mid": 3, "low": 2}).select("ticker", "stratum", "rank"), "rank"), ACTIVITY + "SELECT * FROM (SELECT ticker, stratum, row_number() OVER (PARTITION BY stratum ORDER BY diversity DESC, ticker) AS rank FROM (SELECT ticker, diversity, CASE WHEN n_days > (SELECT quantile_cont(n_days, 0.67) FROM act) THEN 'high' WHEN n_days > (SELECT quantile_cont(n_days, 0.33) FROM act) THEN 'mid' ELSE 'low' END AS stratum FROM act)) WHERE rank <= CASE stratum WHEN 'low' THEN 2 ELSE 3 END")
query("tk7_extremes", lambda s, d: U.extremes(A.daily(s, d), "v", ["ticker", "date"]), "(SELECT 'max' AS kind, ticker, date, v FROM daily ORDER BY v DESC, ticker, date LIMIT 1) UNION ALL (SELECT 'min', ticker, date, v FROM daily ORDER BY v, ticker, date LIMIT 1)")
query("tk8_sample_n", lambda s, d: U.sample_n(A.daily(s, d), ["ticker", "date"], 100).select("ticker", "date"), """
SELECT ticker, date FROM daily ORDER BY md5(concat_ws('|', '42', ticker, date::VARCHAR)), ticker, date LIMIT 100""")
query("so1_union_diagonal", lambda s, d: U.union_diagonal([A.details(s, d).select("ticker", "cik"), A.universe(s, d).select("ticker", "type")]), "SELECT ticker, cik, NULL AS type FROM details UNION ALL SELECT ticker, NULL, type FROM universe")
query("so2_distinct_on", lambda s, d: U.distinct_on(A.filings(s, d), ["ticker", "form"], [F.desc("filing_date")]), "SELECT ticker, form, max(filing_date) AS filing_date FROM filings GROUP BY 1, 2")
query("so3_merge_tickers", lambda s, d: U.merge_tickers(A.details(s, d), A.filings(s, d)), "SELECT ticker FROM details UNION SELECT ticker FROM filings")
query("so4_top_overlap", lambda s, d: rounded(U.top_overlap(A.details(s, d), A.universe(s, d).filter("active"))), "SELECT count(*) FILTER (a.ticker IS NOT NULL AND b.ticker IS NOT NULL) AS both, count(*) FILTER (b.ticker IS NULL) AS only_a, count(*) FILTER (a.ticker IS NULL) AS only_b, round(count(*) FILTER (a.ticker IS NOT NULL AND b.ticker IS NOT NULL) * 100.0 / count(a.ticker), 6) AS match_pct FROM details a FULL JOIN (SELECT * FROM universe WHERE active) b ON a.ticker = b.ticker")
query("so5_hybrid_universe", lambda s, d: U.hybrid_universe(A.universe(s, d), A.details(s, d), 5e6).select("ticker", "active"), "SELECT ticker, active FROM universe WHERE NOT active OR ticker IN (SELECT ticker FROM details WHERE market_cap < 5e6)")
query("so8_duplicated_rows", lambda s, d: duplicated_rows(A.filings(s, d), ["ticker", "form"]).groupBy("ticker", "form").agg(F.max("copies").alias("copies")), "SELECT ticker, form, count(*) AS copies FROM filings GROUP BY 1, 2 HAVING count(*) > 1")

# ---- dimensions and joins -------------------------------------------------------------------------
query("sd3_scd2_from_snapshots", lambda s, d: A.cap_dim(s, d), "SELECT * FROM cap_dim")
query("sd5_scd2_integrity", lambda s, d: S.scd2_integrity(A.cap_dim(s, d)), "SELECT ticker, count(*) FILTER (e < f) AS reversed, count(*) FILTER (n > e) AS gaps, count(*) FILTER (n < e) AS overlaps, count(*) FILTER (n = f) AS repeated, count(*) FILTER (e = DATE '2099-12-31') AS open_rows FROM (SELECT ticker, effective_from AS f, effective_to AS e, lead(effective_from) OVER (PARTITION BY ticker ORDER BY effective_from) AS n FROM cap_dim) GROUP BY 1")
query("sd6_current_view", lambda s, d: S.current_view(A.cap_dim(s, d)), "SELECT * FROM cap_dim WHERE effective_to = DATE '2099-12-31'")
query("sd6_as_of", lambda s, d: S.as_of(A.cap_dim(s, d), "1998-06-15"), "SELECT * FROM cap_dim WHERE effective_from <= DATE '1998-06-15' AND effective_to > DATE '1998-06-15'")
query("sd1_sd2_merge", lambda s, d: long_(S.scd2_merge(
    S.scd2_initial(A.customer_caps(s, d, 1997).withColumn("snapshot_date", F.lit("1998-01-01"))), A.customer_caps(s, d, 1998), "1999-01-01", ["market_cap", "shares_outstanding"], True), "version"), """,
p AS (SELECT 'C' || o_custkey AS ticker, floor(max(o_totalprice) / 100000) AS market_cap, count(*)::DOUBLE AS shares_outstanding FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1),
q AS (SELECT 'C' || o_custkey AS ticker, floor(max(o_totalprice) / 100000) AS market_cap, count(*)::DOUBLE AS shares_outstanding FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1),
b AS (SELECT p.ticker AS t, q.ticker AS u, p.market_cap AS pm, p.shares_outstanding AS ps, q.market_cap AS qm, q.shares_outstanding AS qs, p.market_cap IS NOT DISTINCT FROM q.market_cap AND p.shares_outstanding IS NOT DISTINCT FROM q.shares_outstanding AS same FROM p FULL JOIN q ON p.ticker = q.ticker)
SELECT t AS ticker, pm AS market_cap, ps AS shares_outstanding, DATE '1998-01-01' AS effective_from, CASE WHEN u IS NULL OR NOT same THEN DATE '1999-01-01' END AS effective_to, 1::BIGINT AS version FROM b WHERE t IS NOT NULL
UNION ALL SELECT u, qm, qs, DATE '1999-01-01', NULL, CASE WHEN t IS NULL THEN 1 ELSE 2 END FROM b WHERE u IS NOT NULL AND (t IS NULL OR NOT same)""")


def stored_dimension(s, d):
    """The customers' caps of each year, merged into a stored dimension year by year."""
    dim = StoredDimension(s, scratch_folder(s, "dimension"), T._parse_datatype_string("market_cap double, shares_outstanding double"), buckets=4)
    for year in (*range(1992, 1999), 1998):  # the last one twice
        caps = A.customer_caps(s, d, year).select("ticker", F.col("market_cap").cast("double").alias("market_cap"), F.col("shares_outstanding").cast("double").alias("shares_outstanding"))
        dim.merge(caps, f"{year + 1}-01-01", close_absent=True)
    return dim.rows()


query("sd2_stored_dimension", lambda s, d: long_(stored_dimension(s, d), "version"), """,
c AS (SELECT 'C' || o_custkey AS ticker, year(o_orderdate) AS y, floor(max(o_totalprice) / 100000)::DOUBLE AS market_cap, count(*)::DOUBLE AS shares_outstanding FROM orders WHERE year(o_orderdate) BETWEEN 1992 AND 1998 GROUP BY 1, 2),
m AS (SELECT *, coalesce(lag(y) OVER w = y - 1 AND market_cap IS NOT DISTINCT FROM lag(market_cap) OVER w AND shares_outstanding IS NOT DISTINCT FROM lag(shares_outstanding) OVER w, false) AS goes_on FROM c WINDOW w AS (PARTITION BY ticker ORDER BY y)),
r AS (SELECT *, sum((NOT goes_on)::INT) OVER (PARTITION BY ticker ORDER BY y) AS run FROM m),
u AS (SELECT ticker, market_cap, shares_outstanding, min(y) AS a, max(y) AS b FROM r GROUP BY ticker, run, market_cap, shares_outstanding),
k AS (SELECT *, coalesce(lag(b) OVER w = a - 1, false) AS follows FROM u WINDOW w AS (PARTITION BY ticker ORDER BY a)),
h AS (SELECT *, sum((NOT follows)::INT) OVER (PARTITION BY ticker ORDER BY a) AS chain FROM k)
SELECT ticker, market_cap, shares_outstanding, make_date(a + 1, 1, 1) AS effective_from, CASE WHEN b < 1998 THEN make_date(b + 2, 1, 1) END AS effective_to,
  row_number() OVER (PARTITION BY ticker, chain ORDER BY a) AS version FROM h""")
query("jn1_asof_dim_join", lambda s, d: J.asof_dim_join(A.cache_li(s, d).select("ticker", "trading_day"), A.cap_dim(s, d)), "SELECT a.ticker, trading_day, market_cap AS market_cap_d FROM cache a LEFT JOIN cap_dim b ON a.ticker = b.ticker AND effective_from <= trading_day AND trading_day < effective_to")
lapped = lambda s, d: A.cap_dim(s, d).withColumn("effective_to", F.when(F.month("effective_from") % 3 == 0, F.date_add("effective_from", 10)).otherwise(F.date_add("effective_to", 100)))
query("jn1_asof_overlapping", lambda s, d: J.asof_dim_join(A.cache_li(s, d).select("ticker", "trading_day"), lapped(s, d)), """,
lapped AS (SELECT ticker, effective_from, CASE WHEN month(effective_from) % 3 = 0 THEN effective_from + 10 ELSE effective_to + 100 END AS effective_to, market_cap FROM cap_dim)
SELECT ticker, trading_day, market_cap AS market_cap_d FROM (SELECT a.ticker, trading_day, market_cap, row_number() OVER (PARTITION BY a.ticker, trading_day ORDER BY effective_from DESC NULLS LAST) AS k
  FROM cache a LEFT JOIN lapped b ON a.ticker = b.ticker AND effective_from <= trading_day AND trading_day < effective_to) WHERE k = 1""")
query("jn2_latest_dim_join", lambda s, d: J.latest_dim_join(A.cache_li(s, d).select("ticker", "trading_day"), A.cap_dim(s, d)), "SELECT ticker, trading_day, (SELECT arg_max(market_cap, effective_from) FROM cap_dim b WHERE b.ticker = a.ticker AND market_cap IS NOT NULL) AS market_cap FROM cache a")
query("jn4_events_lineage", lambda s, d: J.events_lineage(labels_of(s, d).select("ticker", (F.col("anchor_ts") + F.col("bar_no") % 2).alias("anchor_ts")), bars_of(s, d)), "SELECT ticker, anchor_ts + bar_no % 2 AS anchor_ts FROM labels_ a WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.ticker = a.ticker AND b.t_close = anchor_ts + bar_no % 2)")
rets = lambda s, d: forward_returns(A.daily(s, d)).select("ticker", "date", *R.HORIZONS)
RETS = ", rets AS (SELECT ticker, date, " + ", ".join(f"lead(c, {k}) OVER w / nullif(c, 0) - 1 AS ret_{k}d" for k in (1, 3, 5, 10)) + " FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY date))\n"
signals = lambda s, d: J.signals_with_returns(watch(s, d), rets(s, d))
query("jn5_signals_with_returns", lambda s, d: rounded(signals(s, d).select("ticker", "date", "ret_1d", "ret_10d")), WATCH + RETS + "SELECT ticker, date, round(ret_1d, 6) AS ret_1d, round(ret_10d, 6) AS ret_10d FROM watch JOIN rets USING (ticker, date)")
query("jn6_event_window_join", lambda s, d: long_(J.event_window_join(found(s, d), A.daily(s, d).select("ticker", "date", "n")), "rel_day"), WATCH + "SELECT e.ticker, e.date AS event_date, event_type, d.date - e.date AS rel_day, d.date, n FROM ev e JOIN daily d ON d.ticker = e.ticker AND d.date BETWEEN e.date - 3 AND e.date + 3")
query("jn7_semi_universe", lambda s, d: J.semi_universe(A.details(s, d), A.universe(s, d).filter("active")).select("ticker"), "SELECT ticker FROM details WHERE ticker IN (SELECT ticker FROM universe WHERE active)")
query("jn8_missing", lambda s, d: J.missing(A.universe(s, d), A.details(s, d), ["ticker"]).select("ticker"), "SELECT ticker FROM universe WHERE ticker NOT IN (SELECT ticker FROM details)")
query("jn9_corporate_actions", lambda s, d: J.corporate_actions_lookup(A.filings(s, d).select("ticker").distinct(), A.filings(s, d).filter("form = 'S-3'"), A.filings(s, d).filter("form = '8-K'")), "SELECT ticker, count(*) FILTER (form = 'S-3') AS n_splits, count(*) FILTER (form = '8-K') AS n_dividends, count(*) FILTER (form = 'S-3') > 0 AS has_splits, count(*) FILTER (form = '8-K') > 0 AS has_dividends FROM filings GROUP BY 1")
query("jn10_enrich_universe", lambda s, d: J.enrich_universe(A.universe(s, d).select("ticker", "active"), A.details(s, d)), "SELECT ticker, active, CASE WHEN active THEN market_cap END AS market_cap, CASE WHEN active THEN cik END AS cik FROM universe LEFT JOIN details USING (ticker)")
ours = lambda s, d: A.minutes(s, d).select("ticker", F.timestamp_micros("t").alias("t"), "o", "h", "l", (F.col("c") * (1 + F.pmod("n", F.lit(3)) / 100)).alias("c"), "v")
ref = lambda s, d: A.minutes(s, d).select("ticker", F.timestamp_micros("t").alias("t"), "o", "h", "l", "c", "v")
query("jn11_compare_bars", lambda s, d: rounded(J.compare_bars(ref(s, d), ours(s, d), 0.015)), "SELECT ticker, count(*) AS n, round(avg((x <= 0.015)::INT), 6) AS match_rate, round(avg(x), 6) AS mean_price_diff, round(quantile_cont(x, 0.95), 6) AS p95_price_diff, count(*) FILTER (x > 0.015) AS breaks FROM (SELECT ticker, abs(c * (1 + (n % 3) / 100) - c) / CASE WHEN abs(c) < 1e-12 THEN 1 ELSE abs(c) END AS x FROM minutes) GROUP BY 1")
query("jn12_compare_daily", lambda s, d: J.compare_daily(A.daily(s, d).withColumn("c", F.col("c") * (1 + (F.col("n") % 2) / 100)).withColumn("v", F.col("v") + F.col("n") % 3 * 10), A.daily(s, d)).transform(rounded), """
SELECT ticker, date, round(p, 6) AS price_pct, round(q, 6) AS volume_pct, CASE WHEN p <= 0.10 AND q <= 3 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  SELECT ticker, date, abs(c * (1 + (n % 2) / 100) - c) / CASE WHEN abs(c) < 1e-12 THEN 1 ELSE abs(c) END * 100 AS p, n % 3 * 10 / v * 100 AS q FROM daily)""")
three = lambda s, d: A.daily(s, d).select("ticker", "date", "c", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")).select(F.concat(F.lit("v"), F.col("k").cast("string")).alias("source"), "ticker", "date", (F.col("c") + F.col("k") * F.col("k")).alias("c"))
query("jn13_consensus_bars", lambda s, d: rounded(J.consensus_bars(three(s, d), times=2.5)), "SELECT ticker, date, round(c + 1, 6) AS median, 1.0::DOUBLE AS mad, 3::BIGINT AS n_sources, round(1 / 3, 6) AS outlier_share FROM daily")
#: Three sources on odd days and four on even ones, as far apart as the day's number of ticks says.
several = lambda s, d: A.daily(s, d).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3) - F.col("n") % 2))).select(
    F.concat(F.lit("v"), F.col("k").cast("string")).alias("source"), "ticker", "date", (F.col("v") + F.col("k") * F.col("k") * (F.col("n") % 4)).cast("double").alias("c"))
query("jn13_consensus_of_several", lambda s, d: rounded(J.consensus_bars(several(s, d), times=2.0)), """,
src AS (SELECT ticker, date, (v + k * k * (n % 4))::DOUBLE AS p FROM (SELECT *, unnest(range(0, 4 - n % 2)) AS k FROM daily)),
mid AS (SELECT ticker, date, quantile_cont(p, 0.5) AS median, count(*) AS n_sources FROM src GROUP BY 1, 2),
off AS (SELECT *, abs(p - median) AS o FROM src JOIN mid USING (ticker, date)),
mad AS (SELECT ticker, date, quantile_cont(o, 0.5) AS mad FROM off GROUP BY 1, 2)
SELECT ticker, date, round(any_value(median), 6) AS median, round(any_value(mad), 6) AS mad, any_value(n_sources) AS n_sources, round(avg((o > 2 * mad)::INT), 6) AS outlier_share
FROM off JOIN mad USING (ticker, date) GROUP BY 1, 2""")
PTI_GIVEN = {"mc_max": 1e6, "float_max": 60.0, "pmin": 900.0, "pmax": 1400.0, "volmin": 60.0, "chgmin": 0.10}  # about the data's own size
exchange = lambda: F.when(F.col("ticker") < "S3", "NASDAQ").when(F.col("ticker") < "S6", "NYSE MKT").when(F.col("ticker") < "S8", "OTC")
pti_cache = lambda s, d: A.cache_li(s, d).select("ticker", F.col("trading_day").alias("date"), F.col("close_d").alias("close"), F.col("vol_d").alias("volume"), F.col("pctchg_d").alias("pct_chg"), (F.col("session_rows") * 300).alias("shares_out"), (F.col("vol_d") / 2).alias("float_est"), exchange().alias("exchange"))
PTI_SQL = """SELECT * FROM (SELECT f.ticker, f.date, CASE WHEN c.ticker IS NOT NULL THEN round(close_d * session_rows * 300, 6) END AS market_cap, CASE WHEN c.ticker IS NULL THEN 'missing daily_cache' ELSE concat_ws('+',
  CASE WHEN close_d * session_rows * 300 > 1e6 THEN 'market_cap' END, CASE WHEN vol_d / 2 > 60 THEN 'float' END, CASE WHEN close_d < 900 OR close_d > 1400 THEN 'price' END, CASE WHEN vol_d < 60 THEN 'volume' END,
  CASE WHEN coalesce(abs(pctchg_d), 0) < 0.10 THEN 'change' END, CASE WHEN NOT (f.ticker < 'S6') THEN 'exchange' END) END AS reasons
FROM (SELECT DISTINCT ticker, filing_date AS date FROM filings) f LEFT JOIN cache c ON c.ticker = f.ticker AND c.trading_day = f.date) WHERE reasons <> ''"""
query("jn14_pti_universe", lambda s, d: rounded(J.pti_universe_check(A.filings(s, d).select("ticker", F.col("filing_date").alias("date")), pti_cache(s, d), PTI_GIVEN).select("ticker", "date", "market_cap", F.array_join("reasons", "+").alias("reasons"))), PTI_SQL)
query("jn15_filings_coverage", lambda s, d: J.filings_coverage(A.filings(s, d), A.cache_li(s, d)), "SELECT DISTINCT ticker, filing_date AS trading_day, form FROM filings f WHERE form IN ('S-3', '424B') AND NOT EXISTS (SELECT 1 FROM cache c WHERE c.ticker = f.ticker AND c.trading_day = f.filing_date)")
query("ag22_imputed_cap", lambda s, d: rounded(J.imputed_cap(A.cap_dim(s, d), A.daily_li(s, d))), """,
m AS (SELECT d.ticker, effective_from, median(c * shares_outstanding) AS m, count(*) AS k FROM cap_dim d JOIN daily_li b ON b.ticker = d.ticker AND b.date >= effective_from AND b.date < effective_to GROUP BY 1, 2),
z AS (SELECT ticker, median(c) AS lc FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS q FROM daily_li) WHERE q <= 30 GROUP BY 1)
SELECT ticker, effective_from, effective_to, round(coalesce(market_cap, CASE WHEN coalesce(k, 0) >= 5 THEN m ELSE lc * shares_outstanding END), 6) AS market_cap, shares_outstanding, market_cap IS NULL AS imputed FROM cap_dim LEFT JOIN m USING (ticker, effective_from) LEFT JOIN z USING (ticker)""")

# ---- reports --------------------------------------------------------------------------------------
query("ag6_count_by", lambda s, d: R.count_by(A.filings(s, d), form=F.col("form"), year=F.year("filing_date").cast("long")), "SELECT form, year(filing_date) AS year, count(*) AS n FROM filings GROUP BY 1, 2")
query("ag7_nunique_by", lambda s, d: R.nunique_by(A.daily_li(s, d), F.year("date").cast("long"), "year", "ticker"), "SELECT year(date) AS year, count(DISTINCT ticker) AS n FROM daily_li GROUP BY 1")
PROFILE = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls, count(*) AS rows, round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75 FROM cache" for c in ("rvol30", "pctchg_d"))
query("ag8_profile", lambda s, d: rounded(R.profile(A.cache_li(s, d), ["rvol30", "pctchg_d"])), PROFILE)
query("ag9_completeness", lambda s, d: rounded(R.completeness(A.snapshots(s, d), ["market_cap", "ticker"])), " UNION ALL ".join(f"SELECT '{c}' AS field, count({c}) AS n, round(count({c}) * 100.0 / count(*), 6) AS pct FROM snapshots" for c in ("market_cap", "ticker")))
query("ag10_quantile_report", lambda s, d: rounded(R.quantile_report(A.cache_li(s, d), "pctchg_d", [0.01, 0.5, 0.99], F.year("trading_day").cast("string"))), "SELECT year(trading_day)::VARCHAR AS period, round(quantile_cont(pctchg_d, 0.01), 6) AS p01, round(quantile_cont(pctchg_d, 0.5), 6) AS p50, round(quantile_cont(pctchg_d, 0.99), 6) AS p99, round(avg(pctchg_d), 6) AS mean, round(stddev_samp(pctchg_d), 6) AS std, count(*) FILTER (pctchg_d > 0) AS up, count(*) FILTER (pctchg_d < 0) AS down, count(*) FILTER (pctchg_d = 0) AS flat FROM cache GROUP BY 1")
query("ag11_outlier_counts", lambda s, d: long_(R.outlier_counts(A.cache_li(s, d), "rvol30", (1, 2, 3)), "above"), " UNION ALL ".join(f"SELECT {e}::BIGINT AS above, count(*) FILTER (rvol30 > {e}) AS n FROM cache" for e in (1, 2, 3)))
query("ag12_yearly_density", lambda s, d: rounded(long_(R.yearly_density(A.daily_li(s, d)), "year")), "SELECT year(date) AS year, sum(k)::BIGINT AS total, count(*) AS days, round(avg(k), 6) AS mean, median(k) AS median, max(k) AS most FROM (SELECT date, count(DISTINCT ticker) AS k FROM daily_li GROUP BY 1) GROUP BY 1")
query("ag13_event_stats", lambda s, d: rounded(R.event_stats(E.detect(A.daily(s, d), "E2"))), f", e AS (SELECT ticker, (o - prev_c) / prev_c AS value FROM runs WHERE (o - prev_c) / prev_c >= 0.1) SELECT '{E.EVENTS['E2']}' AS event_type, count(*) AS n, round(min(value), 6) AS min, round(avg(value), 6) AS mean, round(max(value), 6) AS max, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, round(count(*) / count(DISTINCT ticker), 6) AS per_ticker FROM e")
STATS = "count(*) AS n, count(*) FILTER (ret > 0) AS wins, round(avg(ret), 6) AS mean, round(stddev_samp(ret), 6) AS std"
RATES = "round(count(*) FILTER (ret > 0) / count(*), 6) AS win_rate, round(coalesce(avg(ret) / nullif(stddev_samp(ret), 0), 0), 6) AS sharpe"
query("ag14_forward_performance", lambda s, d: rounded(R.forward_performance(signals(s, d).withColumn("event_type", F.explode("events")), "event_type")), WATCH + RETS + ", sig AS (SELECT unnest(events) AS event_type, rets.* FROM watch JOIN rets USING (ticker, date))" + f"SELECT event_type, horizon, {STATS}, round(min(ret), 6) AS min, round(max(ret), 6) AS max, {RATES} FROM (" + " UNION ALL ".join(f"SELECT event_type, '{h}' AS horizon, {h} AS ret FROM sig WHERE {h} IS NOT NULL" for h in R.HORIZONS) + ") GROUP BY 1, 2")
query("ag15_pair_performance", lambda s, d: rounded(R.pair_performance(signals(s, d))), WATCH + RETS + f", sig AS (SELECT DISTINCT ev.*, ret_3d AS ret FROM ev JOIN rets USING (ticker, date) WHERE ret_3d IS NOT NULL) SELECT first, second, {STATS}, {RATES} FROM (SELECT a.event_type AS first, b.event_type AS second, a.ret FROM sig a JOIN sig b ON a.ticker = b.ticker AND a.date = b.date AND a.event_type < b.event_type) GROUP BY 1, 2 HAVING count(*) >= 10")
KINDS = [E.EVENTS[k] for k in ("E2", "E3", "E8", "E9")]
query("ag17_pivot_counts", lambda s, d: R.pivot_counts(found(s, d), KINDS).withColumn("year", F.col("year").cast("long")), WATCH + "SELECT year(date) AS year, " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS \"{k}\"" for k in KINDS) + " FROM ev GROUP BY 1")
query("ag18_cooccurrence", lambda s, d: rounded(R.cooccurrence_corr(watch(s, d), KINDS)), WATCH + " UNION ALL ".join(f"SELECT '{a.split('_')[0]}' AS a, '{b.split('_')[0]}' AS b, round(corr(list_contains(events, '{a}')::INT, list_contains(events, '{b}')::INT), 6) AS corr FROM watch" for i, a in enumerate(KINDS) for b in KINDS[i + 1 :]))
query("ag19_gini", lambda s, d: rounded(R.gini(A.daily(s, d).select("ticker", F.trunc("date", "MM").alias("date"), F.col("v").cast("double").alias("weight")))), "SELECT ticker, date, round(sum((2 * i - n - 1) * w) / (any_value(n) * sum(w)), 6) AS gini FROM (SELECT ticker, date_trunc('month', date)::DATE AS date, v + 1e-18 AS w, row_number() OVER (PARTITION BY ticker ORDER BY v) AS i, count(*) OVER (PARTITION BY ticker) AS n FROM daily) GROUP BY 1, 2")
query("ag23_set_windows", lambda s, d: R.set_intersection_windows(A.filings(s, d).select("ticker", F.col("form").alias("window"))), "SELECT windows, count(*) AS tickers FROM (SELECT ticker, count(DISTINCT form) AS windows FROM filings GROUP BY 1) GROUP BY 1")
query("ag24_ticker_event_stats", lambda s, d: rounded(R.ticker_event_stats(A.cache_li(s, d)), 5), "SELECT ticker, count(*) AS n, round(avg(rvol30), 5) AS mean_rvol, round(avg(abs(pctchg_d)), 5) AS mean_change, round(avg(dollar_vol_d), 5) AS mean_dollar, round(avg(close_d), 5) AS mean_price FROM cache GROUP BY 1")
query("ag25_label_returns", lambda s, d: rounded(R.label_returns(labels_of(s, d))), "SELECT label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct, round(avg(ret_at_outcome), 6) AS mean, round(stddev_samp(ret_at_outcome), 6) AS std FROM labels_ GROUP BY 1")

# ---- statistics -----------------------------------------------------------------------------------
two = lambda s, d: A.daily(s, d).select((F.col("n") % 4).alias("x"), (F.col("v") % 5).alias("y"))
CELLS = ", g AS (SELECT n % 4 AS x, v % 5 AS y, count(*) AS k FROM daily GROUP BY 1, 2), gm AS (SELECT *, sum(k) OVER (PARTITION BY x) AS kx, sum(k) OVER (PARTITION BY y) AS ky, sum(k) OVER () AS t FROM g)\n"
query("ag20_contingency_mi", lambda s, d: rounded(I.contingency_mi(two(s, d), "x", "y")), CELLS + "SELECT round(sum(k / t * ln(k * t / (kx * ky))), 6) AS mi FROM gm")
query("st_mi1_equal_width_bin", lambda s, d: long_(I.equal_width_bin(A.daily(s, d), "v").select("ticker", "date", "v_bin"), "v_bin"), "SELECT ticker, date, greatest(0, least(9, ceil((v - lo) / ((hi - lo) / 10.0)) - 1))::BIGINT AS v_bin FROM daily, (SELECT min(v) AS lo, max(v) AS hi FROM daily)")
query("st_mi4_normalized_mi", lambda s, d: rounded(I.normalized_mi(two(s, d), "x", "y")), CELLS + ", h AS (SELECT sum(k / t * ln(k * t / (kx * ky))) AS mi, -sum(k / t * ln(kx / t)) AS hx, -sum(k / t * ln(ky / t)) AS hy FROM gm) SELECT round(mi, 6) AS mi, round(hx, 6) AS hx, round(hy, 6) AS hy, round(mi / ((hx + hy) / 2), 6) AS nmi FROM h")
query("st_mi2_mutual_info", lambda s, d: rounded(I.mutual_info(A.daily(s, d), ["v", "n"], "c")), ", u AS (SELECT 'v' AS f, v::DOUBLE AS x, c AS y FROM daily UNION ALL SELECT 'n', n, c FROM daily), b AS (SELECT f, greatest(0, least(9, ceil((x - min(x) OVER w) / ((max(x) OVER w - min(x) OVER w) / 10)) - 1)) AS x, greatest(0, least(9, ceil((y - min(y) OVER w) / ((max(y) OVER w - min(y) OVER w) / 10)) - 1)) AS y FROM u WINDOW w AS (PARTITION BY f)), c AS (SELECT f, x, y, count(*) AS k FROM b GROUP BY ALL), m AS (SELECT *, sum(k) OVER (PARTITION BY f, x) AS kx, sum(k) OVER (PARTITION BY f, y) AS ky, sum(k) OVER (PARTITION BY f) AS t FROM c) SELECT round(avg(mi), 6) AS mi, count(*) AS features FROM (SELECT f, sum(k / t * ln(k * t / (kx * ky))) AS mi FROM m GROUP BY 1)")


def mi3(s, d):
    days = materialise(A.daily(s, d), "days")
    return I.mi_by_relative_day(E.detect_all(days, SHORT).select("ticker", "date", "event_type"), days.select("ticker", "date", "v", "n"), days, ["v", "n"])


MI3 = WATCH + """,
base AS (SELECT e.ticker, e.date, event_type, b.c / nullif(a.c, 0) - 1 AS ret FROM ev e JOIN daily a ON a.ticker = e.ticker AND a.date = e.date JOIN daily b ON b.ticker = e.ticker AND b.date = e.date + 3),
rel AS (SELECT event_type, rel_day, ret, f.v, f.n FROM base, (SELECT unnest(range(-3, 4))::INT AS rel_day) JOIN daily f ON f.ticker = base.ticker AND f.date = base.date + rel_day),
long AS (SELECT event_type, rel_day, 'v' AS f, v::DOUBLE AS x, ret AS y FROM rel WHERE ret IS NOT NULL UNION ALL SELECT event_type, rel_day, 'n', n, ret FROM rel WHERE ret IS NOT NULL),
ranges AS (SELECT *, count(*) OVER g AS rows_, min(x) OVER g AS x0, max(x) OVER g AS x1, min(y) OVER g AS y0, max(y) OVER g AS y1 FROM long WINDOW g AS (PARTITION BY event_type, rel_day, f)),
cut AS (SELECT event_type, rel_day, f, CASE WHEN x0 = x1 THEN 5 ELSE greatest(0, least(9, ceil((x - x0) / ((x1 - x0) / 10)) - 1)) END AS x, CASE WHEN y0 = y1 THEN 5 ELSE greatest(0, least(9, ceil((y - y0) / ((y1 - y0) / 10)) - 1)) END AS y FROM ranges WHERE rows_ > 10),
cells AS (SELECT event_type, rel_day, f, x, y, count(*) AS k FROM cut GROUP BY ALL),
margins AS (SELECT *, sum(k) OVER (PARTITION BY event_type, rel_day, f, x) AS kx, sum(k) OVER (PARTITION BY event_type, rel_day, f, y) AS ky, sum(k) OVER (PARTITION BY event_type, rel_day, f) AS t FROM cells),
each AS (SELECT event_type, rel_day, f, greatest(0, sum(k / t * ln(k * t / (kx * ky)))) AS mi FROM margins GROUP BY 1, 2, 3),
mean AS (SELECT event_type, rel_day, avg(mi) AS mi FROM each GROUP BY 1, 2),
mi3 AS (SELECT event_type, rel_day::BIGINT AS rel_day, count(*) AS n_rows, CASE WHEN count(*) >= 50 THEN coalesce(any_value(mi), 0) ELSE 0 END AS mi FROM rel LEFT JOIN mean USING (event_type, rel_day) GROUP BY 1, 2),
mi6 AS (SELECT *, coalesce(mi / nullif(max(mi) OVER (PARTITION BY event_type), 0), 0) AS nmi FROM mi3)
"""
query("st_mi3_mi_by_relative_day", lambda s, d: rounded(long_(mi3(s, d), "rel_day")), MI3 + "SELECT event_type, rel_day, n_rows, round(mi, 6) AS mi FROM mi3")
query("st_mi5_suggest_window", lambda s, d: long_(long_(I.suggest_window(mi3(s, d)), "first_day"), "last_day"), MI3 + "SELECT event_type, min(rel_day) AS first_day, max(rel_day) AS last_day FROM mi6 WHERE nmi >= 0.1 GROUP BY 1")
query("st_mi6_mi_scale", lambda s, d: rounded(long_(I.mi_scale(mi3(s, d)), "rel_day")), MI3 + "SELECT event_type, rel_day, n_rows, round(mi, 6) AS mi, round(nmi, 6) AS nmi FROM mi6")
joined = lambda s, d: J.event_window_join(found(s, d), labels_of(s, d).drop("t1"))
query("st_ed1_window_grid", lambda s, d: I.window_grid(joined(s, d)).groupBy("event_type", F.col("pre_days").cast("long").alias("pre_days"), F.col("post_days").cast("long").alias("post_days")).agg(F.count("*").alias("n")), WATCH + ", grid(pre_days, post_days) AS (VALUES (0, 0), (1, 0), (0, 1), (1, 1), (2, 1), (1, 2), (2, 2), (3, 1), (1, 3), (3, 2), (2, 3), (3, 3)) SELECT event_type, pre_days::BIGINT AS pre_days, post_days::BIGINT AS post_days, count(*) AS n FROM ev e JOIN labels_ l ON l.ticker = e.ticker AND l.date BETWEEN e.date - 3 AND e.date + 3 JOIN grid ON l.date - e.date BETWEEN -pre_days AND post_days GROUP BY 1, 2, 3")
GRID_FEATURES = ["vol_at_anchor", "rel_day", "bar_no", "span"]


def grid_models(s, d):
    """A model of every event and window; whether its scores lie where they must."""
    rows = joined(s, d).withColumn("weight", F.lit(1.0)).withColumn("span", F.col("end_bar") - F.col("bar_no"))
    rows = materialise(rows.select("event_type", "rel_day", "ticker", "date", "bar_no", "span", "vol_at_anchor", "label", "ret_at_outcome", "weight"), "grid")
    keys = ["event_type", "pre_days", "post_days"]
    made = window_models(rows, GRID_FEATURES, keys, trees=5, depth=3, rate=0.3, windows=I.WINDOWS)
    ends = rows.groupBy("event_type", "rel_day").agg(F.min("ret_at_outcome").alias("low"), F.max("ret_at_outcome").alias("high"))
    ends = I.window_grid(ends).groupBy(*keys).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    inside = F.col("edge").isNull() | (F.col("edge") == 0) | F.col("edge").between(F.col("low") - 1e-9, F.col("high") + 1e-9)
    return made.join(ends, keys).select(
        "event_type", *[F.col(c).cast("long").alias(c) for c in keys[1:]], "n_bars", "n_days", F.col("auc").isNotNull().alias("scored"),
        F.coalesce(F.col("auc").between(0.5, 1), F.lit(True)).alias("auc_ok"), inside.alias("edge_ok"),
    )


query("st_ed2_window_models", grid_models, WATCH + """,
grid(pre_days, post_days) AS (VALUES (0, 0), (1, 0), (0, 1), (1, 1), (2, 1), (1, 2), (2, 2), (3, 1), (1, 3), (3, 2), (2, 3), (3, 3))
SELECT event_type, pre_days::BIGINT AS pre_days, post_days::BIGINT AS post_days, count(*) AS n_bars, count(DISTINCT (l.ticker, l.date)) AS n_days,
  count(*) >= 100 AND count(DISTINCT label > 0) = 2 AS scored, true AS auc_ok, true AS edge_ok
FROM ev e JOIN labels_ l ON l.ticker = e.ticker JOIN grid ON l.date BETWEEN e.date - pre_days::INT AND e.date + post_days::INT GROUP BY 1, 2, 3""")
query("st_ed3_weighted_edge", lambda s, d: rounded(I.weighted_edge(labels_of(s, d).withColumn("prob", (F.col("bar_no") % 2).cast("double")).withColumn("weight", F.lit(1.0) + F.col("bar_no")), ["ticker"])), "SELECT ticker, round(sum(ret_at_outcome * (1 + bar_no)) FILTER (bar_no % 2 = 1) / sum(1 + bar_no) FILTER (bar_no % 2 = 1), 6) AS edge, count(*) AS n_bars FROM labels_ GROUP BY 1")
pairs = lambda s, d: A.daily(s, d).groupBy("ticker").agg(F.avg("v").alias("mi"), F.avg("c").alias("edge"))
PAIRS = ", pr AS (SELECT ticker, avg(v) AS mi, avg(c) AS edge FROM daily GROUP BY 1), rk2 AS (SELECT *, rank() OVER (ORDER BY mi) + (count(*) OVER (PARTITION BY mi) - 1) / 2 AS a, rank() OVER (ORDER BY edge) + (count(*) OVER (PARTITION BY edge) - 1) / 2 AS b FROM pr)\n"
query("st_co1_spearman", lambda s, d: rounded(I.spearman(pairs(s, d))), PAIRS + "SELECT n, round(rho, 6) AS rho, round(rho * sqrt((n - 2) / (1 - rho * rho)), 6) AS t FROM (SELECT count(*) AS n, corr(a, b) AS rho FROM rk2)")
query("st_co2_hybrid_score", lambda s, d: rounded(I.hybrid_score(pairs(s, d)).select("ticker", "hybrid", "selected")), PAIRS + ", hy AS (SELECT ticker, 0.6 * (mi - min(mi) OVER ()) / (max(mi) OVER () - min(mi) OVER () + 1e-10) + 0.4 * (edge - min(edge) OVER ()) / (max(edge) OVER () - min(edge) OVER () + 1e-10) AS hybrid FROM pr) SELECT ticker, round(hybrid, 6) AS hybrid, hybrid >= (SELECT quantile_cont(hybrid, 0.8) FROM hy) AS selected FROM hy")
query("st_co3_concordance", lambda s, d: rounded(I.concordance_report(pairs(s, d))), PAIRS + "SELECT count(*) AS n_windows, " + ", ".join(f"round({f}({c}), 6) AS {n}_{c}" for c in ("mi", "edge") for n, f in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max"))) + ", round(corr(a, b), 6) AS rho, CASE WHEN corr(a, b) > 0.7 THEN 'strong' WHEN corr(a, b) > 0.4 THEN 'moderate' ELSE 'weak' END AS concordance FROM rk2")

# ---- quality --------------------------------------------------------------------------------------
query("qc1_inventory", lambda s, d: Q.inventory({"ticks": A.ticks(s, d), "early": A.daily(s, d).filter("v > 700")}), "SELECT ticker, date, true AS has_ticks, v > 700 AS has_early FROM daily")
query("qc2_schema", lambda s, d: Q.schema_check(A.snapshots(s, d), {"ticker": "string", "market_cap": "bigint", "absent": "date"}), "SELECT 'ticker' AS \"column\", 'string' AS type, true AS present, true AS type_ok, count(*) FILTER (ticker IS NULL) AS nulls FROM snapshots UNION ALL SELECT 'market_cap', 'bigint', true, false, count(*) FILTER (market_cap IS NULL) FROM snapshots UNION ALL SELECT 'absent', 'date', false, false, NULL")
query("qc3_conservation", lambda s, d: rounded(Q.tick_bar_conservation(A.ticks(s, d), bars_of(s, d).withColumn("v", F.when((F.dayofmonth("date") == 5) & (F.col("bar_no") == 0), 0).otherwise(F.col("v"))))), """
SELECT ticker, date, round(lost / greatest(1, v), 6) AS volume_error, 0.0::DOUBLE AS dollar_error, lost / greatest(1, v) <= 0.001 AS ok
FROM daily JOIN (SELECT ticker, date, coalesce(sum(v) FILTER (day(date) = 5 AND bar_no = 0), 0) AS lost FROM bars GROUP BY 1, 2) USING (ticker, date)""")
lost_dollars = lambda s, d: bars_of(s, d).withColumn("dollar", F.when(F.col("bar_no") % 3 == 1, 0.0).otherwise(F.col("dollar")))
query("qc3_lost_dollars", lambda s, d: rounded(Q.tick_bar_conservation(A.ticks(s, d), lost_dollars(s, d))), """
SELECT ticker, date, 0.0::DOUBLE AS volume_error, round(lost / greatest(1, dollar), 6) AS dollar_error, lost / greatest(1, dollar) <= 0.001 AS ok
FROM daily JOIN (SELECT ticker, date, coalesce(sum(dollar) FILTER (bar_no % 3 = 1), 0) AS lost FROM bars GROUP BY 1, 2) USING (ticker, date)""")
query("qc4_label_logic", lambda s, d: rounded(Q.label_logic(labels_of(s, d))), "SELECT *, round(greatest(n_down, n_flat, n_up) / n, 6) AS max_share, greatest(n_down, n_flat, n_up) / n <= 0.9 AND both_hit = 0 AND reversed = 0 AS ok FROM (SELECT count(*) AS n, count(*) FILTER (pt_hit AND sl_hit) AS both_hit, count(*) FILTER (t1 < anchor_ts) AS reversed, count(*) FILTER (label = -1) AS n_down, count(*) FILTER (label = 0) AS n_flat, count(*) FILTER (label = 1) AS n_up FROM labels_)")
whole_days = lambda s, d: A.daily(s, d).select("ticker", "date", "v", F.when(F.col("n") % 7 != 0, F.col("n")).alias("n"))
query("qc8_content_hash", lambda s, d: Q.content_hash(whole_days(s, d), ["date"]).withColumn("sum", F.col("sum").cast("long")), r"""
SELECT date, count(*) AS n, bit_xor(h) AS xor, sum(h % (1::BIGINT << 40))::BIGINT AS sum
FROM (SELECT date, ('0x' || substr(md5(date::VARCHAR || '|' || coalesce(CASE WHEN n % 7 <> 0 THEN n END::VARCHAR, '\N') || '|' || ticker || '|' || v::VARCHAR), 1, 15))::BIGINT AS h FROM daily)
GROUP BY date""")
changed_days = lambda s, d: whole_days(s, d).withColumn("v", F.col("v") + (F.dayofmonth("date") % 5 == 0).cast("long") * (F.col("ticker") == "T3").cast("long"))
query("qc8_reproducible", lambda s, d: Q.reproducible(whole_days(s, d), changed_days(s, d), ["date"]), "SELECT DISTINCT date FROM daily WHERE day(date) % 5 = 0 AND ticker = 'T3'")
query("ag24_count_histogram", lambda s, d: R.count_histogram(A.daily(s, d)).withColumn("from_n", F.col("from_n").cast("long")), """
SELECT CASE WHEN n >= 100 THEN 100 WHEN n >= 50 THEN 50 WHEN n >= 20 THEN 20 WHEN n >= 10 THEN 10 WHEN n >= 5 THEN 5 WHEN n >= 2 THEN 2 WHEN n >= 1 THEN 1 ELSE 0 END::BIGINT AS from_n, count(*) AS tickers FROM daily GROUP BY 1""")
query("so1_union_relaxed", lambda s, d: U.union_relaxed([A.daily(s, d).select("ticker", "date", "n"), A.daily_li(s, d).select("n", "date", "ticker")]).groupBy("ticker").agg(F.count("*").alias("days"), F.sum("n").alias("n")), """
SELECT ticker, count(*) AS days, sum(n)::BIGINT AS n FROM (SELECT ticker, date, n FROM daily UNION ALL SELECT ticker, date, n FROM daily_li) GROUP BY 1""")
query("qc9_split_purge", lambda s, d: Q.split_purge(walk_forward_split(labels_of(s, d))).select("train", "valid", "purged", "ok"), "SELECT greatest(n * 4 // 5 - 50, 0) AS train, n - n * 4 // 5 AS valid, n * 4 // 5 - greatest(n * 4 // 5 - 50, 0) AS purged, true AS ok FROM (SELECT count(*) AS n FROM labels_)")
cert = lambda s, d: labels_of(s, d).select(F.concat(F.lit("L"), F.col("label")).alias("event_type"), "anchor_ts", (F.col("anchor_ts") - F.col("bar_no") * 10**6).alias("start_ts"), F.col("t1").alias("end_ts"))
query("qc10_events_order", lambda s, d: Q.events_order(cert(s, d).withColumn("start_ts", F.col("start_ts") + 3 * 10**6)), "SELECT 'L' || label AS event_type, anchor_ts, anchor_ts - bar_no * 1000000 + 3000000 AS start_ts, t1 AS end_ts FROM labels_ WHERE NOT (bar_no >= 3 AND anchor_ts <= t1)")
query("qc12_repeated_events", lambda s, d: rounded(Q.repeated_events(cert(s, d).union(cert(s, d)))), "SELECT 'L' || label AS event_type, 2 * count(*) AS n, 0.5::DOUBLE AS share, true AS ok FROM labels_ GROUP BY 1")
query("qc13_ohlc_rules", lambda s, d: Q.ohlc_rules(A.daily_li(s, d).withColumn("h", F.when(F.col("n") == 3, F.col("l") - 1).otherwise(F.col("h")))), "SELECT count(*) AS n, count(*) FILTER (n = 3) AS high_below, 0::BIGINT AS low_above, count(*) FILTER (n = 3) AS high_below_low, count(*) FILTER (c <= 0) AS no_price, 0::BIGINT AS negative_volume, 0::BIGINT AS no_volume, 0::BIGINT AS repeated FROM daily_li")
off_days = lambda s, d: A.daily(s, d).withColumns({
    "o": F.col("o") + (F.col("n") % 7 == 0).cast("int"), "h": F.col("h") + (F.col("n") % 5 == 0).cast("int"), "l": F.col("l") - (F.col("n") % 4 == 0).cast("int"), "c": F.col("c") - (F.col("n") % 3 == 0).cast("int")})
query("qc14_prices_that_are_off", lambda s, d: Q.aggregation_check(A.minutes(s, d), off_days(s, d)), "SELECT ticker, date FROM daily WHERE n % 7 = 0 OR n % 5 = 0 OR n % 4 = 0 OR n % 3 = 0")
query("qc14_aggregation_check", lambda s, d: Q.aggregation_check(A.minutes(s, d), A.daily(s, d).withColumn("v", F.col("v") + (F.col("n") % 2))), "SELECT ticker, date FROM daily WHERE n % 2 = 1")
query("qc17_timestamp_sanity", lambda s, d: Q.timestamp_sanity(A.ticks(s, d).withColumn("t_unit", F.when(F.col("seq") % 10 == 0, "ns").otherwise("us"))).select("seq"), "SELECT seq FROM ticks WHERE seq % 10 = 0")
query("qc18_month_coverage", lambda s, d: Q.month_coverage(A.daily_li(s, d), "1994-06-01", "1997-12-31"), "SELECT ticker, count(DISTINCT date_trunc('month', date)) FILTER (date BETWEEN '1994-06-01' AND '1997-12-31') AS present, 43::BIGINT AS expected, CASE WHEN count(DISTINCT date_trunc('month', date)) FILTER (date BETWEEN '1994-06-01' AND '1997-12-31') = 43 THEN 'full' ELSE 'partial' END AS status FROM daily_li GROUP BY 1")
query("qc20_event_file", lambda s, d: Q.event_file_check(found(s, d).withColumn("ticker", F.when(F.dayofmonth("date") != 7, F.col("ticker"))), ["ticker", "date", "event_type", "value"], ["ticker", "event_type"]), WATCH + """
SELECT sum(k)::BIGINT AS rows, sum(k) FILTER (ticker IS NULL)::BIGINT AS null_keys, sum(k) FILTER (k > 1)::BIGINT AS repeated, false AS columns_ok
FROM (SELECT ticker, event_type, count(*) AS k FROM (SELECT CASE WHEN day(date) <> 7 THEN ticker END AS ticker, event_type FROM ev) GROUP BY 1, 2)""")
query("qc22_alphabet", lambda s, d: Q.alphabet_coverage(A.universe(s, d)), "SELECT chr(65 + i::INT) AS letter FROM range(26) t(i) WHERE chr(65 + i::INT) NOT IN (SELECT upper(substr(ticker, 1, 1)) FROM universe)")
query("qc23_verdict_no_go", lambda s, d: Q.verdict(A.filings(s, d).groupBy("ticker").agg((F.count_if(F.col("form") == "S-3") > 0).alias("ok"))), "SELECT count(*) AS checks, count(*) FILTER (k = 0) AS failed, CASE WHEN count(*) FILTER (k = 0) = 0 THEN 'GO' ELSE 'NO-GO' END AS verdict FROM (SELECT ticker, count(*) FILTER (form = 'S-3') AS k FROM filings GROUP BY 1)")
query("qc23_verdict", lambda s, d: Q.verdict(A.filings(s, d).groupBy("form").agg((F.count("*") > 0).alias("ok"))), "SELECT count(DISTINCT form) AS checks, 0::BIGINT AS failed, 'GO' AS verdict FROM filings")

# ---- sources and shaping --------------------------------------------------------------------------
query("io2_read_range", lambda s, d: io.read_range(s, f"{d}/orders.parquet", "1997-01-01", "1997-12-31", ["o_orderkey", "o_totalprice"], "o_orderdate"), "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate BETWEEN '1997-01-01' AND '1997-12-31'")
query("io6_merge_idempotent", lambda s, d: io.merge_idempotent(A.filings(s, d).filter("form <> '8-K'"), A.filings(s, d).withColumn("form", F.lit("new")).filter("ticker < 'S5'"), ["ticker", "filing_date"], [F.col("form")]), "SELECT ticker, CASE WHEN ticker < 'S5' THEN 'new' ELSE min(form) END AS form, filing_date FROM filings WHERE ticker < 'S5' OR form <> '8-K' GROUP BY ticker, filing_date")
query("io7_pending", lambda s, d: io.pending_partitions(A.daily(s, d).select("ticker", "date"), A.daily(s, d).filter("v > 700"), ["ticker", "date"]), "SELECT ticker, date FROM daily WHERE v <= 700")
query("io9_manifest", lambda s, d: rounded(io.manifest(A.snapshots(s, d), "as_of", "market_cap")), "SELECT count(*) AS rows, count(DISTINCT ticker) AS tickers, count(DISTINCT as_of) AS days, min(as_of) AS first_day, max(as_of) AS last_day, round(count(market_cap) * 100.0 / count(*), 6) AS coverage_pct FROM snapshots")
query("nr1_time_unit", lambda s, d: N.detect_time_unit(A.ticks(s, d).drop("t_unit").withColumn("t", F.col("t_raw") * F.when(F.dayofmonth("date") % 2 == 0, 1000).otherwise(1)).drop("t_raw")).select("seq", "t_unit", "t_raw"), "SELECT seq, CASE WHEN day(date) % 2 = 0 THEN 'ns' ELSE 'us' END AS t_unit, t_raw * CASE WHEN day(date) % 2 = 0 THEN 1000 ELSE 1 END AS t_raw FROM ticks")
query("nr2_event_time", lambda s, d: N.to_event_time(A.ticks(s, d).drop("ts").withColumn("t_raw", F.col("t_raw") * F.when(F.col("seq") % 2 == 0, 1000).otherwise(1))).select("seq", F.unix_micros("ts").alias("us")), "SELECT seq, t_raw AS us FROM ticks")
#: Letters, marks, digits and joiners by Unicode: RE2's own \\b knows ASCII only. A word alone between bounds is a whole run of these.
WORD_SQL = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}\x{24B6}-\x{24E9}\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}\x{1F170}-\x{1F189}"


def hits_sql(pattern: str) -> str:
    text = "lower(coalesce(text, ''))"
    if pattern.startswith(r"\b"):
        return f"len(list_filter(regexp_split_to_array({text}, '[^{WORD_SQL}]+'), lambda w: w = '{pattern[2:-2]}'))"
    return f"len(regexp_extract_all({text}, '{pattern}'))"


PATTERNS = {"the": r"\bthe\b", "shout": "!!", "es": r"\bde\b"}
query("nr9_keyword_flags", lambda s, d: N.keyword_flags(A.table(s, d, "documents").select("doc_id", "text"), PATTERNS).select("doc_id", *[F.coalesce(F.get_json_object("keyword_flags", f"$.{k}").cast("long"), F.lit(0)).alias(f"n_{k}") for k in PATTERNS]), "SELECT doc_id, " + ", ".join(f"{hits_sql(p)} AS n_{k}" for k, p in PATTERNS.items()) + " FROM documents")
query("nr17_cik_mapping", lambda s, d: N.cik_mapping(A.details(s, d), A.universe(s, d)), "SELECT ticker, lpad(cik, 10, '0') AS cik FROM details")
query("nr18_eligible_trades", lambda s, d: N.eligible_trades(A.table(s, d, "lineitem").withColumn("cond", F.concat("l_returnflag", "l_linestatus")), ["a", "n"], ["o"]).groupBy("cond").agg(F.count("*").alias("n")), "SELECT l_returnflag || l_linestatus AS cond, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_linestatus <> 'O' GROUP BY 1")
query("nr19_normalize_ids", lambda s, d: A.details(s, d).select(N.normal_ticker(F.lower("ticker")).alias("ticker"), N.normal_cik(F.concat(F.lit("no. "), "cik")).alias("cik")), "SELECT ticker, lpad(cik, 10, '0') AS cik FROM details")
