"""Registered queries of certification checks, window models and share counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import information as I, quality as Q, scd as S
from tickloom.plans import adapters as A
from tickloom.plans.market import WATCH, bars_of, labels_of, query, rounded, watch, weights_of

# ---- weights, lineage, filings, universe ----------------------------------------------------------
query("qc5_weight_stats", lambda s, d: rounded(Q.weight_stats(weights_of(s, d).withColumn("weight", F.col("weight") * F.when(F.dayofmonth("date") == 7, 2).otherwise(1)), most=0.5)), """,
w AS (SELECT ticker, date, weight * CASE WHEN day(date) = 7 THEN 2 ELSE 1 END AS weight FROM weights_),
g AS (SELECT ticker, date, sum(weight) AS total, sum((2 * i - n - 1) * (weight + 1e-18)) / (any_value(n) * sum(weight + 1e-18)) AS gini FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY weight) AS i, count(*) OVER (PARTITION BY ticker, date) AS n FROM w) GROUP BY 1, 2)
SELECT count(*) AS groups, count(*) FILTER (abs(total - 1) > 1e-6) AS bad_sums, round(avg(gini), 6) AS mean_gini, count(*) FILTER (abs(total - 1) > 1e-6) = 0 AND avg(gini) <= 0.5 AS ok FROM g""")
days = lambda s, d: A.cache_li(s, d).select("ticker", F.col("trading_day").alias("date"))
query("qc6_point_in_time", lambda s, d: Q.point_in_time(days(s, d), pti(s, d), {"pmin": 900.0, "pmax": 1400.0, "volmin": 60.0, "chgmin": 0.10}), """
SELECT count(*) AS checked, count(*) FILTER (ok) AS passed, false AS ok FROM (
  SELECT close_d BETWEEN 900 AND 1400 AND vol_d >= 60 AND coalesce(abs(pctchg_d), 0) >= 0.10 AND ticker < 'S8' AS ok FROM cache)""")
pti = lambda s, d: A.cache_li(s, d).select("ticker", F.col("trading_day").alias("date"), F.col("close_d").alias("close"), F.col("vol_d").alias("volume"), F.col("pctchg_d").alias("pct_chg"), F.lit(10).alias("shares_out"), F.col("vol_d").alias("float_est"), F.when(F.col("ticker") < "S8", "NYSE").alias("exchange"))
query("qc7_filings_coverage", lambda s, d: Q.filings_covered(A.filings(s, d), A.cache_li(s, d)), """
SELECT count(*) AS checked, count(*) FILTER (c.ticker IS NULL) AS missing, count(*) FILTER (c.ticker IS NULL) = 0 AS ok
FROM (SELECT DISTINCT ticker, filing_date, form FROM filings WHERE form IN ('S-3', '424B')) f LEFT JOIN cache c ON c.ticker = f.ticker AND c.trading_day = f.filing_date""")
anchors = lambda s, d: labels_of(s, d).select("ticker", (F.col("anchor_ts") + (F.col("bar_no") % 2)).alias("anchor_ts"))
query("qc11_events_lineage", lambda s, d: Q.lineage(anchors(s, d), bars_of(s, d)), """
SELECT count(*) AS checked, count(*) FILTER (bar_no % 2 = 1 AND NOT EXISTS (SELECT 1 FROM bars b WHERE b.ticker = l.ticker AND b.t_close = l.anchor_ts + 1)) AS orphans,
  count(*) FILTER (bar_no % 2 = 1 AND NOT EXISTS (SELECT 1 FROM bars b WHERE b.ticker = l.ticker AND b.t_close = l.anchor_ts + 1)) = 0 AS ok FROM labels_ l""")

# ---- caches ---------------------------------------------------------------------------------------
stored = lambda s, d: A.daily(s, d).select("ticker", F.col("date").alias("trading_day"), (F.col("v") + F.when(F.col("n") % 5 == 0, F.col("v"))
                                          .otherwise(0)).alias("vol_d"), F.col("n").alias("session_rows"), (F.col("n") < 20).alias("has_gaps"))
query("qc15_cache_checks", lambda s, d: Q.cache_checks(stored(s, d), A.minutes(s, d), 18), """,
w AS (SELECT ticker, min(date) AS a, max(date) AS b, count(*) AS days, count(*) FILTER (n % 5 = 0) AS bad_volume, count(*) FILTER ((n < 20) <> (n < 18)) AS bad_flags FROM daily GROUP BY 1),
k AS (SELECT ticker, (SELECT count(*) FROM range(a, b + 1, INTERVAL 1 DAY) AS t(x) WHERE isodow(x) <= 5) AS weekdays FROM w)
SELECT ticker, days, weekdays, bad_volume, bad_flags, abs(days / weekdays - 1) <= 0.05 AS coverage_ok, bad_volume = 0 AND bad_flags = 0 AND abs(days / weekdays - 1) <= 0.05 AS ok FROM w JOIN k USING (ticker)""")
spoilt = lambda s, d: A.cache_li(s, d).withColumn("rvol30", F.col("rvol30") + F.when(F.col("session_rows") % 4 == 0, 0.01).otherwise(0.0)).withColumn("market_cap_d", F.when(F.col("session_rows") > 1, F.col("close_d")))
query("qc16_recompute", lambda s, d: rounded(Q.recompute_features(spoilt(s, d))), """
SELECT count(*) AS n, count(*) FILTER (session_rows % 4 = 0) AS bad_rvol, 0::BIGINT AS bad_change, round(count(*) FILTER (session_rows > 1) * 100.0 / count(*), 6) AS cap_pct, round(min(close_d), 6) AS low, round(max(close_d), 6) AS high FROM cache""")
ill = lambda s, d: weights_of(s, d).withColumn("weight", F.when(F.col("bar_no") % 5 == 0, None).when(F.col("bar_no") % 5 == 1, -1.0).when(F.col("bar_no") % 5 == 2, float("inf")).otherwise(F.col("weight")))
query("qc19_weights_sanity", lambda s, d: Q.weights_sanity(ill(s, d), labels_of(s, d)), """
SELECT count(*) AS rows, count(*) FILTER (bar_no % 5 = 0) AS nulls, count(*) FILTER (bar_no % 5 = 1) AS negative, count(*) FILTER (bar_no % 5 = 2) AS not_finite, count(*) AS label_rows, false AS ok FROM weights_""")
query("qc21_split_ratios", lambda s, d: Q.split_ratios(A.table(s, d, "lineitem").select(F.concat(F.lit("P"), (F.col("l_partkey") % 97).cast("string")).alias("ticker"), (F.col("l_quantity") / (1 + F.col("l_linenumber") * 4)).alias("ratio"))), """
SELECT 'P' || (l_partkey % 97) AS ticker, count(*) AS n, count(*) FILTER (q < 0.1 OR q > 10) AS extreme, count(*) FILTER (q < 1) AS reverse, count(*) FILTER (q < 1) >= 5 AS many_reverse
FROM (SELECT l_partkey, l_quantity / (1 + l_linenumber * 4) AS q FROM lineitem) GROUP BY 1""")
EVENTS = {"E2": "E2_GapUp", "E8": "E8_GapDownViolent"}
fused = lambda s, d: watch(s, d).select(
    "ticker", "date", (F.col("event_count") + F.when(F.dayofmonth("date") == 9, 1).otherwise(0)).alias("num_events"), F.col("events").alias("event_types"),
    F.transform("events", lambda e: F.when(F.dayofmonth("date") == 11, "{").otherwise(F.concat(F.lit('{"type": "'), e, F.lit('"}')))).alias("details"),
    F.array_contains("events", EVENTS["E2"]).alias("has_e2"), (F.array_contains("events", EVENTS["E8"]) | (F.dayofmonth("date") == 13)).alias("has_e8"))
query("qc24_watchlist_consistency", lambda s, d: Q.watchlist_consistency(fused(s, d), EVENTS), WATCH + """
SELECT ticker, date FROM watch WHERE day(date) IN (9, 11) OR (day(date) = 13 AND NOT list_contains(events, 'E8_GapDownViolent'))""")

# ---- window models --------------------------------------------------------------------------------
modelled = lambda s, d: labels_of(s, d).join(bars_of(s, d).select("ticker", "date", "bar_no", "n", "imbalance_score", "dollar"), ["ticker", "date", "bar_no"]).withColumn("weight", F.lit(1.0))
query("st_ed2_window_model", lambda s, d: I.window_model(modelled(s, d), ["n", "imbalance_score", "dollar"], trees=10, depth=3))
results = lambda s, d: labels_of(s, d).groupBy(F.col("ticker").alias("event_type"), (F.col("bar_no") % 3).alias("pre_days"), (F.col("bar_no") % 2).alias("post_days")).agg(
    F.when(F.count("*") % 4 != 0, F.avg("ret_at_outcome")).alias("edge"), F.when(F.count("*") % 3 != 0, F.avg(F.col("pt_hit").cast("double"))).alias("auc"), F.count("*").alias("n_bars"))
query("st_ed4_window_score", lambda s, d: rounded(I.window_score(results(s, d)).select("event_type", "pre_days", "post_days", "score", F.col("rank").cast("long").alias("rank"), "best")), """,
res AS (SELECT ticker AS event_type, bar_no % 3 AS pre_days, bar_no % 2 AS post_days, CASE WHEN count(*) % 4 <> 0 THEN avg(ret_at_outcome) END AS edge, CASE WHEN count(*) % 3 <> 0 THEN avg(pt_hit::INT) END AS auc, count(*) AS n_bars FROM labels_ GROUP BY 1, 2, 3),
sc AS (SELECT *, CASE WHEN n_bars > 1 THEN abs(coalesce(edge, 0)) * coalesce(auc, 0.5) / ln(n_bars) ELSE 0 END AS score FROM res),
rk AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY score DESC, pre_days, post_days) AS rank FROM sc)
SELECT event_type, pre_days, post_days, round(score, 6) AS score, rank, rank = 1 AS best FROM rk""")

# ---- share counts ---------------------------------------------------------------------------------
counted = lambda s, d: A.table(s, d, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ticker"), F.when(F.col("p_size") % 3 == 0, F.col("p_size")).alias("share_class_shares_outstanding"), F.when(F.col("p_size") % 2 == 0, F.col("p_size") * 10).alias("weighted_shares_outstanding"))
query("sd4_shares_coalesce", lambda s, d: S.shares_coalesce(counted(s, d)).select("ticker", "shares_outstanding"), """
SELECT 'P' || p_partkey AS ticker, CASE WHEN p_size % 3 = 0 THEN p_size WHEN p_size % 2 = 0 THEN p_size * 10 END::DOUBLE AS shares_outstanding FROM part""")
