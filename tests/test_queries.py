"""Registered market queries against DuckDB on the smallest tables, and edge frames of the operators."""

import datetime as dt
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from tickloom.functions import ordering
from tickloom.operators import bars, detectors, joins, labels, quality, scd, windows
from tickloom.plans import registry
from tickloom.sources import io, normalize

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()
CHECKED = (
    "gap_watchlist", "ag1_minute_to_daily", "ag21_daily_quality", "wn7_streaks", "wn11_ema", "wn13_percentile_score", "e2_gap_up", "e4_parabolic", "e7_first_red_day",
    "ev5_fuse_watchlist", "br2_dollar_bars", "br6_imbalance_bars", "br7_imbalance_reset", "lb2_triple_barrier", "wt1_concurrency", "wt2_sample_weights", "ds3_walk_forward",
    "sd1_sd2_merge", "jn1_asof_dim_join", "jn6_event_window_join", "st_co1_spearman", "st_mi2_mutual_info", "qc1_inventory", "qc4_label_logic",
    "fp7_price_bins", "fp7_cap_bins", "tk3_topn_snapshots", "tk6_stratified_pick", "jn1_asof_overlapping", "jn14_pti_universe", "jn15_filings_coverage", "ag22_imputed_cap", "st_ed1_window_grid",
    "st_mi3_mi_by_relative_day", "st_ed4_window_score", "br4_dollar_bars_multi_day", "br5_volume_bars_multi_day", "io1_read_parquet_tree", "io3_read_delimited", "io4_vendor_json", "io5_write_partitioned",
    "io8_write_csv_topk", "nr3_normalize_minute", "nr3_normalize_daily", "nr4_normalize_trades", "nr5_normalize_quotes", "nr6_flatten_financials", "nr7_ticker_events", "nr8_parse_filings", "nr10_short_volume",
    "nr11_fails", "nr12_vendor_bars", "nr13_clean_splits", "nr14_clean_dividends", "nr15_normalize_snapshot", "nr16_ensure_columns", "qc5_weight_stats", "qc6_point_in_time", "qc7_filings_coverage",
    "qc11_events_lineage", "qc15_cache_checks", "qc16_recompute", "qc19_weights_sanity", "qc21_split_ratios", "qc24_watchlist_consistency", "sd4_shares_coalesce", "st1_stream_ticks", "st2_stream_minute_bars",
    "st3_stream_dedup", "st3_merge_newest", "st4_stream_triggers", "st5_stream_dollar_bars", "st6_stream_spike", "st7_eod_update",
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return round(float(value), 5)
    return value


@pytest.mark.parametrize("name", CHECKED)
def test_query_is_its_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    want = duck.sql(registry.oracle_sql()[name])
    order = [want.columns.index(c) for c in columns]
    want = sorted((tuple(plain(row[i]) for i in order) for row in want.fetchall()), key=str)
    assert got == want


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_detectors_on_edges(spark):
    rows = [("A", day(i), o, max(o, c) * 1.2, min(o, c), c, 100) for i, (o, c) in enumerate([(1.0, 1.1), (1.1, 1.2), (1.2, 1.6), (1.6, 1.6), (1.6, 1.5), (0.0, 1.0), (1.15, 1.0)])]
    rows += [("B", day(0), 1.0, 1.0, 1.0, 1.0, 0)]
    daily = spark.createDataFrame(rows, "ticker string, date date, o double, h double, l double, c double, v long")
    found = {(r.ticker, r.date, r.event_type) for r in detectors.detect_all(daily, ("E2", "E3", "E6", "E7", "E8")).collect()}
    assert ("A", day(2), "E6_MultipleGreenDays") in found and not [f for f in found if f[0] == "B"]
    assert not [f for f in found if f[2].startswith("E7")]  # the doji on day 3 ends the run
    assert ("A", day(5), "E8_GapDownViolent") in found and ("A", day(6), "E2_GapUp") in found
    assert ("A", day(5), "E3_PriceSpikeIntraday") not in found  # opens at 0


def test_bar_kernels():
    import numpy as np

    assert bars.reset_bars(np.array([5, 5, 1, 20, 3]), 10).tolist() == [0, 0, 1, 1, 2]
    assert bars.reset_bars(np.array([]), 10).tolist() == []
    assert bars.signed_reset_ids(np.array([0, 1, 1, -1]), np.array([9, 5, 5, 10]), 10).tolist() == [0, 0, 0, 1]
    up, down = labels.first_hits(np.array([1, 3, 1.0]), np.array([1, 0, 1.0]), np.array([2, 9, 9.0]), np.array([0.5, 0, 0]), 5)
    assert up.tolist() == [1, 0, 0] and down.tolist() == [0, 0, 0]  # the high is tested first


def test_golden_split(spark):
    n, folds, purge = 1_622_333, 5, 50
    df = labels.walk_forward_split(spark.range(n).select(F.col("id").alias("anchor_ts")), folds, purge, ("anchor_ts",))
    counts = {r.part: r["count"] for r in df.groupBy("part").count().collect()}
    assert counts == {"train": 1_297_816, "valid": 324_467, "purged": 50}


def test_dimension_join_keeps_days_without_a_cap(spark):
    daily = spark.createDataFrame([("A", day(i)) for i in range(6)] + [("B", day(1))], "ticker string, trading_day date")
    dim = spark.createDataFrame([("A", day(1), day(3), 5.0), ("A", day(3), day(4), None), ("A", day(5), None, 7.0)], "ticker string, effective_from date, effective_to date, market_cap double")
    got = {(r.ticker, r.trading_day): r.market_cap_d for r in joins.asof_dim_join(daily, dim).collect()}
    assert [got["A", day(i)] for i in range(6)] == [None, 5.0, 5.0, None, None, 7.0] and got["B", day(1)] is None


def test_scd_is_null_safe(spark):
    snaps = spark.createDataFrame([("A", day(i), c) for i, c in enumerate([None, None, 1.0, None])], "ticker string, as_of date, market_cap double")
    rows = scd.scd2_from_snapshots(snaps, ("market_cap",)).orderBy("effective_from").collect()
    assert [(r.effective_from, r.market_cap) for r in rows] == [(day(0), None), (day(2), 1.0), (day(3), None)]


def test_zscore_of_a_constant_is_zero(spark):
    df = spark.createDataFrame([("A", day(i), 1.0) for i in range(25)], "ticker string, date date, x double")
    assert {r.x_z for r in windows.rolling_zscore(df, "x").collect()} == {0.0}


def test_overlapping_spans_of_a_dimension(spark):
    """A newer, shorter span that has ended gives way to the older one still in force."""
    spans = [(0, None, 5.0), (2, 4, 9.0), (3, 3, 1.0), (8, 10, None), (9, None, 7.0)]
    dim = spark.createDataFrame([("A", day(a), b and day(b), c) for a, b, c in spans] + [("B", day(1), day(2), 1.0), ("B", day(2), day(3), 2.0)], "ticker string, effective_from date, effective_to date, market_cap double")
    daily = spark.createDataFrame([(t, day(i)) for t in "AB" for i in range(12)], "ticker string, trading_day date")
    got = {(r.ticker, r.trading_day): r.market_cap_d for r in joins.asof_dim_join(daily, dim).collect()}
    assert [got["A", day(i)] for i in range(12)] == [5.0, 5.0, 9.0, 9.0, 5.0, 5.0, 5.0, 5.0, None, 7.0, 7.0, 7.0]
    assert [got["B", day(i)] for i in range(4)] == [None, 1.0, 2.0, None]


def test_vendor_shapes(spark):
    bar = '"open": "1", "high": "2", "low": "0.5", "close": "1.5", "volume": "10"'
    shapes = {
        "alphavantage": ('{"Time Series (1min)": {"t1": {"1. open": "1", "2. high": "2", "3. low": "0.5", "4. close": "1.5", "5. volume": "10"}}}', "t1"),
        "twelvedata": ('{"values": [{"datetime": "t1", %s}]}' % bar, "t1"), "polygon": ('{"results": [{"t": 1704067200000001000, "o": 1, "h": 2, "l": 0.5, "c": 1.5, "v": 10}]}', "2024-01-01 00:00:00.000001Z"),
        "fmp": ('[{"date": "t1", %s}]' % bar, "t1"), "another": ('{"data": [{"time": "t1", %s}]}' % bar, "t1"),
    }
    for vendor, (text, ts) in shapes.items():
        row = io.vendor_bars(spark.createDataFrame([(text,), ("{}",), (None,)], "value string"), vendor).collect()[0]
        assert (row.ts, *[float(row[c]) for c in "ohlcv"]) == (ts, 1.0, 2.0, 0.5, 1.5, 10.0)


def test_multi_day_bars_in_any_batches(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    part = pd.DataFrame({"t_raw": np.arange(400), "p": rng.integers(1, 9, 400).astype(float), "s": rng.integers(1, 20, 400)})
    size = part["s"].to_numpy(np.int64)
    whole, end = bars.extend_bars(None, part, size, 90, part["p"].to_numpy() * size)
    for step in (1, 7, 399):
        carry, pieces = None, []
        for at in range(0, 400, step):
            cut = part.iloc[at : at + step]
            closed, carry = bars.extend_bars(carry, cut, cut["s"].to_numpy(np.int64), 90, cut["p"].to_numpy() * cut["s"].to_numpy())
            pieces.append(closed)
        pieces = [p for p in pieces if len(p)]
        pd.testing.assert_frame_equal(pd.concat(pieces).reset_index(drop=True)[list(bars.OPEN[:11])], whole.reset_index(drop=True)[list(bars.OPEN[:11])], check_dtype=False)
        assert carry == end


def test_filings_and_skipped_hours(spark):
    text = '{"accessionNumber": ["a", "b"], "form": ["S-3", "8-K"], "filingDate": ["2024-01-02", "2024-01-03"], "reportDate": ["", "2024-01-01"], "items": ["", ""]}'
    frame = spark.createDataFrame([("1", "A", text)], "cik string, ticker string, json string")
    rows = normalize.parse_filings(frame, "2024-01-01", "2024-12-31", ["S-3"]).collect()
    assert len(rows) == 1 and rows[0].report_date is None and rows[0]["items"] is None
    times = spark.createDataFrame([("2024-03-10 02:30:00", "1", "1", "1", "1", "x"), ("2024-03-11 10:00:00", "1", "1", "1", "1", "5")], "ts string, o string, h string, l string, c string, v string")
    rows = normalize.normalize_vendor_bars(times).collect()
    assert len(rows) == 1 and rows[0].volume == 5 and rows[0].t == dt.datetime(2024, 3, 11, 14, 0)
    # an hour that the zone has twice is ambiguous, the hours around it are not; a time with its zone is what it says
    hours = [("2024-11-03 00:59:00", 4), ("2024-11-03 01:30:00", None), ("2024-11-03 02:00:00", 7), ("2024-11-03 01:30:00Z", 1), ("nonsense", None)]
    times = spark.createDataFrame([(t, "1", "1", "1", "1", "5") for t, _ in hours], "ts string, o string, h string, l string, c string, v string")
    assert sorted(r.t.hour for r in normalize.normalize_vendor_bars(times).collect()) == sorted(h for _, h in hours if h is not None)


def test_grouped_quantiles_are_exact(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [("a", float(x)) for x in rng.integers(0, 9, 400)] + [("b", float(x)) for x in rng.normal(size=7)] + [("c", 1.5), ("d", None), ("b", None)]
    frame = spark.createDataFrame(rows, "g string, x double").repartition(5)
    wanted = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = {r.g: r.q for r in ordering.grouped_quantiles(frame, ["g"], "x", wanted).collect()}
    assert set(got) == {"a", "b", "c"}
    for g in got:
        assert np.allclose(got[g], np.quantile([x for k, x in rows if k == g and x is not None], wanted))
    assert ordering.grouped_quantiles(frame.limit(0), ["g"], "x", wanted).count() == 0


def test_synonyms_keep_other_columns(spark):
    frame = spark.createDataFrame([("20240105", "X", 5, 3.5, "q")], "`Settlement Date` string, Ticker string, Fails long, `Last Price` double, note string")
    row = normalize.normalize_ftd(frame).first().asDict()
    assert row == {"settlement_date": "2024-01-05", "symbol": "X", "quantity_fails": 5.0, "price": 3.5, "note": "q"}
    row = normalize.normalize_short_volume(spark.createDataFrame([("d", 1.0, "z")], "date string, shortsalevolume double, note string")).first().asDict()
    assert row == {"tradeDate": "d", "shortVolume": 1.0, "note": "z", "symbol": None, "totalVolume": None}


def test_repeated_events_need_no_window(spark):
    rows = [("a", 1, 2, 1), ("a", 1, 2, 2), ("a", None, 2, 1), ("a", None, 2, 1), ("a", 3, 4, 3), ("b", 1, 2, 1)]
    out = quality.repeated_events(spark.createDataFrame(rows, "event_type string, start_ts long, end_ts long, anchor_ts long"))
    assert sorted(map(tuple, out.collect())) == [("a", 5, 0.4, True), ("b", 1, 0.0, True)]
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
