"""Streaming jobs give what the batch operators give on the same files."""

import datetime as dt

from pyspark.sql import functions as F

from tickloom.operators import universe, windows
from tickloom.plans import adapters
from tickloom.streaming import jobs
from tickloom.streaming.versions import VersionedTables

SF = "/root/testdata/sf0.001"


def test_minute_bars_of_a_stream(spark, tmp_path):
    ticks = adapters.ticks(spark, SF).select("ticker", "date", "seq", "t_raw", "p", "s", F.col("ts").cast("timestamp").alias("ts"))
    late = spark.createDataFrame([("Z", None, 10**9, 4102444800000000, 1.0, 1)], "ticker string, date date, seq long, t_raw long, p double, s long").withColumn("ts", F.timestamp_micros("t_raw"))
    ticks.write.parquet(f"{tmp_path}/in/a")
    ticks.write.mode("append").parquet(f"{tmp_path}/one")
    late.write.mode("append").parquet(f"{tmp_path}/one")
    stream = jobs.stream_minute_bars(jobs.stream_ticks(spark, f"{tmp_path}/one"))
    jobs.run_once(stream, f"{tmp_path}/out", f"{tmp_path}/ck")
    got = {(r.ticker, r.minute, r.o, r.c, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    at = F.struct("t_raw", "seq")
    want = ticks.groupBy("ticker", F.date_trunc("minute", "ts").alias("minute")).agg(F.min_by("p", at).alias("o"), F.max_by("p", at).alias("c"), F.count("*").alias("n"))
    assert got == {(r.ticker, r.minute, r.o, r.c, r.n) for r in want.collect()}


def landed(spark, folder, rows):
    """Rows appended to a landing folder as one more file."""
    frame = spark.createDataFrame(rows, "ticker string, date date, seq long, t_raw long, p double, s long").withColumn("ts", F.timestamp_micros("t_raw"))
    frame.coalesce(1).write.mode("append").parquet(folder)


def tick(seq, minutes, p, s=10, day=1):
    start = int(dt.datetime(2024, 1, day, 14, tzinfo=dt.timezone.utc).timestamp())
    return ("A", dt.date(2024, 1, day), seq, (start + minutes * 60) * 10**6, float(p), s)


def test_dollar_bars_over_batches_with_tail_and_late_rows(spark, tmp_path):
    inbox, out, ck = (f"{tmp_path}/{n}" for n in ("in", "out", "ck"))

    def run():
        with jobs.state_store(spark):
            jobs.run_once(jobs.stream_dollar_bars(jobs.stream_ticks(spark, inbox), 250.0), out, ck)
        return sorted((r.date.day, r.bar_no, r.o, r.c, r.n) for r in spark.read.schema(jobs.BARS).parquet(out).collect())

    landed(spark, inbox, [tick(2, 1, 11), tick(1, 0, 10), tick(3, 2, 12)])
    assert run() == [(1, 0, 10.0, 12.0, 3)]
    landed(spark, inbox, [tick(4, 30, 20)])  # an open bar
    assert run() == [(1, 0, 10.0, 12.0, 3)]
    landed(spark, inbox, [tick(5, 31, 21), tick(6, 0, 99)])  # the second is later than the watermark and has no part
    assert run() == [(1, 0, 10.0, 12.0, 3), (1, 1, 20.0, 21.0, 2)]
    landed(spark, inbox, [tick(7, 32, 5)])
    run()
    landed(spark, inbox, [tick(8, 0, 1, day=3)])  # the first day is over: its tail goes out
    landed(spark, inbox, [tick(9, 1, 1, day=3)])
    assert (1, 2, 5.0, 5.0, 1) in run()


def test_newest_rows_over_batches(spark, tmp_path):
    inbox, out, ck = (f"{tmp_path}/{n}" for n in ("in", "out", "ck"))

    def run():
        jobs.merge_newest(jobs.stream_ticks(spark, inbox), out, ["ticker", "date"], ck, ["t_raw", "seq"]).awaitTermination()
        return {(r.ticker, r.date.day): r.p for r in jobs.newest_version(spark, out).collect()}

    landed(spark, inbox, [tick(1, 5, 1), tick(2, 7, 2), tick(3, 6, 3)])
    assert run() == {("A", 1): 2.0}
    landed(spark, inbox, [tick(4, 6, 4), tick(5, 0, 5, day=2)])  # the older row of a later batch doesn't win
    assert run() == {("A", 1): 2.0, ("A", 2): 5.0}
    landed(spark, inbox, [tick(6, 8, 6)])
    assert run() == {("A", 1): 6.0, ("A", 2): 5.0}


def test_days_are_appended_with_their_features(spark, tmp_path):
    from tickloom.operators.windows import cache_features

    days = adapters.daily_li(spark, SF).select("ticker", F.col("date").alias("trading_day"), F.col("c").alias("close_d"), F.col("v").alias("vol_d")).cache()
    cut = dt.date(1998, 6, 30)
    inbox, out, ck = (f"{tmp_path}/{n}" for n in ("in", "out", "ck"))
    for part in (days.filter(F.col("trading_day") <= cut), days.filter(F.col("trading_day") > cut)):
        part.coalesce(1).write.mode("append").parquet(inbox)
        jobs.eod_update(jobs.stream_ticks(spark, inbox, days.schema), out, ck).awaitTermination()
    key = lambda r: (r.ticker, r.trading_day)
    got = {key(r): r for r in spark.read.parquet(out).collect()}
    want = {key(r): r for r in cache_features(days).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        for c in ("pctchg_d", "rvol30"):
            assert (got[k][c] is None) == (w[c] is None) and (w[c] is None or abs(got[k][c] - w[c]) < 1e-9)


def test_only_touched_buckets_are_rewritten_and_a_lost_batch_leaves_the_old_rows(spark, tmp_path):
    out = f"{tmp_path}/table"
    schema = "k long, at long, x double"
    tables = VersionedTables(spark, out, buckets=4)
    first = spark.createDataFrame([(k, 1, float(k)) for k in range(40)], schema)
    tables.commit(0, replaced={"rows": tables.write("rows", 0, first, ["k"])})
    files = lambda: {f.relative_to(tmp_path) for f in (tmp_path / "table" / "rows").rglob("*.parquet")}
    before = files()
    one = spark.createDataFrame([(7, 2, 70.0)], schema)
    touched = [r[0] for r in one.select(tables.bucket_of(["k"])).collect()]
    both = one.unionByName(tables.read("rows", first.schema, touched)).groupBy("k").agg(F.max_by(F.struct("k", "at", "x"), "at").alias("r")).select("r.*")
    written = tables.write("rows", 1, both, ["k"])
    assert written == touched and before <= files()
    value = lambda: {r.k: r.x for r in tables.read("rows", first.schema).collect()}
    assert value()[7] == 7.0  # lost before its commit: the old rows are seen
    written = tables.write("rows", 1, both, ["k"])  # it comes again
    tables.commit(1, replaced={"rows": written})
    assert value() == {k: 70.0 if k == 7 else float(k) for k in range(40)}
    assert VersionedTables(spark, out, buckets=9).buckets == 4
    two = spark.createDataFrame([(7, 3, 71.0)], schema)
    both = two.unionByName(tables.read("rows", first.schema, touched)).groupBy("k").agg(F.max_by(F.struct("k", "at", "x"), "at").alias("r")).select("r.*")
    tables.commit(2, replaced={"rows": tables.write("rows", 2, both, ["k"])})
    kept = {f.parent.relative_to(tmp_path / "table" / "rows").as_posix() for f in (tmp_path / "table" / "rows").rglob("*.parquet")}
    assert f"v=0/bucket={touched[0]}" not in kept and f"v=1/bucket={touched[0]}" in kept and len([k for k in kept if k.startswith("v=0")]) == 3
    assert value()[7] == 71.0 and tables.numbers() == [1, 2]


def test_cache_watchlist_and_ranking_equal_the_batch_operators(spark, tmp_path):
    days = adapters.cache_li(spark, SF).select("ticker", "trading_day", "close_d", F.col("vol_d").cast("double").alias("vol_d"), "dollar_vol_d").cache()
    given = {"rvol": 1.2, "pctchg": 0.15, "dvol": 1e5, "max_price": 1e5}
    inbox, out, ck = (f"{tmp_path}/{n}" for n in ("in", "out", "ck"))
    cuts = [dt.date(1992, 1, 1), dt.date(1994, 3, 1), dt.date(1997, 5, 5), dt.date(2100, 1, 1)]
    for a, b in zip(cuts, cuts[1:]):
        days.filter((F.col("trading_day") >= a) & (F.col("trading_day") < b)).write.mode("append").parquet(inbox)
        jobs.eod_tables(jobs.stream_ticks(spark, inbox, days.schema), out, ck, thresholds=given, buckets=3).awaitTermination()
    days.filter(F.col("trading_day") < cuts[1]).write.mode("append").parquet(inbox)  # days that have been: left out
    jobs.eod_tables(jobs.stream_ticks(spark, inbox, days.schema), out, ck, thresholds=given, buckets=3).awaitTermination()
    want = universe.info_rich(windows.cache_features(days), given)
    rows = lambda df: sorted((r.ticker, r.trading_day, r.info_rich, None if r.rvol30 is None else round(r.rvol30, 9)) for r in df.collect())
    assert rows(jobs.read_eod(spark, out, "cache")) == rows(want)
    assert rows(jobs.read_eod(spark, out, "watchlist")) == rows(want.filter("info_rich"))
    ranks = lambda df: [(r.ticker, r.days_rich, r.last_seen) for r in df.orderBy(F.desc("days_rich"), F.desc("last_seen"), "ticker").collect()]
    assert ranks(jobs.read_eod(spark, out, "topn")) == ranks(universe.topn_12m(want))
    # the same batches once more, as after a driver that died behind its commit
    jobs.eod_tables(jobs.stream_ticks(spark, inbox, days.schema), out, f"{ck}-again", thresholds=given, buckets=3).awaitTermination()
    assert rows(jobs.read_eod(spark, out, "cache")) == rows(want)


def test_sliding_spikes_over_batches(spark, tmp_path):
    inbox, out, ck = (f"{tmp_path}/{n}" for n in ("in", "out", "ck"))
    ticks = [tick(i, m, p) for i, (m, p) in enumerate([(0, 10), (3, 10), (9, 13), (10, 6), (14, 10), (40, 10), (41, 10.5), (300, 1)])]

    def run():
        with jobs.state_store(spark):
            jobs.run_once(jobs.stream_spike(jobs.stream_ticks(spark, inbox), length=10, step=2), out, ck)
        return {(r.start, round(r.spike_up, 6), round(r.spike_down, 6)) for r in spark.read.parquet(out).collect()}

    for at in range(0, len(ticks), 2):
        landed(spark, inbox, ticks[at : at + 2])
        got = run()
    base = dt.datetime(2024, 1, 1, 14)
    want = set()
    for start in range(-10, 60, 2):
        inside = [t for t in ticks if start <= (t[3] // 60_000_000) - int(base.replace(tzinfo=dt.timezone.utc).timestamp()) // 60 < start + 10]
        if inside:
            o, h, low = inside[0][4], max(t[4] for t in inside), min(t[4] for t in inside)
            if h / o - 1 >= 0.2 or low / o - 1 <= -0.3:
                want.add((base + dt.timedelta(minutes=start), round((h - o) / o, 6), round((low - o) / o, 6)))
    assert got == want and want


def test_a_new_york_day_ends_at_its_own_midnight():
    assert jobs.day_end(dt.date(2024, 1, 15), "America/New_York") == int(dt.datetime(2024, 1, 16, 5, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert jobs.day_end(dt.date(2024, 7, 15), "America/New_York") == int(dt.datetime(2024, 7, 16, 4, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert jobs.day_end(dt.date(2024, 3, 10), "UTC") == int(dt.datetime(2024, 3, 11, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_a_bar_stays_open_through_after_hours(spark, tmp_path):
    """19:30 in New York is half past midnight in UTC: the day's bar goes on."""
    inbox, out, ck = (f"{tmp_path}/{n}" for n in ("in", "out", "ck"))
    late = int(dt.datetime(2024, 1, 3, 0, 30, tzinfo=dt.timezone.utc).timestamp())
    after_hours = ("A", dt.date(2024, 1, 2), 50, late * 10**6, 12.0, 10)
    for rows in ([tick(1, 0, 10, day=2)], [("B", dt.date(2024, 1, 2), 9, (late - 60) * 10**6, 1.0, 1)], [after_hours]):
        landed(spark, inbox, rows)
        with jobs.state_store(spark):
            jobs.run_once(jobs.stream_dollar_bars(jobs.stream_ticks(spark, inbox), 200.0), out, ck)
    rows = [(r.bar_no, r.o, r.c, r.n) for r in spark.read.schema(jobs.BARS).parquet(out).collect() if r.ticker == "A"]
    assert rows == [(0, 10.0, 12.0, 2)]
