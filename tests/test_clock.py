"""The same results in sessions of any zone, and dimensions swept like a plain search."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.functions import clock
from tickloom.operators import daily, joins, universe
from tickloom.sources import normalize

ZONES = ("UTC", "America/Los_Angeles", "Asia/Tokyo", "Asia/Kolkata")
US = 1_000_000


@pytest.fixture(params=ZONES)
def zoned(spark, request):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield spark
    spark.conf.set(key, before)


def micros(*at):
    return int(dt.datetime(*at, tzinfo=dt.timezone.utc).timestamp()) * US


#: In UTC: winter and summer trading hours in New York, and hours that zones in the west skip or have twice.
TIMES = [(2024, 1, 15, 14, 0), (2024, 1, 15, 14, 29), (2024, 1, 15, 14, 30), (2024, 1, 15, 21, 0), (2024, 1, 15, 21, 1), (2024, 7, 15, 13, 30), (2024, 7, 15, 13, 29), (2024, 7, 15, 20, 0),
         (2024, 3, 10, 2, 30), (2024, 3, 10, 10, 30), (2024, 11, 3, 1, 30), (2024, 11, 3, 8, 30), (2024, 11, 3, 9, 30), (2024, 3, 11, 13, 30), (2024, 11, 4, 14, 29), (1969, 12, 31, 23, 59)]


def test_trading_hours_in_any_session(zoned):
    frame = zoned.createDataFrame([(i, micros(*t)) for i, t in enumerate(TIMES)], "i int, us long")
    both = frame.select("i", F.timestamp_micros("us").alias("instant"), clock.utc_clock(F.col("us")).alias("utc"))
    for column in ("instant", "utc"):
        assert {r.i for r in universe.rth_filter(both, column).collect()} == {2, 3, 5, 7, 13}
        as_it_is = {i for i, t in enumerate(TIMES) if 570 <= t[3] * 60 + t[4] <= 960}
        assert {r.i for r in universe.rth_filter(both, column, None).collect()} == as_it_is
    assert [r[0] for r in both.orderBy("i").select(clock.clock_micros(F.col("utc"))).collect()] == [micros(*t) for t in TIMES]
    for column in ("instant", "utc"):
        made = both.withColumn("u", F.unix_micros(clock.floored(clock.epoch_micros(both, column), "hour"))).orderBy("i").collect()
        assert [r.u for r in made] == [micros(*t[:4], 0) for t in TIMES]


def test_minutes_in_any_session(zoned):
    frame = zoned.createDataFrame([("A", micros(*t) // 1000, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 1.0) for t in TIMES], "ticker string, t long, o double, h double, l double, c double, v double, n long, vw double")
    text = ["{:04}-{:02}-{:02} {:02}:{:02}".format(*t) for t in TIMES]
    assert sorted((r.date, r.minute) for r in normalize.normalize_minute(frame).collect()) == sorted((x[:10], x) for x in text)
    assert sorted(r.date for r in normalize.normalize_daily(frame).collect()) == sorted(x[:10] for x in text)
    ticks = zoned.createDataFrame([("A", micros(*t) + 59 * US, i, 1.0, 1) for i, t in enumerate(TIMES)], "ticker string, t_raw long, seq long, p double, s long").withColumn("ts", F.timestamp_micros("t_raw")).withColumn("date", F.lit(None).cast("date"))
    assert sorted(r.t for r in daily.ticks_to_minute(ticks).collect()) == sorted(micros(*t) for t in TIMES)


def test_vendor_times_in_any_session(zoned):
    said = {
        "2024-01-15 10:00:00": (2024, 1, 15, 15, 0), "2024-07-15 10:00:00": (2024, 7, 15, 14, 0), "2024-03-10 02:30:00": None, "2024-03-10 01:30:00": (2024, 3, 10, 6, 30), "2024-03-10 03:30:00": (2024, 3, 10, 7, 30),
        "2024-11-03 01:30:00": None, "2024-11-03 02:30:00": (2024, 11, 3, 7, 30), "2024-03-10 02:30:00Z": (2024, 3, 10, 2, 30), "2024-11-03T01:30:00+09:00": (2024, 11, 2, 16, 30), "x": None,
    }
    frame = zoned.createDataFrame([(t, "1", "1", "1", "1", "5") for t in said], "ts string, o string, h string, l string, c string, v string")
    got = lambda df: sorted(r[0] for r in df.select(F.unix_micros("t")).collect())
    assert got(normalize.normalize_vendor_bars(frame)) == sorted(micros(*t) for t in said.values() if t)
    assert got(normalize.normalize_vendor_bars(frame, rth_only=True)) == sorted(micros(*t) for t in ((2024, 1, 15, 15, 0), (2024, 7, 15, 14, 0), (2024, 11, 2, 16, 30)))
    naive = frame.filter(F.col("ts").isin("2024-03-10 02:30:00", "2024-11-03 01:30:00"))
    assert got(normalize.normalize_vendor_bars(naive, tz=None)) == sorted((micros(2024, 3, 10, 2, 30), micros(2024, 11, 3, 1, 30)))


def test_overlapping_dimensions_are_swept_like_a_search(spark):
    rng, start = random.Random(5), dt.date(2024, 1, 1)
    day = lambda k: start + dt.timedelta(days=k)
    rows, number = [], 0
    for ticker in ("a", "b", "c", "d"):
        for _ in range({"a": 3, "b": 40, "c": 200, "d": 1}[ticker]):
            a = rng.randrange(60)
            rows.append((ticker, day(a), None if rng.random() < 0.1 else day(a + rng.randrange(-1, 25)), float(number := number + 1)))
    rows = [r for k, r in enumerate(rows) if (r[0], r[1], r[2]) not in {(x[0], x[1], x[2]) for x in rows[:k]}]
    dim = spark.createDataFrame(rows, "ticker string, effective_from date, effective_to date, market_cap double").repartition(6)
    days = spark.createDataFrame([(t, day(k)) for t in "abcde" for k in range(-3, 95)], "ticker string, trading_day date")
    end = dt.date(2099, 12, 31)
    for r in joins.asof_dim_join(days, dim).collect():
        held = [(a, b or end, cap) for t, a, b, cap in rows if t == r.ticker and a <= r.trading_day < (b or end)]
        assert r.market_cap_d == (max(held)[2] if held else None), r


def test_many_open_rows_of_one_ticker(spark):
    dim = spark.range(100_000).select(F.lit("A").alias("ticker"), F.date_add(F.lit("1970-01-01").cast("date"), (F.col("id") % 18_000).cast("int")).alias("effective_from"), F.lit(None).cast("date").alias("effective_to"), F.col("id").cast("double").alias("market_cap"))
    changes = joins.in_force(dim)
    assert changes.count() == 18_001 and changes.filter("dim_ is null").count() == 1
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_the_first_bar_of_a_minute_counts(spark):
    at = dt.datetime(2024, 1, 2, 10, 0)
    bars = lambda rows: spark.createDataFrame([("A", at + dt.timedelta(seconds=s), c, c, c, c, 1.0) for s, c in rows], "ticker string, t timestamp, o double, h double, l double, c double, v double")
    one = joins.compare_bars(bars([(1, 10.0), (30, 99.0)]), bars([(59, 50.0), (2, 10.0), (2, 11.0)])).collect()
    assert [(r.n, r.match_rate, r.breaks, r.p95_price_diff) for r in one] == [(1, 1.0, 0, 0.0)]
