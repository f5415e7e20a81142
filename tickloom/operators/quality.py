"""Data certification: checks as queries that return violations or one row of figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.functions.expressions import ratio
from tickloom.operators import joins, reports
from tickloom.operators.daily import minute_to_daily_ohlcv
from tickloom.operators.windows import cache_features

KEYS = ["ticker", "date"]


def inventory(datasets: dict[str, DataFrame]) -> DataFrame:
    """Every ticker-day with a flag per dataset: one grouping of the tagged keys, no chain of outer joins."""
    tagged = [d.select(*KEYS, F.lit(name).alias("dataset")) for name, d in datasets.items()]
    rows = reduce(lambda a, b: a.unionByName(b), tagged)
    return rows.groupBy(*KEYS).agg(*[F.coalesce(F.bool_or(F.col("dataset") == n), F.lit(False)).alias(f"has_{n}") for n in datasets])


def schema_check(df: DataFrame, required: dict[str, str]) -> DataFrame:
    """Required columns: present, of the type asked for, and their nulls."""
    have, spark = dict(df.dtypes), df.sparkSession
    there = [c for c in required if c in have]
    counts = df.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in there]).alias("p")).select(F.explode("p").alias("p")).select("p.*") if there else None
    asked = spark.createDataFrame([(c, t, c in have, have.get(c) == t) for c, t in required.items()], "column string, type string, present boolean, type_ok boolean")
    return asked.join(F.broadcast(counts), "column", "left") if counts is not None else asked.withColumn("nulls", F.lit(None).cast("long"))


def tick_bar_conservation(ticks: DataFrame, bars: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Relative errors of volume and dollars between ticks and bars, per ticker-day, and whether they hold."""
    a = ticks.groupBy(*KEYS).agg(F.sum("s").alias("tv"), F.sum(F.col("p") * F.col("s")).alias("td"))
    b = bars.groupBy(*KEYS).agg(F.sum("v").alias("bv"), F.sum("dollar").alias("bd"))
    error = lambda x, y: F.abs(F.col(x) - F.col(y)) / F.greatest(F.lit(1.0), F.col(y))
    out = a.join(b, KEYS).select(*KEYS, error("bv", "tv").alias("volume_error"), error("bd", "td").alias("dollar_error"))
    return out.withColumn("ok", (F.col("volume_error") <= tolerance) & (F.col("dollar_error") <= tolerance))


def label_logic(labels: DataFrame, most: float = 0.9) -> DataFrame:
    """Rows with both hits, rows that end before they start, the largest class share, and the verdict."""
    out = labels.agg(
        F.count("*").alias("n"), F.count_if(F.col("pt_hit") & F.col("sl_hit")).alias("both_hit"), F.count_if(F.col("t1") < F.col("anchor_ts")).alias("reversed"),
        *[F.count_if(F.col("label") == k).alias(f"n_{n}") for k, n in ((-1, "down"), (0, "flat"), (1, "up"))],
    )
    share = F.coalesce(ratio(F.greatest("n_down", "n_flat", "n_up") * 1.0, F.col("n")), F.lit(0.0))
    return out.withColumn("max_share", share).withColumn("ok", (F.col("both_hit") == 0) & (F.col("reversed") == 0) & (F.col("max_share") <= most))


def weight_stats(weights: DataFrame, tolerance: float = 1e-6, most: float = 0.9) -> DataFrame:
    """Ticker-days whose weights do not add up to 1, the mean Gini, and the verdict."""
    sums = weights.groupBy(*KEYS).agg(F.sum("weight").alias("total")).join(reports.gini(weights), KEYS)
    out = sums.agg(F.count("*").alias("groups"), F.count_if(F.abs(F.col("total") - 1) > tolerance).alias("bad_sums"), F.avg("gini").alias("mean_gini"))
    return out.withColumn("ok", (F.col("bad_sums") == 0) & (F.col("mean_gini") <= most))


def content_hash(df: DataFrame, keys: list[str]) -> DataFrame:
    """An order-free fingerprint of each partition's rows: sums and exclusive ors of the rows' digests, as they
    stand in text (columns by name, null as \\N)."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in sorted(df.columns)])
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.bit_xor(h).alias("xor"), F.sum(F.pmod(h, F.lit(1 << 40))).alias("sum"))


def reproducible(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Partitions whose fingerprints differ between two runs."""
    x, y = content_hash(a, keys).alias("x"), content_hash(b, keys).alias("y")
    both = x.join(y, keys, "full")
    same = reduce(lambda p, q: p & q, [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("n", "xor", "sum")])
    return both.filter(~same).select(*keys)


def split_purge(split: DataFrame, purge: int = 50) -> DataFrame:
    """Row counts of the split and whether train ends at least `purge` rows before valid begins."""
    out = split.agg(
        F.count_if(F.col("part") == "train").alias("train"), F.count_if(F.col("part") == "valid").alias("valid"), F.count_if(F.col("part") == "purged").alias("purged"),
        F.max(F.when(F.col("part") == "train", F.col("idx"))).alias("last_train"), F.min(F.when(F.col("part") == "valid", F.col("idx"))).alias("first_valid"),
    )
    return out.withColumn("ok", F.coalesce(F.col("last_train") + purge < F.col("first_valid"), F.lit(True)))


def events_order(events: DataFrame) -> DataFrame:
    """Events that do not satisfy start <= anchor <= end."""
    return events.filter(~F.coalesce((F.col("start_ts") <= F.col("anchor_ts")) & (F.col("anchor_ts") <= F.col("end_ts")), F.lit(False)))


def repeated_events(events: DataFrame, most: float = 0.8) -> DataFrame:
    """Per type the share of events with the start and end of the one before, in order of these: all but one of each."""
    alike = events.groupBy("event_type", "start_ts", "end_ts").agg(F.count("*").alias("k"))
    out = alike.groupBy("event_type").agg(F.sum("k").alias("n"), (F.sum(F.col("k") - 1) / F.sum("k")).alias("share"))
    return out.withColumn("ok", F.col("share") <= most)


def ohlc_rules(daily: DataFrame) -> DataFrame:
    """Counts of days that break a rule, and repeated days."""
    days = daily.withColumn("copies", F.count("*").over(Window.partitionBy(*KEYS)))
    return days.agg(
        F.count("*").alias("n"), F.count_if(F.col("h") < F.greatest("o", "c")).alias("high_below"), F.count_if(F.col("l") > F.least("o", "c")).alias("low_above"),
        F.count_if(F.col("h") < F.col("l")).alias("high_below_low"), F.count_if(F.col("c") <= 0).alias("no_price"), F.count_if(F.col("v") < 0).alias("negative_volume"),
        F.count_if(F.col("v") == 0).alias("no_volume"), F.count_if(F.col("copies") > 1).alias("repeated"),
    )


def aggregation_check(minutes: DataFrame, daily: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Days whose stored bar is not that of their minutes."""
    a, b = minute_to_daily_ohlcv(minutes).alias("a"), daily.alias("b")
    off = reduce(lambda p, q: p | q, [F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) > tolerance * F.greatest(F.lit(1.0), F.abs(f"b.{c}")) for c in "ohlcv"])
    return a.join(b, KEYS).filter(off).select(*KEYS)


def cache_checks(cache: DataFrame, minutes: DataFrame, session_minutes: int = 390, tolerance: float = 0.01, coverage: float = 0.05) -> DataFrame:
    """Per ticker: days against weekdays of its range (5 % allowed), days whose volume is not the minutes', wrong gap flags."""
    volume = minutes.groupBy("ticker", F.col("date").alias("trading_day")).agg(F.sum("v").alias("minute_v"))
    rows = cache.join(volume, ["ticker", "trading_day"], "left")
    out = rows.groupBy("ticker").agg(
        F.count("*").alias("days"), F.min("trading_day").alias("first"), F.max("trading_day").alias("last"),
        F.count_if(F.abs(F.col("vol_d") - F.coalesce("minute_v", F.lit(0.0))) > tolerance * F.greatest(F.lit(1.0), F.col("vol_d"))).alias("bad_volume"),
        F.count_if(F.col("has_gaps") != (F.col("session_rows") < session_minutes)).alias("bad_flags"),
    )
    weekdays = F.size(F.filter(F.sequence("first", "last"), lambda d: F.weekday(d) < 5))
    out = out.select("ticker", "days", weekdays.cast("long").alias("weekdays"), "bad_volume", "bad_flags")
    out = out.withColumn("coverage_ok", F.abs(ratio(F.col("days") * 1.0, F.col("weekdays")) - 1) <= coverage)
    return out.withColumn("ok", F.col("coverage_ok") & (F.col("bad_volume") == 0) & (F.col("bad_flags") == 0))


def recompute_features(cache: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Figures of a stored cache against its own recomputation."""
    fresh = cache_features(cache.drop("rvol30", "pctchg_d", "return_d")).select("ticker", "trading_day", F.col("rvol30").alias("rvol_"), F.col("pctchg_d").alias("chg_"))
    both = cache.join(fresh, ["ticker", "trading_day"])
    off = lambda a, b: F.abs(F.coalesce(F.col(a), F.lit(0.0)) - F.coalesce(F.col(b), F.lit(0.0))) > tolerance
    return both.agg(
        F.count("*").alias("n"), F.count_if(off("rvol30", "rvol_")).alias("bad_rvol"), F.count_if(off("pctchg_d", "chg_")).alias("bad_change"),
        (F.count("market_cap_d") * 100.0 / F.count("*")).alias("cap_pct"), F.min("close_d").alias("low"), F.max("close_d").alias("high"),
    )


def timestamp_sanity(ticks: DataFrame) -> DataFrame:
    """Ticks whose raw time is not plausible for its unit (years 2000 to 2100)."""
    per_second = F.when(F.col("t_unit") == "ns", 10**9).when(F.col("t_unit") == "us", 10**6).when(F.col("t_unit") == "ms", 10**3)
    seconds = F.floor(F.col("t_raw") / per_second)
    return ticks.filter(~F.coalesce(seconds.between(946_684_800, 4_102_444_800), F.lit(False)))


def month_coverage(daily: DataFrame, first: str, last: str) -> DataFrame:
    """Months with data of those expected, per ticker: full, partial or none."""
    months = daily.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).groupBy("ticker").agg(F.countDistinct(F.trunc("date", "MM")).alias("present"))
    ends = [F.trunc(F.lit(d).cast("date"), "MM") for d in (first, last)]
    expected = (F.months_between(ends[1], ends[0]) + 1).cast("long")
    out = daily.select("ticker").distinct().join(months, "ticker", "left").select("ticker", F.coalesce("present", F.lit(0)).alias("present"), expected.alias("expected"))
    return out.withColumn("status", F.when(F.col("present") == 0, "none").when(F.col("present") < F.col("expected"), "partial").otherwise("full"))


def weights_sanity(weights: DataFrame, labels: DataFrame) -> DataFrame:
    out = weights.agg(
        F.count("*").alias("rows"), F.count_if(F.col("weight").isNull()).alias("nulls"), F.count_if(F.col("weight") < 0).alias("negative"),
        F.count_if(F.isnan("weight") | (F.abs("weight") == float("inf"))).alias("not_finite"),
    )
    return out.join(F.broadcast(labels.agg(F.count("*").alias("label_rows")))).withColumn("ok", (F.col("rows") == F.col("label_rows")) & (F.col("nulls") + F.col("negative") + F.col("not_finite") == 0))


def event_file_check(events: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Exact column set, rows with a null key, and repeated keys."""
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    groups = events.groupBy(*keys).agg(F.count("*").alias("k"))
    bad = groups.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(null, F.col("k"))), F.lit(0)).alias("null_keys"), F.coalesce(F.sum(F.when(F.col("k") > 1, F.col("k"))), F.lit(0)).alias("repeated"))
    return bad.withColumn("columns_ok", F.lit(sorted(events.columns) == sorted(columns)))


def split_ratios(splits: DataFrame, low: float = 0.1, high: float = 10.0, many: int = 5) -> DataFrame:
    """Per ticker: extreme ratios, reverse splits (below 1) and whether there are many."""
    out = splits.groupBy("ticker").agg(F.count("*").alias("n"), F.count_if((F.col("ratio") < low) | (F.col("ratio") > high)).alias("extreme"), F.count_if(F.col("ratio") < 1).alias("reverse"))
    return out.withColumn("many_reverse", F.col("reverse") >= many)


def alphabet_coverage(universe: DataFrame) -> DataFrame:
    """First letters from A to Z that no ticker has."""
    letters = universe.sparkSession.range(26).select(F.char(F.col("id") + 65).alias("letter"))
    return letters.join(universe.select(F.upper(F.substring("ticker", 1, 1)).alias("letter")).distinct(), "letter", "left_anti")


def watchlist_consistency(fused: DataFrame, events: dict[str, str]) -> DataFrame:
    """Rows of a fused watchlist whose counts, flags or details do not agree."""
    flags = reduce(lambda a, b: a & b, [F.col(f"has_{k.lower()}") == F.array_contains("event_types", v) for k, v in events.items()])
    parses = F.forall("details", lambda d: F.from_json(d, "map<string,string>").isNotNull())
    ok = (F.col("num_events") == F.size("event_types")) & (F.col("num_events") == F.size("details")) & flags & parses
    return fused.filter(~ok).select("ticker", "date")


def verdict(checks: DataFrame) -> DataFrame:
    """checks (name, ok) -> GO only if all hold."""
    return checks.agg(F.count("*").alias("checks"), F.count_if(~F.col("ok")).alias("failed"), F.bool_and("ok").alias("all_ok")).select("checks", "failed", F.when(F.col("all_ok"), "GO").otherwise("NO-GO").alias("verdict"))


def point_in_time(watchlist: DataFrame, cache: DataFrame, given: dict | None = None) -> DataFrame:
    """Watchlist rows checked and borne out by the cache of their day; ok if all are and there are any."""
    broken = joins.pti_universe_check(watchlist, cache, given).agg(F.count("*").alias("broken"))
    total = watchlist.select("ticker", "date").distinct().agg(F.count("*").alias("checked"))
    out = total.join(F.broadcast(broken))  # one row
    return out.select("checked", (F.col("checked") - F.col("broken")).alias("passed"), ((F.col("broken") == 0) & (F.col("checked") > 0)).alias("ok"))


def filings_covered(filings: DataFrame, cache: DataFrame, forms=joins.DILUTING_FORMS) -> DataFrame:
    """Days with diluting filings, those without a daily row, and whether there are none."""
    asked = filings.filter(F.col("form").isin(*forms)).select("ticker", "filing_date", "form").distinct().agg(F.count("*").alias("checked"))
    return asked.join(F.broadcast(joins.filings_coverage(filings, cache, forms).agg(F.count("*").alias("missing")))).withColumn("ok", F.col("missing") == 0)  # one row


def lineage(events: DataFrame, bars: DataFrame) -> DataFrame:
    """Events, those whose anchor is no bar's close, and whether there are none."""
    total = events.agg(F.count("*").alias("checked"))
    return total.join(F.broadcast(joins.events_lineage(events, bars).agg(F.count("*").alias("orphans")))).withColumn("ok", F.col("orphans") == 0)  # one row
