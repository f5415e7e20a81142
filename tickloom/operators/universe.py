"""Universe filters, watchlist tests, rankings and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.clock import at_zone, epoch_micros, minute_of_day, utc_clock
from tickloom.functions.expressions import by

#: The thresholds of an information-rich day.
THRESHOLDS = {"rvol": 2.0, "pctchg": 0.15, "dvol": 5_000_000.0, "min_price": 0.2, "max_price": 20.0, "cap_max": 2_000_000_000.0}


def thresholds(given: dict | None = None) -> dict:
    """The defaults with those given in their place, one by one."""
    return THRESHOLDS | (given or {})


def select_universe(snapshot: DataFrame, details: DataFrame | None = None, cap_max: float | None = None, types=("CS",), exchanges=("XNAS", "XNYS")) -> DataFrame:
    """Common stock of the exchanges; with a cap only tickers known to be below it."""
    rows = snapshot.filter(F.col("type").isin(*types) & F.col("primary_exchange").isin(*exchanges)).dropDuplicates(["ticker"])
    if details is None or cap_max is None:
        return rows
    caps = details.groupBy("ticker").agg(F.max("market_cap").alias("market_cap"))
    return rows.join(caps, "ticker", "left").filter(F.col("market_cap") < cap_max)


def cap_filter(cache: DataFrame, cap_max: float) -> DataFrame:
    """Caps up to the bound; unknown caps stay."""
    return cache.filter(F.col("market_cap_d").isNull() | (F.col("market_cap_d") <= cap_max))


def _tests(given: dict | None) -> dict[str, Column]:
    t = thresholds(given)
    return {
        "r_rvol": F.col("rvol30") >= t["rvol"], "r_chg": F.abs("pctchg_d") >= t["pctchg"], "r_dvol": F.col("dollar_vol_d") >= t["dvol"],
        "r_px": F.col("close_d").between(t["min_price"], t["max_price"]),
    }


def info_rich(cache: DataFrame, given: dict | None = None) -> DataFrame:
    """The four tests and their three-valued AND."""
    tests = _tests(given)
    return cache.withColumns(tests).withColumn("info_rich", reduce(lambda a, b: a & b, [F.col(c) for c in tests]))


def filter_hits(cache: DataFrame, given: dict | None = None) -> DataFrame:
    """The four tests with null as false, how many hold, and which as "F1+F3"."""
    tests = {k: F.coalesce(v, F.lit(False)) for k, v in _tests(given).items()}
    df = cache.withColumns(tests)
    number = sum((F.col(c).cast("int") for c in tests), F.lit(0))
    return df.withColumn("num_filters", number).withColumn("combination", F.concat_ws("+", *[F.when(F.col(c), F.lit(f"F{i + 1}")) for i, c in enumerate(tests)]))


def rth_filter(df: DataFrame, ts: str = "ts", tz: str | None = "America/New_York") -> DataFrame:
    """09:30 to 16:00 inclusive on the clock of tz; None takes a clock as it is, an instant by UTC. The session's zone plays no part."""
    clock = utc_clock(epoch_micros(df, ts))
    return df.filter(minute_of_day(at_zone(clock, tz) if tz else clock).between(570, 960))


def date_window(df: DataFrame, first, last, date: str = "date") -> DataFrame:
    return df.filter(F.col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def bins(df: DataFrame, column: str, edges: list[float], labels: list[str], out: str = "bin") -> DataFrame:
    """Rows per labelled range, each below its edge; labels has one more entry than edges, its last one for the rest."""
    chain = F.when(F.lit(False), labels[-1])
    for e, label in zip(edges, labels, strict=False):
        chain = chain.when(F.col(column) < e, label)
    return df.groupBy(chain.otherwise(labels[-1]).alias(out)).agg(F.count("*").alias("n"))


#: Ranges of price and market capitalisation, with their names.
PRICE_EDGES, TOP_PRICE = (0.50, 1.00, 5.00, 10.00), 20.00
PRICE_LABELS = ("$0.20-$0.50 (penny)", "$0.50-$1.00", "$1.00-$5.00", "$5.00-$10.00", "$10.00-$20.00", ">$20.00 (ERROR!)")
CAP_EDGES = (50_000_000, 300_000_000, 2_000_000_000, 10_000_000_000)
CAP_LABELS = ("< $50M (Nano)", "$50M-$300M (Micro)", "$300M-$2B (Small)", "$2B-$10B (Mid)", "> $10B (Large)")


def price_bins(df: DataFrame, column: str = "close_d") -> DataFrame:
    """Rows per range of price; the highest price allowed belongs to the range below it, null to the last."""
    above = F.when(F.col(column) == TOP_PRICE, PRICE_EDGES[-1]).otherwise(F.col(column))
    return bins(df.select(above.alias("price_")), "price_", [*PRICE_EDGES, TOP_PRICE], list(PRICE_LABELS))


def cap_bins(df: DataFrame, column: str = "market_cap") -> DataFrame:
    """Rows per range of market capitalisation, of those that have one."""
    return bins(df.filter(F.col(column).isNotNull()), column, list(CAP_EDGES), list(CAP_LABELS))


def topn_12m(cache: DataFrame, rows: int = 252, k: int = 1000) -> DataFrame:
    """Tickers by information-rich days among their last rows."""
    last = cache.withColumn("rank_", F.row_number().over(by("ticker", F.col("trading_day").desc()))).filter(F.col("rank_") <= rows)
    sums = last.groupBy("ticker").agg(F.coalesce(F.sum(F.col("info_rich").cast("int")), F.lit(0)).alias("days_rich"), F.max("trading_day").alias("last_seen"))
    return sums.orderBy(F.desc("days_rich"), F.desc("last_seen"), "ticker").limit(k)


def topn_asof(cache: DataFrame, asof: str, k: int = 100, days: int = 252) -> DataFrame:
    """Ranking over the calendar days (asof - days, asof]."""
    return topn_snapshots(cache, cache.sparkSession.sql(f"SELECT DATE'{asof}' AS asof"), k, days)


def topn_snapshots(cache: DataFrame, asofs: DataFrame, k: int = 100, days: int = 252) -> DataFrame:
    """Rankings for all dates of asofs at once: each row counts for the dates that lie up to `days` days after it.

    The dates are exploded to the days that they reach back to, so that the join is on equal days.
    """
    asofs = asofs.select(F.col("asof").cast("date")).distinct()
    reach = asofs.select("asof", F.explode(F.sequence(F.date_add("asof", 1 - days), F.col("asof"))).alias("trading_day"))
    daily = cache.groupBy("ticker", "trading_day").agg(F.coalesce(F.sum(F.col("info_rich").cast("int")), F.lit(0)).alias("rich"))
    sums = daily.join(reach, "trading_day").groupBy("asof", "ticker").agg(F.sum("rich").alias("days_rich"), F.max("trading_day").alias("last_seen"))
    rank = F.row_number().over(by("asof", F.desc("days_rich"), F.desc("last_seen"), "ticker"))
    return sums.withColumn("rank", rank).filter(F.col("rank") <= k)


def calendar(df: DataFrame, kind: str = "monthly", date: str = "trading_day") -> DataFrame:
    """Month ends or year ends within the range of df, or both."""
    span = df.agg(F.min(date).alias("a"), F.max(date).alias("b"))
    months = span.select("a", "b", F.explode(F.expr("sequence(trunc(a, 'MM'), trunc(b, 'MM'), interval 1 month)")).alias("m")).select("a", "b", F.last_day("m").alias("asof"))
    months = months.filter("asof between a and b").select("asof")
    return {"monthly": months, "annual": months.filter("month(asof) = 12"), "both": months}[kind]


def top_k(df: DataFrame, key: str, k: int) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(k)


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(by(group, *order))).filter(F.col("rank") <= k)


def stratified_pick(activity: DataFrame, picks: dict[str, int] | None = None) -> DataFrame:
    """The most diverse tickers of the low, middle and high third by active days."""
    picks = picks or {"high": 20, "mid": 20, "low": 10}
    cuts = activity.agg(F.percentile("n_days", F.array(F.lit(0.33), F.lit(0.67))).alias("q"))
    rows = activity.join(F.broadcast(cuts))  # one row
    stratum = F.when(F.col("n_days") > F.col("q")[1], "high").when(F.col("n_days") > F.col("q")[0], "mid").otherwise("low")
    rows = rows.withColumn("stratum", stratum).drop("q")
    rows = rows.withColumn("rank", F.row_number().over(by("stratum", F.desc("diversity"), "ticker")))
    return rows.filter(reduce(lambda a, b: a | b, [(F.col("stratum") == s) & (F.col("rank") <= n) for s, n in picks.items()]))


def extremes(df: DataFrame, measure: str, row: list[str]) -> DataFrame:
    """The rows with the largest and the smallest measure, ties to the first by the row's columns."""
    high = df.orderBy(F.desc(measure), *row).limit(1).withColumn("kind", F.lit("max"))
    return high.unionByName(df.filter(F.col(measure).isNotNull()).orderBy(measure, *row).limit(1).withColumn("kind", F.lit("min"))).select("kind", *row, measure)


def sample_n(df: DataFrame, key: list[str], n: int, seed: int = 42) -> DataFrame:
    """n rows that depend on keys and seed only: the first by the digest of seed and key."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])), *key).limit(n)


def union_relaxed(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_diagonal(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_on(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order given."""
    return top_k_per_group(df, keys, order, 1).drop("rank")


def merge_tickers(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("ticker").union(b.select("ticker")).distinct()


def top_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """How two lists of tickers agree."""
    x, y = a.select("ticker").distinct(), b.select("ticker").distinct()
    sides = x.withColumn("in_a", F.lit(1)).join(y.withColumn("in_b", F.lit(1)), "ticker", "full").agg(
        F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNotNull()).alias("both"), F.count_if(F.col("in_b").isNull()).alias("only_a"),
        F.count_if(F.col("in_a").isNull()).alias("only_b"), F.count("in_a").alias("n_a"),
    )
    return sides.select("both", "only_a", "only_b", F.try_divide(F.col("both") * 100.0, F.col("n_a")).alias("match_pct"))


def hybrid_universe(universe: DataFrame, details: DataFrame, cap_max: float) -> DataFrame:
    """Active tickers known to be below the cap, and all inactive ones."""
    small = details.filter(F.col("market_cap") < cap_max).select("ticker").distinct()
    return universe.filter("active").join(small, "ticker", "left_semi").unionByName(universe.filter(~F.coalesce(F.col("active"), F.lit(False))))
