"""Aggregations behind reports: counts, profiles, quantiles, performance of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.expressions import correlation, ratio
from tickloom.functions.ordering import grouped_quantiles


def count_by(df: DataFrame, **keys: Column) -> DataFrame:
    return df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(F.count("*").alias("n"))


def nunique_by(df: DataFrame, key: Column, name: str, of: str, approximate: bool = False) -> DataFrame:
    return df.groupBy(key.alias(name)).agg((F.approx_count_distinct(of) if approximate else F.countDistinct(of)).alias("n"))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per numeric column: nulls, range, mean, deviation and quartiles."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])).alias("e")).select("e.*")
    stats = long.groupBy("column").agg(
        F.count_if(F.col("x").isNull()).alias("nulls"), F.count("*").alias("rows"), F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std")
    )
    quartiles = grouped_quantiles(long, ["column"], "x", [0.25, 0.5, 0.75])
    out = stats.join(F.broadcast(quartiles), "column", "left")  # a row per column
    return out.select(*stats.columns, F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75"))


def distinct_lists(df: DataFrame, columns: list[str], most: int = 20) -> DataFrame:
    """Per column the number of its values and, where there are at most so many, their sorted list as text.

    Values are first made distinct per column, and one more than `most` of them at the utmost is listed.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("e")).select("e.*")
    ranked = long.filter("value is not null").distinct()
    few = ranked.groupBy("column").agg(F.count("*").alias("n_distinct"))
    kept = ranked.join(F.broadcast(few.filter(F.col("n_distinct") <= most)), "column")  # a row per column
    lists = kept.groupBy("column").agg(F.array_join(F.sort_array(F.collect_list("value")), ",").alias("values"))
    return few.join(lists, "column", "left")


def completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """Values and their share in percent, per field."""
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.count(f).alias("n"), ratio(F.count(f) * 100.0, F.count("*")).alias("pct")) for f in fields])
    return df.agg(rows.alias("p")).select(F.explode("p").alias("p")).select("p.*")


def quantile_report(df: DataFrame, x: str, quantiles: list[float], period: Column | None = None) -> DataFrame:
    """Linear quantiles, moments and counts of signs, by period; one row per quantile list."""
    names = [f"p{round(q * 100):02d}" for q in quantiles]
    rows = df.select((period if period is not None else F.lit("all")).alias("period"), F.col(x).alias("x"))
    stats = rows.groupBy("period").agg(
        F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.count_if(F.col("x") > 0).alias("up"), F.count_if(F.col("x") < 0).alias("down"), F.count_if(F.col("x") == 0).alias("flat")
    )
    out = stats.join(grouped_quantiles(rows, ["period"], "x", quantiles), "period", "left")
    return out.select("period", *[F.col("q")[i].alias(n) for i, n in enumerate(names)], "mean", "std", "up", "down", "flat")


def outlier_counts(df: DataFrame, x: str, edges=(10, 20, 50, 100)) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(e).alias("above"), F.count_if(F.col(x) > e).alias("n")) for e in edges])
    return df.agg(rows.alias("p")).select(F.explode("p").alias("p")).select("p.*")


def top_outliers(df: DataFrame, x: str, columns: list[str], k: int = 20) -> DataFrame:
    """The k rows with the largest x, ties in order of the columns."""
    return df.filter(F.col(x).isNotNull()).orderBy(F.desc(x), *columns).limit(k).select(*columns, x)


def hit_rates(events: DataFrame, days: DataFrame) -> DataFrame:
    """Per event type: events, tickers, the share of all days in percent, and events per ticker."""
    total = days.agg(F.count("*").alias("total"))
    out = events.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("ticker").alias("tickers")).join(F.broadcast(total))  # one row
    return out.select("event_type", "n", "tickers", ratio(F.col("n") * 100.0, F.col("total")).alias("hit_rate_pct"), ratio(F.col("n") * 1.0, F.col("tickers")).alias("per_ticker"))


def yearly_density(watchlist: DataFrame, date: str = "date", by_month: bool = False) -> DataFrame:
    """Tickers per day, summed up by year (and month)."""
    keys = [F.year(date).alias("year")] + ([F.month(date).alias("month")] if by_month else [])
    daily = watchlist.groupBy(date).agg(F.countDistinct("ticker").alias("k"))
    return daily.groupBy(*keys).agg(F.sum("k").alias("total"), F.count("*").alias("days"), F.avg("k").alias("mean"), F.percentile("k", 0.5).alias("median"), F.max("k").alias("most"))


def event_stats(events: DataFrame) -> DataFrame:
    """Range, mean and upper quantiles of the value, and events per ticker, by event type."""
    out = events.groupBy("event_type").agg(
        F.count("*").alias("n"), F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max"), F.countDistinct("ticker").alias("tickers")
    )
    places = grouped_quantiles(events, ["event_type"], "value", [0.5, 0.95, 0.99]).withColumnRenamed("event_type", "type_")
    out = out.join(places, F.col("event_type").eqNullSafe(F.col("type_")), "left")
    return out.select("event_type", "n", "min", "mean", "max", F.col("q")[0].alias("median"), F.col("q")[1].alias("p95"), F.col("q")[2].alias("p99"), ratio(F.col("n") * 1.0, F.col("tickers")).alias("per_ticker"))


HORIZONS = ("ret_1d", "ret_3d", "ret_5d", "ret_10d")


def forward_performance(signals: DataFrame, group: str, horizons=HORIZONS) -> DataFrame:
    """Per group and horizon: n, wins, moments, win rate, mean over deviation (0 where the deviation is)."""
    long = signals.unpivot([group], list(horizons), "horizon", "ret").filter("ret is not null")
    out = long.groupBy(group, "horizon").agg(
        F.count("*").alias("n"), F.count_if(F.col("ret") > 0).alias("wins"), F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("std"), F.min("ret").alias("min"), F.max("ret").alias("max")
    )
    sharpe = F.coalesce(ratio(F.col("mean"), F.col("std")), F.lit(0.0))
    return out.withColumn("win_rate", F.col("wins") / F.col("n")).withColumn("sharpe", sharpe)


def pair_performance(signals: DataFrame, horizon: str = "ret_3d", least: int = 10) -> DataFrame:
    """The same for every two events of a day (events: sorted array); a day's pairs come from its own row."""
    pairs = F.flatten(F.transform("events", lambda a: F.transform(F.filter("events", lambda b: b > a), lambda b: F.struct(a.alias("first"), b.alias("second")))))
    rows = signals.filter(F.col(horizon).isNotNull()).select(F.col(horizon).alias("ret"), F.explode(pairs).alias("p")).select("ret", "p.*")
    out = rows.groupBy("first", "second").agg(F.count("*").alias("n"), F.count_if(F.col("ret") > 0).alias("wins"), F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("std")).filter(F.col("n") >= least)
    return out.withColumn("win_rate", F.col("wins") / F.col("n")).withColumn("sharpe", F.coalesce(ratio(F.col("mean"), F.col("std")), F.lit(0.0)))


def ticker_activity(watchlist: DataFrame) -> DataFrame:
    """Days, events, first and last day, span, different events and their diversity n_unique * ln(n_days)."""
    days = watchlist.groupBy("ticker").agg(F.count("*").alias("n_days"), F.sum("event_count").alias("total_events"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    kinds = watchlist.select("ticker", F.explode("events").alias("e")).groupBy("ticker").agg(F.countDistinct("e").alias("n_unique"))
    return days.join(kinds, "ticker").withColumns({"span_days": F.datediff("last_day", "first_day"), "diversity": F.col("n_unique") * F.ln("n_days")})


def pivot_counts(events: DataFrame, values: list[str]) -> DataFrame:
    return events.groupBy(F.year("date").alias("year")).pivot("event_type", values).count().fillna(0)


def presence_matrix(watchlist: DataFrame, values: list[str]) -> DataFrame:
    return watchlist.select("ticker", "date", *[F.array_contains("events", v).cast("int").alias(v.split("_")[0]) for v in values])


def cooccurrence_corr(watchlist: DataFrame, values: list[str]) -> DataFrame:
    """Correlation of the presence of every two events, in one aggregate; NaN for an event that all rows or none have."""
    m, codes = presence_matrix(watchlist, values), [v.split("_")[0] for v in values]
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), correlation(F.col(a).cast("double"), F.col(b).cast("double")).alias("corr")) for i, a in enumerate(codes) for b in codes[i + 1 :]]
    return m.agg(F.array(*rows).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def gini(weights: DataFrame, keys=("ticker", "date"), x: str = "weight") -> DataFrame:
    """Gini coefficient per group: 1 if a value is negative, 0 for no mass beyond 1e-18."""
    w = Window.partitionBy(*keys).orderBy(x)
    ranked = weights.withColumn("i", F.row_number().over(w)).withColumn("x_", F.col(x) + 1e-18)
    out = ranked.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("x_").alias("total"), F.sum(F.col("i") * F.col("x_")).alias("ranked"), F.min(x).alias("low"))
    value = (2 * F.col("ranked") - (F.col("n") + 1) * F.col("total")) / (F.col("n") * F.col("total"))
    return out.select(*keys, F.when(F.col("low") < 0, 1.0).otherwise(F.coalesce(value, F.lit(0.0))).alias("gini"))


def set_intersection_windows(coverage: DataFrame) -> DataFrame:
    """coverage (ticker, window): how many tickers are complete in how many windows."""
    per = coverage.groupBy("ticker").agg(F.countDistinct("window").alias("windows"))
    return per.groupBy("windows").agg(F.count("*").alias("tickers"))


def ticker_event_stats(cache: DataFrame) -> DataFrame:
    return cache.groupBy("ticker").agg(
        F.count("*").alias("n"), F.avg("rvol30").alias("mean_rvol"), F.avg(F.abs("pctchg_d")).alias("mean_change"), F.avg("dollar_vol_d").alias("mean_dollar"), F.avg("close_d").alias("mean_price")
    )


def count_histogram(stats: DataFrame, edges=(1, 2, 5, 10, 20, 50, 100)) -> DataFrame:
    """Tickers by the range their count is in; a range is named by its lower edge."""
    chain = F.lit(0)
    for e in edges:
        chain = F.when(F.col("n") >= e, e).otherwise(chain)
    return stats.groupBy(chain.alias("from_n")).agg(F.count("*").alias("tickers"))


def label_returns(labels: DataFrame) -> DataFrame:
    """Share, mean and deviation of returns per label."""
    total = F.sum(F.count("*")).over(Window.partitionBy())  # over the groups, three rows
    return labels.groupBy("label").agg(F.count("*").alias("n"), (F.count("*") * 100.0 / total).alias("pct"), F.avg("ret_at_outcome").alias("mean"), F.stddev_samp("ret_at_outcome").alias("std"))
