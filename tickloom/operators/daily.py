"""Aggregations of ticks, minutes and bars to coarser bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.functions.clock import epoch_micros, floored
from tickloom.functions.expressions import ratio


def ohlcv(df: DataFrame, keys: list[str], t: str, price: str, size: str) -> DataFrame:
    """Open, high, low, close, volume, count and dollar volume of prices in order of t (a column or struct)."""
    p, s = F.col(price), F.col(size)
    return df.groupBy(*keys).agg(
        F.min_by(p, t).alias("o"), F.max(p).alias("h"), F.min(p).alias("l"), F.max_by(p, t).alias("c"),
        F.sum(s).alias("v"), F.count("*").alias("n"), F.sum(p * s).alias("dollar"),
    )


def minute_to_daily_ohlcv(minutes: DataFrame) -> DataFrame:
    """Daily bars of minute bars; dollar is the sum of volume times close."""
    return minutes.groupBy("ticker", "date").agg(
        F.min_by("o", "t").alias("o"), F.max("h").alias("h"), F.min("l").alias("l"), F.max_by("c", "t").alias("c"),
        F.sum("v").alias("v"), F.sum("n").alias("n"), F.sum(F.col("v") * F.col("c")).alias("dollar"),
    )


def daily_cache_agg(minutes: DataFrame, session_minutes: int = 390) -> DataFrame:
    """Closing price, volume, dollar volume, VWAP (null without volume), rows and gap flag of a session."""
    daily = minutes.groupBy("ticker", F.col("date").alias("trading_day")).agg(
        F.max_by("c", "t").alias("close_d"), F.sum("v").alias("vol_d"), F.sum(F.col("v") * F.col("vw")).alias("dollar_vol_d"), F.count("n").alias("session_rows")
    )
    return daily.withColumn("vwap_d", ratio(F.col("dollar_vol_d"), F.col("vol_d"))).withColumn("has_gaps", F.col("session_rows") < session_minutes)


def ticks_to_minute(ticks: DataFrame, unit: str = "minute") -> DataFrame:
    """OHLCV and VWAP per ticker and minute (or second, hour, day in UTC) of event time ts."""
    keyed = ticks.withColumn("minute", floored(epoch_micros(ticks, "ts"), unit))
    bars = ohlcv(keyed, ["ticker", "date", "minute"], "seq", "p", "s")
    return bars.withColumn("vw", ratio(F.col("dollar"), F.col("v"))).withColumn("t", F.unix_micros(F.col("minute").cast("timestamp")))


def bars_to_minute(bars: DataFrame, unit: str = "minute") -> DataFrame:
    """Information bars regrouped by the minute of t_close."""
    keyed = bars.withColumn("minute", floored(F.col("t_close"), unit))
    return keyed.groupBy("ticker", "minute").agg(
        F.min_by("o", "bar_no").alias("o"), F.max("h").alias("h"), F.min("l").alias("l"), F.max_by("c", "bar_no").alias("c"), F.sum("v").alias("v")
    )


def day_features(bars: DataFrame) -> DataFrame:
    """Mean relative body and range, volumes, mean imbalance and ticks of a day's bars."""
    return bars.groupBy("ticker", "date").agg(
        F.avg(ratio(F.col("c") - F.col("o"), F.col("o"))).alias("ret_mean"), F.avg(ratio(F.col("h") - F.col("l"), F.col("o"))).alias("range_mean"),
        F.sum("v").alias("vol_sum"), F.sum("dollar").alias("dollar_sum"), F.avg("imbalance_score").alias("imbalance_mean"), F.sum("n").alias("n_sum"),
    )


def daily_quality(minutes: DataFrame, gap_days: int = 7) -> DataFrame:
    """Per ticker: days, minutes, minutes per day, price range, repeated minutes and long gaps."""
    days = minutes.groupBy("ticker", "date").agg(
        F.count("*").alias("rows"), F.countDistinct("minute").alias("minutes"), F.min("l").alias("low"), F.max("h").alias("high"), F.sum("v").alias("volume")
    )
    last = F.lag("date").over(Window.partitionBy("ticker").orderBy("date"))
    days = days.withColumn("gap", (F.datediff("date", last) > gap_days).cast("int"))
    return days.groupBy("ticker").agg(
        F.count("*").alias("days"), F.sum("minutes").alias("minutes"), F.min("minutes").alias("min_per_day"), F.avg("minutes").alias("avg_per_day"),
        F.max("minutes").alias("max_per_day"), F.sum("volume").alias("volume"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum(F.col("rows") - F.col("minutes")).alias("repeated"), F.coalesce(F.sum("gap"), F.lit(0)).alias("gaps"),
    )
