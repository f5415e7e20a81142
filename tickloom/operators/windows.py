"""Window features of daily and intraday series, by ticker in order of date."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tickloom.functions.expressions import by, daily_window, full_window, price_change, ratio, run_length
from tickloom.functions.ordering import running
from tickloom.operators.sliding import sliding_extreme


def prev_close(daily: DataFrame) -> DataFrame:
    return daily.withColumn("prev_c", F.lag("c").over(daily_window()))


def cache_features(cache: DataFrame, rows: int = 30) -> DataFrame:
    """Change, log return and relative volume against the mean of the last rows, today's among them."""
    w = by("ticker", "trading_day")
    before = F.lag("close_d").over(w)
    mean = F.avg("vol_d").over(w.rowsBetween(1 - rows, 0))
    return cache.withColumns({
        "pctchg_d": price_change(F.col("close_d"), before),
        "return_d": F.when((F.col("close_d") > 0) & (before > 0), F.ln(ratio(F.col("close_d"), before))),
        "rvol30": ratio(F.col("vol_d"), mean),
    })


def rvol_strict(daily: DataFrame, rows: int = 20, include_today: bool = True) -> DataFrame:
    """Volume against the mean of a full window of rows; null until it is full."""
    first, last = (1 - rows, 0) if include_today else (-rows, -1)
    return daily.withColumn("rvol", ratio(F.col("v"), full_window(F.col("v"), daily_window(), first, last, F.avg, rows)))


def forward_returns(daily: DataFrame, horizons: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    return daily.withColumns({f"ret_{k}d": ratio(F.lead("c", k).over(daily_window()), F.col("c")) - 1 for k in horizons})


def rolling_max_prev(daily: DataFrame, rows: int = 252) -> DataFrame:
    """Highest close of the rows before today; null until there are as many closes."""
    return sliding_max(daily, "c", rows, "max_prev")


def sliding_max(df: DataFrame, x: str, rows: int, out: str, keys=("ticker",), order=("date",)) -> DataFrame:
    """Largest x of the `rows` rows before each; null unless all of them are there and have one.

    A ticker's rows are cut into blocks of `rows`: a window that ends in one block began in the block before,
    so that it is the end of one and the beginning of the other, each a running maximum. No frame slides: the
    time is linear in the rows, whatever their number in a window.
    """
    whole = by(keys, *order)
    place = df.withColumn("row_", F.row_number().over(whole) - 1).withColumn("seen_", F.count(x).over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    block = by([*keys, "block_"], *order)
    place = place.withColumn("block_", F.floor(F.col("row_") / rows))
    place = place.withColumn("upto_", F.max(x).over(block.rowsBetween(Window.unboundedPreceding, 0))).withColumn("from_", F.max(x).over(block.rowsBetween(0, Window.unboundedFollowing)))
    last, first = (F.lag(c, k).over(whole) for c, k in (("upto_", 1), ("from_", rows)))
    full = (F.col("row_") >= rows) & (F.lag("seen_", 1).over(whole) - F.coalesce(F.lag("seen_", rows + 1).over(whole), F.lit(0)) == rows)
    return place.withColumn(out, F.when(full, F.greatest(first, last))).drop("row_", "seen_", "block_", "upto_", "from_")


def rolling_zscore(df: DataFrame, x: str, rows: int = 20, keys=("ticker",), order=("date",)) -> DataFrame:
    """(x - mean) / (sample deviation + 1e-12) over the last rows; 0 until there are enough or where constant."""
    frame = by(keys, *order).rowsBetween(1 - rows, 0)
    mean, deviation = F.avg(x).over(frame), F.stddev_samp(x).over(frame)
    z = F.when((F.count(x).over(frame) == rows) & (deviation > 0), (F.col(x) - mean) / (deviation + 1e-12))
    return df.withColumn(f"{x}_z", F.coalesce(z, F.lit(0.0)))


def streaks(daily: DataFrame) -> DataFrame:
    """Lengths of the runs of green (c > o) and red (c < o) days that end at each row."""
    return daily.withColumn("green_run", run_length(F.col("c") > F.col("o"), daily_window())).withColumn("red_run", run_length(F.col("c") < F.col("o"), daily_window()))


def cumulative(minutes: DataFrame) -> DataFrame:
    """Running volume and dollar volume of the day, and the change since its open."""
    w = by(("ticker", "date"), "t").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.first("o").over(w)
    return minutes.withColumns({"cum_v": F.sum("v").over(w), "cum_dollar": F.sum(F.col("v") * F.col("c")).over(w), "pct_open": price_change(F.col("c"), opened)})


def first_trigger(minutes: DataFrame, change: float = 0.15, dollars: float = 5e6, low: float = 0.2, high: float = 20.0) -> DataFrame:
    """The first bar of a day that moved enough on enough dollar volume within the price range."""
    hit = (F.abs("pct_open") >= change) & (F.col("cum_dollar") >= dollars) & F.col("c").between(low, high)
    return cumulative(minutes).filter(hit).groupBy("ticker", "date").agg(F.min_by(F.struct("t", "c", "cum_dollar", "pct_open"), "t").alias("x")).select("ticker", "date", "x.*")


def last_n(df: DataFrame, rows: int = 252, order: str = "date") -> DataFrame:
    return df.withColumn("rank_", F.row_number().over(by("ticker", F.col(order).desc()))).filter(F.col("rank_") <= rows).drop("rank_")


def ema_values(x: np.ndarray, span: float) -> np.ndarray:
    """alpha = 2 / (span + 1), started at the first value; null counts as 0."""
    return pd.Series(np.nan_to_num(x)).ewm(span=span, adjust=False).mean().to_numpy()


def ema(df: DataFrame, x: str, span: float, keys=("ticker", "date"), order=("bar_no",)) -> DataFrame:
    """Exponential mean along a group: infinite memory, so a grouped kernel and no frame."""
    schema = T.StructType([*df.schema.fields, T.StructField(f"{x}_ema{span:g}", T.DoubleType())])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(list(order), kind="stable")
        return part.assign(**{f"{x}_ema{span:g}": ema_values(part[x].to_numpy(float), span)})

    return df.groupBy(*keys).applyInPandas(run, schema)


def scd_next(snapshots: DataFrame) -> DataFrame:
    return snapshots.withColumn("effective_to", F.lead("as_of").over(by("ticker", "as_of")))


def percentile_score(df: DataFrame, weights: dict[str, float], heavy: float = 70.0, medium: float = 40.0) -> DataFrame:
    """Rank percentiles of the columns, their weighted sum and its class. Ranks are taken through counts per
    value and a running sum over ranges of values, so no task sees all of them."""
    total = df.agg(F.count("*").alias("total_"))
    for x in weights:
        counts = df.groupBy(x).agg(F.count("*").alias("k"))
        upto = running(counts, [x], "k", "below").select(F.col(x).alias("v_"), (F.col("below") + F.col("k")).alias(f"upto_{x}"))
        df = df.join(upto, F.col(x) == F.col("v_"), "left").drop("v_")
    df = df.join(F.broadcast(total))  # one row
    rank = {x: F.when(F.col("total_") > 1, (F.col(f"upto_{x}") - 1) * 100.0 / (F.col("total_") - 1)).otherwise(100.0) for x in weights}
    df = df.withColumns({f"pct_{x}": r for x, r in rank.items()})
    score = sum((F.col(f"pct_{x}") * w for x, w in weights.items()), F.lit(0.0))
    df = df.withColumn("score", score).drop("total_", *[f"upto_{x}" for x in weights])
    return df.withColumn("class", F.when(F.col("score") >= heavy, "heavy").when(F.col("score") >= medium, "medium").otherwise("light"))


def gap_days(df: DataFrame, most: int = 7) -> DataFrame:
    """Rows that follow the ticker's one before by more than `most` days."""
    return df.withColumn("gap", F.datediff("date", F.lag("date").over(daily_window()))).filter(F.col("gap") > most)


def rolling_range_spike(minutes: DataFrame, seconds: int = 7200) -> DataFrame:
    """Highest and lowest price of the last seconds against the open of the window's first bar.

    Bars of one second are in each other's windows. Extremes go through a queue in which each bar is once.
    """
    schema = T.StructType([*minutes.schema.fields, T.StructField("spike_up", T.DoubleType()), T.StructField("spike_down", T.DoubleType())])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["t", "o", "h", "l"], kind="stable")
        sec = part["t"].to_numpy() // 1_000_000
        first, last = np.searchsorted(sec, sec - seconds), np.searchsorted(sec, sec, "right")
        o = part["o"].to_numpy(float)[first]
        high, low = (sliding_extreme(part[c].to_numpy(float), first, last, c == "h") for c in "hl")
        with np.errstate(divide="ignore", invalid="ignore"):
            up, down = (pd.array(np.where(o == 0, np.nan, (x - o) / o), "Float64") for x in (high, low))
        return part.assign(spike_up=up, spike_down=down)

    return minutes.groupBy("ticker", "date").applyInPandas(run, schema)
