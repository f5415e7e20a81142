"""Information bars. Rules that start anew at a threshold run in a grouped kernel per ticker-day, in which
ends of bars are searched in bulk; bars that run over days are made day by day too, once small maps of the
days have been chained; the tick rule and the running variant are plain windows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tickloom.functions.expressions import by, ratio
from tickloom.operators.carry import CarryMap, carry_map, first_passages
from tickloom.session import materialise

ORDER = ("t_raw", "seq")
BAR_FIELDS = "bar_no long, t_open long, t_close long, o double, h double, l double, c double, v long, n long, dollar double, imbalance_score double"


def tick_rule(ticks: DataFrame, keys=("ticker", "date")) -> DataFrame:
    """Sign of the change to the tick before; 0 for the first and for equal prices."""
    return ticks.withColumn("sign", F.coalesce(F.signum(F.col("p") - F.lag("p").over(by(keys, *ORDER))), F.lit(0.0)).cast("int"))


def signs(p: np.ndarray) -> np.ndarray:
    return np.sign(np.diff(p, prepend=p[:1]))


def reset_bars(size: np.ndarray, target: float) -> np.ndarray:
    """Bar numbers: a bar ends with the tick that brings its sum of size to the target; the next starts at 0."""
    total, out, at, number = np.cumsum(size), np.zeros(len(size), np.int64), 0, 0
    while at < len(size):
        start = total[at - 1] if at else 0
        end = max(at, int(np.searchsorted(total, start + target, "left"))) + 1
        out[at:end] = number
        at, number = end, number + 1
    return out


def imbalance_ids(sign: np.ndarray, size: np.ndarray, target: float, alpha: float) -> np.ndarray:
    """A bar ends where its signed sum reaches max(1, mean |sign| * target), or its sum the target.

    The exponential mean goes on through bars, so that every tick's threshold is known beforehand.
    """
    mean = pd.Series(np.abs(sign)).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    return first_passages(np.cumsum(sign * size), np.maximum(1.0, mean * target), np.cumsum(size), target)


def signed_reset_ids(sign: np.ndarray, size: np.ndarray, threshold: float) -> np.ndarray:
    return first_passages(np.cumsum(sign * size), threshold)


def _bars(ticks: DataFrame, keys: tuple[str, ...], ids: Callable[[pd.DataFrame], np.ndarray], signed: bool = False) -> DataFrame:
    """Finished bars of ticks (ticker, date, t_raw, seq, p, s) under the numbers that ids() gives; signed adds imbalance."""
    fields = BAR_FIELDS + (", imbalance double" if signed else "")
    schema = T.StructType([ticks.schema[k] for k in keys] + T._parse_datatype_string(fields).fields)
    cents = "cents" in ticks.columns

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(list(ORDER), kind="stable").reset_index(drop=True)
        p, s = part["p"].to_numpy(float), part["s"].to_numpy(np.int64)
        dollar = part["cents"].to_numpy(np.int64) * s if cents else p * s
        part = part.assign(bar_no=ids(part), dollar=dollar, sign=signs(p), signed=dollar * signs(p))
        g = part.groupby("bar_no", sort=True)
        out = pd.DataFrame({
            "t_open": g["t_raw"].first(), "t_close": g["t_raw"].last(), "o": g["p"].first(), "h": g["p"].max(), "l": g["p"].min(), "c": g["p"].last(),
            "v": g["s"].sum(), "n": g.size(), "dollar": g["dollar"].sum() / (100 if cents else 1), "imbalance_score": g["sign"].mean(),
            "imbalance": g["signed"].sum() / (100 if cents else 1),
        }).reset_index()
        for k in keys:
            out[k] = part[k].iloc[0]
        return out[[f.name for f in schema]]

    return ticks.groupBy(*keys).applyInPandas(run, schema)


def _money(part: pd.DataFrame) -> np.ndarray:
    """p * s, in whole cents where the ticks have them, so that sums are exact."""
    s = part["s"].to_numpy(np.int64)
    return part["cents"].to_numpy(np.int64) * s if "cents" in part else part["p"].to_numpy(float) * s


def _scale(ticks: DataFrame, target: float) -> float:
    return target * 100 if "cents" in ticks.columns else target


OPEN = ("bar_no", "t_open", "t_close", "o", "h", "l", "c", "v", "n", "dollar", "signs", "size", "last_p")


def extend_bars(carry: tuple | None, part: pd.DataFrame, size: np.ndarray, limit: float, dollar: np.ndarray) -> tuple[pd.DataFrame, tuple]:
    """Go on with the open bar of `carry` (fields OPEN; None at the start) through the ordered ticks of part.

    Gives the bars that they close and the bar then open, whose n is 0 where the last tick closed one.
    """
    p, held = part["p"].to_numpy(float), carry is not None and carry[8] > 0
    first, last_p = (carry[0], carry[12]) if carry else (0, p[0])
    if held:
        size = size.copy()
        size[0] += carry[11]
    ticks = pd.DataFrame({
        "bar_no": reset_bars(size, limit) + first, "t": part["t_raw"].to_numpy(), "p": p, "s": part["s"].to_numpy(np.int64), "dollar": dollar,
        "sign": np.sign(np.diff(p, prepend=last_p)), "size": size,
    })
    g = ticks.groupby("bar_no", sort=True)
    bars = pd.DataFrame({
        "t_open": g["t"].first(), "t_close": g["t"].last(), "o": g["p"].first(), "h": g["p"].max(), "l": g["p"].min(), "c": g["p"].last(),
        "v": g["s"].sum(), "n": g.size(), "dollar": g["dollar"].sum(), "signs": g["sign"].sum(), "size": g["size"].sum(),
    }).reset_index()
    if held:
        for column, value in zip(OPEN, carry):
            if column in ("t_open", "o"):
                bars.loc[0, column] = value
            elif column in ("v", "n", "dollar", "signs"):
                bars.loc[0, column] += value
        bars.loc[0, "h"], bars.loc[0, "l"] = max(bars.loc[0, "h"], carry[4]), min(bars.loc[0, "l"], carry[5])
    tail = bars.iloc[-1]
    if tail["size"] >= limit:
        return bars, (int(tail["bar_no"]) + 1, *[0] * 11, float(p[-1]))
    kept = tuple(type(v)(tail[c]) for c, v in zip(OPEN[:-1], (0, 0, 0, 0.0, 0.0, 0.0, 0.0, 0, 0, 0.0, 0.0, 0.0)))
    return bars.iloc[:-1], (*kept, float(p[-1]))


MAP = "total double, bounds array<double>, outs array<double>, counts array<long>, last_p double"
BLOCK_DAYS = 32


def _map_of(row) -> CarryMap:
    return CarryMap(row.total, *(np.array(x, kind) for x, kind in ((row.bounds, float), (row.outs, float), (row.counts, np.int64))))


def _map_columns(m: CarryMap, last_p: float) -> dict:
    return {"total": [m.total], "bounds": [m.bounds], "outs": [m.outs], "counts": [m.counts], "last_p": [last_p]}


def _bars_over_days(ticks: DataFrame, limit: float, by_volume: bool) -> DataFrame:
    """Bars that run over days, each day of a ticker by itself.

    A day gives a map from the open bar's sum before it to the sum after it. The maps of a block of days are
    composed, those of a ticker's blocks are walked, and walking each block again gives every day the sum and
    the number of the bar that is open before it. With these each day makes its own parts of bars, and parts
    of one bar, from days in a row, are put together.
    """
    cents = "cents" in ticks.columns
    key = [ticks.schema["ticker"]]
    day = [ticks.schema["ticker"], ticks.schema["date"]]
    needed = ["ticker", "date", "t_raw", "seq", "p", "s", *(["cents"] if cents else [])]

    def kind(fields: list, text: str) -> T.StructType:
        return T.StructType(fields + T._parse_datatype_string(text).fields)

    def sizes(part: pd.DataFrame) -> np.ndarray:
        return part["s"].to_numpy(np.int64) if by_volume else _money(part)

    def of_day(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(list(ORDER), kind="stable")
        block = (pd.Timestamp(part["date"].iloc[0]) - pd.Timestamp(0)).days // BLOCK_DAYS
        return pd.DataFrame({"ticker": [part["ticker"].iloc[0]], "date": [part["date"].iloc[0]], "block": [block]} | _map_columns(carry_map(sizes(part), limit), float(part["p"].iloc[-1])))

    def of_block(part: pd.DataFrame) -> pd.DataFrame:
        rows = list(part.sort_values("date").itertuples(index=False))
        whole = _map_of(rows[0])
        for row in rows[1:]:
            whole = whole.then(_map_of(row))
        return pd.DataFrame({"ticker": [rows[0].ticker], "block": [rows[0].block]} | _map_columns(whole, rows[-1].last_p))

    def walk(rows: pd.DataFrame, order: str, x: float, bar: int, last_p: float | None) -> pd.DataFrame:
        """Each row with the sum, bar and price before it."""
        out = []
        for row in rows.sort_values(order).itertuples(index=False):
            out.append((row.ticker, getattr(row, order), x, bar, last_p))
            (x,), (more,) = _map_of(row).at(np.array([x]))
            x, bar, last_p = float(x), bar + int(more), row.last_p
        return pd.DataFrame(out, columns=["ticker", order, "x", "bar", "prev_p"]).astype({"prev_p": float})

    def of_ticker(part: pd.DataFrame) -> pd.DataFrame:
        return walk(part, "block", 0.0, 0, None)

    def within(part: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        return walk(part, "date", *start[["x", "bar", "prev_p"]].iloc[0])

    def parts_of(part: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(list(ORDER), kind="stable").reset_index(drop=True)
        x, bar, prev_p = start[["x", "bar", "prev_p"]].iloc[0]
        p, size = part["p"].to_numpy(float), sizes(part).copy()
        if x:
            size[0] += type(size[0])(x)
        number = reset_bars(size, limit) + int(bar)
        g = part.assign(bar_no=number, dollar=_money(part), sign=np.sign(np.diff(p, prepend=p[0] if np.isnan(prev_p) else prev_p))).groupby("bar_no", sort=True)
        out = pd.DataFrame({
            "t_open": g["t_raw"].first(), "t_close": g["t_raw"].last(), "o": g["p"].first(), "h": g["p"].max(), "l": g["p"].min(), "c": g["p"].last(),
            "v": g["s"].sum(), "n": g.size(), "dollar": g["dollar"].sum(), "signs": g["sign"].sum(),
        }).reset_index()
        return out.assign(ticker=part["ticker"].iloc[0], date=part["date"].iloc[0])[[f.name for f in parts]]

    parts = kind(day, f"bar_no long, t_open long, t_close long, o double, h double, l double, c double, v long, n long, dollar {'long' if cents else 'double'}, signs double")
    rows = ticks.select(*needed).groupBy("ticker", "date")
    maps = materialise(rows.applyInPandas(of_day, kind(day, f"block long, {MAP}")), "day-maps")
    blocks = maps.groupBy("ticker", "block").applyInPandas(of_block, kind(key, f"block long, {MAP}"))
    before = blocks.groupBy("ticker").applyInPandas(of_ticker, kind(key, "block long, x double, bar long, prev_p double"))
    opened = maps.groupBy("ticker", "block").cogroup(before.groupBy("ticker", "block")).applyInPandas(within, kind(day, "x double, bar long, prev_p double"))
    pieces = rows.cogroup(opened.groupBy("ticker", "date")).applyInPandas(parts_of, parts)
    return pieces.groupBy("ticker", "bar_no").agg(
        F.min("t_open").alias("t_open"), F.max("t_close").alias("t_close"), F.min_by("o", "date").alias("o"), F.max("h").alias("h"), F.min("l").alias("l"),
        F.max_by("c", "date").alias("c"), F.sum("v").alias("v"), F.sum("n").alias("n"), (F.sum("dollar") / (100 if cents else 1)).alias("dollar"), (F.sum("signs") / F.sum("n")).alias("imbalance_score"),
    )


def dollar_bars(ticks: DataFrame, target: float = 300_000) -> DataFrame:
    """Bars of equal dollar volume; the closing tick belongs to the bar, the tail of a day is kept."""
    limit = _scale(ticks, target)
    return _bars(ticks, ("ticker", "date"), lambda part: reset_bars(_money(part), limit))


def volume_bars(ticks: DataFrame, target: float = 100_000) -> DataFrame:
    return _bars(ticks, ("ticker", "date"), lambda part: reset_bars(part["s"].to_numpy(np.int64), target))


def dollar_bars_multi_day(ticks: DataFrame, target: float = 50_000) -> DataFrame:
    return _bars_over_days(ticks, _scale(ticks, target), False)


def volume_bars_multi_day(ticks: DataFrame, target: float = 50_000) -> DataFrame:
    return _bars_over_days(ticks, target, True)


def imbalance_bars(ticks: DataFrame, kind: str = "dollar", target: float = 50_000, alpha: float = 0.2, span: str = "day") -> DataFrame:
    """Dollar- or volume-imbalance bars with an exponential mean of |sign| that bars do not reset."""
    limit = _scale(ticks, target) if kind == "dollar" else target

    def ids(part: pd.DataFrame) -> np.ndarray:
        size = _money(part) if kind == "dollar" else part["s"].to_numpy(np.int64)
        return imbalance_ids(signs(part["p"].to_numpy(float)), size, limit, alpha)

    return _bars(ticks, ("ticker", "date") if span == "day" else ("ticker",), ids)


def imbalance_bars_reset(ticks: DataFrame, threshold: float = 250_000) -> DataFrame:
    """Bars that end where the signed dollar sum (imbalance) reaches the threshold; with vwap and tick count."""
    limit = _scale(ticks, threshold)
    bars = _bars(ticks, ("ticker", "date"), lambda part: signed_reset_ids(signs(part["p"].to_numpy(float)), _money(part), limit), signed=True)
    return bars.withColumn("vwap", F.coalesce(ratio(F.col("dollar"), F.col("v")), F.col("c")))


def imbalance_bars_running(ticks: DataFrame, threshold: float = 250_000) -> DataFrame:
    """No reset: a tick's bar is the number of ticks before it at which the running signed sum was beyond the threshold."""
    w = by(("ticker", "date"), *ORDER)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    money = F.col("cents") * F.col("s") / 100 if "cents" in ticks.columns else F.col("p") * F.col("s")
    df = tick_rule(ticks).withColumn("money", money).withColumn("running", F.sum(F.col("sign") * money).over(upto))
    hit = (F.abs("running") >= threshold).cast("int")
    df = df.withColumn("bar_no", F.coalesce(F.sum(hit).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    at = F.struct(*ORDER)
    return df.groupBy("ticker", "date", "bar_no").agg(
        F.min_by("p", at).alias("o"), F.max("p").alias("h"), F.min("p").alias("l"), F.max_by("p", at).alias("c"), F.sum("s").alias("v"), F.count("*").alias("n"),
        ratio(F.sum("money"), F.sum("s")).alias("vwap"), ((F.max("t_raw") - F.min("t_raw")) / 1e6).alias("duration_sec"),
    )


def minute_as_ticks(minutes: DataFrame) -> DataFrame:
    """Pseudo-trades: a minute's close as price, its volume as size."""
    return minutes.select("ticker", "date", F.col("t").alias("t_raw"), F.lit("us").alias("t_unit"), F.col("t").alias("seq"), F.col("c").alias("p"), F.col("v").cast("long").alias("s"))


def bar_anomalies(bars: DataFrame, most: float = 0.05) -> DataFrame:
    return bars.withColumn("range_pct", ratio(F.col("h") - F.col("l"), F.col("o"))).filter(F.col("range_pct") > most)


def largest_imbalance(bars: DataFrame) -> DataFrame:
    """Per ticker-day the bar of largest absolute imbalance (the first of equals)."""
    best = F.max_by(F.struct("bar_no", "imbalance_score"), F.struct(F.abs("imbalance_score"), -F.col("bar_no")))
    return bars.groupBy("ticker", "date").agg(best.alias("b")).select("ticker", "date", "b.*")


def top_label(labels: DataFrame) -> DataFrame:
    """Per ticker-day the label of largest absolute return (the first of equals)."""
    best = F.max_by(F.struct("bar_no", "label", "ret_at_outcome"), F.struct(F.abs("ret_at_outcome"), -F.col("bar_no")))
    return labels.groupBy("ticker", "date").agg(best.alias("b")).select("ticker", "date", "b.*")


def bar_stats(bars: DataFrame, target: float) -> DataFrame:
    """Bars per ticker-day, quartiles of dollars, ticks per bar, share near the target, sides by imbalance."""
    q, side = F.percentile("dollar", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))), F.col("imbalance_score")
    return bars.groupBy("ticker", "date").agg(
        F.count("*").alias("bars"), q.alias("q"), F.avg("n").alias("ticks_per_bar"), F.avg(F.col("dollar").between(0.8 * target, 1.5 * target).cast("double")).alias("near_target"),
        F.count_if(side > 0.1).alias("buying"), F.count_if(side < -0.1).alias("selling"), F.count_if(F.abs(side) <= 0.1).alias("neutral"),
    ).select("ticker", "date", "bars", F.col("q")[0].alias("dollar_p25"), F.col("q")[1].alias("dollar_p50"), F.col("q")[2].alias("dollar_p75"), "ticks_per_bar", "near_target", "buying", "selling", "neutral")
