"""Triple-barrier labels, sample weights, features, the training set and its split."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, WindowSpec, functions as F, types as T

from tickloom.functions.expressions import by, ratio
from tickloom.functions.ordering import row_index
from tickloom.operators.windows import ema_values

KEYS = ("ticker", "date")


def bar_window() -> WindowSpec:
    return by(KEYS, "bar_no")


def bar_vol(bars: DataFrame, method: str = "ema", span: int = 50) -> DataFrame:
    """Volatility at each bar: exponential or rolling mean of |log return| within the day (first return 0)."""
    before = F.lag("c").over(bar_window())
    df = bars.withColumn("abs_ret", F.coalesce(F.abs(F.ln(F.when((F.col("c") > 0) & (before > 0), ratio(F.col("c"), before)))), F.lit(0.0)))
    if method == "sma":
        return df.withColumn("vol", F.avg("abs_ret").over(bar_window().rowsBetween(1 - span, 0))).drop("abs_ret")
    schema = T.StructType([*bars.schema.fields, T.StructField("vol", T.DoubleType())])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("bar_no", kind="stable")
        return part.assign(vol=ema_values(part["abs_ret"].to_numpy(float), span)).drop(columns="abs_ret")

    return df.groupBy(*KEYS).applyInPandas(run, schema)


def first_hits(h: np.ndarray, low: np.ndarray, top: np.ndarray, bottom: np.ndarray, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bar the steps to the first bar whose high or low touches its barrier (0: none); high goes first."""
    n = len(h)
    up, down, open_ = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(1, min(horizon, n - 1) + 1):  # all bars at once, one step ahead at a time
        i = np.flatnonzero(open_[: n - k])
        if not len(i):
            break
        hit_up = h[i + k] >= top[i]
        hit_down = ~hit_up & (low[i + k] <= bottom[i])
        up[i[hit_up]], down[i[hit_down]] = k, k
        open_[i[hit_up | hit_down]] = False
    return up, down


def triple_barrier(bars_with_vol: DataFrame, pt: float = 3.0, sl: float = 2.0, t1: int = 120) -> DataFrame:
    """anchor, end, hits, label and return of every bar; the barriers are pt and sl times volatility."""
    schema = T.StructType([bars_with_vol.schema[k] for k in KEYS] + T._parse_datatype_string(
        "bar_no long, anchor_ts long, end_bar long, t1 long, pt_hit boolean, sl_hit boolean, label int, ret_at_outcome double, vol_at_anchor double"
    ).fields)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("bar_no", kind="stable").reset_index(drop=True)
        c, vol, n = part["c"].to_numpy(float), np.maximum(1e-8, part["vol"].to_numpy(float)), len(part)
        up, down = first_hits(part["h"].to_numpy(float), part["l"].to_numpy(float), c * (1 + pt * vol), c * (1 - sl * vol), t1)
        i = np.arange(n)
        end = np.where(up + down > 0, i + up + down, np.minimum(n - 1, i + t1))
        number = part["bar_no"].to_numpy()
        return pd.DataFrame({
            "ticker": part["ticker"], "date": part["date"], "bar_no": number, "anchor_ts": part["t_close"], "end_bar": number[end],
            "t1": part["t_close"].to_numpy()[end], "pt_hit": up > 0, "sl_hit": down > 0, "label": np.sign(up).astype(np.int32) - np.sign(down).astype(np.int32),
            "ret_at_outcome": c[end] / c - 1, "vol_at_anchor": vol,
        })

    return bars_with_vol.groupBy(*KEYS).applyInPandas(run, schema)


def concurrency(labels: DataFrame) -> DataFrame:
    """How many labels of the ticker-day are open at each anchor: the starts up to it less the ends before it.

    Labels and their ends go through one ordered stream, so nothing is joined back.
    """
    rows = labels.select(*KEYS, F.col("bar_no").alias("at_"), F.lit(1).alias("step_"), F.struct(*labels.columns).alias("row_"))
    ends = labels.select(*KEYS, (F.col("end_bar") + 1).alias("at_"), F.lit(-1).alias("step_"), F.lit(None).cast(rows.schema["row_"].dataType).alias("row_"))
    upto = by(KEYS, "at_").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = rows.union(ends).withColumn("open_", F.greatest(F.lit(1), F.sum("step_").over(upto))).filter("row_ is not null")
    return counted.select("row_.*", F.col("open_").alias("concurrency"))


def sample_weights(labels: DataFrame, uniqueness: bool = True, abs_return: bool = True, half_life: float | None = None) -> DataFrame:
    """|return| (or 1) over concurrency, with opt-in decay by age in days, normalised per ticker-day."""
    df = concurrency(labels) if uniqueness else labels.withColumn("concurrency", F.lit(1))
    base = (F.abs("ret_at_outcome") if abs_return else F.lit(1.0)) / F.col("concurrency")
    df = df.withColumn("raw", base)
    if half_life:
        df = time_decay(df, half_life).withColumn("raw", F.col("raw") * F.col("decay")).drop("decay")
    total = F.sum("raw").over(Window.partitionBy(*KEYS))
    return df.withColumn("weight", F.col("raw") / F.greatest(F.lit(1e-12), total)).select(*KEYS, "bar_no", "anchor_ts", "concurrency", "weight")


def time_decay(df: DataFrame, half_life: float) -> DataFrame:
    """0.5 ** (age in days / half_life), the age against the ticker's last day."""
    last = F.max("date").over(Window.partitionBy("ticker"))
    return df.withColumn("decay", F.pow(F.lit(0.5), F.datediff(last, "date") / half_life))


EMA_SPANS = {"ret_1": (10, 30), "range_norm": (20,), "vol_f": (20,), "dollar_f": (20,), "imb_f": (20,)}


def bar_features(bars: DataFrame) -> DataFrame:
    """The 14 features of a bar: returns, ranges, sizes, their exponential means and z-scores, and ticks."""
    before = F.lag("c").over(bar_window())
    df = bars.select(
        *KEYS, "bar_no", "t_close", F.coalesce(F.ln(F.when((F.col("c") > 0) & (before > 0), ratio(F.col("c"), before))), F.lit(0.0)).alias("ret_1"),
        ((F.col("h") - F.col("l")) / (F.abs(F.coalesce(before, F.col("c"))) + 1e-12)).alias("range_norm"), F.col("v").cast("double").alias("vol_f"),
        F.col("dollar").alias("dollar_f"), F.col("imbalance_score").alias("imb_f"), F.col("n").alias("n"),
    )
    added = [f"{x}_ema{s}" for x, spans in EMA_SPANS.items() for s in spans]
    schema = T.StructType([*df.schema.fields, *[T.StructField(a, T.DoubleType()) for a in added]])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("bar_no", kind="stable")
        return part.assign(**{f"{x}_ema{s}": ema_values(part[x].to_numpy(float), s) for x, spans in EMA_SPANS.items() for s in spans})

    df = df.groupBy(*KEYS).applyInPandas(run, schema)
    frame = bar_window().rowsBetween(-19, 0)
    for x, name in (("vol_f", "vol_z20"), ("dollar_f", "dollar_z20")):
        deviation = F.stddev_samp(x).over(frame)
        z = F.when((F.count(x).over(frame) == 20) & (deviation > 0), (F.col(x) - F.avg(x).over(frame)) / (deviation + 1e-12))
        df = df.withColumn(name, F.coalesce(z, F.lit(0.0)))
    return df


def assemble(labels: DataFrame, features: DataFrame, weights: DataFrame) -> DataFrame:
    """labels with the features of their bar (null and NaN as 0) and their weight (1 where absent)."""
    keys = [*KEYS, "bar_no"]
    names = [c for c in features.columns if c not in (*keys, "t_close")]
    clean = features.select(*keys, *[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in names])
    return labels.join(clean, keys).join(weights.select(*keys, "weight"), keys, "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))


def build_dataset(bars: DataFrame, labels: DataFrame, weights: DataFrame) -> DataFrame:
    """The training rows of the ticker-days that have labels and bars."""
    return assemble(labels, bar_features(bars), weights)


def global_dataset(parts: list[DataFrame]) -> DataFrame:
    """All parts as one table, labels and weights without nulls; the split gives the global order."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return whole.withColumn("label", F.coalesce("label", F.lit(0))).withColumn("weight", F.coalesce("weight", F.lit(1.0)))


def walk_forward_split(df: DataFrame, folds: int = 5, purge: int = 50, order=("anchor_ts", "ticker", "date", "bar_no"), drop_overlap: bool = False) -> DataFrame:
    """df with idx and part: train up to the last fold less the purged rows, valid from there on."""
    indexed = row_index(df, *order)
    n = indexed.count()
    cut = (n * (folds - 1)) // folds
    part = F.when(F.col("idx") < max(cut - purge, 0), "train").when(F.col("idx") >= cut, "valid").otherwise("purged")
    out = indexed.withColumn("part", part)
    if drop_overlap:
        first = out.filter("part = 'valid'").agg(F.min("anchor_ts").alias("first_valid"))
        out = out.join(F.broadcast(first)).withColumn("part", F.when((F.col("part") == "train") & (F.col("t1") >= F.col("first_valid")), "purged").otherwise(F.col("part"))).drop("first_valid")
    return out


def dataset_meta(split: DataFrame) -> DataFrame:
    return split.groupBy("part").agg(F.count("*").alias("rows"), F.min("anchor_ts").alias("first_ts"), F.max("anchor_ts").alias("last_ts"), F.sum("weight").alias("weight"))
