"""Maps of days, first passages and bars over days against plain loops."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickloom.operators import bars
from tickloom.operators.carry import carry_map, first_passages


def walked(x, sizes, limit):
    """The sum carried out and the bars closed, tick by tick."""
    closed = 0
    for s in sizes:
        x += s
        if x >= limit:
            x, closed = 0, closed + 1
    return x, closed


def test_maps_of_days_compose_like_ticks():
    rng = np.random.default_rng(3)
    for _ in range(150):
        limit = int(rng.integers(1, 60))
        a, b, c = (rng.integers(0, 12, size=rng.integers(0, 25)) for _ in range(3))
        x, one = np.arange(limit, dtype=float), [carry_map(z, limit) for z in (a, b, c)]
        for made, ticks in ((one[0], a), (one[0].then(one[1]).then(one[2]), np.r_[a, b, c]), (one[0].then(one[1].then(one[2])), np.r_[a, b, c])):
            out, closed = made.at(x)
            assert list(zip(out.astype(int).tolist(), closed.tolist())) == [walked(int(i), ticks.tolist(), limit) for i in x]


def looped(step, limits, sizes=None, cap=np.inf):
    out, number, run, total = [], 0, 0, 0
    for i, s in enumerate(step):
        run, total = run + s, total + (0 if sizes is None else sizes[i])
        out.append(number)
        if abs(run) >= limits[i] or total >= cap:
            number, run, total = number + 1, 0, 0
    return out


def test_first_passages_equal_a_loop():
    rng = np.random.default_rng(4)
    for turn in range(200):
        n = int(rng.integers(0, 9000 if turn % 40 == 0 else 300))
        step, size = rng.integers(-9, 10, n), rng.integers(0, 9, n)
        limits = rng.integers(1, 60, n) if turn % 2 else np.full(n, int(rng.integers(1, 500)))
        cap = int(rng.integers(1, 400))
        assert first_passages(np.cumsum(step), limits).tolist() == looped(step, limits)
        assert first_passages(np.cumsum(step), limits, np.cumsum(size), cap).tolist() == looped(step, limits, size, cap)


def test_long_bars_under_a_moving_threshold():
    rng = np.random.default_rng(5)
    sign, size = rng.integers(-1, 2, 60_000), rng.integers(1, 50, 60_000)
    mean = pd.Series(np.abs(sign)).ewm(alpha=0.2, adjust=False).mean().to_numpy()
    for target in (30, 2_000, 20_000):
        assert bars.imbalance_ids(sign, size, target, 0.2).tolist() == looped((sign * size).tolist(), np.maximum(1, mean * target).tolist(), size.tolist(), target)


def test_a_hot_ticker_is_made_day_by_day(spark):
    rng = np.random.default_rng(6)
    rows = [("HOT" if i % 10 else f"t{i % 3}", i) for i in range(6000)]
    at = pd.DataFrame(rows, columns=["ticker", "i"]).assign(s=rng.integers(0, 50, 6000), cents=rng.integers(1, 400, 6000))
    at["date"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(at["i"] // 100, unit="D")
    at["t_raw"] = at["i"] // 2  # ties go by seq
    ticks = spark.createDataFrame(at).select("ticker", F.to_date("date").alias("date"), "t_raw", F.col("i").alias("seq"), (F.col("cents") / 100).alias("p"), "s", "cents")
    for made, size, limit in ((bars.dollar_bars_multi_day(ticks, 900.0), lambda d: d["cents"] * d["s"], 90_000), (bars.volume_bars_multi_day(ticks, 20_000), lambda d: d["s"], 20_000)):
        got = made.toPandas().sort_values(["ticker", "bar_no"])
        for name, one in at.groupby("ticker"):
            number, total, want = 0, 0, []
            for s in size(one).tolist():
                want.append(number)
                total += s
                if total >= limit:
                    number, total = number + 1, 0
            g = one.assign(bar=want, sign=np.sign(one["cents"].diff().fillna(0))).groupby("bar")
            mine = got[got["ticker"] == name]
            assert mine["bar_no"].tolist() == list(g.groups)
            assert mine["n"].tolist() == g.size().tolist() and mine["v"].tolist() == g["s"].sum().tolist()
            assert mine["c"].tolist() == (g["cents"].last() / 100).tolist() and mine["o"].tolist() == (g["cents"].first() / 100).tolist()
            np.testing.assert_allclose(mine["imbalance_score"], g["sign"].mean(), atol=1e-12)
