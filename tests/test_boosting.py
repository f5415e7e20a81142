"""Grids of models against plain code, group by group."""

import numpy as np
import pandas as pd

from tickloom.operators import boosting, information


def frame(spark, seed=1, n=900):
    rng = np.random.default_rng(seed)
    rows = pd.DataFrame({
        "event_type": rng.choice(["a", "b", "c"], n, p=[0.6, 0.35, 0.05]), "pre_days": rng.integers(0, 2, n), "ticker": rng.choice(["x", "y"], n), "date": 1 + np.arange(n) % 9,
        "bar_no": np.arange(n), "u": rng.normal(size=n), "v": rng.integers(0, 5, n).astype(float), "weight": rng.random(n) + 0.1,
    })
    up = np.where(rows["event_type"] == "a", rows["u"] > 0.3, rows["v"] > 2)
    rows["label"] = np.where(rng.random(n) < 0.1, -1, np.where(up, 1, -1))
    rows["ret_at_outcome"] = 0.01 * rows["label"] + 0.005 * rng.normal(size=n)
    return rows, spark.createDataFrame(rows).repartition(5)


KEYS = ["event_type", "pre_days"]


def test_a_grid_of_models(spark):
    rows, df = frame(spark)
    made = boosting.window_models(df, ["u", "v"], KEYS, trees=6, depth=2, rate=0.4).orderBy(*KEYS).collect()
    assert [(r.event_type, r.pre_days) for r in made] == sorted(rows.groupby(KEYS).groups)
    for r in made:
        part = rows[(rows["event_type"] == r.event_type) & (rows["pre_days"] == r.pre_days)]
        assert r.n_bars == len(part) and r.n_days == len(part[["ticker", "date"]].drop_duplicates())
        if len(part) < 100:
            assert r.auc is None and r.edge is None
        else:
            assert 0.8 < r.auc <= 1 and part["ret_at_outcome"].min() <= r.edge <= part["ret_at_outcome"].max() and r.edge > 0.005
    again = boosting.window_models(df.repartition(3), ["u", "v"], KEYS, trees=6, depth=2, rate=0.4).orderBy(*KEYS).collect()
    assert [(r.n_bars, r.auc and round(r.auc, 9), r.edge and round(r.edge, 9)) for r in made] == [(r.n_bars, r.auc and round(r.auc, 9), r.edge and round(r.edge, 9)) for r in again]
    held = boosting.window_models(df, ["u", "v"], KEYS, trees=4, depth=2, rate=0.4, holdout=0.3).collect()
    assert all(r.auc is None or 0.6 < r.auc <= 1 for r in held)
    assert boosting.window_models(df.limit(0), ["u", "v"], KEYS).collect() == []


def test_the_first_split_is_the_best_one(spark):
    rows, df = frame(spark, 2)
    data = df.selectExpr("*", "cast(label > 0 as double) y")
    binned, groups = boosting.binned_rows(data, KEYS, ["u", "v"])
    forest = boosting.grow(binned, groups.count(), 2, 1, 1, 1.0, 1.0, 0)
    number = {(r.event_type, r.pre_days): r.g for r in groups.collect()}
    table = binned.toPandas()
    for g in number.values():
        part = table[table["g"] == g]
        bins, y, w = np.array(part["bins"].tolist()), part["y"].to_numpy(), part["weight"].to_numpy()
        p = np.average(y, weights=w)
        grad, hess = w * (p - y), np.full(len(y), p * (1 - p)) * w
        score = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + 1)
        gains = {(j, c): score(bins[:, j] <= c) + score(bins[:, j] > c) for j in range(2) for c in range(boosting.BINS - 1) if 0 < (bins[:, j] <= c).sum() < len(part)}
        best = max(gains.values())
        mine = int(forest.feature[g, 0, 0]), int(forest.cut[g, 0, 0])
        assert abs(gains[mine] - best) < 1e-9
        low = bins[:, mine[0]] <= mine[1]
        assert np.isclose(forest.value[g, 0, 0], -grad[low].sum() / (hess[low].sum() + 1))
        assert np.allclose(forest.margins(np.full(len(part), g), bins, 1), forest.bias[g] + np.where(low, forest.value[g, 0, 0], forest.value[g, 0, 1]))


def test_grouped_auc_by_pairs(spark):
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({"g": rng.integers(0, 3, 200), "prob": rng.integers(0, 6, 200) / 6, "y": rng.integers(0, 2, 200).astype(float), "weight": rng.random(200)})
    got = {r.g: r.auc for r in boosting.grouped_auc(spark.createDataFrame(rows).repartition(4), "g").collect()}
    for g, part in rows.groupby("g"):
        pos, neg = part[part["y"] == 1], part[part["y"] == 0]
        order = (pos["prob"].to_numpy()[:, None] > neg["prob"].to_numpy()) + 0.5 * (pos["prob"].to_numpy()[:, None] == neg["prob"].to_numpy())
        weight = pos["weight"].to_numpy()[:, None] * neg["weight"].to_numpy()
        assert np.isclose(got[g], (order * weight).sum() / weight.sum())


def test_a_single_window(spark):
    rows, df = frame(spark, 4, 400)
    one, again = (information.window_model(df, ["u", "v"], trees=3, depth=2).first() for _ in range(2))
    assert 0.5 < one.auc <= 1 and rows["ret_at_outcome"].min() <= one.edge <= rows["ret_at_outcome"].max()
    assert (one.n_bars, one.n_days) == (400, len(rows[["ticker", "date"]].drop_duplicates()))
    assert abs(one.auc - again.auc) < 1e-9 and abs(one.edge - again.edge) < 1e-9  # the seed is fixed
    few = information.window_model(df.limit(50), ["u", "v"]).first()
    assert few.auc is None and few.edge is None and few.n_bars == 50


def test_windows_of_joined_rows_are_those_of_the_grid(spark):
    """Rows that count in many windows give the models of the rows once a window, and trees see gathered rows only."""
    rows, _ = frame(spark, 5, 2000)
    rows["rel_day"] = np.random.default_rng(6).integers(-2, 3, len(rows))
    df = spark.createDataFrame(rows.drop(columns=["pre_days"])).repartition(4)
    windows, keys = ((0, 0), (1, 2), (2, 2)), ["event_type", "pre_days", "post_days"]
    options = {"trees": 3, "depth": 2, "rate": 0.4}
    got = boosting.window_models(df, ["v", "rel_day"], keys, windows=windows, **options).orderBy(*keys).collect()
    want = boosting.window_models(information.window_grid(df, windows), ["v", "rel_day"], keys, **options).orderBy(*keys).collect()
    assert len(got) == len(want) == 9
    for a, b in zip(got, want):
        assert a[:3] == b[:3] and (a.n_bars, a.n_days) == (b.n_bars, b.n_days) and (a.auc is None) == (b.auc is None)
        assert a.auc is None or (abs(a.auc - b.auc) < 1e-9 and abs(a.edge - b.edge) < 1e-9)
    binned, _ = boosting.binned_rows(df.selectExpr("*", "cast(label > 0 as double) y"), keys, ["v", "rel_day"], windows=windows)
    cells = boosting.gathered(binned, 2, 0.5)
    assert binned.count() == 2000 and cells.count() <= 3 * 5 * 5 * 2
    sums = cells.selectExpr("sum(weight)", "sum(w0)", "sum(w1)").first()
    assert np.isclose(sums[0], rows["weight"].sum()) and 0.4 < sums[1] / sums[0] < 0.6 and sums[1] != sums[2]


def test_a_single_window_computes_its_rows_once(spark, tmp_path):
    rows, df = frame(spark, 7, 300)

    def noted(batches, folder=str(tmp_path)):
        import uuid

        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        yield from batches

    information.window_model(df.coalesce(1).mapInPandas(noted, df.schema), ["u", "v"], trees=2, depth=1).collect()
    assert len(list(tmp_path.iterdir())) == 1
