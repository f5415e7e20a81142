"""Boosted trees for many groups at once: rows are gathered by their bins, one pass over these grows a level of every group's tree."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.ordering import running
from tickloom.operators.information import window_grid
from tickloom.session import materialise

BINS = 32
LEAST_WEIGHT = 1e-3  # of the rows on either side of a split, by the second derivative
DAMPING = 1.0


@dataclass
class Forest:
    """Trees of all groups, filled level by level: [group, tree, node] with a node's children at 2k + 1 and 2k + 2.

    feature is -1 where a node isn't split: all its rows go left. value holds what a row's last node adds.
    """

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    bias: np.ndarray

    @classmethod
    def empty(cls, groups: int, trees: int, depth: int) -> Forest:
        inner, leaves = 2**depth - 1, 2**depth
        return cls(np.full((groups, trees, inner), -1, np.int16), np.full((groups, trees, inner), BINS, np.int16), np.zeros((groups, trees, leaves)), np.zeros(groups))

    @property
    def depth(self) -> int:
        return int(self.value.shape[2]).bit_length() - 1

    def nodes(self, group: np.ndarray, bins: np.ndarray, tree: int, level: int) -> np.ndarray:
        """The place of each row among the nodes of a level."""
        node, rows = np.zeros(len(group), np.int64), np.arange(len(group))
        for _ in range(level):
            feature = self.feature[group, tree, node]
            right = bins[rows, np.maximum(feature, 0)] > self.cut[group, tree, node]
            node = 2 * node + 1 + (right & (feature >= 0))
        return node - (2**level - 1)

    def margins(self, group: np.ndarray, bins: np.ndarray, trees: int) -> np.ndarray:
        out = self.bias[group].copy()
        for t in range(trees):
            out += self.value[group, t, self.nodes(group, bins, t, self.depth)]
        return out


def taken(key: Column, tree: int, seed: int, share: float) -> Column:
    """Whether a tree learns from the row of this key, the same at every run."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(tree), F.lit(seed)), 40) < share * float(1 << 24)


def best_splits(grad: np.ndarray, hess: np.ndarray) -> list[tuple[int, int, int, float, float]]:
    """grad, hess: [node, feature, bin] sums -> node, feature (-1: none), cut, and the two sides' steps."""
    out = []
    left_g, left_h = grad.cumsum(2)[:, :, :-1], hess.cumsum(2)[:, :, :-1]
    all_g, all_h = grad[:, :1].sum(2, keepdims=True), hess[:, :1].sum(2, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + DAMPING) + right_g**2 / (right_h + DAMPING) - all_g**2 / (all_h + DAMPING)
    gain = np.where((left_h >= LEAST_WEIGHT) & (right_h >= LEAST_WEIGHT), gain, 0.0)
    for node in range(len(grad)):
        feature, cut = divmod(int(gain[node].argmax()), gain.shape[2])
        step = float(-all_g[node, 0, 0] / (all_h[node, 0, 0] + DAMPING))
        if gain[node, feature, cut] <= 1e-12:
            out.append((node, -1, BINS, step, step))
        else:
            sides = [float(-g[node, feature, cut] / (h[node, feature, cut] + DAMPING)) for g, h in ((left_g, left_h), (right_g, right_h))]
            out.append((node, feature, cut, *sides))
    return out


def binned_rows(df: DataFrame, keys: list[str], features: list[str], bins: int = BINS, windows=None) -> tuple[DataFrame, DataFrame]:
    """Rows as group number, bins of the features, y, weight and a key of the row; and the groups with their numbers.

    Edges are quantiles of each feature over all rows; the groups are those of the grid, a bounded table.
    With windows (pairs of days before and after) a row is in all that hold its rel_day: it comes once, under the
    number of its event and rel_day, and `parts` of a group lists the numbers that it holds.
    """
    edges = df.agg(*[F.percentile_approx(c, [(k + 1) / bins for k in range(bins - 1)], 10_000).alias(f"e{i}") for i, c in enumerate(features)]).first()
    own = keys if windows is None else [*[k for k in keys if k not in ("pre_days", "post_days")], "rel_day"]
    days = df.groupBy(*own, "ticker", "date").agg(F.count("*").alias("n"), F.min("y").alias("low_"), F.max("y").alias("high_"))
    days = materialise(days, "grid-days")
    parts = materialise(_numbered(days.select(*own).distinct(), own, "part"), "grid-parts")
    days = days.join(F.broadcast(parts), own)
    if windows is not None:
        days = window_grid(days, windows)
    groups = days.groupBy(*keys).agg(
        F.sum("n").alias("n_bars"), F.countDistinct("ticker", "date").alias("n_days"), F.when(F.min("low_") < F.max("high_"), 2).otherwise(1).alias("kinds"), F.collect_set("part").alias("parts")
    )
    groups = materialise(_numbered(groups, keys, "g"), "grid")
    places = []
    for i, c in enumerate(features):
        cuts = sorted(set(edges[f"e{i}"] or []))
        places.append(sum((F.when(F.col(c) > e, 1).otherwise(0) for e in cuts), F.lit(0)))
    rows = df.join(F.broadcast(parts), own)
    names = ["ticker", "date", "bar_no", "ret_at_outcome", "y", "weight"]
    return rows.select(F.col("part").alias("g"), F.array(*[p.cast("int") for p in places]).alias("bins"), *names, F.xxhash64("ticker", "date", "bar_no").alias("key")), groups


def _numbered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """A bounded table in the order of its keys, with its rows' places."""
    return df.coalesce(1).sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id().cast("int"))


class Spread:
    """The groups that each row of a batch is in, by the number that the row has: itself, or those of holds."""

    def __init__(self, groups: int, holds: list[list[int]] | None = None):
        holds = [[g] for g in range(groups)] if holds is None else holds
        self.length = np.array([len(h) for h in holds], np.int64)
        self.start, self.flat = self.length.cumsum() - self.length, np.array([g for h in holds for g in h], np.int64)

    def __call__(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the batch, a place as often as its row has groups, and these groups."""
        length = self.length[part]
        within = np.arange(length.sum()) - np.repeat(length.cumsum() - length, length)
        return np.repeat(np.arange(len(part)), length), self.flat[np.repeat(self.start[part], length) + within]


def gathered(rows: DataFrame, trees: int = 0, share: float = 1.0, seed: int = 0) -> DataFrame:
    """Rows of one number, bins and y as one row: weight, weighted returns, and w0, w1, ... the weight that each tree learns from.

    A tree cannot tell such rows apart, so their number is bounded by that of the bins.
    """
    w = F.col("weight")
    by_tree = [F.sum(F.when(taken(F.col("key"), t, seed, share), w).otherwise(0.0)).alias(f"w{t}") for t in range(trees)]
    return rows.groupBy("g", "bins", "y").agg(F.sum(w).alias("weight"), F.sum(F.col("ret_at_outcome") * w).alias("ret"), *by_tree)


def _level(forest: Forest, spread: Spread, groups: int, features: int, tree: int, level: int):
    """Two steps over the rows: sums of derivatives by group, node, feature and bin; and the best splits of a group."""
    wide = 2**level
    cells = groups * wide * features * BINS

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, cells))
        for batch in batches:
            part, y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("g", "y", f"w{tree}"))
            at, g = spread(part)
            bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(-1, features)[at]
            y, w = y[at], w[at]
            p = 1 / (1 + np.exp(-forest.margins(g, bins, tree)))
            base = (g * wide + forest.nodes(g, bins, tree, level)) * features
            for j in range(features):
                at = (base + j) * BINS + bins[:, j]
                total[0] += np.bincount(at, w * (p - y), cells)
                total[1] += np.bincount(at, w * p * (1 - p), cells)
        parts = total.reshape(2, groups, -1)
        for g in np.flatnonzero(parts[1].any(1)):
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([parts[0, g].tobytes()], pa.binary()), pa.array([parts[1, g].tobytes()], pa.binary())], ["g", "grad", "hess"])

    def split(part: pd.DataFrame) -> pd.DataFrame:
        grad, hess = (np.sum([np.frombuffer(b) for b in part[c]], axis=0).reshape(wide, features, BINS) for c in ("grad", "hess"))
        return pd.DataFrame(best_splits(grad, hess), columns=["node", "feature", "cut", "low", "high"]).assign(g=part["g"].iloc[0])

    return sums, split


def grow(rows: DataFrame, groups: int, features: int, trees: int, depth: int, rate: float, share: float, seed: int, holds: list[list[int]] | None = None) -> Forest:
    """A forest of all groups: one job a level over the gathered rows, whose result is a split for each node of each group.

    holds lists the groups of each number that rows have, where these are not the groups' own.
    """
    forest, spread = Forest.empty(groups, trees, depth), Spread(groups, holds)
    learn = materialise(gathered(rows, trees, share, seed), "grid-learn")
    positive = np.zeros((2, groups))
    for r in learn.groupBy("g").agg(F.sum(F.col("y") * F.col("weight")).alias("p"), F.sum("weight").alias("w")).collect():
        positive[:, spread(np.array([r["g"]]))[1]] += [[r["p"]], [r["w"]]]
    for g, (p, w) in enumerate(positive.T.tolist()):
        q = min(max(p / w if w else 0.5, 1e-6), 1 - 1e-6)
        forest.bias[g] = np.log(q / (1 - q))
    for tree in range(trees):
        for level in range(depth):
            sums, split = _level(forest, spread, groups, features, tree, level)
            found = learn.select("g", "bins", "y", f"w{tree}").mapInArrow(sums, "g int, grad binary, hess binary").groupBy("g").applyInPandas(split, "node int, feature int, cut int, low double, high double, g int").collect()
            for r in found:
                at = 2**level - 1 + r["node"]
                forest.feature[r["g"], tree, at], forest.cut[r["g"], tree, at] = r["feature"], r["cut"]
                if level == depth - 1:
                    forest.value[r["g"], tree, 2 * r["node"]], forest.value[r["g"], tree, 2 * r["node"] + 1] = rate * r["low"], rate * r["high"]
    return forest


def scored(rows: DataFrame, forest: Forest, features: int, holds: list[list[int]] | None = None) -> DataFrame:
    """Gathered rows, once in each of their groups, with prob, the probability of y."""
    spread, columns = Spread(len(forest.bias), holds), ["y", "weight", "ret"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, g = spread(batch.column("g").to_numpy())
            bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(-1, features)[at]
            p = 1 / (1 + np.exp(-forest.margins(g, bins, forest.value.shape[1])))
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), *[batch.column(c).take(pa.array(at)) for c in columns], pa.array(p)], ["g", *columns, "prob"])

    return rows.select("g", "bins", *columns).mapInArrow(run, "g int, y double, weight double, ret double, prob double")


def grouped_auc(df: DataFrame, key: str) -> DataFrame:
    """key, auc: the weighted share of pairs of a positive and a negative row that prob puts in order, ties by half.

    Rows are summed by probability and put in order over ranges, so that no task holds a group.
    """
    w, y = F.col("weight"), F.col("y")
    sums = running(df.groupBy(key, "prob").agg(F.sum(w * y).alias("pos"), F.sum(w * (1 - y)).alias("neg")), [key, "prob"], "neg", "below_")
    first = sums.groupBy(key).agg(F.min("below_").alias("first_"), F.sum("pos").alias("p_"), F.sum("neg").alias("n_"))
    pairs = F.sum(F.col("pos") * (F.col("below_") - F.col("first_") + F.col("neg") / 2))
    return sums.join(F.broadcast(first), key).groupBy(key).agg(F.try_divide(pairs, F.first("p_") * F.first("n_")).alias("auc"))


def window_models(
    df: DataFrame, features: list[str], keys=("event_type", "pre_days", "post_days"), least_rows: int = 100, holdout: float = 0.0, threshold: float = 0.5,
    seed: int = 42, trees: int = 100, depth: int = 5, rate: float = 0.05, share: float = 0.8, windows=None,
) -> DataFrame:
    """Boosted trees on label > 0 for every group of keys at once: keys, auc, edge, n_bars, n_days.

    As information.window_model, a row a group: rows with a null feature, label, return or weight take no part;
    auc and edge are null in groups of fewer than least_rows rows or of one kind of label; without a row at the
    threshold the edge is 0. Scores are on the training rows unless holdout gives the share kept apart.
    The driver holds the trees: a split for each node, tree and group of the grid. With windows, pairs of days before
    and after, rows are those joined at the widest reach (see joins.event_window_join) and count in each window that
    holds their rel_day, so that they need not be there once a window.
    """
    keys = list(keys)
    data = df.dropna(subset=[*features, "label", "ret_at_outcome", "weight"]).withColumn("y", (F.col("label") > 0).cast("double"))
    data = data.withColumn("weight", F.col("weight").cast("double"))
    rows, groups = binned_rows(materialise(data, "grid-rows"), keys, features, windows=windows)
    apart = F.pmod(F.xxhash64("ticker", "date", "bar_no", F.lit(seed)), F.lit(1000)) < int(1000 * holdout)
    held = groups.select("g", F.explode("parts").alias("part")).collect()
    holds = [[] for _ in range(1 + max((r["part"] for r in held), default=-1))]
    for r in held:
        holds[r["part"]].append(r["g"])
    count = groups.count()
    empty = groups.select(*keys, F.lit(None).cast("double").alias("auc"), F.lit(None).cast("double").alias("edge"), "n_bars", "n_days")
    if not count:
        return empty
    forest = grow(rows.filter(~apart) if holdout else rows, count, len(features), trees, depth, rate, share, seed, holds)
    made = materialise(scored(gathered(rows.filter(apart) if holdout else rows), forest, len(features), holds), "grid-scores")
    over = F.col("prob") >= threshold
    edges = made.groupBy("g").agg(F.coalesce(F.try_divide(F.sum(F.when(over, F.col("ret"))), F.sum(F.when(over, F.col("weight")))), F.lit(0.0)).alias("edge"))
    fit = (F.col("n_bars") >= least_rows) & (F.col("kinds") == 2)
    joined = groups.join(F.broadcast(edges), "g", "left").join(F.broadcast(grouped_auc(made, "g")), "g", "left")
    return joined.select(*keys, F.when(fit, F.col("auc")).alias("auc"), F.when(fit, F.coalesce("edge", F.lit(0.0))).alias("edge"), "n_bars", "n_days")
