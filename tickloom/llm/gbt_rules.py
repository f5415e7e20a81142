"""Quality rules: gradient-boosted trees over document statistics.

The trees are grown on a bounded hash sample of labelled documents (`sample_rows`, the one bound),
on binned statistics with the logistic loss, and flattened into arrays of nodes, so that a batch is
scored by a few array look-ups a level. Chosen statistics carry a monotonic constraint: a split that
would break it is not taken, and each side's values stay beyond the middle of the two.

Fixed rules come first (`base_rules`): a text with few words or with many repeated windows fails.

Defined cases: a null text has no words and fails; repeated rows are judged one by one; a null doc_id
takes no part in learning; without labels of both kinds the trees keep everything; extra columns of
the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.llm.arrow import slices, texts
from tickloom.llm.folds import in_fold, sampled

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\v\f\r"
#: Statistic -> -1 where more of it may only lower the score, 0 where it is free.
STATS = {
    "log_words": 0, "word_length": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": 0,
    "digit_share": 0, "other_share": 0, "distinct_share": 0, "exclaimed": -1, "unlettered_words": -1, "words_per_line": 0,
}
WINDOW = 8


def repeated_words(ids: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words of each document that lie in a window of 8 words found twice or more in it.

    ids, doc: the words of several documents one after the other. Windows get their identity by
    doubling (pairs of words, of pairs, of fours), so no hash can mistake them.
    """
    span = 1
    while span < WINDOW and len(ids) > span:
        ids, doc = pd.factorize(ids[:-span].astype(np.int64) << 32 | ids[span:])[0], doc
        span *= 2
    if span < WINDOW or not len(ids):
        return np.zeros(n_docs, np.int64)
    inside = doc[: len(ids)] == doc[WINDOW - 1 :]
    key = pd.factorize(ids.astype(np.int64) << 32 | doc[: len(ids)])[0]
    twice = inside & (np.bincount(key[inside], minlength=key.max() + 1)[key] > 1)
    cover = np.zeros(len(doc) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + WINDOW, -1)
    return np.bincount(doc[cover.cumsum()[:-1] > 0], minlength=n_docs)


def statistics(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Base counts (rows x 5, integers) and the trees' statistics (rows x 12) of whole texts."""
    base, stats = np.zeros((len(batch), len(BASE)), np.int64), np.zeros((len(batch), len(STATS)))
    split, vocabulary = [], {}
    for i, text in enumerate(batch):
        raw = text.encode("utf-8", "surrogatepass")
        words, lines = raw.split(), [x for x in text.split("\n") if x.strip(BLANKS)]
        split.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), np.int64, len(words)))
        n = len(words)
        blank = sum(text.count(c) for c in BLANKS)
        base[i, :4] = n, len(text) - blank, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines))
        if not n:
            continue
        code = np.frombuffer(raw, np.uint8)
        upper, digit = int(((code >= 65) & (code <= 90)).sum()), int(((code >= 48) & (code <= 57)).sum())
        letter = upper + int((((code >= 97) & (code <= 122)) | (code >= 128)).sum())
        stats[i] = (
            np.log1p(n), base[i, 1] / n, base[i, 2] / n, base[i, 3] / len(lines), 0, upper / max(1, letter), digit / len(raw),
            max(0, len(raw) - letter - digit - blank) / len(raw), len(set(words)) / n, text.count("!") / n,
            sum(w.isdigit() or not any(c > 64 for c in w) for w in words) / n, np.log1p(n / len(lines)),
        )
    doc = np.repeat(np.arange(len(batch)), [len(x) for x in split])
    ids = np.concatenate(split) if split else np.empty(0, np.int64)
    base[:, 4] = repeated_words(ids, doc, len(batch))
    stats[:, 4] = base[:, 4] / np.maximum(base[:, 0], 1)
    return base, stats


def base_failed(base: np.ndarray, least_words: int = 20, most_repeated: int = 30) -> np.ndarray:
    return (base[:, 0] < least_words) | (100 * base[:, 4] > most_repeated * base[:, 0])


@dataclass(frozen=True)
class FlatTrees:
    """All trees' nodes one after the other; a leaf's children are itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    bias: float
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        z, rows = np.full(len(x), self.bias), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            z += self.value[node]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 64, least_hessian: float = 2.0, ridge: float = 1.0) -> FlatTrees:
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.999
    bias = float(np.log(share / (1 - share)))
    columns: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots, z = [], np.full(len(y), bias)

    def add(value: float) -> int:
        node = len(columns["value"])
        for k, v in (("feature", 0), ("threshold", 0.0), ("left", node), ("right", node), ("value", value)):
            columns[k].append(v)
        return node

    def best_split(g, h, index, low, high):
        best = (1e-6, None)
        total_g, total_h = g[index].sum(), h[index].sum()
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            gl = np.bincount(binned[index, f], g[index], len(c) + 1).cumsum()[:-1]
            hl = np.bincount(binned[index, f], h[index], len(c) + 1).cumsum()[:-1]
            gr, hr = total_g - gl, total_h - hl
            vl, vr = (np.clip(-a / (b + ridge), low, high) for a, b in ((gl, hl), (gr, hr)))
            gain = -(gl * vl + (hl + ridge) * vl * vl / 2) - (gr * vr + (hr + ridge) * vr * vr / 2)
            ok = (hl >= least_hessian) & (hr >= least_hessian) & ((vr - vl) * monotone[f] >= 0)
            gain = np.where(ok, gain, -np.inf)
            k = int(gain.argmax())
            whole = np.clip(-total_g / (total_h + ridge), low, high)
            more = gain[k] + total_g * whole + (total_h + ridge) * whole * whole / 2
            if more > best[0]:
                best = (more, (f, k, vl[k], vr[k]))
        return best[1]

    def grow(g, h, index, value, low, high, level) -> int:
        node = add(rate * value)
        split = best_split(g, h, index, low, high) if level < depth and len(index) > 1 else None
        if split:
            f, k, vl, vr = split
            goes_left, middle = binned[index, f] <= k, (vl + vr) / 2
            bounds = {0: ((low, high), (low, high)), -1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}[monotone[f]]
            columns["feature"][node], columns["threshold"][node] = f, cuts[f][k]
            columns["left"][node] = grow(g, h, index[goes_left], vl, *bounds[0], level + 1)
            columns["right"][node] = grow(g, h, index[~goes_left], vr, *bounds[1], level + 1)
        return node

    for _ in range(trees if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-z))
        root = grow(p - y, p * (1 - p), np.arange(len(y)), 0.0, -4.0, 4.0, 0)
        roots.append(root)
        node = np.full(len(y), root)
        for _ in range(depth):
            f = np.array(columns["feature"])[node]
            node = np.where(x[np.arange(len(y)), f] <= np.array(columns["threshold"])[node], np.array(columns["left"])[node], np.array(columns["right"])[node])
        z = z + np.array(columns["value"])[node]
    arrays = {k: np.array(v, float if k in ("threshold", "value") else np.int64) for k, v in columns.items()}
    return FlatTrees(np.array(roots, np.int64), **arrays, bias=bias, depth=depth)


def train_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000, folds: int = 3, held_fold: int = 1, **options) -> FlatTrees:
    """Learn quality labels outside the held fold, from about sample_rows documents at most."""
    known = labels.filter(~in_fold("doc_id", folds, held_fold) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    chosen = known.filter(sampled("doc_id", sample_rows, known.count(), 4))  # bounded, so is its broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    schema = T.StructType([T.StructField("quality", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(list(statistics(texts(batch))[1]), pa.list_(pa.float64()))], schema.names)

    got = rows.mapInArrow(run, schema).toArrow()
    x = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATS)) if got.num_rows else np.zeros((0, len(STATS)))
    y = got.column("quality").to_numpy(zero_copy_only=False).astype(float)
    order = np.lexsort((*x.T, y))
    return fit_trees(x[order], y[order], list(STATS.values()), **options)


def judge(docs: DataFrame, model: FlatTrees, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and score of every document's whole text."""
    longs = [T.StructField(c, T.LongType()) for c in BASE]
    schema = T.StructType([docs.schema["doc_id"], *longs, T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base, stats = statistics(texts(batch))
            failed, score = base_failed(base), model.scores(stats)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(base[:, i]) for i in range(len(BASE))], pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)],
                schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
