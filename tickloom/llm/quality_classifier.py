"""Positive-unlabelled quality classifier.

Trusted positives and unlabelled web text are each a bounded hash sample (`sample_rows`, the one
bound on what is fitted); every document is scored over its whole text. A linear model on document
statistics and word-shape shares minimises the non-negative unbiased risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss; the prior is estimated from positives and unlabelled text alone.

Defined cases: a null text scores as an empty one; repeated rows are scored one by one; a null
doc_id is scored and counts as not held out; without positives every document scores 0.5; extra
columns of the inputs are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.llm.arrow import slices, texts
from tickloom.llm.folds import in_fold, sampled

SHAPES = 128  # hashed word shapes
STATS = 13
SHAPE_OF = bytes.maketrans(
    bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(48, 58)) + bytes(range(128, 256)),
    b"A" * 26 + b"a" * 26 + b"9" * 10 + b"a" * 128,
)


def features(text: str) -> np.ndarray:
    """Statistics of the whole text and the shares of its word shapes (runs of a class as one)."""
    out = np.zeros(STATS + SHAPES, np.float32)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return out
    n, size = len(words), len(raw)
    classes = np.frombuffer(raw.translate(SHAPE_OF), np.uint8)
    upper, lower, digits = (int((classes == c).sum()) for c in b"Aa9")
    space = size - sum(map(len, words))
    common = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.split()]
    out[:STATS] = (
        np.log1p(n), (size - space) / n, upper / max(1, upper + lower), (upper + lower) / size, digits / size,
        (size - upper - lower - digits - space) / size, len(common) / n, common.most_common(1)[0][1] / n,
        1 - len(set(lines)) / len(lines), len(lines) / n, max(map(len, words)) / 100,
        sum(k * (k - 1) for k in common.values()) / n / n, np.log1p(len(common)),
    )
    kept = np.concatenate(([True], classes[1:] != classes[:-1]))
    for shape, k in Counter(classes[kept].tobytes().split()).items():
        out[STATS + zlib.crc32(shape) % SHAPES] += k / n
    return out


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [features(t).tolist() for t in texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("positive"), pa.array(rows, pa.list_(pa.float32()))], ["positive", "x"]
        )


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(x, y, loss_weights, steps: int, rate: float, ridge: float):
    """Adam on a differentiable risk; loss_weights(z) gives its gradient by z."""
    w, moment, square = np.zeros(x.shape[1] + 1), 0.0, 0.0
    for step in range(1, steps + 1):
        g_z = loss_weights(x @ w[:-1] + w[-1], y)
        g = np.append(x.T @ g_z + ridge * w[:-1], g_z.sum())
        moment, square = 0.9 * moment + 0.1 * g, 0.999 * square + 0.001 * g * g
        w -= rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives in the unlabelled scores: the lowest ratio of upper tails, with a margin
    for the sampling error of each tail (best-bin estimate)."""
    tops = np.quantile(positive, np.linspace(0.0, 0.95, 96))
    p = 1 - np.searchsorted(np.sort(positive), tops, "left") / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), tops, "left") / len(unlabelled)
    slack = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    best = int(np.argmin((u + slack) / np.maximum(p, 1e-9)))
    return float(np.clip(u[best] / max(p[best], 1e-9), 0.02, 0.98))


def risks(s: np.ndarray, t: np.ndarray, prior: float) -> tuple[float, float]:
    """Risks of scores s by the logistic loss: of the positive class, and the unbiased one of the negative class."""
    return prior * np.logaddexp(0, -s[t]).mean(), np.logaddexp(0, s[~t]).mean() - prior * np.logaddexp(0, s[t]).mean()


def risk_gradient(s: np.ndarray, t: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of the non-negative risk by s; t marks the trusted positives, the others are unlabelled.

    Where the negative class's risk has fallen below zero, the step climbs back on that part alone.
    """
    up, n_p, n_u, g = _sigmoid(s), t.sum(), (~t).sum(), np.zeros_like(s)
    if risks(s, t, prior)[1] >= 0:
        g[t], g[~t] = prior * (up[t] - 1) / n_p - prior * up[t] / n_p, up[~t] / n_u
    else:
        g[t], g[~t] = prior * up[t] / n_p, -up[~t] / n_u
    return g


def fit_pu(x: np.ndarray, positive: np.ndarray, steps: int = 400, rate: float = 0.05, ridge: float = 1e-3) -> QualityModel:
    """Fit on rows x; positive marks the trusted rows, the others are unlabelled."""
    mean, scale = x.mean(0), x.std(0) + 1e-3
    if not positive.any() or positive.all():
        return QualityModel(mean, scale, np.zeros(x.shape[1]), 0.0, 0.5)
    z = np.clip((x - mean) / scale, -8, 8).astype(np.float64)
    y = positive.astype(bool)
    # a plain classifier of trusted against unlabelled rows, on half of them, ranks the other half for the prior
    half = np.arange(len(y)) % 2 == 0
    balance = np.where(y, 0.5 / max(1, (y & half).sum()), 0.5 / max(1, (~y & half).sum()))[half]
    plain = _descend(z[half], y[half], lambda s, t: balance * (_sigmoid(s) - t), 200, rate, ridge)
    rank = z[~half] @ plain[:-1] + plain[-1]
    rest = y[~half]
    prior = estimate_prior(rank[rest], rank[~rest]) if rest.any() and (~rest).any() else 0.5

    w = _descend(z, y, lambda s, t: risk_gradient(s, t, prior), steps, rate, ridge)
    return QualityModel(mean, scale, w[:-1], float(w[-1]), prior)


def train_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000, folds: int = 3, held_fold: int = 1) -> QualityModel:
    """Learn from documents outside the held fold; at most about sample_rows positives and as many unlabelled."""
    train = ~in_fold("doc_id", folds, held_fold)
    trusted = labels.filter((F.col("quality") == 1) & train).select("doc_id").distinct()
    chosen = trusted.filter(sampled("doc_id", sample_rows, trusted.count(), 1)).withColumn("trusted", F.lit(True))
    base = docs.select("doc_id", "text").filter(train)
    web = sampled("doc_id", sample_rows, base.count(), 2)
    # the chosen ids are bounded by sample_rows, so that their broadcast is
    rows = base.join(F.broadcast(chosen), "doc_id", "left").withColumn("web", web).filter("trusted or web")
    rows = rows.select(
        "text",
        F.explode(F.filter(F.array(F.when(F.col("trusted"), True), F.when(F.col("web"), False)), lambda v: v.isNotNull())).alias("positive"),
    )
    schema = T.StructType([T.StructField("positive", T.BooleanType()), T.StructField("x", T.ArrayType(T.FloatType()))])
    got = rows.mapInArrow(_features_of, schema).toArrow()
    if not got.num_rows:
        return QualityModel(np.zeros(STATS + SHAPES), np.ones(STATS + SHAPES), np.zeros(STATS + SHAPES), 0.0, 0.5)
    x = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(got.num_rows, -1)
    positive = got.column("positive").to_numpy(zero_copy_only=False).astype(bool)
    order = np.lexsort((*x.T, positive))  # independent of the order in which tasks end
    return fit_pu(x[order], positive[order])


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 if score >= 0.5); other columns stay."""
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    docs = docs.select(*names)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = model.scores(np.stack([features(t) for t in texts(batch)]))
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], [*names, "score", "predicted"]
            )

    return docs.mapInArrow(score, schema)


def accepted(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents with score >= 0.5, with their own columns, whatever their names."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text = batch.column("row").field("text").to_pylist()
            s = model.scores(np.stack([features(t or "") for t in text]))
            yield batch.filter(pa.array(s >= 0.5))

    return rows.mapInArrow(keep, rows.schema).select("row.*")
