"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained example by example with follow-the-regularised-leader under an elastic net on a bounded hash
sample (`sample_rows`, the one bound), then calibrated: one temperature is fitted by Newton steps on a part
of the sample that training has not seen. There, pieces of a few words stand for the texts, since whole
texts are told apart without an error and say nothing of how sure the model may be. The same pieces
choose the l1 penalty: the largest whose loss is within a standard error of the least one, so that most
weights are zero. Every document is predicted from its whole text.

Defined cases: a null text or one without a letter gets "und" with score 0; documents without lang
take no part in learning; with nothing to learn from all are "und"; repeated rows are predicted one
by one; ids may be of any type; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.llm.arrow import slices, texts
from tickloom.llm.folds import in_fold, sampled

BITS, GRAMS = 15, (1, 2, 3)
LETTER = regex.compile(r"\p{L}")


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character 1- to 3-grams of the lower-cased text: places and counts."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(code), 1 << 16):  # pieces, each with the two characters before it
        part = code[max(0, at - max(GRAMS) + 1) : at + (1 << 16)]
        fresh = len(code[at : at + (1 << 16)])
        h = np.zeros(len(part), np.uint32)
        for n in range(1, max(GRAMS) + 1):
            if len(part) < n:
                break
            end = part[n - 1 :]
            h = (h[: len(end)] + end + np.uint32(n)) * np.uint32(2654435761)
            h ^= h >> np.uint32(15)
            if n in GRAMS:
                total += np.bincount(h[-fresh:] >> np.uint32(32 - BITS), minlength=1 << BITS)
    found = np.flatnonzero(total)
    return found, total[found]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # grams x languages
    bias: np.ndarray
    temperature: float

    def sparsity(self, seen: np.ndarray) -> float:
        """Share of zeros among the weights of the n-grams at these places."""
        return float(np.mean(self.weights[seen] == 0)) if len(seen) else 1.0

    def logits(self, found: np.ndarray, count: np.ndarray) -> np.ndarray:
        return weighed(found, count, self.idf) @ self.weights[found] + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        if not self.languages or not LETTER.search(text):
            return "und", 0.0
        p = _softmax(self.logits(*gram_counts(text)) / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def weighed(found: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(count)) * idf[found]
    return x / max(1e-12, np.sqrt(x @ x))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


L1_CHOICES = (0.002, 0.02, 0.1, 0.3, 1.0, 3.0)
CHOICE_ROWS = 1500  # rows on which the l1 penalty is chosen
PIECE_CHARS = 12


def piece_of(text: str, key: int, size: int = PIECE_CHARS) -> str:
    """Some characters from a place that the key chooses."""
    start = key % max(1, len(text) - size)
    return text[start : start + size]


def losses(logits: np.ndarray, y: np.ndarray, temperature: float) -> np.ndarray:
    z = logits / temperature
    z = z - z.max(1, keepdims=True)
    return np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]


def fit_temperature(logits: np.ndarray, y: np.ndarray, steps: int = 60) -> float:
    """The temperature of least loss, by Newton steps on its logarithm, with no bound; a prior that weighs as
    much as one row keeps it finite where there is no error at all."""
    u, n = 0.0, len(y)  # u: logarithm of 1 / temperature
    right = logits[np.arange(n), y]
    total = lambda v: losses(logits, y, np.exp(-v)).sum() + 0.5 * v * v
    for _ in range(steps):
        b = np.exp(u)
        p = _softmax(b * logits)
        mean = (p * logits).sum(1)
        first, second = (mean - right).sum(), ((p * logits**2).sum(1) - mean**2).sum()
        slope, bend = b * first + u, b * b * second + abs(b * first) + 1
        step = -slope / bend
        while total(u + step) > total(u) and abs(step) > 1e-12:
            step /= 2
        u += step
        if abs(step) < 1e-10:
            break
    return float(np.exp(-u))


def fit_language(
    rows: list[tuple[str, np.ndarray, np.ndarray]], alpha: float = 0.5, beta: float = 1.0, l1: float | None = None, l2: float = 0.1, epochs: int = 2, seed: int = 3,
    pieces: list[tuple[np.ndarray, np.ndarray]] | None = None,
) -> LanguageModel:
    """rows: language, places and counts of the n-grams; pieces: places and counts for a piece of each row's
    text, by which temperature and, where none is given, l1 are fitted (the rows themselves if there are none)."""
    pieces = pieces or [r[1:] for r in rows]
    if l1 is None:
        tried = []
        for choice in L1_CHOICES:
            model = fit_language(rows[:CHOICE_ROWS], alpha, beta, choice, l2, epochs, seed, pieces[:CHOICE_ROWS])
            held = [(r[0], *p) for i, (r, p) in enumerate(zip(rows[:CHOICE_ROWS], pieces, strict=False)) if i % 5 == 4 and r[0] in model.languages]
            if not held:
                tried = []
                break
            lost = losses(np.stack([model.logits(f, c) for _, f, c in held]), np.array([model.languages.index(name) for name, _, _ in held]), model.temperature)
            tried.append((lost.mean(), lost.std() / max(1, len(lost)) ** 0.5))
        best = min(tried, default=(0.0, 0.0))
        l1 = max((c for c, (lost, _) in zip(L1_CHOICES, tried, strict=False) if lost <= sum(best)), default=L1_CHOICES[0])
    languages = tuple(sorted({r[0] for r in rows}))
    size, k = 1 << BITS, len(languages)
    if not k:
        return LanguageModel((), np.ones(size), np.zeros((size, 0)), np.zeros(0), 1.0)
    held = [(r[0], *p) for i, (r, p) in enumerate(zip(rows, pieces, strict=True)) if i % 5 == 4]
    train = [r for i, r in enumerate(rows) if i % 5 != 4]
    have = np.zeros(size)
    for _, found, _ in train:
        have[found] += 1
    idf = np.log((1 + len(train)) / (1 + have)) + 1
    z, n = np.zeros((size + 1, k)), np.zeros((size + 1, k))  # the last row is the bias

    def weights_at(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        shrunk = np.sign(zz) * np.maximum(np.abs(zz) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    rng, number = np.random.default_rng(seed), {name: i for i, name in enumerate(languages)}
    for _ in range(epochs):
        for r in rng.permutation(len(train)):
            name, found, count = train[r]
            at, x = np.append(found, size), np.append(weighed(found, count, idf), 1.0)
            w = weights_at(at)
            p = _softmax(x @ w)
            p[number[name]] -= 1
            g = x[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    w = weights_at(np.arange(size + 1))
    model = LanguageModel(languages, idf, w[:-1].astype(np.float32), w[-1], 1.0)
    if not held:
        return model
    logits, y = np.stack([model.logits(f, c) for _, f, c in held]), [number.get(r[0], 0) for r in held]
    return LanguageModel(languages, idf, model.weights, model.bias, fit_temperature(logits, np.array(y)))


def train_language(docs: DataFrame, sample_rows: int = 6000, folds: int = 4, held_fold: int = 2) -> LanguageModel:
    """Learn from documents with a lang outside the held fold, about sample_rows of them at most."""
    known = docs.filter(~in_fold("doc_id", folds, held_fold) & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    rows = known.filter(sampled("doc_id", sample_rows, known.count(), 5))
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("lang", T.StringType()), *[T.StructField(c, ints) for c in ("found", "count", "piece_found", "piece_count")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, said = batch.column("key").to_pylist(), texts(batch)
            got = [[g.astype(np.int32) for part in (t, piece_of(t, k)) for g in gram_counts(part)] for k, t in zip(keys, said, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("lang"), *[pa.array([g[i] for g in got], pa.list_(pa.int32())) for i in range(4)]], schema.names)

    rows = rows.select(F.hash(F.col("doc_id").cast("string")).alias("key"), "lang", "text")
    got = rows.mapInArrow(run, schema).toArrow()
    parts = [
        (key, lang, *[g.values.to_numpy() for g in grams])
        for key, lang, *grams in zip(got["key"].to_pylist(), got["lang"].to_pylist(), *[got[c] for c in ("found", "count", "piece_found", "piece_count")], strict=True)
    ]
    parts = sorted((p for p in parts if len(p[2])), key=lambda r: (r[0], r[1], len(r[2]), r[2].sum()))
    return fit_language([p[1:4] for p in parts], pieces=[p[4:] for p in parts])


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score (calibrated probability) of every document."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            said = [model.predict(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
