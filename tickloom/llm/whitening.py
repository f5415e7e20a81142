"""Whitening of embeddings by a bidiagonal solver over blockwise QR.

Entries become integers (floor of 64 times the entry, plus an offset), so that sums are exact and copies
of a vector are equal. The fit list is each different vector once. Its rows, centred by the exact mean,
are reduced block by block to one triangular factor a partition, and those by rounds of groups to one.
That small matrix is made bidiagonal and solved (bidiagonal.py); its right singular vectors are the
components, its squared singular values over n the variances. Nothing but sums per dimension and small
triangles leaves the tasks.

Defined cases: vectors that are null, or hold a null, an entry that is not finite or one whose integer
would not fit a long, are dropped, as are those of another length than most different ones have (of
equal numbers the longest); a null id is kept and rows that come again have a row each; components
without variance have no whitened value (null) and explain nothing; if there is no variance at all,
what is explained is null; an empty table gives an empty result; extra columns are ignored; a deviation
that does not fit a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.llm.bidiagonal import right_vectors
from tickloom.session import Scratch

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 2048
GROUP_BYTES = 64_000_000  # triangles that one task reduces at a time
LONG = 2**63 - 1


@dataclass(frozen=True)
class Whitening:
    """n different vectors with their sums per dimension; variances and directions of the components, strongest first."""

    n: int
    sums: list[int]
    variances: np.ndarray
    directions: np.ndarray
    total: float
    identity_error: float | None = None

    @property
    def used(self) -> int:
        """Components that have variance."""
        return int(np.count_nonzero(self.variances))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit integers where they suffice, else Python's."""
        sums = np.array(self.sums, object)
        if len(x) and max(int(np.max(np.abs(x))) * self.n, max(map(abs, self.sums))) >= LONG // 4:
            return x.astype(object) * self.n - sums
        return x * self.n - sums.astype(np.int64)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        """Sum of squares of each row, exact; None beyond a long."""
        if not centred.size:
            return [0] * len(centred)
        if centred.dtype == object or int(np.max(np.abs(centred))) ** 2 * centred.shape[1] > LONG:
            sums = [sum(int(v) ** 2 for v in row) for row in centred.tolist()]
            return [s if s <= LONG else None for s in sums]
        return np.einsum("ij,ij->i", centred, centred).tolist()

    def project(self, centred: np.ndarray) -> np.ndarray:
        """Whitened values of the components that have variance."""
        k = self.used
        return (centred.astype(float) / self.n) @ (self.directions[:, :k] / np.sqrt(self.variances[:k]))


def whole(vector: Column) -> Column:
    """True if every entry is there, finite and small enough to become a long."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float(2**56))), F.lit(False))


def as_integers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)


def usable(embeddings: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """vec_id, x of the rows with a whole vector."""
    return embeddings.filter(whole(F.col(f"`{vector}`"))).select(F.col(f"`{vec_id}`").alias("vec_id"), as_integers(F.col(f"`{vector}`")).alias("x"))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _triangle(blocks: list[np.ndarray]) -> np.ndarray:
    """The triangular factor of the blocks' rows, one below the other."""
    return np.linalg.qr(np.vstack(blocks), mode="r")


def triangle(fit: DataFrame, model: Whitening, hold: Scratch) -> np.ndarray:
    """The triangular factor of the centred fit list: one per partition, then rounds of groups of them."""
    dims = len(model.sums)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, dims))
        for batch in batches:
            x = _matrix(batch, dims)
            for at in range(0, len(x), BLOCK_ROWS):
                r = _triangle([r, model.centred(x[at : at + BLOCK_ROWS]).astype(float) / model.n])
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        r = _triangle([np.frombuffer(r).reshape(-1, dims) for r in rows["r"]])
        return pd.DataFrame({"part": [rows["part"].iloc[0] // fan], "r": [r.tobytes()]})

    fan = int(np.clip(GROUP_BYTES // (8 * dims * dims), 2, 16))
    level = hold.write(fit.select("x").mapInArrow(first, "part long, r binary"), "triangles")
    while level.count() > 1:
        before, level = level, hold.write(level.groupBy(F.floor(F.col("part") / fan)).applyInPandas(join, "part long, r binary"), "triangles")
        hold.drop(before)
    r = np.frombuffer(level.first()["r"]).reshape(-1, dims)
    hold.drop(level)
    return np.vstack([r, np.zeros((dims - len(r), dims))])


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity; its means are zero by the exact sums."""
    k, dims = model.used, len(model.sums)
    if not k:
        return None

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w = model.project(model.centred(_matrix(batch, dims)))
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k), pa.int64()), pa.array(total.ravel(), pa.float64())], ["cell", "value"])

    cells = fit.select("x").mapInArrow(gram, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    off = np.zeros(k * k)
    for c in cells:
        off[c["cell"]] = c["value"] / model.n
    return float(np.max(np.abs(off - np.eye(k).ravel())))


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """usable() rows -> the model of their different vectors; None if there are none."""
    hold = Scratch(rows.sparkSession)
    fit = hold.write(rows.select("x").distinct(), "fit")
    most = fit.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if most is None or not most["dims"]:
        hold.drop(fit)
        return None
    same = fit.filter(F.size("x") == most["dims"])
    by_place = same.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(20,0)")).alias("s")).orderBy("pos").collect()
    plain = Whitening(most["count"], [int(r["s"]) for r in by_place], np.zeros(0), np.zeros((0, 0)), 0.0)
    squares, vectors = right_vectors(triangle(same, plain, hold), min(components, most["dims"]))
    variances = squares / plain.n
    model = Whitening(plain.n, plain.sums, variances[: vectors.shape[1]], vectors, float(variances.sum()))
    model = Whitening(model.n, model.sums, model.variances, model.directions, model.total, identity_error(same, model))
    hold.drop(fit)
    return model


def whiten(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """usable() rows -> vec_id, deviation, whitened (array of one value a component, null without variance)."""
    schema = T.StructType([rows.schema["vec_id"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    dims, rest = len(model.sums), [None] * (len(model.variances) - model.used)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                centred = model.centred(_matrix(part, dims))
                values = pa.array([[*w, *rest] for w in model.project(centred).tolist()], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(model.deviations(centred), pa.int64()), values], schema.names)

    return rows.filter(F.size("x") == dims).mapInArrow(run, schema)


def whitened_components(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """embeddings -> one row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = usable(embeddings)
    model = fit_whitening(rows, components)
    share = [float(v / model.total) if model.total else None for v in model.variances] if model else []
    n, error = (model.n, model.identity_error) if model else (0, None)
    made = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    shares = F.array(*[F.lit(s).cast("double") for s in share]) if share else F.lit(None).cast("array<double>")
    return made.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
