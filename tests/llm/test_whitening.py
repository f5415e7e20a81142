"""Whitening against numpy, the solver against numpy's, and edge cases."""

import math

import numpy as np

from tickloom.llm import queries, whitening
from tickloom.llm.bidiagonal import bidiagonalise, right_vectors, squared_values

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, x string, component string"


def matrices():
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    yield rng.standard_normal((300, 40))
    yield rng.standard_normal((300, 40)) * np.logspace(0, -8, 40)
    yield rng.standard_normal((300, 40)) * np.logspace(-8, 0, 40)
    yield np.eye(40)
    yield np.diag([5.0] * 10 + [3] * 20 + [1] * 10) @ turn
    yield np.diag([5 + 1e-9 * i for i in range(10)] + [3] * 20 + [1] * 10) @ turn
    yield rng.standard_normal((5, 40))
    yield np.hstack([rng.standard_normal((300, 8))] * 5)
    yield rng.standard_normal((9, 1))
    yield np.zeros((4, 4))
    wilkinson = np.diag(np.abs(np.arange(-10, 11)) + 20.0) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield np.linalg.cholesky(wilkinson).T


def test_solver_equals_numpy():
    for a in matrices():
        r = np.linalg.qr(a, mode="r")
        r = np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))])
        values, vectors = right_vectors(r, min(16, len(r)))
        want = np.linalg.svd(r, compute_uv=False) ** 2
        top = max(want[0], 1e-300)
        assert np.max(np.abs(values - want)) < 1e-13 * top
        assert np.max(np.abs(vectors.T @ vectors - np.eye(vectors.shape[1]))) < 1e-12
        assert np.max(np.linalg.norm(r.T @ (r @ vectors) - vectors * values[: vectors.shape[1]], axis=0)) < 1e-12 * top


def test_small_values_keep_their_digits():
    d, e = np.logspace(0, -12, 20), 0.3 * np.logspace(0, -12, 20)[1:]
    got = squared_values(d, e)
    inverse = np.linalg.inv(np.diag(d) + np.diag(e, 1))
    assert abs(got[-1] * np.linalg.svd(inverse, compute_uv=False)[0] ** 2 - 1) < 1e-10  # the least one, from the inverse's largest
    diagonal, upper, right = bidiagonalise(np.diag([3.0, 2.0, 1.0]))
    assert np.allclose(np.abs(diagonal), [3, 2, 1]) and np.allclose(upper, 0) and np.allclose(right @ right.T, np.eye(3))


def brute(rows, components=16):
    """vec_id -> n, deviation, whitened, explained by plain numpy."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[c - t / n for c, t in zip(x, s, strict=True)] for x in fit])
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, len(s))
    out = {}
    for i, x in good:
        w = (np.array(x) - np.array(s) / n) @ v[:, :k] / np.sqrt(e[:k])
        out[i] = (n, sum((n * c - t) ** 2 for c, t in zip(x, s, strict=True)), w, e[:k] / np.trace(cov))
    return out


def test_whitening_equals_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in table.collect()])
    rows = queries.op13_whitening(spark, SF).collect()
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert got.keys() == want.keys()
    signs = np.ones(16)
    some = next(iter(want))
    for k in range(16):
        signs[k] = np.sign(got[some][k + 1].whitened * want[some][2][k])
    for i, (n, deviation, w, explained) in want.items():
        assert sorted(got[i]) == list(range(1, 17))
        assert {(r.n, r.deviation) for r in got[i].values()} == {(n, deviation)}
        assert np.allclose([got[i][k + 1].whitened for k in range(16)], signs * w, atol=1e-8)
        assert np.allclose([got[i][k + 1].explained for k in range(16)], explained, rtol=1e-9)
    assert {r.identity_error for r in rows}.pop() < 1e-10


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    vectors = [[float(x) for x in np.float32(rng.standard_normal(3))] for _ in range(40)]
    rows = [(i, v, "x", "y") for i, v in enumerate(vectors)] + [(40, vectors[0], "x", "y"), (0, vectors[0], "x", "y"), (None, vectors[1], "x", "y")]
    bad = [(50, None, "x", "y"), (51, [1.0, None, 2.0], "x", "y"), (52, [1.0, float("nan"), 2.0], "x", "y"), (53, [1.0, float("inf"), 2.0], "x", "y"), (54, [1.0, 2.0], "x", "y"), (55, [], "x", "y"), (56, [1e30, 0.0, 0.0], "x", "y")]
    frame = spark.createDataFrame(rows + bad, SCHEMA)
    made = whitening.whitened_components(frame).collect()
    assert len(made) == 3 * len(rows) and {r.n for r in made} == {40}  # copies are once in the fit list, and have rows of their own
    want = brute([(i, v) for i, v, *_ in rows])
    for r in made:
        assert abs(abs(r.whitened) - abs(want[r.vec_id][2][r.component - 1])) < 1e-9 and r.deviation == want[r.vec_id][1]
    assert whitening.whitened_components(frame.filter("false")).collect() == []
    assert whitening.whitened_components(frame.filter("vec_id >= 50 and vec_id <> 54")).collect() == []


def test_components_without_variance_and_large_numbers(spark):
    rows = [(i, [float(i % 4), 2.0 * (i % 4), 7.0], "x", "y") for i in range(9)]
    made = whitening.whitened_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in made) and {round(r.explained, 12) for r in made if r.component == 1} == {1.0}
    one = whitening.whitened_components(spark.createDataFrame(rows[:1], SCHEMA)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(k, 1, 0, None, None, None) for k in (1, 2, 3)]
    far = [(i, [float(2.0 ** (40 + i)), float(i)], "x", "y") for i in range(6)]
    made = whitening.whitened_components(spark.createDataFrame(far, SCHEMA)).collect()
    assert len(made) == 12 and all(r.deviation is None for r in made if r.vec_id == 5)
    model = whitening.Whitening(3, [3 * 2**62, 0], np.zeros(0), np.zeros((0, 0)), 0.0)
    assert model.centred(np.array([[2**62, 5]], np.int64)).tolist() == [[0, 15]]


def test_rounds_of_triangles(spark, monkeypatch):
    monkeypatch.setattr(whitening, "GROUP_BYTES", 1)  # two triangles a task: several rounds
    rng = np.random.default_rng(3)
    frame = spark.createDataFrame([(i, [float(x) for x in v], "x", "y") for i, v in enumerate(np.float32(rng.standard_normal((200, 5))))], SCHEMA).repartition(7)
    model = whitening.fit_whitening(whitening.usable(frame))
    x = np.array(sorted({tuple(math.floor(64 * float(c)) for c in r.embedding) for r in frame.collect()}), float)
    assert np.allclose(model.variances, np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1], rtol=1e-12) and model.n == len(x)
