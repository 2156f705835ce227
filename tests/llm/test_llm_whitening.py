"""Whitening: the numerics against a dense solver, the query against a brute-force version, and edge rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventlake.llm import whitening
from eventlake.llm.queries import op12_embedding_whitening
from eventlake.llm.whitening import bidiagonal, dqds, fit, leading, whiten

SMALL = "/root/testdata/sf0.01"
rng = np.random.default_rng(5)


def spread_out(d, values):
    left, right = (np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(2))
    return left @ np.diag(values) @ right.T


MATRICES = {
    "random": rng.normal(size=(40, 40)),
    "triangle": np.triu(rng.normal(size=(64, 64))),
    "graded": spread_out(30, np.logspace(0, -9, 30)),
    "rank 3": spread_out(20, [5.0, 4.0, 3.0] + [0.0] * 17),
    "equal": spread_out(12, [3.0] * 5 + [1.0] * 7),
    "near": spread_out(12, 2 + 1e-9 * np.arange(12)),
    "identity": np.eye(9),
    "diagonal": np.diag([1.0, 0.0, 7.0, 7.0, 2.0]),
    "zero column": np.triu(rng.normal(size=(16, 16))) * (np.arange(16) != 3),
    "zero": np.zeros((4, 4)),
    "one": np.array([[-2.0]]),
    "two": np.array([[1.0, 2.0], [0.0, 3.0]]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading_against_a_dense_solver(name):
    m = MATRICES[name]
    values, vectors = leading(m, 6)
    expected = np.linalg.svd(m, compute_uv=False)
    scale = max(expected[0], 1e-300)
    assert np.abs(values - expected).max() <= 1e-13 * scale * len(m)
    k = vectors.shape[1]
    assert k == min(6, int((expected > 1e-12 * scale).sum()))
    assert np.abs(vectors.T @ vectors - np.eye(k)).max(initial=0) < 1e-9
    for j in range(k):
        assert np.linalg.norm(m.T @ (m @ vectors[:, j]) - values[j] ** 2 * vectors[:, j]) <= 1e-12 * scale**2 * len(m)


def test_bidiagonal_form():
    m = MATRICES["random"]
    a, b, right = bidiagonal(m)
    band = np.diag(a) + np.diag(b, 1)
    assert np.allclose(right.T @ right, np.eye(40), atol=1e-13)
    assert np.allclose(band.T @ band, right.T @ m.T @ m @ right, atol=1e-11)


def test_small_singular_values_are_accurate():
    """dqds keeps the digits of values far below the largest, which a solver of the whole matrix loses."""
    a, b = 10.0 ** -np.arange(0, 24, 2.0), 10.0 ** -np.arange(1, 23, 2.0) / 3
    got = dqds(a, b)
    assert math.prod(got) == pytest.approx(math.prod(a), rel=1e-11)  # the determinant


def plain(rows):
    """(key, component): (n, deviation, |whitened|, explained) by a dense solver over exact whole numbers."""
    sound = [(k, [math.floor(256 * float(c)) for c in v]) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    out = defaultdict(Counter)
    for length in {len(x) for _, x in sound}:
        fitted = sorted({tuple(x) for _, x in sound if len(x) == length})
        n, sums = len(fitted), [sum(c) for c in zip(*fitted, strict=True)]
        exact = np.array([[n * c - s for c, s in zip(x, sums, strict=True)] for x in fitted], float) / n
        e, v = np.linalg.eigh(exact.T @ exact / n)
        e, v = e[::-1], v[:, ::-1]
        for key, x in sound:
            if len(x) != length:
                continue
            whole = [n * c - s for c, s in zip(x, sums, strict=True)]
            for k in range(min(4, int((e > 1e-12 * e[0]).sum()) if e[0] > 0 else 0)):
                z = float(np.array(whole, float) @ v[:, k] / n / math.sqrt(e[k]))
                out[key, k + 1][n, sum(c * c for c in whole), round(abs(z), 7), round(float(e[k] / e.sum()), 9)] += 1
    return out


def got(frame):
    out = defaultdict(Counter)
    for r in frame.collect():
        assert r.identity_error < 1e-9
        out[r[0], r.component][r.n, r.deviation, round(abs(r.whitened), 7), round(r.explained, 9)] += 1
    return out


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert got(op12_embedding_whitening(spark, SMALL)) == plain(rows)


def test_edge_rows(spark):
    vectors = [(i, [float(c) for c in rng.normal(size=5)]) for i in range(60)]
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in vectors]
    vectors += [(100 + i, vectors[3][1]) for i in range(40)] + [vectors[7], (7, vectors[9][1]), (None, vectors[5][1])]
    vectors += [(200, None), (201, [None] + [0.0] * 4), (202, [float("nan")] * 5), (203, [float("-inf")] + [0.0] * 4), (204, [])]
    vectors += [(300, [1.0, 2.0]), (301, [1.0, 2.0]), (302, [-3.5, 0.25]), (400, [4.0])]
    table = spark.createDataFrame([(*v, "t", 1) for v in vectors], "vec_id long, embedding array<float>, x string, n int")
    models = fit(table)
    assert sorted(models) == [1, 2, 5] and models[5].n == 60 and models[1].directions.shape == (1, 0)
    frame = whiten(table, models)
    assert frame.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got(frame) == plain(vectors)
    renamed = table.withColumnRenamed("vec_id", "x_id")
    assert got(whiten(renamed, models, key="x_id")) == plain(vectors)
    with pytest.raises(ValueError):
        whiten(table, models, key="n")
    nothing = table.limit(0)
    assert fit(nothing) == {} and whiten(nothing, {}).count() == 0


def test_many_blocks_and_large_components(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    rows = [(i, [float(i % 7) * 2.0**33, float(i * i), 3.0]) for i in range(500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(9)
    result = whiten(table, fit(table)).collect()
    expected = plain(rows)
    assert {r.component for r in result} == {1, 2} and len(result) == 1000
    for r in result:
        ((n, deviation, z, share),) = expected[r.vec_id, r.component]
        assert r.n == n and r.explained == pytest.approx(share, abs=1e-9) and abs(r.whitened) == pytest.approx(z, abs=1e-6)
        assert r.deviation == (deviation if deviation < 1 << 63 else None)
    beyond = spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        fit(beyond)
