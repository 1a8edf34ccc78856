"""Embedding whitening against plain linear algebra."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import whitening
from strata.llm.bidiagonal_svd import bidiagonalise, dqds, top_directions
from strata.llm.common import load
from strata.llm.whitening import op12_whitening

ODD = [(1, [0.5, -0.25, 0.125]), (2, None), (3, [0.5, None, 1.0]), (4, [float("nan"), 0.0, 0.0]),
       (5, [float("inf"), 0.0, 0.0]), (6, [0.1, 0.2, 0.3]), (6, [0.1, 0.2, 0.3]), (None, [1.0, 0.7, -2.0]),
       (7, [-0.4, 0.9, 0.3]), (8, []), (9, [1.0]), (10, [0.0, 0.0, 0.0])]


def _write(spark, rows, path):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("x", "at", "n", "whitened", "deviation", "block", "component", "size", "count"):
        df = df.selectExpr("*", f"'clash' as {name}")
    df.write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_bidiagonal_values_and_directions():
    rng = np.random.default_rng(3)
    cases = [rng.standard_normal((n, n)) for n in (1, 2, 3, 8, 40)]
    cases += [np.diag([3.0, 3.0, 3.0, 1.0]), np.zeros((4, 4)), np.diag(10.0 ** -np.arange(12.0)),
              np.ones((6, 6)), np.triu(np.ones((9, 9))) * (10.0 ** -np.arange(9.0))[:, None],
              np.kron(np.eye(5), rng.standard_normal((3, 3)))]
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    cases.append(np.diag([5.0] * 6 + [4.999999] * 4 + [1.0] * 20) @ q)
    for r in cases:
        diagonal, upper, v = bidiagonalise(r)
        b = np.diag(diagonal) + np.diag(upper, 1)
        top = max(np.linalg.norm(r, 2), 1e-300)
        assert np.abs(v.T @ v - np.eye(len(r))).max() < 1e-13
        assert np.abs((r @ v).T @ (r @ v) - b.T @ b).max() <= 1e-13 * top ** 2
        want = np.linalg.svd(r, compute_uv=False)
        values, vectors = top_directions(r, 8)
        assert np.abs(values - want).max() <= 1e-13 * top
        k = vectors.shape[1]
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-11
        assert np.abs((r @ vectors).T @ (r @ vectors) - np.diag(values[:k] ** 2)).max() <= 1e-11 * top ** 2


def test_small_values_keep_their_digits():
    a, b = 10.0 ** -np.arange(10.0), 10.0 ** -(np.arange(9.0) + 3)
    got = dqds(a, b)
    # Fractions: the product of the values is the product of the diagonal
    assert math.isclose(float(np.prod(got)), float(np.prod(a)), rel_tol=1e-12)
    assert math.isclose(got[-1], np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False)[-1], rel_tol=1e-6)


def _check(rows, out):
    good = [(i, v) for i, v in rows if v is not None and len(v) == len(rows[0][1])
            and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in good]
    n, d = len(x), len(x[0])
    total = [sum(r[j] for r in x) for j in range(d)]
    cov = np.cov((np.array(x) - np.array(total) / n).T, bias=True).reshape(d, d)
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1], vec[:, ::-1]
    k = min(8, d)
    got = {}
    for r in out:
        if r["deviation_exact"] is not None:
            got.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
        assert r["n"] == n and abs(r["explained"] - e[r["component"] - 1] / e.sum()) <= 1e-9
        assert r["identity_error"] < 1e-9
    want = {}
    for (i, _), row in zip(good, x, strict=True):
        dev = sum((n * a - s) ** 2 for a, s in zip(row, total, strict=True))
        want.setdefault((i, dev), []).append((np.array(row) - np.array(total) / n) @ vec[:, :k] / np.sqrt(e[:k]))
    assert got.keys() == want.keys()
    for c in range(k):
        pairs = [(g, w[c]) for key in want for g, w in zip(got[key][c + 1], want[key], strict=True)]
        g, w = np.array(pairs).T
        assert min(np.abs(g - w).max(), np.abs(g + w).max()) < 1e-6 * max(1, np.abs(w).max())


def test_query_matches_plain_linear_algebra(spark, sf_small):
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in load(spark, sf_small, "embeddings").collect()]
    out = op12_whitening(spark, sf_small).collect()
    assert len(out) == 8 * len(rows)
    _check(rows, out)


def test_odd_and_no_vectors(spark, tmp_path):
    out = op12_whitening(spark, _write(spark, ODD, tmp_path / "odd")).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in out) == sorted(
        (i or 0, c) for i, v in ODD if i not in (2, 3, 4, 5) for c in (1, 2, 3))
    assert {r["vec_id"] for r in out if r["deviation_exact"] is None} == {8, 9}
    _check(ODD, out)
    for i, rows in enumerate(([], [(1, None)], [(1, [])])):
        assert op12_whitening(spark, _write(spark, rows, tmp_path / f"none{i}")).collect() == []
    same = op12_whitening(spark, _write(spark, [(1, [1.0, 2.0])] * 3, tmp_path / "same")).collect()
    assert len(same) == 6 and all(r["whitened"] is None and r["deviation"] == 0 for r in same)


def test_deviations_beyond_64_bits(spark, tmp_path):
    rows = [(1, [1e8, 3.0]), (2, [-1e8, 5.0]), (3, [7.0, 8.0])]
    out = op12_whitening(spark, _write(spark, rows, tmp_path / "big")).collect()
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in rows]
    total = [sum(c) for c in zip(*x, strict=True)]
    for r in out:
        want = sum((3 * a - s) ** 2 for a, s in zip(x[r["vec_id"] - 1], total, strict=True))
        assert int(r["deviation_exact"]) == want and r["deviation"] == (want if want < 1 << 63 else None)


@pytest.mark.parametrize("fan_in", [2, 3])
def test_many_triangles(spark, sf_small, monkeypatch, fan_in):
    rows = load(spark, sf_small, "embeddings").select("vec_id", whitening.quantised(F.col("embedding")).alias("x"))
    one = whitening.fit(rows.coalesce(1))
    monkeypatch.setattr(whitening, "FAN_IN", fan_in)
    many = whitening.fit(rows.repartition(23))
    assert one.total == many.total and np.allclose(one.explained, many.explained, rtol=1e-10)
    assert np.allclose(np.abs(one.directions), np.abs(many.directions), rtol=1e-6, atol=1e-9)
