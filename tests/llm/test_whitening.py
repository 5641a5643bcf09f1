"""Whitened embeddings against whole numbers and a plain eigenvalue solver."""

import math
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as entry
from ledgerloom.llm import whitening
from ledgerloom.llm.whitening import jacobi_columns, pivoted_cholesky, principal_components, whiten
from tests.llm.conftest import SF_DIR


def _plain(rows, most=16):
    """(vec_id, component): n, deviation, whitened up to its sign, explained; from exact covariances."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for length in {len(x) for _, x in kept}:
        own = [(i, x) for i, x in kept if len(x) == length]
        fit = sorted({tuple(x) for _, x in own})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        away = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], object)
        covariance = np.array([[float(Fraction(int(v), n**3)) for v in row] for row in away.T.dot(away)])
        values, vectors = np.linalg.eigh(covariance)
        values, vectors = values[::-1], vectors[:, ::-1].T
        for i, x in own:
            far = [n * c - s for c, s in zip(x, sums)]
            for k in range(min(most, length)):
                if values[k] > 1e-9 * values[0] and values[0] > 0:
                    w = float(np.array(far, float) @ vectors[k] / n / math.sqrt(values[k]))
                    out.append((i, k + 1, n, sum(f * f for f in far), w, values[k] / covariance.trace()))
    return out


def _check(found, wanted):
    key = lambda r: (str(r[0]), r[1], r[3], abs(r[4]))
    found, wanted = sorted(map(tuple, found), key=key), sorted(wanted, key=key)
    assert [(f[0], f[1], f[2], int(f[3])) for f in found] == [w[:4] for w in wanted]
    signs = {}
    for f, w in zip(found, wanted):
        assert abs(f[5] - w[5]) <= 1e-9 * w[5] and f[6] <= 1e-9
        if abs(w[4]) > 1e-6:
            sign = signs.setdefault((f[1], f[2]), f[4] * w[4] > 0)
            assert (f[4] * w[4] > 0) == sign
        assert abs(abs(f[4]) - abs(w[4])) < 1e-7


def test_op11(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    df = entry.queries()["op11_embedding_whitening"](spark, SF_DIR)
    assert df.columns == "vec_id component n deviation whitened explained identity_error".split()
    assert dict(df.dtypes)["deviation"] == "bigint"
    _check(df.collect(), _plain([(r["vec_id"], r["embedding"]) for r in table.collect()]))


def _vectors(n=60, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 5)) * [8, 4, 2, 1, 0.5]
    # The last dimension says nothing new, one before is constant.
    return np.c_[base, np.full(n, 2.5), np.floor(64 * base[:, 0]) / 64].tolist()


def test_any_rows(spark):
    """Nulls, other lengths, repeated and equal vectors, clashing columns."""
    rows = [(i, v) for i, v in enumerate(_vectors())]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (70, [c + 1e-9 for c in rows[5][1]])]
    rows += [(71, None), (72, [1.0] * 6 + [None]), (73, [float("nan")] * 7), (74, [math.inf] + [0.0] * 6), (75, [])]
    rows += [(76, [1.0, 2.0]), (77, [1.0, 3.0]), (78, [4.0, 3.0]), (79, [0.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    found = whiten(df.selectExpr("*", "1 as component", "2 as n", "3 as x", "4 as dims")).collect()
    _check(found, _plain(rows))
    assert {r["vec_id"] for r in found} == {*range(60), None, 70, 76, 77, 78}
    _check(whiten(df, 2).collect(), _plain(rows, 2))


def test_exact_deviations_beyond_64_bits(spark):
    rows = [(i, [float(v * 10**9), float(i)]) for i, v in enumerate([0, 1, 2, 5, 9, 11])]
    found = whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    wanted = {(r[0], r[3]) for r in _plain(rows)}
    assert {(r["vec_id"], int(r["deviation"])) for r in found} == wanted and max(wanted, key=lambda w: w[1])[1] > 2**63


def test_one_vector_and_none(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    assert whiten(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 7, 24])
def test_factor_and_rotations(n):
    rng = np.random.default_rng(n)
    half = rng.normal(size=(n, n + 3)) * 10.0 ** rng.integers(-4, 4, size=(n, 1))
    scatter = half @ half.T
    low, order = pivoted_cholesky(scatter)
    assert np.allclose(low @ low.T, scatter[order][:, order], rtol=1e-12) and (np.triu(low, 1) == 0).all()
    rotated = jacobi_columns(low)
    norms = np.linalg.norm(rotated, axis=0)
    assert (np.diff(norms) <= 0).all()
    assert np.abs((rotated / norms).T @ (rotated / norms) - np.eye(n)).max() < 1e-13
    values, vectors = principal_components(scatter, n)
    assert np.allclose(values, np.linalg.eigvalsh(scatter)[::-1], rtol=1e-6, atol=1e-15 * values[0])
    assert np.allclose(vectors @ vectors.T, np.eye(n), atol=1e-13)


def test_dependent_dimensions_add_no_component():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 3))
    x = np.c_[x, x[:, 0] + x[:, 1], np.zeros(50)]
    assert len(principal_components(x.T @ x)[0]) == 3
    # Small variances beside large ones are kept.
    assert len(principal_components(np.diag([1e12, 1e-6, 1.0, 0.0]))[0]) == 3


def test_errors_are_measured(spark, monkeypatch):
    """The error says so if components are wrong."""
    monkeypatch.setattr(whitening, "principal_components", lambda v, most: (np.ones(2), np.eye(len(v))[:2]))
    rows = [(i, v) for i, v in enumerate(_vectors())]
    found = whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).first()
    assert found["identity_error"] > 1
