"""Whitening against plain covariances, and the solver on matrices of known spectra."""

from decimal import Decimal

import numpy as np
import pytest

from fleetschema.llm import qd, queries, whitening
from tests.conftest import SF


def spectrum(values, rows, seed):
    rng = np.random.default_rng(seed)
    u = np.linalg.qr(rng.standard_normal((rows, len(values))))[0]
    v = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    return np.linalg.qr((u * values) @ v.T, mode="r"), v


SPECTRA = {
    "spread": np.linspace(30, 1, 24),
    "graded": 10.0 ** -np.arange(12),
    "pairs": np.repeat([9.0, 7.0, 5.0, 3.0, 1.0], 2),
    "near pairs": np.repeat([9.0, 7.0, 5.0], 2) * (1 + 1e-9 * np.arange(6)),
    "equal": np.full(10, 2.0),
    "rank": np.array([5.0, 4.0, 3.0, 0.0, 0.0, 0.0]),
    "chain": 1 + 1e-4 * np.arange(16)[::-1],
    "one": np.array([3.0]),
}


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("seed", [1, 2])
def test_solver_on_known_spectra(name, seed):
    values = np.sort(SPECTRA[name])[::-1]
    r, _ = spectrum(values, 40, seed)
    every, got, vectors = qd.eigenpairs(r, 8)
    want = values**2
    assert np.allclose(every, want, rtol=1e-12, atol=1e-13 * want[0])
    assert len(got) == min(8, (want > len(want) * qd.EPS * want[0]).sum())
    k = len(got)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(r.T @ (r @ vectors) - vectors * got).max() < 1e-12 * want[0]


def test_small_singular_values_keep_their_digits():
    """dqds on a bidiagonal matrix whose values span 30 orders."""
    d, f = 10.0 ** -np.arange(0.0, 15), 0.5 * 10.0 ** -np.arange(0.0, 14)
    got = qd.dqds(d, f)
    # the determinant is the product of the diagonal, exact whatever is above it
    assert np.prod(got) == pytest.approx(np.prod(d**2), rel=1e-12)
    assert len(got) == 15 and (np.diff(got) <= 0).all()


def test_bidiagonal_is_orthogonal():
    a = np.random.default_rng(5).standard_normal((9, 9))
    d, f, w = qd.bidiagonal(a)
    b = np.diag(d) + np.diag(f, 1)
    assert np.allclose(w.T @ w, np.eye(9), atol=1e-13) and np.allclose(b.T @ b, w.T @ (a.T @ a) @ w, atol=1e-12)


def plain(rows):
    """The contract, with numpy's eigenvectors of the covariance."""
    keep = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(np.float64(c)))) + 100000 for c in v] for _, v in keep], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [int(sum((n * a - s) ** 2 for a, s in zip(row, sums))) for row in x]
    y = ((x * n - sums) / n).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return [i for i, _ in keep], deviation, y, values[::-1], vectors[:, ::-1]


def test_query_equals_plain_whitening(spark, con):
    rows = con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids, deviation, y, values, vectors = plain(rows)
    got = queries.QUERIES["op13_embedding_whitening"](spark, SF).toPandas()
    assert len(got) == 8 * len(ids) and set(got["n"]) == {len(ids)}
    assert got["identity_error"].nunique() == 1 and 0 <= got["identity_error"][0] < 1e-9
    assert got.groupby("vec_id")["deviation"].first().to_dict() == dict(zip(ids, deviation))
    for c in range(1, 9):
        part = got[got["component"] == c].set_index("vec_id").loc[ids]
        want = y @ vectors[:, c - 1] / np.sqrt(values[c - 1])
        sign = np.sign(want @ part["whitened"])
        assert np.allclose(part["whitened"], sign * want, atol=1e-8)
        assert np.allclose(part["explained"], values[c - 1] / values.sum(), rtol=1e-10)


def whitened(spark, rows, components=8, schema="vec_id long, embedding array<double>"):
    df = spark.createDataFrame(rows, schema)
    model = whitening.fit(df, "embedding", components)
    return model, whitening.whiten(df, "embedding", model)


def test_many_parts_give_one_triangle(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 3)
    rng = np.random.default_rng(2)
    rows = [(k, (rng.standard_normal(6) * [9, 5, 3, 2, 1, 0.5]).tolist()) for k in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(23)
    model = whitening.fit(df, "embedding", 6)
    *_, values, vectors = plain(rows)
    assert np.allclose(model.values, values, rtol=1e-11)
    assert np.allclose(np.abs((model.directions * vectors).sum(axis=0)), 1, atol=1e-10)
    out = whitening.whiten(df, "embedding", model)
    assert whitening.identity_error(out, "whitened", 6) < 1e-10


def test_rows_that_are_left_out(spark):
    rows = [
        (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 0.0]), (5, [float("inf"), 0.0]), (6, []),
        (7, [-1.0, 5.0]), (7, [-1.0, 5.0]), (None, [3.0, 3.5]),
    ]
    model, out = whitened(spark, rows)
    got = out.collect()
    assert model.n == 4 and sorted(str(r["vec_id"]) for r in got) == ["1", "7", "7", "None"]
    assert all(len(r["whitened"]) == 2 for r in got)
    _, deviation, *_ = plain(rows)
    assert sorted(r["deviation"] for r in got) == sorted(deviation)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(k, [4.0, 4.0]) for k in range(30)]])
def test_nothing_to_whiten(spark, rows):
    model, out = whitened(spark, rows)
    assert not len(model.values) and [r["whitened"] for r in out.collect()] == [[]] * (len(rows) if model.n else 0)
    assert whitening.identity_error(out, "whitened", 0) == 0.0


def test_lengths_and_clashing_names(spark):
    with pytest.raises(ValueError, match=r"several lengths: \[1, 2\]"):
        whitened(spark, [(1, [1.0]), (2, [1.0, 2.0])])
    schema = "vec_id long, embedding array<double>, whitened string, Deviation int, v int, part int, r int, `a.b` int"
    rows = [(k, [float(k), float(k * k % 7)], "w", 1, 2, 3, 4, 5) for k in range(9)]
    _, out = whitened(spark, rows, schema=schema)
    assert out.columns[-2:] == ["whitened_", "deviation_"] and out.count() == 9


def test_large_numbers_stay_exact():
    x = np.array([[10**6, -(10**6)], [3, 5]], np.int64)
    sums = np.array([10**18, 7], object)
    m = whitening._multiples(x, 10**13, sums)
    assert whitening._squares(m) == [(10**19 - 10**18) ** 2 + (-(10**19) - 7) ** 2, (3 * 10**13 - 10**18) ** 2 + (5 * 10**13 - 7) ** 2]
    assert Decimal(whitening._squares(x)[0]) == 2 * 10**12
