import math
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.conftest import path
from wayfarer.llm import registry
from wayfarer.llm import whitening as W

NAN, INF = float("nan"), float("inf")


def random_covariance(n, seed, values=None):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(n, n)))[0]
    values = np.sort(rng.uniform(0.1, 5, n))[::-1] if values is None else np.asarray(values, float)
    v = (q * values) @ q.T
    return (v + v.T) / 2, values


@pytest.mark.parametrize("n", [1, 2, 3, 10, 64, 150])
def test_tridiagonal_form_keeps_the_matrix(n):
    v, _ = random_covariance(n, n)
    diagonal, side, normals = W.tridiagonal(v)
    t = np.diag(diagonal) + np.diag(side, 1) + np.diag(side, -1)
    q = np.array([W.reflected(normals, e) for e in np.eye(n)]).T
    assert np.allclose(q.T @ q, np.eye(n), atol=1e-13) and np.allclose(q @ t @ q.T, v, atol=1e-12)


def test_sturm_counts():
    rng = np.random.default_rng(5)
    d, e = rng.normal(size=40), rng.normal(size=39)
    e[[7, 20]] = 0.0
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.concatenate([rng.uniform(-4, 4, 300), values - 1e-9, values + 1e-9])
    assert np.array_equal(W.sturm_counts(d, e, at), (values[None, :] < at[:, None]).sum(axis=1))


@pytest.mark.parametrize("values", [
    None, [5] * 10 + [1] * 20, [3, 3 - 1e-15, 3 - 1e-12, 3 - 1e-8, 3 - 1e-4, 2, 2, 2, *[0.5] * 40], [1e9, 1, 1e-1, *[1e-3] * 9],
    [1e-300] * 4 + [0] * 4, [7] + [0] * 20, [4, 3, 2, 1, 0.5]])
@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_eigenvectors(values, seed):
    n = 64 if values is None else len(values)
    v, values = random_covariance(n, seed, values)
    vectors, found = W.leading_components(v, 8)
    m = int((values[:8] > W.LEAST * values[0] * 1.01).sum())
    assert len(found) == m and np.allclose(found, values[:m], rtol=1e-9, atol=1e-13 * values[0])
    assert np.abs(vectors @ vectors.T - np.eye(m)).max() < 1e-12
    assert np.abs(vectors @ v - found[:, None] * vectors).max() < 1e-12 * values[0]


def test_diagonal_and_zero_matrices():
    vectors, found = W.leading_components(np.diag([1.0, 5, 5, 2]), 3)
    assert found.tolist() == pytest.approx([5, 5, 2]) and np.allclose(vectors @ vectors.T, np.eye(3))
    assert len(W.leading_components(np.zeros((3, 3)), 8)[1]) == 0


@pytest.mark.parametrize("size", [3, 1 << 10, 1 << 30, 1 << 53])
def test_sums_and_products_are_exact(size):
    x = np.random.default_rng(size).integers(-size, size + 1, (5000, 3))
    rows = x.tolist()
    assert W.exact_sums(x) == [sum(r[i] for r in rows) for i in range(3)]
    assert W.exact_products(x).tolist() == [[sum(r[i] * r[j] for r in rows) for j in range(3)] for i in range(3)]


def table(spark, rows):
    rows = [(i, v, 1, "x", 0.5) for i, v in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, component string, _v double")


def check(got, rows, d, m):
    """``got`` against exact arithmetic and numpy's own eigenvectors."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    assert {(r["n"], r["identity_error"]) for r in got} == {(n, got[0]["identity_error"])} and got[0]["identity_error"] <= 1e-9
    want = sorted((i, sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True))) for (i, _), r in zip(rows, x, strict=True))
    for k in range(1, m + 1):
        assert sorted((r["vec_id"], r["deviation"]) for r in got if r["component"] == k) == want
    centred = np.array([[float(a - Fraction(b, n)) for a, b in zip(r, s, strict=True)] for r in x])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    by_id = {i: c for (i, _), c in zip(rows, centred, strict=True)}
    for k in range(1, m + 1):
        mine = {r["vec_id"]: r["whitened"] for r in got if r["component"] == k}
        z = np.array([by_id[i] @ vectors[:, -k] / math.sqrt(values[-k]) for i in mine])
        w = np.array(list(mine.values()))
        assert min(np.abs(w - z).max(), np.abs(w + z).max()) < 1e-7
        said = {r["explained"] for r in got if r["component"] == k}
        assert len(said) == 1 and said.pop() == pytest.approx(values[-k] / np.trace(v), rel=1e-10)
    assert len(got) == n * m


def test_special_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=10) * np.arange(1, 11)).astype("f4").tolist()) for i in range(40)]
    rows += [(50, rows[0][1])]
    bad = [(60, None), (61, []), (62, [1.0] * 9), (63, [*[0.0] * 9, None]), (64, [NAN, *[0.0] * 9]), (65, [-INF, *[0.0] * 9]),
           (None, None), (66, [1.0] * 11), (67, [1e30, *[0.0] * 9])]
    check(W.whiten(table(spark, bad + rows).repartition(3)).collect(), rows, 10, 8)


def test_null_and_repeated_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).tolist()) for i in (None, 1, 1, None, 2)]
    got = W.whiten(table(spark, rows)).collect()
    assert sorted(str(r["vec_id"]) for r in got if r["component"] == 1) == ["1", "1", "2", "None", "None"]


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    df = W.whiten(table(spark, rows))
    assert df.collect() == [] and df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_dimensions_than_components(spark):
    rows = [(i, [float(i % 3), float(i * i % 5), 0.0]) for i in range(20)]
    got = W.whiten(table(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2} and got[0]["identity_error"] < 1e-9


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(4 ** i), 1.0]) for i in range(20)]
    found = W.transform(table(spark, rows), W.fit(table(spark, rows))).collect()
    x = [4 ** i * 1024 + 100_000 for i in range(20)]
    assert {r["vec_id"]: int(r["deviation"]) for r in found} == {i: (20 * v - sum(x)) ** 2 for i, v in enumerate(x)}
    assert {r["deviation"] for r in W.whiten(table(spark, rows)).collect()} == {None} | {
        y for v in x if (y := (20 * v - sum(x)) ** 2) < 1 << 63}


def test_the_split_of_the_table_does_not_matter(spark):
    df = spark.read.parquet(path("embeddings"))
    one, many = W.fit(df.coalesce(1)), W.fit(df.repartition(7))
    assert one.sums == many.sums and np.array_equal(one.vectors, many.vectors) and np.array_equal(one.variances, many.variances)


def test_query_equals_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(path("embeddings")).collect()]
    got = registry.queries()["op12_embedding_whitening"](spark, path("x").rsplit("/", 1)[0]).collect()
    check(got, rows, 64, 8)
