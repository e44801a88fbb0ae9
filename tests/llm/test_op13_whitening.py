import numpy as np
import pytest

from guildbook.llm import op13_whitening as op


def brute(vectors):
    """n, deviations, eigenvalues, projections up to sign, of a list of vectors by numpy's own routine."""
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    centred = x - s / n
    v = centred.T @ centred / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][: op.KEEP], w[:, ::-1][:, : op.KEEP]
    return n, deviation, e / np.trace(v), np.abs(centred @ w / np.sqrt(e))


def held(spark, rows, kind="array<float>"):
    df = spark.createDataFrame([(i, v, "z", 1, 2) for i, v in rows], f"vec_id long, embedding {kind}, z string, d int, component int").repartition(3)
    return op.whiten(df, ["vec_id"]).collect()


def test_against_eigh(spark):
    rng = np.random.default_rng(1)
    data = (rng.standard_normal((300, 20)) * np.linspace(2, 0.2, 20) @ rng.standard_normal((20, 20))).astype(np.float32).tolist()
    rows = list(enumerate(data)) + [(7, data[7]), (None, data[8])]
    odd = [(900, None), (901, [None] * 20), (902, [float("nan")] * 20), (903, [float("inf")] + [0.0] * 19), (904, []), (905, [1e30] * 20)]
    got = held(spark, rows + odd)
    n, deviation, explained, z = brute([v for _, v in rows])
    assert len(got) == len(rows) * op.KEEP
    want = {}
    for (i, _), dev, r in zip(rows, deviation, z, strict=True):
        want.setdefault(i, (dev, r))
    for r in got:
        dev, row = want[r["vec_id"]]
        k = r["component"] - 1
        assert r["n"] == n and int(r["deviation"]) == dev
        assert abs(abs(r["whitened"]) - row[k]) < 1e-8
        assert abs(r["explained"] / explained[k] - 1) < 1e-9
        assert r["identity_error"] < 1e-9


def test_lengths_are_whitened_on_their_own(spark):
    rng = np.random.default_rng(2)
    a, b = rng.standard_normal((40, 3)).tolist(), rng.standard_normal((30, 12)).tolist()
    got = held(spark, list(enumerate(a)) + [(100 + i, v) for i, v in enumerate(b)] + [(500, [1.0, 2.0])], "array<double>")
    for first, vectors, keep in ((0, a, 3), (100, b, 8)):
        part = [r for r in got if first <= r["vec_id"] < first + 100]
        n, deviation, explained, z = brute(vectors)
        assert len(part) == n * keep and {r["n"] for r in part} == {n}
        assert all(abs(abs(r["whitened"]) - z[r["vec_id"] - first][r["component"] - 1]) < 1e-8 for r in part)
    alone = [r for r in got if r["vec_id"] == 500]
    assert len(alone) == 2 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in alone)


def test_components_without_variance(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((50, 2))
    got = held(spark, [(i, [float(a), float(b), float(a), 0.5]) for i, (a, b) in enumerate(base)], "array<double>")
    assert {r["component"] for r in got if r["whitened"] is not None} == {1, 2}
    assert all(r["identity_error"] < 1e-8 for r in got)


def test_exact_beyond_machine_words():
    x = np.array([[2**40, 5], [3, -(2**40)]])
    total = [2**60, -7]
    assert op._deviations(x, 10**9, total) == [sum((10**9 * int(a) - s) ** 2 for a, s in zip(r, total, strict=True)) for r in x.tolist()]


@pytest.mark.parametrize("eigenvalues", [[1e8, 1e4, 1.0, 1e-3, 0, 0], [3, 3, 3, 2, 2, 1], [5.0] * 6, [4, 3, 2, 1, 0, -1e-18], [1, 2, 3, 4, 5, 6]])
def test_divide_and_conquer(eigenvalues):
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.standard_normal((6, 6)))[0]
    a = q @ np.diag(eigenvalues) @ q.T
    a = (a + a.T) / 2
    values, vectors = op.components(a, 6)
    scale = max(map(abs, eigenvalues))
    assert np.allclose(values, sorted(eigenvalues, reverse=True), atol=1e-12 * scale)
    assert np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-12)
    assert np.allclose(a @ vectors, vectors * values, atol=1e-11 * scale)


def test_polar_gives_signs():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    e = np.concatenate([np.geomspace(1e-9, 1, 15), -np.geomspace(1e-7, 3, 15)])
    assert np.allclose(op.polar(q * e @ q.T), q * np.sign(e) @ q.T, atol=1e-6)


def test_query_and_empty(spark):
    got = op.op13_whitening(spark, "/root/testdata/sf0.001")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    vectors = [r["embedding"] for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()]
    n, deviation, explained, z = brute(vectors)
    rows = got.orderBy("vec_id", "component").collect()
    assert len(rows) == n * 8 and [r["deviation"] for r in rows[::8]] == deviation
    assert np.allclose([abs(r["whitened"]) for r in rows], z.ravel(), atol=1e-7)
    assert op.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>"), ["vec_id"]).count() == 0
