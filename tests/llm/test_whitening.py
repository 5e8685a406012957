import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hopscope.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, own string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "own", "clash") for i, v in rows], SCHEMA).repartition(5)


def dense(vectors):
    """Whole numbers, eigenvalues and vectors straight from the covariance."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(np.float64)) + 1000000
    c = x - x.mean(axis=0)
    values, q = np.linalg.eigh(c.T @ c / len(x))
    return x, c, values[::-1], q[:, ::-1]


def clustered(n, d, seed=0):
    rng = np.random.default_rng(seed)
    scale = np.linspace(3, 0.5, d)
    return (rng.standard_normal((n, d)) * scale @ np.linalg.qr(rng.standard_normal((d, d)))[0] + 0.1).astype(np.float32)


def odd_vectors(d):
    one = [0.5] * d
    return [(900, None), (901, []), (902, [None, *one[1:]]), (903, [math.nan, *one[1:]]), (904, [math.inf, *one[1:]]), (905, one[1:])]


def test_query_against_dense_eigenvectors(spark, tmp_path):
    d = 64
    vectors = clustered(600, d)
    rows = [(i, [float(e) for e in v]) for i, v in enumerate(vectors)] + odd_vectors(d)
    rows += [(0, rows[0][1]), (None, rows[1][1])]
    frame(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    good = [v for _, v in rows if v and len(v) == d and all(e is not None and math.isfinite(e) for e in v)]
    x, c, values, q = dense(good)
    n = len(good)
    got = queries.op13_embedding_whitening(spark, str(tmp_path)).collect()
    assert len(got) == 32 * n and {r["n"] for r in got} == {n}
    white = c @ q[:, :32] / np.sqrt(values[:32])
    by_row = {}
    for r in got:
        by_row.setdefault(r["vec_id"], []).append(r)
    signs = {}
    for r in by_row[7]:
        k = r["component"] - 1
        signs[k] = np.sign(r["whitened"] * white[7, k])
    sums = x.sum(axis=0)
    for i in range(1, 600):
        for r in by_row[i]:
            k = r["component"] - 1
            assert r["whitened"] * signs[k] == pytest.approx(white[i, k], abs=1e-8)
            assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
            assert r["deviation"] == sum(int(e) ** 2 for e in n * x[i] - sums)
    assert len(by_row[0]) == 64 and len(by_row[None]) == 32
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10


def test_filter_runs_on_a_narrow_block(spark):
    """More dimensions than the block has columns, outliers far above a flat spectrum."""
    rng = np.random.default_rng(3)
    d = 96
    v = rng.standard_normal((3000, d)) + 40 * rng.standard_normal((3000, 1)) * rng.standard_normal(d)
    v += 6 * rng.standard_normal((3000, 1)) * rng.standard_normal(d)
    model = whitening.fit(frame(spark, [(i, [float(e) for e in r]) for i, r in enumerate(v)]), components=6, spare=6)
    _, _, values, q = dense(v)
    assert np.allclose(model.values, values[:6], rtol=1e-12)
    assert np.allclose(np.abs((model.vectors * q[:, :6]).sum(axis=0)), 1, atol=1e-12)
    assert model.residual <= 1e-11 and model.identity_error < 1e-10 and model.passes > 10


def test_filter_damps_the_interval(spark):
    class Dense:
        dims, count = 4, 0

        def times(self, block):
            return np.diag([10.0, 6.0, 1.0, 0.5]) @ block

    made = whitening.chebyshev(Dense(), np.eye(4), np.zeros((4, 0)), 0.0, 1.5, 10.0, 6)
    sizes = np.abs(np.diag(made))
    assert sizes[0] == pytest.approx(1) and sizes[2] < 1e-6 and sizes[3] < 1e-6 < sizes[1]


def test_equal_eigenvalues(spark):
    rows = [[s * (2.0 if i == k else 0.0) for i in range(5)] for k in range(5) for s in (1, -1)]
    model = whitening.fit(frame(spark, list(enumerate(rows))), components=2, spare=1)
    assert np.allclose(model.values, model.values[0]) and model.identity_error < 1e-12
    assert np.allclose(model.vectors.T @ model.vectors, np.eye(2))


def test_flat_directions_are_left_out(spark, tmp_path):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    frame(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op13_embedding_whitening(spark, str(tmp_path))
    assert got.count() == 9 and {r["component"] for r in got.collect()} == {1}
    assert got.first()["explained"] == pytest.approx(1)


def test_nothing_to_fit(spark, tmp_path):
    for name, rows in (("none", []), ("odd", odd_vectors(3)[:5]), ("same", [(i, [1.0, 2.0]) for i in range(4)])):
        frame(spark, rows).write.parquet(str(tmp_path / name / "embeddings.parquet"))
        got = queries.op13_embedding_whitening(spark, str(tmp_path / name))
        assert got.count() == 0 and got.columns[:2] == ["vec_id", "component"]


def test_carried_columns_and_order_of_lengths(spark):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(20)] + [(50, [1.0, 2.0, 3.0])]
    vectors = frame(spark, rows)
    model = whitening.fit(vectors)
    assert model.dims == 2 and model.n == 20
    out = whitening.whiten(vectors, model)
    assert out.columns == [*vectors.columns, "deviation", "whitened"] and out.count() == 20
    assert out.filter(F.col("own") == "own").filter(F.col("v") == "clash").count() == 20


def test_large_sums():
    off = np.array([[2**31, 1], [2**32, 2**32], [0, 0]], np.int64)
    assert whitening._deviations(off).to_pylist() == [2**62 + 1, None, 0]
    with pytest.raises(ValueError, match="summed exactly"):
        import pyarrow as pa

        whitening.whole(pa.RecordBatch.from_arrays([pa.array([[1e14, 0.0]])], names=["v"]), 2)
