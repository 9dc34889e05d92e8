"""Uncentred truncated SVD against an exact one."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabforge.operators import svd
from tabforge.operators.svd import truncated_svd


def vectors(spark, x, parts=3):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, x array<double>").select("id", array_to_vector("x").alias("features")).repartition(parts)


@pytest.mark.parametrize("k, d, rank", [(4, 12, 12), (10, 12, 12), (20, 12, 12), (4, 12, 3)])
def test_equals_exact_decomposition(spark, k, d, rank):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, rank)) @ rng.normal(size=(rank, d)) + (1.5 if rank == d else 0)   # not centred
    found = truncated_svd(vectors(spark, x), k, extra=3)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    k = min(k, d)
    assert np.allclose(found.s, s[:k], atol=1e-5 * s[0])
    assert np.allclose(found.v.T @ found.v, np.eye(k), atol=1e-9)
    some = min(k, rank)
    assert np.allclose(np.abs((found.v[:, :some] * vt[:some].T).sum(axis=0)), 1, atol=1e-3)   # the same directions
    got = {r.id: r.reduced for r in found.transform(vectors(spark, x)).collect()}
    assert len(got) == 200 and np.allclose([got[i] for i in range(200)], x @ found.v)


@pytest.mark.parametrize("kept", [12, 2])
def test_values_close_together_need_few_passes(spark, monkeypatch, kept):
    """One-hot columns of many even levels: singular values beyond the wanted ones that hardly differ."""
    monkeypatch.setattr(svd, "KEPT", kept)
    rng = np.random.default_rng(3)
    x = np.linalg.qr(rng.normal(size=(300, 40)))[0] * (1 + 1e-4 * np.arange(40)[::-1]) @ np.linalg.qr(rng.normal(size=(40, 40)))[0]
    found = truncated_svd(vectors(spark, x), 5, extra=3, tol=1e-7 if kept == 2 else 1e-9)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(found.s, s[:5], rtol=1e-5)
    assert np.allclose(found.v.T @ found.v, np.eye(5), atol=1e-9)
    if kept == 12:
        assert found.passes <= 5
        assert np.allclose(np.abs((found.v * vt[:5].T).sum(axis=0)), 1, atol=1e-6)


def test_edges(spark):
    x = np.eye(3)
    with pytest.raises(ValueError):
        truncated_svd(vectors(spark, x).limit(0))
    some = vectors(spark, x).withColumn("features", F.when(F.col("id") > 0, F.col("features")))
    found = truncated_svd(some, 2)
    assert np.allclose(found.s, [1, 1])
    told = {r.id: r.reduced for r in found.transform(some).collect()}
    assert told[0] is None and np.linalg.norm(told[1]) == pytest.approx(1)
    assert truncated_svd(vectors(spark, np.zeros((4, 3))), 2).s.tolist() == [0, 0]
