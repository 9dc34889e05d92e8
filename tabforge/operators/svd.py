"""Truncated singular value decomposition of a vector column, uncentred.

Block Krylov iteration: a block of ``k`` plus some extra directions is multiplied by the rows and by
their transpose in one pass (each task adds up a d x block product; the sums are added by Spark).  The
part of the product outside all directions so far is the next block, and the vectors are read from all
of them, so values that lie close together need few passes; d / block passes span the whole space.  The
driver holds ``KEPT`` blocks of d x block numbers, then starts anew from the vectors found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Blocks of directions that the driver keeps.
KEPT = 12


@dataclass
class Svd:
    """Right singular vectors as columns, singular values falling, and the passes it took."""
    v: np.ndarray
    s: np.ndarray
    passes: int

    def transform(self, df: DataFrame, features: str = "features", out: str = "reduced") -> DataFrame:
        """``df`` with the row's coordinates on the singular vectors (array of doubles; null for a null vector)."""
        v = self.v

        def project(parts):
            for x in parts:
                some = [r for r in x if r is not None]
                told = iter(np.stack(some).astype(np.float64) @ v if some else ())
                yield pd.Series([None if r is None else next(told) for r in x], dtype=object)

        project.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return df.withColumn(out, F.pandas_udf(project, "array<double>")(F.when(F.col(features).isNotNull(), vector_to_array(features))))


def truncated_svd(df: DataFrame, k: int = 50, features: str = "features", extra: int = 10, tol: float = 1e-9,
                  max_passes: int = 100, seed: int = 42) -> Svd:
    """The ``min(k, dimensions)`` greatest singular values and right vectors of the rows of ``features``.

    Null vectors take no part; a table without vectors raises.  Stops when the rows' product turns no
    wanted vector away from itself by more than ``tol`` of the greatest squared value, or raises after
    ``max_passes``.  Each vector's greatest component is positive, so a repeated run gives the same signs.
    """
    rows = df.where(F.col(features).isNotNull()).select(vector_to_array(features).alias("x"))
    first = rows.first()
    if first is None:
        raise ValueError("no vectors to decompose")
    d = len(first["x"])
    k = min(k, d)
    block = min(k + extra, d)

    def product(q):
        """Sum over rows of x (x q), in one pass."""
        def run(batches):
            total = np.zeros(q.shape)
            for b in batches:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                total += x.T @ (x @ q)
            yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1)], pa.list_(pa.float64()))], ["s"])

        s = rows.mapInArrow(run, "s array<double>").agg(Summarizer.sum(array_to_vector("s")).alias("s")).first()["s"]
        return s.toArray().reshape(q.shape)

    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, block)))[0]
    basis = image = np.zeros((d, 0))   # orthonormal directions, and what the rows make of them
    for number in range(1, max_passes + 1):
        turned = product(q)
        basis, image = np.hstack([basis, q]), np.hstack([image, turned])
        small = basis.T @ image
        values, w = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)[:block]
        values, w = values[order], w[:, order]
        v, moved = basis @ w, image @ w
        greatest = max(values[0], np.finfo(float).tiny)
        away = np.linalg.norm(moved - v * values, axis=0)[:k]
        q = _outside(turned, basis, 1e-13 * greatest)
        if np.all(away <= tol * greatest) or not q.shape[1]:
            v = v[:, :k]
            sign = np.sign(v[np.abs(v).argmax(axis=0), np.arange(k)])
            return Svd(v * np.where(sign == 0, 1, sign), np.sqrt(np.maximum(values[:k], 0)), number)
        if basis.shape[1] + q.shape[1] > max(KEPT, 2) * block:
            basis, image, q = v, moved, _outside(moved, v, 1e-13 * greatest)
    raise ValueError(f"singular vectors still turn after {max_passes} passes")


def _outside(x: np.ndarray, basis: np.ndarray, least: float) -> np.ndarray:
    """An orthonormal base of what the columns of ``x`` have outside ``basis``, without directions of at most ``least``."""
    x = x - basis @ (basis.T @ x)
    u, size, _ = np.linalg.svd(x - basis @ (basis.T @ x), full_matrices=False)
    u = u[:, size > least][:, : basis.shape[0] - basis.shape[1]]
    return np.linalg.qr(u - basis @ (basis.T @ u))[0]
