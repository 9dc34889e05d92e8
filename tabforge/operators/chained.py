"""Chained imputation by Bayesian ridge regressions (I6), fitted from sums of products.

Rows are summed up by their pattern of gaps: one matrix of products per pattern, a few thousand numbers
each.  Filling a gap is linear in the other columns, so what an update does to those products follows
from the matrices alone, and a whole round of regressions, each seeing the columns filled before it,
is fitted without reading a row.  A round then costs the one pass that fills the rows and measures how
far they moved.  Where a table has too many patterns for the driver, the products of each regression are
added up from the rows instead: the same regressions, one pass a column.
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

from tabforge.functions.scalars import nonfinite_to_null
from tabforge.session import stored

#: Numbers of one driver or task: patterns times products.
MAX_CELLS = 4_000_000


def evidence_ridge(products: np.ndarray, target: int, max_steps: int = 300, tol: float = 1e-3, prior: float = 1e-6):
    """Weights (0 at ``target``) and intercept of a Bayesian ridge regression, from ``products`` of (1, x) with itself.

    The precisions of noise and weights are those of greatest evidence under gamma priors of shape and
    rate ``prior``, found by fixed-point steps until the weights move by less than ``tol`` in sum.
    """
    n = products[0, 0]
    mean = products[0, 1:] / n
    centred = products[1:, 1:] - n * np.outer(mean, mean)
    others = np.arange(len(mean)) != target
    xy, yy = centred[others, target], max(centred[target, target], 0.0)
    eigen, axes = np.linalg.eigh(centred[np.ix_(others, others)])
    eigen, turned = np.maximum(eigen, 0.0), axes.T @ xy   # everything below is diagonal on these axes
    noise, weight = 1 / (yy / n + np.finfo(float).eps), 1.0
    before = None
    for _ in range(max_steps):
        w = turned / (eigen + weight / noise)
        missed = max(yy - 2 * w @ turned + w @ (eigen * w), 0.0)
        known = np.sum(noise * eigen / (weight + noise * eigen))   # directions that the data determine
        weight = (known + 2 * prior) / (w @ w + 2 * prior)
        noise = (n - known + 2 * prior) / (missed + 2 * prior)
        if before is not None and np.abs(axes @ (w - before)).sum() < tol:
            break
        before = w
    coef = np.zeros(len(mean))
    coef[others] = axes @ (turned / (eigen + weight / noise))
    return coef, mean[target] - coef @ mean


def _fill(x: np.ndarray, gap: np.ndarray, steps) -> None:
    """Gaps of ``x`` replaced in place by one regression after another."""
    for target, coef, intercept in steps:
        rows = gap[:, target]
        x[rows, target] = x[rows] @ coef + intercept


def _moved(products: np.ndarray, target: int, coef: np.ndarray, intercept: float) -> np.ndarray:
    """The products of a pattern after its gap ``target`` is filled."""
    step = np.eye(len(products))
    step[target + 1] = [intercept, *coef]
    return step @ products @ step.T


def _arrays(batch, d: int, gaps: int):
    """Values and gaps of an Arrow batch, as writable matrices."""
    flat = [batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1)]
    return np.array(flat[0], float).reshape(-1, d), np.array(flat[1], bool).reshape(-1, gaps)


@dataclass
class Chained:
    """A fitted imputation: ``cols`` are filled (``others`` only predict), by ``steps`` of every round in turn."""
    cols: list
    others: list
    means: dict
    rounds: list   # per round: (target, weights, intercept) per column, on values less the means
    patterns: int  # patterns of gaps, 0 where they were too many to hold

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the gaps of ``cols`` filled, in one pass; other columns and cells as they are.

        NaN and infinite cells count as gaps.  Columns without a finite value in the fit are left, their
        NaN and infinite cells as null; an empty table stays empty.
        """
        names = [*self.cols, *self.others]
        clean = df.withColumns({c: nonfinite_to_null(F.col(c).cast("double")) for c in self.cols})
        used = [c for c in names if self.means[c] is not None]
        if not self.rounds:
            return clean.fillna({c: self.means[c] for c in self.cols if self.means[c] is not None})
        mean, steps = np.array([self.means[c] for c in used]), [s for r in self.rounds for s in r]

        def filled(parts):
            for part in parts:
                x = np.stack(part) if len(part) else np.empty((0, len(used)))
                gap = np.isnan(x)
                x = np.where(gap, 0.0, x - mean)
                _fill(x, gap, steps)
                yield pd.Series(list(x + mean), dtype=object)

        filled.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
        cells = F.array(*[F.coalesce(nonfinite_to_null(F.col(c).cast("double")), F.lit(float("nan"))) for c in used])
        told = clean.withColumn("__filled", F.pandas_udf(filled, "array<double>")(cells))
        return told.withColumns({c: F.coalesce(c, F.col("__filled")[used.index(c)]) for c in self.cols if c in used}).drop("__filled")


def fit_chained(train: DataFrame, cols, predictors=(), max_rounds: int = 20, tol: float = 1e-3, max_cells: int = MAX_CELLS) -> Chained:
    """Regressions that fill the gaps of ``cols`` from each other and from ``predictors``.

    Gaps start at their column's mean.  A round regresses every column, fewest gaps first, on all others
    over the rows where it was observed, and fills its gaps at once.  Rounds end when no cell moves by
    ``tol`` of the greatest observed magnitude, or after ``max_rounds``.  Null, NaN and infinite cells are
    gaps; gaps of predictors stay at the mean.  Columns without a finite value take no part.
    """
    cols = list(cols)
    others = [p for p in predictors if p not in cols]
    rows = train.select(*[nonfinite_to_null(F.col(c).cast("double")).alias(c) for c in [*cols, *others]])
    seen = rows.agg(*[F.struct(F.avg(c).alias("mean"), F.count(c).alias("n"), F.max(F.abs(c)).alias("most")).alias(c) for c in rows.columns]).first()
    means = {c: seen[c]["mean"] for c in rows.columns}
    filled = [c for c in cols if means[c] is not None]
    used = filled + [c for c in others if means[c] is not None]
    if not filled:
        return Chained(cols, others, means, [], 0)
    order = sorted(range(len(filled)), key=lambda i: (-seen[filled[i]]["n"], i))
    least = tol * max(seen[c]["most"] for c in used)
    d, gaps, size = len(used), len(filled), (len(used) + 1) ** 2

    state = stored(rows.select(F.array(*[F.coalesce(F.col(c) - F.lit(means[c]), F.lit(0.0)) for c in used]).alias("x"),
                               F.array(*[F.col(c).isNull() for c in filled]).alias("gap")), "chained")
    bound = max_cells // size
    patterns = state.select("gap").distinct().limit(bound + 1).count()
    held = patterns <= bound

    def products(df, steps, target=None):
        """``{pattern: products}`` of the rows after ``steps``; of one sum over rows that hold ``target``, if given."""
        def run(batches):
            sums = {}

            def told():
                return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array([s.reshape(-1) for s in sums.values()], pa.list_(pa.float64()))], ["key", "s"])

            for b in batches:
                x, gap = _arrays(b, d, gaps)
                _fill(x, gap, steps)
                if target is not None:
                    x, gap = x[~gap[:, target]], np.zeros((int((~gap[:, target]).sum()), gaps), bool)
                z = np.column_stack([np.ones(len(x)), x])
                keys, which = np.unique(np.packbits(gap, axis=1), axis=0, return_inverse=True)
                for i, key in enumerate(keys):
                    part = z[which.reshape(-1) == i]
                    sums[key.tobytes()] = sums.get(key.tobytes(), 0.0) + part.T @ part
                if len(sums) * size > max_cells:
                    yield told()
                    sums.clear()
            yield told()

        found = df.select("x", "gap").mapInArrow(run, "key binary, s array<double>").groupBy("key").agg(Summarizer.sum(array_to_vector("s")).alias("s"))
        return {bytes(r["key"]): np.array(r["s"]).reshape(d + 1, d + 1) for r in found.select("key", vector_to_array("s").alias("s")).collect()}   # at most the bound

    def advance(df, steps):
        """The rows after ``steps``, stored, and how far the cell that moved most did."""
        def run(batches):
            for b in batches:
                x, gap = _arrays(b, d, gaps)
                was = x.copy()
                _fill(x, gap, steps)
                change = np.abs(x - was).max(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), b.column(1), pa.array(change)], ["x", "gap", "change"])

        after = stored(df.select("x", "gap").mapInArrow(run, "x array<double>, gap array<boolean>, change double"), "chained")
        return after, after.agg(F.max("change")).first()[0]

    sums = products(state, []) if held else {}
    missing = {key: np.unpackbits(np.frombuffer(key, np.uint8))[:gaps].astype(bool) for key in sums}
    rounds = []
    for _ in range(max_rounds):
        steps = []
        for target in order:
            if held:
                observed = sum(s for key, s in sums.items() if not missing[key][target])
            else:
                observed = sum(products(state, steps, target).values())
            coef, intercept = evidence_ridge(observed, target)
            steps.append((target, coef, intercept))
            for key, s in sums.items():
                if missing[key][target]:
                    sums[key] = _moved(s, target, coef, intercept)
        rounds.append(steps)
        state, change = advance(state, steps)
        if change < least or change == 0:
            break
    return Chained(cols, others, means, rounds, patterns if held else 0)
