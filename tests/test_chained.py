"""Chained Bayesian ridge imputation against regressions over the rows themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators.chained import evidence_ridge, fit_chained
from tabforge.operators.models import mice_impute


def brute_ridge(x, y):
    """Weights and intercept by solving the regularised normal equations row by row, precisions by the same rule."""
    mx, my = x.mean(axis=0), y.mean()
    a, b = x - mx, y - my
    noise, weight, before = 1 / (b.var() + np.finfo(float).eps), 1.0, None
    solve = lambda: np.linalg.solve(weight / noise * np.eye(x.shape[1]) + a.T @ a, a.T @ b)
    for _ in range(300):
        w = solve()
        cover = np.linalg.inv(weight * np.eye(x.shape[1]) + noise * a.T @ a)
        known = x.shape[1] - weight * np.trace(cover)
        weight, noise = (known + 2e-6) / (w @ w + 2e-6), (len(y) - known + 2e-6) / (((b - a @ w) ** 2).sum() + 2e-6)
        if before is not None and np.abs(w - before).sum() < 1e-3:
            break
        before = w
    w = solve()
    return w, my - w @ mx


def brute_chain(x, n_cols, fitted=None, rounds=20, tol=1e-3):
    """Row-wise chained imputation; with ``fitted`` the regressions of another table are applied."""
    gap = np.isnan(x)
    mean = fitted[0] if fitted else np.nanmean(x, axis=0)
    most = np.nanmax(np.abs(x))
    cur = np.where(gap, mean, x)
    gap = gap[:, :n_cols]
    order = sorted(range(n_cols), key=lambda i: (gap[:, i].sum(), i))
    made = []
    for _ in range(rounds if fitted is None else len(fitted[1])):
        was, steps = cur.copy(), []
        for step in (order if fitted is None else fitted[1][len(made)]):
            c, model = (step, None) if fitted is None else step
            rest = [i for i in range(x.shape[1]) if i != c]
            w, b = model or brute_ridge(cur[~gap[:, c]][:, rest], cur[~gap[:, c], c])
            cur[gap[:, c], c] = cur[gap[:, c]][:, rest] @ w + b
            steps.append((c, (w, b)))
        made.append(steps)
        if fitted is None and np.abs(cur - was).max() < tol * most:
            break
    return cur, (mean, made)


def table(spark, x, names, parts=3):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in names)).repartition(parts)


def sample(n=160, d=6, share=0.2, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) @ rng.normal(size=(3, d)) + 0.2 * rng.normal(size=(n, d)) + np.arange(d) * 40
    x[:, 1] *= 100
    x[rng.random((n, d)) < share * np.arange(d)[::-1] / d] = np.nan   # the last column has no gap
    return x


@pytest.mark.parametrize("cells", [4_000_000, 0])
def test_equals_row_wise_chain(spark, cells):
    x, y, names = sample(), sample(50, seed=4), list("abcdef")
    want, fitted = brute_chain(x, 5)
    model = fit_chained(table(spark, x, names), names[:5], names[5:], max_cells=cells)
    assert len(model.rounds) == len(fitted[1]) > 1 and (model.patterns > 10) == (cells > 0)
    for df, told in ((x, want), (y, brute_chain(y, 5, fitted)[0])):
        got = {r.id: [r[c] for c in names] for r in model.transform(table(spark, df, names)).collect()}
        assert np.allclose([got[i] for i in range(len(df))], told, rtol=1e-6, atol=1e-6 * np.abs(told).max())


def test_evidence_ridge_of_flat_and_scaled_columns():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(90, 4))
    x[:, 2] = 7.0
    x[:, 3] = 1e5 * x[:, 0] + rng.normal(size=90)
    z = np.column_stack([np.ones(90), x])
    for target in (0, 2, 3):
        rest = [i for i in range(4) if i != target]
        coef, intercept = evidence_ridge(z.T @ z, target)
        w, b = brute_ridge(x[:, rest], x[:, target])
        assert coef[target] == 0 and np.allclose(x @ coef + intercept, x[:, rest] @ w + b, rtol=1e-5, atol=1e-6 * np.abs(x[:, target]).max())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1.0, 2.0, None, "k"), (2, 2.0, None, None, "k"), (3, nan, 6.0, nan, None), (4, 4.0, inf, None, "k"), (5, 5.0, 10.0, None, "k"), (5, 5.0, 10.0, None, "k")]
    df = spark.createDataFrame(rows, "id int, a double, b double, void double, __filled_of string")
    filled, test, rounds = mice_impute(df, ["a", "b", "void"], apply_to=df.limit(0))
    out = sorted(filled.collect())
    assert filled.columns == df.columns and len(out) == 6 and rounds >= 1 and test.count() == 0
    assert [r.void for r in out] == [None] * 6 and out[0][:3] == (1, 1.0, 2.0)   # no finite value: left null
    assert all(v == round(v) for r in out for v in (r.a, r.b))   # whole columns stay whole
    assert out[2].a in (3.0, 2.0, 4.0) and abs(out[3].b - 8) <= 1
    none, _, rounds = mice_impute(df.limit(0), ["a", "b"])
    assert none.count() == 0 and rounds == 0
    only, _, _ = mice_impute(df.withColumn("a", F.lit(None).cast("double")).limit(1), ["a"])
    assert [r.a for r in only.collect()] == [None]
