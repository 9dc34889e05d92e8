"""Exact quantiles by narrowing brackets, against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import quantiles as Q

PROBS = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]


def want(values, p):
    values = sorted(v for v in values if v is not None)
    return float(np.quantile(values, p)) if values else None


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        rows.append((rng.choice(["a", "b", None]) if i % 3 else "hot", None if i % 7 == 0 else float(rng.choice([0, 0, 0, 1, 5])), rng.gauss(0, 1) if i % 2 else rng.gauss(0, 1e9), None))
    return rows, spark.createDataFrame(rows, "g string, ties double, wide double, none double").repartition(6)


@pytest.mark.parametrize("accuracy,most", [(1000, 50_000), (20, 5)])
def test_columns(skewed, accuracy, most):
    rows, df = skewed
    got = Q.quantiles(df, ["ties", "wide", "none"], PROBS, accuracy=accuracy, most=most)
    for j, c in ((1, "ties"), (2, "wide"), (3, "none")):
        for p, x in zip(PROBS, got[c]):
            w = want([r[j] for r in rows], p)
            assert (x is None) == (w is None) and (x is None or math.isclose(x, w, rel_tol=1e-12, abs_tol=1e-9)), (c, p)


@pytest.mark.parametrize("accuracy,most", [(1000, 50_000), (20, 60)])
@pytest.mark.parametrize("p", [0.5, 0.99])
def test_groups(skewed, accuracy, most, p):
    rows, df = skewed
    for j, c in ((1, "ties"), (2, "wide"), (3, "none")):
        got = {r["g"]: r["m"] for r in Q.group_quantile(df, ["g"], c, p, "m", accuracy, most).collect()}
        assert set(got) == {r[0] for r in rows}
        for g, x in got.items():
            w = want([r[j] for r in rows if r[0] == g], p)
            assert (x is None) == (w is None) and (x is None or math.isclose(x, w, rel_tol=1e-12, abs_tol=1e-9)), (c, g)


def test_same_as_percentile_and_no_percentile_in_the_plan(spark, skewed):
    _, df = skewed
    same = df.groupBy("g").agg(F.percentile("wide", 0.3).alias("m")).collect()
    found = Q.group_quantile(df, ["g"], "wide", 0.3, "m")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, same), key=str)
    assert "percentile(" not in found._jdf.queryExecution().toString()


def test_empty(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert Q.quantiles(df, ["x"], [0.5]) == {"x": [None]}
    assert Q.group_quantile(df, ["g"], "x").count() == 0


def test_one_value_at_the_rank_needs_no_count(spark, monkeypatch):
    df = spark.createDataFrame([(0.0, float(i)) for i in range(200)] + [(1.0, None)] * 20, "flag double, wide double")
    assert Q.quantiles(df, ["flag", "wide"], [0.5]) == {"flag": [0.0], "wide": [99.5]}

    def counted(*args):
        raise AssertionError("values were counted")

    monkeypatch.setattr(Q, "_pick", counted)
    assert Q.quantiles(df, ["flag"], [0.25, 0.5]) == {"flag": [0.0, 0.0]}


def test_flags_need_no_sketch(spark, monkeypatch):
    rows = [(i % 3 // 2, 7 if i % 5 else 8, None if i % 2 else 1, None) for i in range(101)]
    df = spark.createDataFrame(rows, "flag int, near short, some byte, none int").repartition(3)
    want_ = {c: [want([r[j] for r in rows], p) for p in PROBS] for j, c in enumerate(df.columns) if c != "none"}
    calls = []
    monkeypatch.setattr(F, "percentile_approx", lambda *a: calls.append(a))
    assert Q.quantiles(df.drop("none"), ["flag", "near", "some"], PROBS) == want_ and not calls
    monkeypatch.undo()
    assert Q.quantiles(df, df.columns, PROBS) == want_ | {"none": [None] * len(PROBS)}


def test_lower_of_two_middle_values(spark):
    df = spark.createDataFrame([(float(i), i, i % 2) for i in range(10)], "x double, n int, flag int")
    assert Q.quantiles(df, ["x", "n", "flag"], [0.5], lower=True) == {"x": [4.0], "n": [4.0], "flag": [0.0]}
    assert Q.quantiles(df, ["x", "n", "flag"], [0.5]) == {"x": [4.5], "n": [4.5], "flag": [0.5]}
