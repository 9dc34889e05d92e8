"""Scores of one-hot levels and numeric columns from counted points, against the same scores of materialised 0/1 columns."""

import numpy as np
import pytest
from pandas import Series
from pyspark.sql import functions as F

from tabforge.operators import eda as E
from tabforge.operators.expanded import feature_scores
from tabforge.operators.neighbours import knn_mutual_information
from tabforge.operators.ordered import rank_correlation, ranges_for

CLASSES = ["zero", "low", "mid", "high"]


def sample(spark, n=300):
    rng = np.random.default_rng(2)
    y = rng.choice(CLASSES, n, p=[0.4, 0.3, 0.25, 0.05])
    kind = np.where(rng.random(n) < 0.5, y, rng.choice(["a", "b", "rare"], n, p=[0.7, 0.29, 0.01]))
    rows = [(str(y[i]), float(np.round(rng.normal(CLASSES.index(y[i])), 1)), None if i % 11 == 0 else float(i % 3), None if i % 7 == 0 else str(kind[i]), "one") for i in range(n)]
    rows += [(None, 1.0, 1.0, "a", "one"), ("other", 1.0, 1.0, "lost", "one"), ("low", float("nan"), None, None, None)]
    return spark.createDataFrame(rows, "y string, num double, third double, kind string, same string").repartition(3)


def test_scores_equal_those_of_dummy_columns(spark):
    df = sample(spark)
    got = {r.feature: (r.f, r.mi, r.spearman) for r in feature_scores(df, "y", CLASSES, ["num", "third"], ["kind", "same"]).collect()}
    known = df.where(F.col("y").isin(CLASSES))
    levels = sorted({r.kind for r in known.collect() if r.kind is not None})
    assert set(got) == {"num", "third", "same=one", *(f"kind={v}" for v in levels)} and "kind=lost" not in got
    wide = known.withColumn("num", F.nanvl("num", F.lit(None).cast("double"))).withColumns({f"kind={v}": (F.col("kind") == v).cast("double") for v in levels}).withColumn("same=one", F.when(F.col("same") == "one", 1.0))
    wide = wide.withColumn("t", F.element_at(F.create_map(*[v for i, c in enumerate(CLASSES) for v in (F.lit(c), F.lit(i))]), F.col("y")))
    names = list(got)
    f = {r.feature: r.f_stat for r in E.anova_f(wide, "y", names).collect()}
    mi = {r.feature: r.mi for r in knn_mutual_information(wide, "y", names).collect()}
    pandas = wide.select("t", *[F.col(f"`{c}`") for c in names]).toPandas()
    for c in names:
        rho = pandas[[c, "t"]].dropna().rank().corr().iloc[0, 1]
        assert got[c] == (pytest.approx(f[c], rel=1e-9), pytest.approx(mi[c], abs=1e-9), pytest.approx(0.0 if np.isnan(rho) else abs(rho), abs=1e-9)), c
    assert got["same=one"] == (0.0, pytest.approx(0, abs=1e-9), 0.0)


def test_edges(spark):
    df = sample(spark)
    assert feature_scores(df.limit(0), "y", CLASSES, ["num"], ["kind"]).count() == 0
    single = feature_scores(df.where("y = 'low'"), "y", CLASSES, ["num"], ["kind"]).collect()
    assert single and all(r.f == 0 and r.spearman == 0 for r in single)
    with pytest.raises(ValueError):
        feature_scores(df, "y", CLASSES)


def test_rank_correlation_of_hot_and_tied_pairs(spark):
    rng = np.random.default_rng(4)
    x = np.where(rng.random(500) < 0.4, 3, rng.integers(0, 60, 500))
    t = np.round(x / 7 + rng.normal(size=500), 1)
    rows = spark.createDataFrame([("a", float(u), float(v)) for u, v in zip(x, t)] + [("b", 1.0, 2.0), ("b", 1.0, 3.0)], "feature string, x double, t double")
    got = {r.feature: r.rho for r in rank_correlation(rows.groupBy("feature", "x", "t").agg(F.count(F.lit(1)).alias("n"))).collect()}
    assert got == {"a": pytest.approx(Series(x).rank().corr(Series(t).rank()), abs=1e-12), "b": None}
    assert (ranges_for(0), ranges_for(10**6), ranges_for(10**12)) == (8, 20, 4096)
