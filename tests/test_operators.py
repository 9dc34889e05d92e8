"""Operators against brute-force answers on small fixtures."""

import itertools
import math
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.operators import impute as I
from tabforge.operators import lookup as J
from tabforge.operators import metrics as M
from tabforge.operators import ordered as OR
from tabforge.operators import quality as D
from tabforge.operators import ranking as W
from tabforge.operators import split as G


def test_mode_ties_and_unseen(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 1.0), ("b", None), (None, 3.0),
                                ("c", 5.0)], "g string, v double")
    modes = {r["g"]: r["v_mode"] for r in I.mode_by_group(df, "g", "v").collect()}
    assert modes == {"a": 1.0, "c": 5.0}          # tie -> smallest, all-null group and null key absent
    target = spark.createDataFrame([("a", None), ("b", None), ("z", None), ("c", 7.0)], "g string, v double")
    out = {r["g"]: r["v"] for r in I.mode_impute_by(target, "v", "g", fit_df=df).collect()}
    assert out["a"] == 1.0 and out["c"] == 7.0
    assert out["b"] == out["z"] == 2.0            # no mode -> median of the fitting rows, filled
    chain = I.mode_impute_chain(spark.createDataFrame([("k", 9.0), ("k", None)], "g string, v double"), [("v", "g")],
                                fit_df=spark.createDataFrame([("k", 1.0)], "g string, v double"))
    assert sorted(r["v"] for r in chain.collect()) == [1.0, 9.0]


def test_nearest_key_join_matches_brute_force(spark):
    rnd = random.Random(7)
    keys = sorted(set(rnd.randint(0, 500) for _ in range(60)))
    lk = spark.createDataFrame([(float(k), f"m{k}") for k in keys], "k double, v string")
    refs = [rnd.uniform(-50, 550) for _ in range(300)] + [float(keys[3]), float((keys[4] + keys[5]) / 2)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(refs)], "i int, x double")
    got = {r["i"]: r["v_nearest"] for r in J.nearest_key_join(df, "x", lk, "k", "v", n_buckets=8).collect()}
    for i, x in enumerate(refs):
        best = min(keys, key=lambda k: (abs(k - x), k))
        assert got[i] == f"m{best}", (x, got[i], best)


def test_bucketed_rank_is_exact(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("p"))
    h = df.withColumn("h", G.salted_hash(F.col("id")))
    got = G.bucketed_rank(h, "h", ["p"], ["id"]).select("id", "p", "h", "__rank").toPandas()
    got = got.sort_values(["p", "h", "id"])
    expect = got.groupby("p").cumcount()
    assert (got["__rank"].values == expect.values).all()


def test_average_rank_matches_pandas(spark):
    rnd = random.Random(3)
    vals = [float(rnd.randint(0, 40)) for _ in range(2000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = OR.average_rank(df, "x").orderBy("i").toPandas()["rank"].values
    assert (got == pd.Series(vals).rank(method="average").values).all()


def test_group_split_properties(spark):
    from tabforge.sources.fixtures import listings
    df = listings(spark, "/root/testdata/sf0.001")
    tagged = G.split_column(df, "host_id", "id")
    per_host = tagged.groupBy(F.coalesce("host_id", F.lit(-1)).alias("g")).agg(F.countDistinct("split").alias("k"))
    assert per_host.filter("k > 1").count() == 0
    n_groups = per_host.count()
    test_groups = tagged.filter("split = 'test'").select(F.coalesce("host_id", F.lit(-1))).distinct().count()
    assert test_groups == math.ceil(0.2 * n_groups)


def test_fold_sizes_within_one(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") % 7 == 0, "a").otherwise("b").alias("y"))
    folds = G.stratified_folds(df, "y", "id", 5).groupBy("y", "fold").count().toPandas()
    for _, g in folds.groupby("y"):
        assert g["count"].max() - g["count"].min() <= 1 and len(g) == 5


def _auc_brute(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_edge_cases(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(400):
        lab = rnd.choice(M.CLASSES)
        raw = [rnd.randint(1, 5) for _ in M.CLASSES]
        s = sum(raw)
        rows.append((i, lab, *[r / s for r in raw]))
    df = spark.createDataFrame(rows, "row_id int, label string, p_high double, p_low double, p_mid double, p_zero double")
    got = {r["cls"]: r["auc"] for r in M.roc_auc_per_class(df).collect()}
    for j, c in enumerate(M.CLASSES):
        exp = _auc_brute([r[2 + j] for r in rows], [r[1] == c for r in rows])
        assert abs(got[c] - exp) < 1e-12
    tied = df.select("row_id", "label", *[F.lit(0.25).alias(f"p_{c}") for c in M.CLASSES])
    assert all(abs(r["auc"] - 0.5) < 1e-12 for r in M.roc_auc_per_class(tied).collect())
    perfect = df.select("row_id", "label", *[(F.col("label") == c).cast("double").alias(f"p_{c}") for c in M.CLASSES])
    assert all(abs(r["auc"] - 1.0) < 1e-12 for r in M.roc_auc_per_class(perfect).collect())


def test_avg_rank_ties(spark):
    t = spark.createDataFrame([("a", "m", 1.0), ("b", "m", 1.0), ("c", "m", 0.5), ("d", "m", 0.0), ("e", "m", 0.0)],
                              "feature string, metric string, v double")
    got = {r["feature"]: r["rank_avg"] for r in W.avg_rank(t, "feature", "metric", "v").collect()}
    assert got == {"a": 1.5, "b": 1.5, "c": 3.0, "d": 4.5, "e": 4.5}


def test_dedup_first_keeps_ordered_first(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 1, "y"), (None, 2, "z"), (None, 1, "w")], "k int, o int, v string")
    got = {r["k"]: r["v"] for r in D.dedup_first(df, "k", ["o"]).collect()}
    assert got == {1: "y", None: "w"}
    cnt = D.duplicate_count(df, "k").first()
    assert cnt["duplicates"] == 2 and cnt["null_keys"] == 2


def test_soft_vote_probabilities_sum_to_one(spark):
    from tabforge.sources.fixtures import SCORE_PARAMS_B, predictions
    a, b = predictions(spark, "/root/testdata/sf0.001"), predictions(spark, "/root/testdata/sf0.001", SCORE_PARAMS_B)
    v = M.soft_vote([a, b])
    s = v.select((F.col("p_high") + F.col("p_low") + F.col("p_mid") + F.col("p_zero")).alias("s"))
    assert s.agg(F.max(F.abs(F.col("s") - 1))).first()[0] < 1e-12


def test_splits_and_folds_keep_null_keys(spark):
    df = spark.createDataFrame([(i if i % 5 else None, "a" if i % 3 else None, i % 7) for i in range(60)], "id long, label string, g int")
    train, test = G.random_split(df, "id", 0.2)
    assert train.count() + test.count() == 60
    assert df.select("id").distinct().count() * 0.2 <= test.select("id").distinct().count() < df.select("id").distinct().count() * 0.2 + 1
    folds = G.stratified_folds(df, "label", "id", 4)
    assert folds.count() == 60 and {r["label"] for r in folds.collect()} == {"a", None}
    for rows in (train, test):
        assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()


def test_hash_cut_is_the_kth_hash(spark):
    import hashlib
    import math
    df = spark.createDataFrame([(i,) for i in range(333)] * 2, "id long")
    hashes = sorted(hashlib.md5(f"42{i}".encode()).hexdigest() for i in range(333))
    for fraction in (0.0, 0.01, 0.2, 1.0):
        k = math.ceil(fraction * 333)
        assert G.hash_cut(df, "id", fraction) == (hashes[k - 1] if k else "")


def test_average_rank_with_null_partitions(spark):
    from tabforge.operators.ordered import average_rank
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 2.0), ("a", 5.0), ("a", None)], "p string, x double")
    got = sorted((r["p"] or "", r["x"] or 0.0, r["rank"]) for r in average_rank(df, "x", ["p"]).collect() if r["rank"] is not None)
    assert got == [("", 1.0, 1.0), ("", 2.0, 2.5), ("", 2.0, 2.5), ("a", 5.0, 1.0)]


def test_threshold_grid_in_any_order(spark):
    from tabforge.operators import metrics as M
    rnd = random.Random(5)
    rows = []
    for i in range(200):
        p = [rnd.random() for _ in range(4)]
        rows.append((i, rnd.choice(["zero", "low", "mid", "high"]), "low", *[x / sum(p) for x in p]))
    pred = spark.createDataFrame(rows, "row_id int, label string, pred string, p_zero double, p_low double, p_mid double, p_high double")
    score = lambda t, m: sorted(map(tuple, M.threshold_grid_scores(pred, t, m).collect()))
    assert score([0.2, 0.3, 0.4], [0.0, 0.05, 0.1]) == score([0.4, 0.2, 0.3], [0.1, 0.0, 0.05])


def test_anova_keeps_its_digits(spark):
    from tabforge.operators import eda as E
    rows = [("a" if i % 2 else "b", 1e9 + (i % 2) + 0.001 * (i % 10)) for i in range(100)]
    got = E.anova_f(spark.createDataFrame(rows, "y string, x double"), "y", ["x"]).first()["f_stat"]
    near = E.anova_f(spark.createDataFrame([(y, x - 1e9) for y, x in rows], "y string, x double"), "y", ["x"]).first()["f_stat"]
    assert got == pytest.approx(near, rel=1e-3)


def test_null_pairs_of_independent_columns_match_brute_force(spark):
    import itertools
    import random

    from tabforge.operators import eda as E
    rng = random.Random(4)
    cols = [f"c{i}" for i in range(40)]   # nearly every row has a null pattern of its own
    rows = [tuple(None if rng.random() < 0.3 else 1 for _ in cols) for _ in range(500)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in cols)).repartition(5)
    got = {(r.col_a, r.col_b): (r.n, r.na, r.nb, r.nab) for r in E.null_pair_table(df).collect()}
    null = lambda r, i: r[i] is None
    assert got == {(cols[i], cols[j]): (500, sum(null(r, i) for r in rows), sum(null(r, j) for r in rows), sum(null(r, i) and null(r, j) for r in rows))
                   for i, j in itertools.combinations(range(40), 2)}
    assert {r.n for r in E.null_pair_table(df.limit(0), ["c0", "c1"]).collect()} == {0}


def test_dummy_correlation_keeps_its_digits(spark):
    import numpy as np

    from tabforge.operators import eda as E
    rng = np.random.default_rng(3)
    level, y = rng.integers(0, 3, 4000), rng.normal(1e8, 1, 4000)   # the mean is far larger than the spread
    y += level
    df = spark.createDataFrame([("abc"[k], float(v)) for k, v in zip(level, y)], "g string, y double")
    got = {r.feature: r["corr"] for r in E.feature_target_corr(df, "y", [], ["g"], scale=1.0).collect()}
    for k, name in ((1, "g_b"), (2, "g_c")):
        assert abs(got[name] - np.corrcoef(level == k, y)[0, 1]) < 1e-6


def test_driver_levels_report_what_is_left_out(spark):
    from tabforge.operators import eda as E
    df = spark.createDataFrame([(f"v{i}", "ab"[i % 2], None, None if i % 5 == 0 else i) for i in range(60)], "many string, few string, none string, x int")
    got = {r.column_name: (r.levels, r.used) for r in E.driver_levels(df).collect()}
    assert got == {"many": (60, False), "few": (2, True), "none": (0, False)}
    assert E.driver_levels(df, max_levels=None).where("used").count() == 2
    assert {r.column_name: r.driver for r in E.missingness_mechanism(df, max_levels=None).collect()}["x"].startswith("many")


def test_nearest_lookup_moves_no_rows(spark):
    """A value held by most rows is looked up where the rows are, not sent to one task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select("id", F.when(F.col("id") < 990, 2.4).when(F.col("id") < 999, 7.0).alias("x"))
        keys = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (8.0, "c")], "k double, v string")
        out = J.nearest_key_join(df, "x", keys, "k", "v")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan.splitlines()[2]   # the join of the rows, below their projection
        assert {(r["x"], r["v_nearest"]): r["count"] for r in out.groupBy("x", "v_nearest").count().collect()} == {(2.4, "b"): 990, (7.0, "c"): 9, (None, None): 1}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_nearest_lookup_over_many_values(spark):
    """Ten thousands of values without a key between them take one step each, in both directions."""
    df = spark.range(60_000).select("id", (F.col("id") * 1.0).alias("x")).repartition(2)
    keys = spark.createDataFrame([(-5.0, "a"), (80_000.0, "b")], "k double, v string")
    begun = time.monotonic()
    out = J.nearest_key_join(df, "x", keys, "k", "v", n_buckets=2).groupBy("v_nearest").agg(F.count("*").alias("n"), F.max("x").alias("top")).collect()
    assert {r["v_nearest"]: (r["n"], r["top"]) for r in out} == {"a": (39_998, 39_997.0), "b": (20_002, 59_999.0)}
    assert time.monotonic() - begun < 25   # about 60,000 squared steps before


def test_numbers_are_coerced_as_their_text_is(spark):
    from tabforge.functions.scalars import numeric_coerce
    from tabforge.operators import eda as E
    df = spark.createDataFrame([(x, i, f"a{i}b-{i}", True) for i, x in enumerate([0.0, -0.0, 1e-4, 1e-3, 12.5, -9999999.0, 1e7, 1e300, float("nan"), float("inf"), None])],
                               "x double, i long, s string, t boolean").withColumn("d", F.current_date())
    out = df.select(*[F.struct(numeric_coerce(c).cast("string"), E._as_number(df, c).cast("string")).alias(c) for c in df.columns]).collect()
    assert all(a == b for r in out for a, b in r)


def test_missingness_reads_its_input_once(spark):
    from tabforge.operators import eda as E
    seen = spark.sparkContext.accumulator(0)

    def counted(parts):
        for d in parts:
            seen.add(len(d))
            yield d

    rows = [(None if i % 4 == 0 else float(i % 9), "a" if i % 4 == 0 else "b", f"t{i}", str(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, g string, wide string, number string")
    out = {r["column_name"]: r for r in E.missingness_mechanism(df.mapInPandas(counted, df.schema)).collect()}
    assert seen.value == 200
    assert set(out) == {"x"} and out["x"]["driver"].startswith("g ") and out["x"]["missing"] == 50
    levels = spark.createDataFrame([(f"v{i % 31}", f"v{i % 30}", None, f"v{i}") for i in range(400)], "a string, b string, c string, d string")
    assert E._used_columns(levels, {c: c.upper() for c in levels.columns}, 30) == {"B"}
    assert E._used_columns(levels, {c: c.upper() for c in levels.columns}, None) == {"A", "B", "D"}


def test_large_tables_come_in_even_parts(spark, monkeypatch):
    from tabforge import session
    parts = 2 * spark.sparkContext.defaultParallelism
    df = spark.range(100 * parts).coalesce(1)
    assert session.spread(df, "id").rdd.getNumPartitions() == 1
    monkeypatch.setattr(session, "SPREAD_ROWS", 100)
    sizes = session.spread(df, "id").rdd.glom().map(len).collect()
    assert len(sizes) == parts and sum(sizes) == 100 * parts and max(sizes) < 200


def test_encoder_medians_are_exact_and_skip_nan(spark, monkeypatch):
    """One row, not every value, reaches Spark's own imputer."""
    from pyspark.ml.feature import Imputer

    from tabforge.operators import models as K
    rows = [(float(i % 40) if i % 7 else float("nan"), i if i % 5 else None, i % 2, "ab"[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, n int, flag int, y string").repartition(4)
    plain = Imputer(strategy="median", inputCols=["x", "n", "flag"], outputCols=["a", "b", "c"], relativeError=1e-4).fit(df).surrogateDF.first()
    fitted, seen = Imputer._fit, []
    monkeypatch.setattr(Imputer, "_fit", lambda self, d: seen.append(d.count()) or fitted(self, d))
    stages = K.fit_encoder(df, "y", ["x", "n", "flag"], []).model.stages
    assert stages[0].surrogateDF.first() == plain and seen == [1]


def test_runs_read_stored_listings(spark, monkeypatch):
    """The listings are derived once for all runs of the comparison."""
    from tabforge.plans import catalog_metrics as CM
    from tabforge.sources import fixtures
    derived, listings = [], fixtures.listings
    for module in (CM, fixtures):
        monkeypatch.setattr(module, "listings", lambda *a: derived.append(1) or listings(*a))
    runs = CM._run_predictions(spark, "/root/testdata/sf0.001")
    assert len(derived) == 1 and len(runs) == 3
    assert not any("lineitem" in pred._jdf.queryExecution().toString() for _, _, pred in runs)


def test_wide_plans_are_not_one_huge_method(spark):
    from tabforge.session import TUNED
    from tabforge.sources.fixtures import table
    for name in TUNED:
        spark.conf.unset(name)
    table(spark, "/root/testdata/sf0.001", "nation")
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "9000")   # a caller's own value is kept
    table(spark, "/root/testdata/sf0.001", "nation")
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "9000"
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
