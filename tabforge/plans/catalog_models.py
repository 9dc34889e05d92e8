"""Registered queries for sources/sinks, the cleaning job, Spark ML training and scoring.

Sources and the cleaning job have DuckDB oracles; model fits are iterative
(rows-only checks) and are covered by invariants in the tests.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions import nulls as N
from tabforge.operators import eda as E
from tabforge.operators import metrics as M
from tabforge.operators import models as K
from tabforge.operators import neighbours as NB
from tabforge.operators import ranking as W
from tabforge.operators import split as G
from tabforge.operators import tokens as TK
from tabforge.operators.expanded import feature_scores
from tabforge.operators.store import Registry, Runs
from tabforge.operators.svd import truncated_svd
from tabforge.plans import cleaning, training
from tabforge.plans.bundle import Bundle
from tabforge.plans.catalog_quality import LEVEL_SQL, LISTING_COLS, SPLIT_CTES
from tabforge.plans.catalog_scalars import LIST_ITEMS_SQL, PRICE_DIGITS_SQL, with_listings
from tabforge.session import scratch_path, stored
from tabforge.sources import io as IO
from tabforge.sources.fixtures import listings
from tabforge.streaming.score import Served, explode_requests, read_request_lines, score_batch, score_stream

Q = {}
O = {}


def _r(df, cols, nd=9):
    return df.select(*[F.round(c, nd).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- S*
def q_read_listings(spark, sf):
    df = listings(spark, sf)
    path = IO.write_csv(df, scratch_path(spark, "listings-csv"))
    return IO.read_listings(spark, path, dict(df.dtypes))


_STRING_COLS = ["neighbourhood_cleansed", "neighbourhood", "host_neighbourhood", "room_type", "property_type", "price",
                "bathrooms_text", "host_is_superhost", "instant_bookable", "host_response_time", "host_response_rate",
                "has_availability", "amenities"]
O["read_listings"] = with_listings("SELECT " + ", ".join(
    (f"CASE WHEN {c} IS NULL OR trim({c}) IN ({N.sql_token_list()}) THEN NULL ELSE {c} END AS {c}"
     if c in _STRING_COLS else c) for c in LISTING_COLS) + " FROM listings"
).replace("listings AS (", "listings AS MATERIALIZED (", 1)   # same rows; avoids a DuckDB dictionary-cache fault


def q_read_requests(spark, sf):
    df = listings(spark, sf)
    path = IO.requests_from(df, scratch_path(spark, "requests"))
    return IO.read_requests(spark, path, id_col=None)


def _req_sql():
    have = {"host_since", "host_response_time", "host_response_rate", "host_is_superhost", "neighbourhood_cleansed",
            "property_type", "room_type", "accommodates", "bedrooms", "beds", "price", "has_availability",
            "availability_365", "number_of_reviews", "review_scores_rating", "reviews_per_month", "amenities"}
    sql_t = {"string": "VARCHAR", "long": "BIGINT", "double": "DOUBLE"}
    cols = []
    for n, t, d in IO.REQUEST_FIELDS:
        lit = f"'{d}'" if t == "string" else repr(d)
        if n in have:
            cols.append(f"coalesce(CAST({n} AS {sql_t[t]}), CAST({lit} AS {sql_t[t]})) AS {n}")
        else:
            cols.append(f"CAST({lit} AS {sql_t[t]}) AS {n}")
    return with_listings("SELECT " + ", ".join(cols) + " FROM listings")


O["read_requests"] = _req_sql()


def _pipeline(spark, sf):
    return cleaning.run(listings(spark, sf))


def q_write_splits(spark, sf):
    train, test, _ = _pipeline(spark, sf)
    paths = cleaning.write_splits(train, test, scratch_path(spark, "splits"))
    tr = spark.read.parquet(paths["train"]).withColumn("split", F.lit("train"))
    te = spark.read.parquet(paths["test"]).withColumn("split", F.lit("test"))
    cols = ["id", "split", "occupancy_level", "price_imputed", "price_was_missing", "price_per_person", "amenities_count"]
    return _r(tr.unionByName(te).select(*cols), ["price_imputed", "price_per_person"])


_PIPE_CTES = (
    *SPLIT_CTES,
    f"sp AS (SELECT split.*, {PRICE_DIGITS_SQL} AS price_clean FROM split)",
    "tr AS (SELECT * FROM sp WHERE split = 'train')",
    "pm AS (SELECT neighbourhood_cleansed, room_type, median(price_clean) AS m FROM tr GROUP BY ALL"
    " HAVING median(price_clean) IS NOT NULL)",
    "nm AS (SELECT neighbourhood_cleansed, median(price_clean) AS m FROM tr GROUP BY ALL"
    " HAVING median(price_clean) IS NOT NULL)",
    "pi AS (SELECT s.*, coalesce(s.price_clean, pm.m, nm.m, (SELECT median(price_clean) FROM tr)) AS price_imputed"
    " FROM sp s LEFT JOIN pm ON s.neighbourhood_cleansed = pm.neighbourhood_cleansed AND s.room_type = pm.room_type"
    " LEFT JOIN nm ON s.neighbourhood_cleansed = nm.neighbourhood_cleansed)",
    "pp AS (SELECT pi.*, price_imputed / CASE WHEN accommodates IS NULL OR accommodates = 0 THEN 1.0 ELSE"
    " CAST(accommodates AS DOUBLE) END AS ppp FROM pi)",
    f"fin AS (SELECT pp.*, CASE WHEN amenities IS NULL THEN 0 ELSE CAST(len({LIST_ITEMS_SQL}) AS INTEGER) END AS"
    f" amenities_count, {LEVEL_SQL.format(x='estimated_occupancy_l365d')} AS occupancy_level FROM pp)",
)
O["write_splits"] = with_listings(
    "SELECT id, split, occupancy_level, round(price_imputed, 9) AS price_imputed, CAST(price_clean IS NULL AS INTEGER)"
    " AS price_was_missing, round(coalesce(ppp, (SELECT median(ppp) FROM pp WHERE split = 'train')), 9)"
    " AS price_per_person, amenities_count FROM fin", *_PIPE_CTES)


def q_run_manifest(spark, sf):
    train, test, _ = _pipeline(spark, sf)
    paths = cleaning.write_splits(train, test, scratch_path(spark, "splits"))
    return cleaning.run_manifest(spark, paths).select("split", "rows")


O["run_manifest"] = with_listings("SELECT split, count(*) AS rows FROM split GROUP BY split", *SPLIT_CTES)


def q_ensure_data(spark, sf):
    train, test, _ = _pipeline(spark, sf)
    paths = cleaning.write_splits(train, test, scratch_path(spark, "splits"))
    tr, te = cleaning.ensure_data(spark, paths)
    return (tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))
            .groupBy("split", "occupancy_level").agg(F.count(F.lit(1)).alias("n")))


O["ensure_data"] = with_listings(
    f"SELECT split, {LEVEL_SQL.format(x='estimated_occupancy_l365d')} AS occupancy_level, count(*) AS n FROM split"
    " GROUP BY ALL", *SPLIT_CTES)


# ---------------------------------------------------------------- E* with SQL oracles
def q_label_index(spark, sf):
    df = listings(spark, sf).select("id", G.occupancy_level("estimated_occupancy_l365d").alias("occupancy_level"))
    m = StringIndexer(inputCol="occupancy_level", outputCol="label_idx", stringOrderType="alphabetAsc").fit(df)
    return m.transform(df)


O["label_index"] = with_listings(
    f"SELECT id, occupancy_level, CAST(CASE occupancy_level WHEN 'high' THEN 0 WHEN 'low' THEN 1 WHEN 'mid' THEN 2"
    f" WHEN 'zero' THEN 3 END AS DOUBLE) AS label_idx FROM (SELECT id, {LEVEL_SQL.format(x='estimated_occupancy_l365d')}"
    " AS occupancy_level FROM listings)")

SCALE_COLS = ["accommodates", "bedrooms", "beds", "availability_365", "estimated_occupancy_l365d"]


def q_standard_scale(spark, sf):
    df = listings(spark, sf).select("id", *[F.col(c).cast("double").alias(c) for c in SCALE_COLS])
    return _r(K.standard_scale(df, SCALE_COLS), SCALE_COLS)


O["standard_scale"] = with_listings("SELECT id, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / stddev_pop(CAST({c} AS DOUBLE)) OVER (), 9)"
    f" AS {c}" for c in SCALE_COLS) + " FROM listings")

KBEST_COLS = ["accommodates", "bedrooms", "beds", "price", "availability_365", "number_of_reviews",
              "reviews_per_month", "review_scores_rating"]


def q_select_k_best(spark, sf):
    from tabforge.plans.catalog_eda import _scored
    mi = E.mutual_information(_scored(spark, sf), "occupancy_level", KBEST_COLS, 10)
    return TK.topk(mi.select("feature", F.round("mi", 9).alias("mi")), [F.col("mi").desc(), F.col("feature")], 5)


def _kbest_sql():
    from tabforge.plans.catalog_eda import SC_CTE
    sc = SC_CTE.replace("estimated_occupancy_l365d AS occ,", "estimated_occupancy_l365d AS occ, availability_365,"
                        " number_of_reviews, reviews_per_month, review_scores_rating,")
    body = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(sum(nxy / n * ln(nxy * n / (nx * ny))), 9) AS mi FROM (SELECT nxy, sum(nxy)"
        f" OVER () AS n, sum(nxy) OVER (PARTITION BY bin) AS nx, sum(nxy) OVER (PARTITION BY y) AS ny FROM (SELECT"
        f" CAST(least(floor((CAST({c} AS DOUBLE) - lo) / w), 9) AS INTEGER) AS bin, y, count(*) AS nxy FROM sc,"
        f" (SELECT min(CAST({c} AS DOUBLE)) AS lo, CASE WHEN max({c}) > min({c}) THEN (max(CAST({c} AS DOUBLE)) -"
        f" min(CAST({c} AS DOUBLE))) / 10 ELSE 1.0 END AS w FROM sc) WHERE {c} IS NOT NULL GROUP BY 1, 2))"
        for c in KBEST_COLS)
    return with_listings(f"SELECT feature, mi FROM ({body}) ORDER BY mi DESC, feature LIMIT 5", sc)


O["select_k_best"] = _kbest_sql()


def q_mutual_information_knn(spark, sf):
    from tabforge.plans.catalog_eda import _scored
    return NB.knn_mutual_information(_scored(spark, sf), "occupancy_level", KBEST_COLS).select("feature", F.round("mi", 7).alias("mi"))


def _psi_sql(n):   # by recurrence and series, as digamma is not a function there
    y = f"(CAST({n} AS DOUBLE) + 6)"
    return (f"(ln({y}) - 0.5 / {y} - 1 / (12 * {y} ** 2) + 1 / (120 * {y} ** 4) - 1 / (252 * {y} ** 6) + 1 / (240 * {y} ** 8) - "
            + " - ".join(f"1.0 / (CAST({n} AS DOUBLE) + {i})" for i in range(6)) + ")")


_KNN_MI = (f"SELECT feature, round(greatest(0.0, {_psi_sql('count(*)')} + avg({_psi_sql('k')} - {_psi_sql('ny')} - {_psi_sql('m')})), 7) AS mi"
           " FROM pts GROUP BY feature")


def _knn_ctes():
    """CTEs from ``cells`` (feature, y, x) to ``pts``, the neighbour counts of every cell."""
    gaps = ", ".join(f"abs(x - {step}(x, {i}) OVER c)" for step in ("lag", "lead") for i in (1, 2, 3))
    return (
        f"near AS (SELECT feature, y, x, count(*) OVER (PARTITION BY feature, y) AS ny, list_sort(list_filter([{gaps}], lambda d: d IS NOT NULL)) AS d FROM cells"
        " WINDOW c AS (PARTITION BY feature, y ORDER BY x))",
        "rad AS (SELECT *, least(3, ny - 1) AS k, d[least(3, ny - 1)] AS r FROM near WHERE ny > 1)",
        "ev AS (SELECT feature, v, sum(n) AS n FROM (SELECT feature, x AS v, 1 AS n FROM rad UNION ALL SELECT feature, x - r, 0 FROM rad UNION ALL"
        " SELECT feature, x + r, 0 FROM rad) GROUP BY feature, v)",
        "cum AS (SELECT feature, v, n, coalesce(sum(n) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ev)",
        "pts AS (SELECT t.feature, ny, CASE WHEN r = 0 THEN count(*) OVER (PARTITION BY t.feature, y, x) - 1 ELSE k END AS k,"
        " CASE WHEN r = 0 THEN lo.n ELSE hi.below - lo.below - lo.n END AS m FROM rad t JOIN cum lo ON lo.feature = t.feature AND lo.v = t.x - t.r"
        " JOIN cum hi ON hi.feature = t.feature AND hi.v = t.x + t.r)")


def _knn_sql():
    from tabforge.plans.catalog_eda import SC_CTE
    sc = SC_CTE.replace("estimated_occupancy_l365d AS occ,", "estimated_occupancy_l365d AS occ, availability_365,"
                        " number_of_reviews, reviews_per_month, review_scores_rating,")

    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, y, CAST({c} AS DOUBLE) AS x FROM sc WHERE {c} IS NOT NULL AND y IS NOT NULL" for c in KBEST_COLS)
    return with_listings(_KNN_MI, sc, f"cells AS ({rows})", *_knn_ctes())


O["mutual_information_knn"] = _knn_sql()


def q_select_k_best_applied(spark, sf):
    """Every row of both splits with its vector cut to the 20 best slots, and whether each value is that of its slot."""
    p = training.prepare(spark, sf)
    cut, _, taken = K.select_k_best(p.train)
    both = p.train.withColumn("split", F.lit("train")).unionByName(p.test.withColumn("split", F.lit("test")))
    from pyspark.ml.functions import vector_to_array
    whole = vector_to_array("features")
    return cut.transform(both).select("row_id", "split", F.size(vector_to_array("features_k")).alias("k"),
                                      (vector_to_array("features_k") == F.array(*[whole[i] for i in taken])).alias("same_values"))


O["select_k_best_applied"] = with_listings("SELECT id AS row_id, split, 20 AS k, true AS same_values FROM split", *SPLIT_CTES)


# ---------------------------------------------------------------- Spark ML (rows-only)
def q_encode_features(spark, sf):
    p = training.prepare(spark, sf)
    from pyspark.ml.functions import vector_to_array
    return p.train.select("row_id", "label", K.LABEL_IDX, F.size(vector_to_array("features")).alias("n_features"),
                          "weight")


def q_write_features(spark, sf):
    """The bundle written, loaded again, and the test split encoded by the loaded one."""
    p = training.prepare(spark, sf)
    path = Bundle(p.fit, p.enc, K.Classifier("vote", [])).save(spark, scratch_path(spark, "features"))
    again = Bundle.load(spark, path)
    from pyspark.ml.functions import vector_to_array
    # both encoders side by side on each row: no vectors are shuffled
    loaded = again.enc.transform(p.clean_test.where(F.col("id").isNotNull()).withColumn("__row", F.struct("*")))
    both = p.enc.transform(loaded.select("__row.*", F.col("features").alias("__loaded")), with_label=True)
    return both.select(F.col("id").alias("row_id"), F.col(cleaning.TARGET).alias("label"), K.LABEL_IDX,
                       (vector_to_array("features") == vector_to_array("__loaded")).alias("same_features"))


O["write_features"] = with_listings(
    f"SELECT id AS row_id, level AS label, CAST(CASE level WHEN 'high' THEN 0 WHEN 'low' THEN 1 WHEN 'mid' THEN 2 WHEN 'zero' THEN 3 END AS DOUBLE)"
    f" AS label_idx, true AS same_features FROM (SELECT id, {LEVEL_SQL.format(x='estimated_occupancy_l365d')} AS level FROM split WHERE split = 'test')",
    *SPLIT_CTES)


def _probable(spark, sf, fit):
    p = training.prepare(spark, sf)
    return _r(fit(p).predict(p.test, p.enc.classes, training.KEEP), [f"p_{c}" for c in M.CLASSES])


def q_logreg(spark, sf):
    return _probable(spark, sf, training.fit_logreg)


def q_random_forest(spark, sf):
    return _probable(spark, sf, training.fit_random_forest)


def q_gbt(spark, sf):
    return _probable(spark, sf, training.fit_gbt)


def q_mlp(spark, sf):
    return _probable(spark, sf, training.fit_mlp)


def q_pca_logreg(spark, sf):
    return _probable(spark, sf, training.fit_pca_logreg)


#: Models of the probability check: any classifier goes through the same steps.
_CHECKED = {"logreg": training.fit_logreg, "pca_logreg": training.fit_pca_logreg,
            "random_forest": lambda p: training.fit_random_forest(p, num_trees=30, max_depth=5),
            "gbt": lambda p: training.fit_gbt(p, max_iter=20)}


def q_probability_checks(spark, sf):
    """K1, K2, K3, K5, K6: every test row once per model, its label, probabilities in [0, 1] that sum to 1, and the most probable class chosen."""
    p = training.prepare(spark, sf)
    made = {name: fit(p) for name, fit in _CHECKED.items()}
    # the vote and its members in one pass: every model is applied to a row once
    rows = K.Classifier("vote", list(made.values())).with_probabilities(p.test, "__p", each=True)
    told = {**{name: f"__p_{i}" for i, name in enumerate(made)}, "ensemble": "__p"}
    each = rows.select(*training.KEEP, F.explode(F.array(*[F.struct(F.lit(name).alias("model_name"), F.col(c).alias("p")) for name, c in told.items()])).alias("m"))
    pred = K.predictions(each.select(*training.KEEP, "m.model_name", "m.p"), "p", p.enc.classes, ("model_name", *training.KEEP))
    cols = [F.col(f"p_{c}") for c in p.enc.classes]
    chosen = F.element_at(F.create_map(*[x for c in p.enc.classes for x in (F.lit(c), F.col(f"p_{c}"))]), F.col("pred"))
    return pred.select("model_name", "row_id", "label", (F.abs(sum(cols, F.lit(0.0)) - 1) < 1e-9).alias("sums_to_one"),
                       (F.least(*cols) >= 0).alias("none_below_zero"), (chosen == F.greatest(*cols)).alias("most_probable"))


O["probability_checks"] = with_listings(
    f"SELECT model_name, id AS row_id, {LEVEL_SQL.format(x='estimated_occupancy_l365d')} AS label, true AS sums_to_one, true AS none_below_zero,"
    " true AS most_probable FROM split, (VALUES ('logreg'), ('pca_logreg'), ('random_forest'), ('gbt'), ('ensemble')) m(model_name) WHERE split = 'test'",
    *SPLIT_CTES)


def q_pca_variance(spark, sf):
    p = training.prepare(spark, sf)
    _, ratios = K.pca_variance(p.train)
    df = spark.createDataFrame([(f"pc{i + 1:03d}", float(r)) for i, r in enumerate(ratios)],
                               "component string, ratio double")
    return W.cumulative_variance(df, "ratio")


def q_svd_reduce(spark, sf):
    """The test rows on the 50 greatest singular directions of the training rows (uncentred)."""
    p = training.prepare(spark, sf)
    return truncated_svd(p.train, 50).transform(p.test).select("row_id", F.transform("reduced", lambda v: F.round(v, 6)).alias("reduced"))


def q_svd_checks(spark, sf):
    """Every training row once, its 50 coordinates, and that none is longer than the row's own vector; over all rows the
    squares add up to the squared singular values."""
    p = training.prepare(spark, sf)
    svd = truncated_svd(p.train, 50)
    from pyspark.ml.functions import vector_to_array
    square = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, v: acc + v * v)
    rows = svd.transform(p.train).select("row_id", "reduced", square("reduced").alias("kept"), square(vector_to_array("features")).alias("all"))
    total, wanted = rows.agg(F.sum("kept")).first()[0], float((svd.s ** 2).sum())
    return rows.select("row_id", F.size("reduced").alias("k"), (F.col("kept") <= F.col("all") * (1 + 1e-9)).alias("not_longer"),
                                        F.lit(abs(total - wanted) <= 1e-6 * wanted).alias("squares_add_up"))


O["svd_checks"] = with_listings("SELECT id AS row_id, 50 AS k, true AS not_longer, true AS squares_add_up FROM split WHERE split = 'train'", *SPLIT_CTES)


def q_feature_ranking(spark, sf):
    """E5: ANOVA F, MI, |Spearman| and forest importance of every expanded feature, numeric or one-hot level -> min-max -> mean rank."""
    p = training.prepare(spark, sf)
    filled = p.clean_train.fillna(p.enc.cat_fill)
    scores = feature_scores(filled, cleaning.TARGET, G.LEVELS, p.enc.num_cols, p.enc.cat_cols).unpivot("feature", ["f", "mi", "spearman"], "metric", "value")
    imp = K.random_forest("weight", 400, min_leaf=2).fit(p.train).featureImportances.toArray()
    imp_df = spark.createDataFrame([(c, "rf", float(v)) for c, v in zip(p.enc.slot_names(), imp, strict=True) if c is not None],
                                   "feature string, metric string, value double")
    # A numeric feature without values has no scores: 0, as its importance.
    names = imp_df.select("feature", F.explode(F.array(*map(F.lit, ("f", "mi", "spearman")))).alias("metric"))
    table = names.join(scores, ["feature", "metric"], "left").select("feature", "metric", F.coalesce("value", F.lit(0.0)).alias("value")).unionByName(imp_df)
    norm = W.minmax_norm(table, "metric", "value")
    return W.avg_rank(norm, "feature", "metric", "norm").orderBy("rank_avg", "feature")


LEVEL_COLS = ["room_type", "property_type", "neighbourhood_cleansed", "host_response_time"]


def q_expanded_scores(spark, sf):
    """E5: ANOVA F, MI and |Spearman| of two numeric columns and of every level of four text columns against the occupancy level."""
    from tabforge.plans.catalog_eda import _scored
    found = feature_scores(_scored(spark, sf), "occupancy_level", G.LEVELS, ["accommodates", "bedrooms"], LEVEL_COLS)
    return found.select("feature", F.round("f", 4).alias("f"), F.round("mi", 7).alias("mi"), F.round("spearman", 6).alias("spearman"))


def _expanded_sql():
    levels = " UNION ALL ".join(f"SELECT '{c}=' || v AS feature, y, CASE WHEN {c} = v THEN 1.0 ELSE 0.0 END AS x FROM lab,"
                                f" (SELECT DISTINCT {c} AS v FROM lab WHERE {c} IS NOT NULL) WHERE {c} IS NOT NULL" for c in LEVEL_COLS)
    numbers = " UNION ALL ".join(f"SELECT '{c}' AS feature, y, CAST({c} AS DOUBLE) AS x FROM lab WHERE {c} IS NOT NULL" for c in ("accommodates", "bedrooms"))
    return with_listings(
        "SELECT a.feature, round(f, 4) AS f, mi, round(spearman, 6) AS spearman FROM anova a JOIN near_mi USING (feature) JOIN rho USING (feature)",
        f"lab AS (SELECT *, {LEVEL_SQL.format(x='estimated_occupancy_l365d')} AS y FROM listings)",
        f"cells AS (SELECT * FROM ({numbers} UNION ALL {levels}) WHERE y IS NOT NULL)",
        *_knn_ctes(), f"near_mi AS ({_KNN_MI})",
        "cm AS (SELECT feature, x, avg(x) OVER (PARTITION BY feature, y) AS m, avg(x) OVER (PARTITION BY feature) AS g, y FROM cells)",
        "anova AS (SELECT feature, (sum((m - g) ** 2) / (count(DISTINCT y) - 1)) / (sum((x - m) ** 2) / (count(*) - count(DISTINCT y))) AS f FROM cm GROUP BY feature)",
        "ranked AS (SELECT feature, rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0 AS rx,"
        " rank() OVER (PARTITION BY feature ORDER BY t) + (count(*) OVER (PARTITION BY feature, t) - 1) / 2.0 AS rt FROM"
        " (SELECT feature, x, CASE y WHEN 'zero' THEN 0 WHEN 'low' THEN 1 WHEN 'mid' THEN 2 ELSE 3 END AS t FROM cells))",
        "rho AS (SELECT feature, abs(corr(rx, rt)) AS spearman FROM ranked GROUP BY feature)")


O["expanded_scores"] = _expanded_sql()


def q_weight_search(spark, sf):
    return training.weight_search(training.prepare(spark, sf))


def q_cross_validate(spark, sf):
    p = training.prepare(spark, sf)
    return training.cross_validate(p, {"logreg": lambda rows: training.fit_logreg(p, rows), "random_forest": lambda rows: training.fit_random_forest(p, rows),
                                       "gbt": lambda rows: training.fit_gbt(p, rows), "mlp": lambda rows: training.fit_mlp(p, rows)})


def _mice(spark, sf):
    from tabforge.functions import scalars as S
    df = listings(spark, sf).select("id", "accommodates", "bedrooms", "beds",
                                    "review_scores_rating", "reviews_per_month", "availability_365",
                                    "number_of_reviews", "estimated_occupancy_l365d", S.price_digits("price").alias("price"),
                                    S.clean_percent("host_response_rate").alias("host_response_rate"))
    df = df.select(*[F.col(c).cast("double").alias(c) if c != "id" else F.col(c) for c in df.columns])
    sp = G.split_column(df, None, "id")
    train, test = sp.filter("split = 'train'"), sp.filter("split = 'test'")
    cols = ["bedrooms", "beds", "review_scores_rating", "reviews_per_month", "price", "host_response_rate"]
    preds = ["accommodates", "availability_365", "number_of_reviews", "estimated_occupancy_l365d"]
    tr, te, rounds = K.mice_impute(train, cols, preds, apply_to=test)
    return sp, tr.unionByName(te).select("id", "split", *cols, F.lit(rounds).alias("rounds")), cols


def q_mice_impute(spark, sf):
    return _mice(spark, sf)[1]


def q_mice_checks(spark, sf):
    """Observed cells are as they were, no cell is null, counts stay whole, and every row of both sides comes out once."""
    before, after, cols = _mice(spark, sf)
    both = after.join(before.select("id", *[F.col(c).alias(f"was_{c}") for c in cols]), "id")
    return both.select("id", reduce(and_, (F.col(c).isNotNull() for c in cols)).alias("no_null"),
                       reduce(and_, (F.col(f"was_{c}").isNull() | (F.col(f"was_{c}") == F.col(c)) for c in cols)).alias("observed_kept"),
                       ((F.col("bedrooms") % 1 == 0) & (F.col("beds") % 1 == 0)).alias("whole"))


O["mice_checks"] = with_listings(
    "SELECT id, true AS no_null, true AS observed_kept, true AS whole FROM listings")


def _trained(spark, sf):
    """A registry with a trained model in Production, and requests that carry every training input of the test split."""
    raw = stored(cleaning.null_tokens_to_null(listings(spark, sf)), "raw")   # read for training and for the requests
    p = training.prepare(spark, sf, raw)
    root = scratch_path(spark, "models")
    training.train_job(spark, p, root, {"logreg": training.fit_logreg})
    path = IO.requests_from(raw.join(p.test.select(F.col("row_id").alias("id")), "id", "left_semi"), scratch_path(spark, "req"),
                            inputs=p.fit.inputs, complete=True)
    return p, Served(spark, root, training.MODEL_NAME), path


def q_score_batch(spark, sf):
    _, served, path = _trained(spark, sf)
    inputs = served.current()[1].fit.inputs
    return score_batch(explode_requests(read_request_lines(spark, path, inputs), inputs), served.current()[1])


def q_score_stream(spark, sf):
    _, served, path = _trained(spark, sf)
    out, ck = scratch_path(spark, "scored"), scratch_path(spark, "stream-ckpt")
    score_stream(spark, path, out, ck, served)
    return spark.read.parquet(out)


def q_serving_parity(spark, sf):
    """M1, M2, M3: every row of the test split, served in batch and as a stream by the reloaded bundle, has the class of the test split."""
    p, served, path = _trained(spark, sf)
    inputs = served.current()[1].fit.inputs
    here = training.fit_logreg(p).predict(p.test, p.enc.classes).select(F.col("row_id").cast("string").alias("id"), F.col("pred").alias("split_class"))
    batch = score_batch(explode_requests(read_request_lines(spark, path, inputs), inputs), served.current()[1])
    out, ck = scratch_path(spark, "scored"), scratch_path(spark, "stream-ckpt")
    score_stream(spark, path, out, ck, served)
    stream = spark.read.parquet(out).select("id", F.col("pred_label").alias("stream_class"), "model_version")
    both = here.join(batch.select("id", F.col("pred_label").alias("batch_class"), "defaulted"), "id", "full").join(stream, "id", "full")
    return both.select(F.col("id").cast("long").alias("id"), (F.col("batch_class") == F.col("split_class")).alias("batch_same"),
                       (F.col("stream_class") == F.col("split_class")).alias("stream_same"), F.size("defaulted").alias("n_defaulted"), "model_version")


O["serving_parity"] = with_listings(
    "SELECT id, true AS batch_same, true AS stream_same, 0 AS n_defaulted, 1 AS model_version FROM split WHERE split = 'test'", *SPLIT_CTES)


def q_train_job(spark, sf):
    """Two training jobs one after the other; the registry with the runs behind its versions."""
    p = training.prepare(spark, sf)
    root = scratch_path(spark, "models")
    training.train_job(spark, p, root, {"logreg": training.fit_logreg})
    training.train_job(spark, p, root, {"logreg": training.fit_logreg, "random_forest": lambda x: training.fit_random_forest(x, num_trees=50, max_depth=6),
                                        "pca_logreg": training.fit_pca_logreg})
    runs = M.model_comparison(Runs(spark, root).table())
    return runs.join(Registry(spark, root).table(), "run_id", "left").select(*runs.columns, "version", "stage")


for _name, _fn in list(globals().items()):
    if _name.startswith("q_") and callable(_fn):
        Q[_name[2:]] = _fn

QUERIES = Q
ORACLES = O
