"""Registered queries for evaluation metrics, voting, threshold tuning, run/registry
tables and rank aggregation, over the synthetic predictions derived from listings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabforge.operators import metrics as M
from tabforge.operators import ranking as W
from tabforge.operators.store import Registry, Runs
from tabforge.plans.catalog_scalars import with_listings
from tabforge.session import scratch_path, stored
from tabforge.sources.fixtures import SCORE_PARAMS_B, listings, predictions, predictions_sql

Q = {}
O = {}
PR = predictions_sql()
PRB = predictions_sql(SCORE_PARAMS_B, "prb")
CLS = M.CLASSES
RANK_SQL = "CASE {c} WHEN 'zero' THEN 0 WHEN 'low' THEN 1 WHEN 'mid' THEN 2 WHEN 'high' THEN 3 END"
# Threshold-search grids.
THRESHOLDS = [float(x) for x in np.linspace(0.25, 0.75, 21)]
MARGINS = [float(x) for x in np.linspace(0.0, 0.25, 26)]


def _r(df, cols, nd=9):
    return df.select(*[F.round(c, nd).alias(c) if c in cols else F.col(c) for c in df.columns])


def with_pred(body, *ctes):
    return with_listings(body, PR, *ctes)


def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(predictions(spark, sf))


O["confusion_matrix"] = with_pred(
    "SELECT g.label, g.pred, count(pr.row_id) AS n FROM (SELECT a.c AS label, b.c AS pred FROM (VALUES ('high'), ('low'),"
    " ('mid'), ('zero')) a(c), (VALUES ('high'), ('low'), ('mid'), ('zero')) b(c)) g LEFT JOIN pr"
    " ON pr.label = g.label AND pr.pred = g.pred GROUP BY g.label, g.pred")

PER_CLASS_SQL = ("pc AS (SELECT c AS cls, count(*) FILTER (WHERE label = c AND pred = c) AS tp, count(*) FILTER"
                 " (WHERE pred = c) AS predicted, count(*) FILTER (WHERE label = c) AS support FROM {src},"
                 " (VALUES ('high'), ('low'), ('mid'), ('zero')) v(c) GROUP BY c)")
REP_SQL = ("rep AS (SELECT cls, precision, recall, support, CASE WHEN precision + recall > 0 THEN 2 * precision * recall"
           " / (precision + recall) ELSE 0.0 END AS f1 FROM (SELECT cls, CASE WHEN predicted > 0 THEN tp / predicted"
           " ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM pc))")


def q_classification_report(spark, sf):
    return _r(M.classification_report(predictions(spark, sf)), ["precision", "recall", "f1"])


O["classification_report"] = with_pred(
    "SELECT cls, round(precision, 9) AS precision, round(recall, 9) AS recall, support, round(f1, 9) AS f1 FROM rep"
    " UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), CAST(sum(support) AS BIGINT), round(avg(f1), 9)"
    " FROM rep", PER_CLASS_SQL.format(src="pr"), REP_SQL)


def summary_sql(src):
    return (f"SELECT round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 9) AS accuracy,"
            f" round(avg(abs({RANK_SQL.format(c='label')} - {RANK_SQL.format(c='pred')})), 9) AS mae,"
            f" (SELECT round(avg(f1), 9) FROM rep) AS f1_macro,"
            f" (SELECT round(avg(CASE WHEN support > 0 THEN recall END), 9) FROM rep) AS bal_acc FROM {src}")


def q_accuracy_f1_balacc(spark, sf):
    return _r(M.summary_metrics(predictions(spark, sf)), ["accuracy", "mae", "f1_macro", "bal_acc"])


O["accuracy_f1_balacc"] = with_pred(summary_sql("pr"), PER_CLASS_SQL.format(src="pr"), REP_SQL)


def q_ordinal_mae(spark, sf):
    return _r(M.ordinal_mae(predictions(spark, sf)), ["mae"])


O["ordinal_mae"] = with_pred(
    f"SELECT round(avg(abs({RANK_SQL.format(c='label')} - {RANK_SQL.format(c='pred')})), 9) AS mae FROM pr")


def auc_sql(src):
    per = " UNION ALL ".join(
        f"SELECT '{c}' AS cls, (sum(CASE WHEN label = '{c}' THEN r END) - P * (P + 1) / 2.0) / (P * N) AS auc FROM"
        f" (SELECT label, rank() OVER (ORDER BY p_{c}) + (count(*) OVER (PARTITION BY p_{c}) - 1) / 2.0 AS r,"
        f" count(*) FILTER (WHERE label = '{c}') OVER () AS P, count(*) FILTER (WHERE label <> '{c}') OVER () AS N"
        f" FROM {src}) GROUP BY P, N" for c in CLS)
    return per


def q_roc_auc_ovr(spark, sf):
    return _r(M.roc_auc_ovr(predictions(spark, sf)), ["roc_auc_ovr"])


O["roc_auc_ovr"] = with_pred(f"SELECT round(avg(auc), 9) AS roc_auc_ovr FROM ({auc_sql('pr')})")


def q_roc_points(spark, sf):
    return _r(M.roc_points(predictions(spark, sf)), ["fpr", "mean_tpr", "auc"])


def _roc_sql():
    per = " UNION ALL ".join(
        f"SELECT '{c}' AS cls, -p_{c} AS s, CAST(label = '{c}' AS INTEGER) AS pos, CAST(label <> '{c}' AS INTEGER) AS neg"
        " FROM pr" for c in CLS)
    return with_pred(
        "SELECT round(x, 9) AS fpr, round(mean_tpr, 9) AS mean_tpr, round(sum((x - px) * (mean_tpr + pt) / 2) OVER (), 9)"
        " AS auc FROM (SELECT k, x, mean_tpr, lag(x) OVER (ORDER BY k) AS px, lag(mean_tpr) OVER (ORDER BY k) AS pt FROM"
        " (SELECT k, x, avg(y) AS mean_tpr FROM (SELECT g.cls, g.k, g.x, CASE WHEN nf IS NULL OR pf = g.x THEN pt"
        " ELSE pt + (nt - pt) * (g.x - pf) / (nf - pf) END AS y FROM (SELECT c.cls, r.k, r.k / 199.0 AS x FROM"
        " (SELECT DISTINCT cls FROM pts) c, range(200) r(k)) g,"
        " LATERAL (SELECT max(fpr) AS pf FROM pts WHERE pts.cls = g.cls AND fpr <= g.x) a,"
        " LATERAL (SELECT max(tmax) AS pt FROM pts WHERE pts.cls = g.cls AND fpr = a.pf) b,"
        " LATERAL (SELECT min(fpr) AS nf FROM pts WHERE pts.cls = g.cls AND fpr > g.x) c2,"
        " LATERAL (SELECT min(tmin) AS nt FROM pts WHERE pts.cls = g.cls AND fpr = c2.nf) d) GROUP BY k, x))",
        f"cs AS ({per})",
        "cum AS (SELECT cls, (sum(neg) OVER w) / (sum(neg) OVER (PARTITION BY cls)) AS fpr,"
        " (sum(pos) OVER w) / (sum(pos) OVER (PARTITION BY cls)) AS tpr FROM (SELECT cls, s, sum(pos) AS pos,"
        " sum(neg) AS neg FROM cs GROUP BY cls, s) WINDOW w AS (PARTITION BY cls ORDER BY s ROWS BETWEEN UNBOUNDED"
        " PRECEDING AND CURRENT ROW))",
        "pts AS (SELECT cls, fpr, max(tpr) AS tmax, min(tpr) AS tmin FROM (SELECT * FROM cum UNION ALL"
        " SELECT DISTINCT cls, 0.0, 0.0 FROM cs) GROUP BY cls, fpr)")


O["roc_points"] = _roc_sql()


def q_soft_vote(spark, sf):
    a, b = predictions(spark, sf), predictions(spark, sf, SCORE_PARAMS_B)
    return _r(M.soft_vote([a, b]), [f"p_{c}" for c in CLS])


def _vote_sql():
    cases = []
    for i, c in enumerate(CLS):
        conds = [f"p_{c} > p_{d}" for d in CLS[:i]] + [f"p_{c} >= p_{d}" for d in CLS[i + 1:]]
        cases.append(f"WHEN {' AND '.join(conds)} THEN '{c}'")
    avg = ", ".join(f"(pr.p_{c} + prb.p_{c}) / 2 AS p_{c}" for c in CLS)
    return with_pred(
        "SELECT row_id, " + ", ".join(f"round(p_{c}, 9) AS p_{c}" for c in CLS) + f", CASE {' '.join(cases)} END AS pred"
        f" FROM (SELECT pr.row_id, {avg} FROM pr JOIN prb ON pr.row_id = prb.row_id)", PRB)


O["soft_vote"] = _vote_sql()


def q_threshold_tune(spark, sf):
    s = M.threshold_grid_scores(predictions(spark, sf), THRESHOLDS, MARGINS)
    return _r(s, ["threshold", "margin", "f1_high", "f1_mid", "score"])


def _thr_sql():
    grid = ", ".join(f"(CAST({t!r} AS DOUBLE), CAST({m!r} AS DOUBLE))" for t in THRESHOLDS for m in MARGINS)
    f1 = ("CASE WHEN 2 * count(*) FILTER (WHERE label = '{c}' AND p = '{c}') + count(*) FILTER (WHERE label <> '{c}'"
          " AND p = '{c}') + count(*) FILTER (WHERE label = '{c}' AND p <> '{c}') > 0 THEN 2.0 * count(*) FILTER"
          " (WHERE label = '{c}' AND p = '{c}') / (2 * count(*) FILTER (WHERE label = '{c}' AND p = '{c}') + count(*)"
          " FILTER (WHERE label <> '{c}' AND p = '{c}') + count(*) FILTER (WHERE label = '{c}' AND p <> '{c}'))"
          " ELSE 0.0 END")
    return with_pred(
        "SELECT round(t, 9) AS threshold, round(m, 9) AS margin, round(fh, 9) AS f1_high, round(fm, 9) AS f1_mid,"
        " round(fh + fm, 9) AS score FROM (SELECT t, m, " + f1.format(c="high") + " AS fh, " + f1.format(c="mid")
        + " AS fm FROM (SELECT t, m, label, CASE WHEN p_high >= t AND m > 0 AND p_high - p_mid < m THEN 'mid'"
        " WHEN p_high >= t THEN 'high' ELSE pred END AS p FROM pr, (VALUES " + grid + ") g(t, m)) GROUP BY t, m)")


O["threshold_tune"] = _thr_sql()


def q_grid_cross(spark, sf):
    return _r(M.grid_cross(predictions(spark, sf), THRESHOLDS, MARGINS), ["threshold", "margin"])


O["grid_cross"] = with_pred(
    "SELECT round(t, 9) AS threshold, round(m, 9) AS margin, p AS pred, count(*) AS n FROM (SELECT t, m,"
    " CASE WHEN p_high >= t AND m > 0 AND p_high - p_mid < m THEN 'mid' WHEN p_high >= t THEN 'high' ELSE pred END"
    " AS p FROM pr, (VALUES " + ", ".join(f"(CAST({t!r} AS DOUBLE), CAST({m!r} AS DOUBLE))" for t in THRESHOLDS
                                        for m in MARGINS) + ") g(t, m)) GROUP BY t, m, p")


def _run_predictions(spark, sf):
    rows = stored(listings(spark, sf).select("id", "estimated_occupancy_l365d"), "labelled")   # read by every run
    base = predictions(spark, sf, rows=rows)
    ens = M.soft_vote([base, predictions(spark, sf, SCORE_PARAMS_B, rows)]).join(base.select("row_id", "label"), "row_id")
    best = M.best_threshold(M.threshold_grid_scores(base, THRESHOLDS, MARGINS)).first()
    tuned = M.apply_threshold(base, best["threshold"], best["margin"])
    return [(f"run-{name}", name, pred) for name, pred in (("base", base), ("ensemble", ens), ("base_high_tuned", tuned))]


def _runs_sql():
    ens = ("en AS (SELECT pr.row_id, pr.label, CASE " + " ".join(
        f"WHEN {' AND '.join([f'(pr.p_{c} + prb.p_{c}) > (pr.p_{d} + prb.p_{d})' for d in CLS[:i]] + [f'(pr.p_{c} + prb.p_{c}) >= (pr.p_{d} + prb.p_{d})' for d in CLS[i + 1:]])} THEN '{c}'"
        for i, c in enumerate(CLS)) + " END AS pred, " + ", ".join(f"(pr.p_{c} + prb.p_{c}) / 2 AS p_{c}" for c in CLS)
        + " FROM pr JOIN prb ON pr.row_id = prb.row_id)")
    best = ("bt AS (SELECT threshold, margin FROM (" + _thr_body() + ") ORDER BY score DESC, f1_high DESC, threshold,"
            " margin LIMIT 1)")
    tuned = ("tu AS (SELECT row_id, label, p_high, p_low, p_mid, p_zero, CASE WHEN p_high >= bt.threshold AND"
             " bt.margin > 0 AND p_high - p_mid < bt.margin THEN 'mid' WHEN p_high >= bt.threshold THEN 'high'"
             " ELSE pred END AS pred FROM pr, bt)")
    parts = []
    ctes = [PRB, ens, best, tuned]
    for name, src in (("base", "pr"), ("ensemble", "en"), ("base_high_tuned", "tu")):
        ctes.append(PER_CLASS_SQL.format(src=src).replace("pc AS", f"pc_{src} AS"))
        ctes.append(REP_SQL.replace("rep AS", f"rep_{src} AS").replace("FROM pc)", f"FROM pc_{src})"))
        parts.append(
            f"SELECT 'run-{name}' AS run_id, '{name}' AS model_name, round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0"
            f" END), 9) AS accuracy, round(avg(abs({RANK_SQL.format(c='label')} - {RANK_SQL.format(c='pred')})), 9) AS"
            f" mae, (SELECT round(avg(f1), 9) FROM rep_{src}) AS f1_macro, (SELECT round(avg(CASE WHEN support > 0 THEN"
            f" recall END), 9) FROM rep_{src}) AS bal_acc, (SELECT round(avg(auc), 9) FROM ({auc_sql(src)})) AS"
            f" roc_auc_ovr FROM {src}")
    return parts, ctes


def _thr_body():
    grid = ", ".join(f"(CAST({t!r} AS DOUBLE), CAST({m!r} AS DOUBLE))" for t in THRESHOLDS for m in MARGINS)
    f1 = ("CASE WHEN 2 * count(*) FILTER (WHERE label = '{c}' AND p = '{c}') + count(*) FILTER (WHERE label <> '{c}'"
          " AND p = '{c}') + count(*) FILTER (WHERE label = '{c}' AND p <> '{c}') > 0 THEN 2.0 * count(*) FILTER"
          " (WHERE label = '{c}' AND p = '{c}') / (2 * count(*) FILTER (WHERE label = '{c}' AND p = '{c}') + count(*)"
          " FILTER (WHERE label <> '{c}' AND p = '{c}') + count(*) FILTER (WHERE label = '{c}' AND p <> '{c}'))"
          " ELSE 0.0 END")
    return ("SELECT t AS threshold, m AS margin, fh AS f1_high, fh + fm AS score FROM (SELECT t, m, "
            + f1.format(c="high") + " AS fh, " + f1.format(c="mid") + " AS fm FROM (SELECT t, m, label, CASE WHEN"
            " p_high >= t AND m > 0 AND p_high - p_mid < m THEN 'mid' WHEN p_high >= t THEN 'high' ELSE pred END AS p"
            " FROM pr, (VALUES " + grid + ") g(t, m)) GROUP BY t, m)")


_RUN_ROOTS: dict = {}


def _stored_runs(spark, sf):
    """The runs of a session and folder: evaluated and stored once, then read from the stored table."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUN_ROOTS:
        root = scratch_path(spark, "runs")
        runs = Runs(spark, root)
        for run_id, name, pred in _run_predictions(spark, sf):
            runs.evaluate(run_id, name, pred)
        _RUN_ROOTS[key] = root
    return _r(Runs(spark, _RUN_ROOTS[key]).table(), ["accuracy", "mae", "f1_macro", "bal_acc", "roc_auc_ovr"])


def q_model_comparison(spark, sf):
    return M.model_comparison(_stored_runs(spark, sf))


_parts, _ctes = _runs_sql()
RUNS_SQL_BODY = " UNION ALL ".join(_parts)
O["model_comparison"] = with_pred(RUNS_SQL_BODY, *_ctes)


def q_select_best(spark, sf):
    return M.select_best(_stored_runs(spark, sf), "mae")


O["select_best"] = with_pred(f"SELECT * FROM ({RUNS_SQL_BODY}) ORDER BY mae, model_name LIMIT 1", *_ctes)


def q_promote_best(spark, sf):
    """K12 on a stored registry: every run is a version, the newest of them in Production until the best run replaces it."""
    runs = _stored_runs(spark, sf)
    registry = Registry(spark, scratch_path(spark, "registry"))
    for r in runs.select("run_id").orderBy("model_name").collect():   # a handful of runs
        registry.promote("occupancy-classifier", runs.where(F.col("run_id") == r["run_id"]))
    registry.promote("occupancy-classifier", M.select_best(runs, "mae"))
    return registry.table()


REG_SQL = ("reg AS (SELECT 'occupancy-classifier' AS name, CAST(row_number() OVER (ORDER BY model_name) AS INTEGER)"
           " AS version, 'Archived' AS stage, run_id, 'runs/' || run_id || '/model' AS path FROM (" + RUNS_SQL_BODY + "))")
BEST_SQL = f"best AS (SELECT run_id FROM ({RUNS_SQL_BODY}) ORDER BY mae, model_name LIMIT 1)"
PROMOTED_SQL = ("SELECT * FROM reg UNION ALL SELECT 'occupancy-classifier', CAST((SELECT max(version) FROM reg) + 1 AS"
                " INTEGER), 'Production', run_id, 'runs/' || run_id || '/model' FROM best")
O["promote_best"] = with_pred(PROMOTED_SQL, *_ctes, REG_SQL, BEST_SQL)


def q_latest_production(spark, sf):
    return M.latest_production(q_promote_best(spark, sf), "occupancy-classifier")


O["latest_production"] = with_pred(
    "SELECT max(version) AS version, arg_max(path, version) AS path, arg_max(run_id, version) AS run_id FROM ("
    + PROMOTED_SQL + ") WHERE name = 'occupancy-classifier' AND stage = 'Production'", *_ctes, REG_SQL, BEST_SQL)


def _metric_table(spark, sf):
    from tabforge.plans.catalog_eda import SCORE_COLS, _scored
    from tabforge.operators import eda as E
    df = _scored(spark, sf)
    mi = E.mutual_information(df, "occupancy_level", SCORE_COLS, 10).select("feature", F.lit("mi").alias("metric"),
                                                                            F.round("mi", 9).alias("value"))
    fs = E.anova_f(df, "occupancy_level", SCORE_COLS).select("feature", F.lit("f").alias("metric"),
                                                              F.round("f_stat", 4).alias("value"))
    return mi.unionByName(fs)


def q_minmax_norm(spark, sf):
    return _r(W.minmax_norm(_metric_table(spark, sf), "metric", "value"), ["norm"])


def _mt_cte():
    from tabforge.plans.catalog_eda import O as EO, SC_CTE
    mi_body = EO["mutual_information"].rsplit(SC_CTE + "\n", 1)[1]
    f_body = EO["anova_f"].rsplit(SC_CTE + "\n", 1)[1]
    return SC_CTE, (f"mt AS (SELECT feature, 'mi' AS metric, mi AS value FROM ({mi_body}) UNION ALL"
                    f" SELECT feature, 'f', f_stat FROM ({f_body}))")


_sc, _mt = _mt_cte()
O["minmax_norm"] = with_listings(
    "SELECT feature, metric, value, round((value - min(value) OVER (PARTITION BY metric)) / (max(value) OVER"
    " (PARTITION BY metric) - min(value) OVER (PARTITION BY metric) + 1e-12), 9) AS norm FROM mt", _sc, _mt)


def q_avg_rank(spark, sf):
    norm = W.minmax_norm(_metric_table(spark, sf), "metric", "value").withColumn("norm", F.round("norm", 9))
    return W.avg_rank(norm, "feature", "metric", "norm")


O["avg_rank"] = with_listings(
    "SELECT feature, avg(r) AS rank_avg FROM (SELECT feature, rank() OVER (PARTITION BY metric ORDER BY norm DESC) +"
    " (count(*) OVER (PARTITION BY metric, norm) - 1) / 2.0 AS r FROM (SELECT feature, metric, round((value - min(value)"
    " OVER (PARTITION BY metric)) / (max(value) OVER (PARTITION BY metric) - min(value) OVER (PARTITION BY metric)"
    " + 1e-12), 9) AS norm FROM mt)) GROUP BY feature", _sc, _mt)

VAR_COLS = ["accommodates", "bedrooms", "beds", "availability_365", "number_of_reviews"]


def q_cumulative_variance(spark, sf):
    df = listings(spark, sf)
    wide = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in VAR_COLS])
    long = wide.unpivot([], VAR_COLS, "component", "variance")
    ratios = long.withColumn("ratio", F.col("variance") / F.sum("variance").over(
        Window.partitionBy()))
    return _r(W.cumulative_variance(ratios, "ratio"), ["ratio", "cum_ratio"]).drop("variance")


O["cumulative_variance"] = with_listings(
    "SELECT component, rank, round(ratio, 9) AS ratio, round(cum_ratio, 9) AS cum_ratio, k80, k95 FROM ("
    "SELECT *, min(CASE WHEN cum_ratio >= 0.8 THEN rank END) OVER () AS k80,"
    " min(CASE WHEN cum_ratio >= 0.95 THEN rank END) OVER () AS k95 FROM (SELECT component, ratio, rank,"
    " sum(ratio) OVER (ORDER BY rank) AS cum_ratio FROM (SELECT component, ratio, CAST(row_number() OVER"
    " (ORDER BY ratio DESC, component) AS INTEGER) AS rank FROM (SELECT component, v / sum(v) OVER () AS ratio FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS component, var_samp(CAST({c} AS DOUBLE)) AS v FROM listings"
                         for c in VAR_COLS) + ")))))")


for _name, _fn in list(globals().items()):
    if _name.startswith("q_") and callable(_fn):
        Q[_name[2:]] = _fn

QUERIES = Q
ORACLES = O
