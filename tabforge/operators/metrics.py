"""Classification metrics over a predictions table (A25-A30), soft voting (K6),
threshold tuning (K9) and the run / registry tables (K10-K12, M3).

A predictions table has a label column, a predicted-class column and one
probability column per class (``p_<class>``).  Metrics are computed from the
label x prediction count table (at most k^2 rows) or, for ranking metrics, from
per-distinct-score aggregates with distributed running sums; no metric
collects rows or sorts the whole table in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabforge.operators.ordered import running_totals
from tabforge.operators.split import LEVELS

# Class names in index order (alphabetical) and in ordinal order.
CLASSES = ("high", "low", "mid", "zero")
ORDERED = LEVELS
ROC_GRID_POINTS = 200


def _all() -> Window:
    return Window.partitionBy()


def argmax_class(classes=CLASSES, prefix: str = "p_"):
    """Class with the largest probability; the first class in ``classes`` wins ties."""
    best = F.lit(classes[0])
    best_p = F.col(f"{prefix}{classes[0]}")
    for c in classes[1:]:
        p = F.col(f"{prefix}{c}")
        best = F.when(p > best_p, F.lit(c)).otherwise(best)
        best_p = F.greatest(best_p, p)
    return best


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "pred", classes=CLASSES) -> DataFrame:
    """Counts for every (label, prediction) pair of ``classes``, zero-filled."""
    spark = pred.sparkSession
    grid = spark.createDataFrame([(a, b) for a in classes for b in classes], f"{label} string, {prediction} string")
    counts = pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, [label, prediction], "left").select(label, prediction,
                                                                 F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def per_class(pred: DataFrame, label: str = "label", prediction: str = "pred", classes=CLASSES) -> DataFrame:
    """tp, predicted count and support per class, from the confusion table."""
    cm = confusion_matrix(pred, label, prediction, classes)
    rows = cm.select(F.explode(F.array(
        F.struct(F.col(label).alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col(prediction).alias("cls"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")))).alias("s")).select("s.*")
    return rows.groupBy("cls").agg(F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"),
                                   F.sum("support").alias("support"))


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "pred", classes=CLASSES) -> DataFrame:
    """Precision, recall, F1 and support per class, plus the macro average row (0 when undefined)."""
    pc = per_class(pred, label, prediction, classes)
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    rep = pc.select("cls", prec.alias("precision"), rec.alias("recall"), "support")
    rep = rep.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(0.0))
    macro = rep.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.sum("support").alias("support"), F.avg("f1").alias("f1"))
    return rep.unionByName(macro)


def summary_metrics(pred: DataFrame, label: str = "label", prediction: str = "pred", classes=CLASSES,
                    ordered=ORDERED) -> DataFrame:
    """A27 + A28: accuracy, macro F1, balanced accuracy (mean recall of classes present) and ordinal MAE."""
    rep = classification_report(pred, label, prediction, classes).filter(F.col("cls") != "macro avg")
    cls_part = rep.agg(F.avg("f1").alias("f1_macro"),
                       F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("bal_acc"))
    rank = F.create_map(*[v for i, c in enumerate(ordered) for v in (F.lit(c), F.lit(i))])
    row_part = pred.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"),
                        F.avg(F.abs(rank[F.col(label)] - rank[F.col(prediction)]).cast("double")).alias("mae"))
    return row_part.withColumn("__k", F.lit(1)).join(cls_part.withColumn("__k", F.lit(1)), "__k").drop("__k")


def metrics_of_counts(counts: DataFrame, by, classes=()) -> DataFrame:
    """Per group ``by``: rows, balanced accuracy and macro F1 from ``label, pred, n`` counts of all pairs of classes,
    and ``f1_<class>`` for the ``classes`` named."""
    n = F.col("n")
    seen = counts.select(*by, F.col("label").alias("cls"), n.alias("support"), F.lit(0).cast("long").alias("predicted"),
                         F.when(F.col("label") == F.col("pred"), n).otherwise(0).alias("tp"))
    told = counts.select(*by, F.col("pred").alias("cls"), F.lit(0).cast("long").alias("support"), n.alias("predicted"), F.lit(0).cast("long").alias("tp"))
    per = seen.unionByName(told).groupBy(*by, "cls").agg(F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("support").alias("support"))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("predicted") + F.col("support")), F.lit(0.0))
    per = per.select(*by, "cls", "support", f1.alias("f1"), F.try_divide("tp", "support").alias("recall"))
    return per.groupBy(*by).agg(F.sum("support").alias("rows"), F.avg("recall").alias("bal_acc"), F.avg("f1").alias("f1_macro"),
                                *[F.max(F.when(F.col("cls") == c, F.col("f1"))).alias(f"f1_{c}") for c in classes])


def ordinal_mae(pred: DataFrame, label: str = "label", prediction: str = "pred", ordered=ORDERED) -> DataFrame:
    """Mean absolute difference of ordinal class ranks."""
    rank = F.create_map(*[v for i, c in enumerate(ordered) for v in (F.lit(c), F.lit(i))])
    return pred.agg(F.avg(F.abs(rank[F.col(label)] - rank[F.col(prediction)]).cast("double")).alias("mae"))


def _class_scores(pred: DataFrame, label: str, classes, prefix: str) -> DataFrame:
    """One row per (class, row): score for that class and whether the row is positive."""
    return pred.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("cls"), F.col(f"{prefix}{c}").cast("double").alias("score"),
                 (F.col(label) == F.lit(c)).cast("long").alias("pos"),
                 (F.col(label) != F.lit(c)).cast("long").alias("neg")) for c in classes])).alias("s")).select("s.*")


def roc_auc_per_class(pred: DataFrame, label: str = "label", classes=CLASSES, prefix: str = "p_") -> DataFrame:
    """One-vs-rest AUC per class (Mann-Whitney with ties counted half), from per-score aggregates."""
    cs = _class_scores(pred, label, classes, prefix)
    rt = running_totals(cs, ["cls"], "score", ["pos", "neg"])
    per = rt.groupBy("cls").agg(F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("u"),
                                F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    pn = F.col("P").cast("double") * F.col("N").cast("double")
    return per.select("cls", F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("u") / pn)
                      .alias("auc"))


def roc_auc_ovr(pred: DataFrame, label: str = "label", classes=CLASSES, prefix: str = "p_") -> DataFrame:
    """Macro one-vs-rest AUC."""
    return roc_auc_per_class(pred, label, classes, prefix).agg(F.avg("auc").alias("roc_auc_ovr"))


def roc_points(pred: DataFrame, label: str = "label", classes=CLASSES, prefix: str = "p_",
               grid_points: int = ROC_GRID_POINTS) -> DataFrame:
    """Macro-mean ROC curve on an even FPR grid (linear interpolation) and its trapezoid AUC.

    Per class, ROC points are cumulative (tp, fp) over distinct scores, high to low.
    For each grid value x the curve is interpolated between the last point with
    fpr <= x (highest tpr there) and the first point with fpr > x (lowest tpr there).
    """
    spark = pred.sparkSession
    cs = _class_scores(pred, label, classes, prefix).withColumn("neg_score", -F.col("score"))
    rt = running_totals(cs, ["cls"], "neg_score", ["pos", "neg"])
    tot = rt.groupBy("cls").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    pts = (rt.join(F.broadcast(tot), "cls")
           .select("cls", F.try_divide(F.col("neg_below") + F.col("neg"), F.col("N")).alias("fpr"),
                   F.try_divide(F.col("pos_below") + F.col("pos"), F.col("P")).alias("tpr")))
    origin = tot.select("cls", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    pts = pts.unionByName(origin).groupBy("cls", "fpr").agg(F.max("tpr").alias("tmax"), F.min("tpr").alias("tmin"))
    m = grid_points - 1
    k_prev = F.ceil(F.col("fpr") * m).cast("int")                   # first grid index with x >= fpr
    prev_tab = pts.groupBy("cls", k_prev.alias("k")).agg(F.max_by(F.struct("fpr", "tmax"), "fpr").alias("pp"))
    next_tab = (pts.filter(k_prev - 1 >= 0).groupBy("cls", (k_prev - 1).alias("k"))
                .agg(F.min_by(F.struct("fpr", "tmin"), "fpr").alias("nn")))
    cls_df = spark.createDataFrame([(c,) for c in classes], "cls string")
    g = cls_df.select("cls", F.explode(F.sequence(F.lit(0), F.lit(m))).alias("k"))
    g = g.join(prev_tab, ["cls", "k"], "left").join(next_tab, ["cls", "k"], "left")
    wp = Window.partitionBy("cls").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    wn = Window.partitionBy("cls").orderBy("k").rowsBetween(0, Window.unboundedFollowing)
    g = g.select("cls", "k", (F.col("k") / F.lit(float(m))).alias("x"),
                 F.last("pp", ignorenulls=True).over(wp).alias("pp"),
                 F.first("nn", ignorenulls=True).over(wn).alias("nn"))
    x0, y0, x1, y1 = F.col("pp.fpr"), F.col("pp.tmax"), F.col("nn.fpr"), F.col("nn.tmin")
    y = F.when(F.col("nn").isNull() | (x0 == F.col("x")), y0).otherwise(y0 + (y1 - y0) * (F.col("x") - x0) / (x1 - x0))
    curve = g.select("k", "x", y.alias("tpr")).groupBy("k", "x").agg(F.avg("tpr").alias("mean_tpr"))
    w = Window.orderBy("k")
    trap = (F.col("x") - F.lag("x").over(w)) * (F.col("mean_tpr") + F.lag("mean_tpr").over(w)) / 2
    curve = curve.withColumn("__t", trap)
    return curve.select(F.col("x").alias("fpr"), "mean_tpr",
                        F.sum("__t").over(Window.partitionBy()).alias("auc"))


def soft_vote(members, key: str = "row_id", classes=CLASSES, prefix: str = "p_") -> DataFrame:
    """K6: mean class probabilities of member prediction tables (joined on the row key), argmax."""
    base = members[0].select(key, *[F.col(f"{prefix}{c}").alias(f"__m0_{c}") for c in classes])
    for i, m in enumerate(members[1:], start=1):
        base = base.join(m.select(key, *[F.col(f"{prefix}{c}").alias(f"__m{i}_{c}") for c in classes]), key)
    k = len(members)
    avg = [(sum((F.col(f"__m{i}_{c}") for i in range(k)), F.lit(0.0)) / k).alias(f"{prefix}{c}") for c in classes]
    out = base.select(key, *avg)
    return out.withColumn("pred", argmax_class(classes, prefix))


def _grid_cells(pred: DataFrame, thresholds, margins, label: str = "label", base: str = "pred",
                hi: str = "high", mid: str = "mid", prefix: str = "p_") -> DataFrame:
    """(threshold, margin, y, b, p, n) cells: the tuned prediction p for every grid point.

    Rule per row: p(high) >= t -> high; if margin > 0 and p(high) - p(mid) < margin
    as well -> mid; otherwise the base prediction.  Rows are first reduced to a
    histogram keyed by (label, base prediction, #thresholds passed, first margin
    index above the gap) - at most a few thousand cells whatever the table size -
    and only that histogram is expanded over the grid.
    """
    thresholds, margins = sorted(set(thresholds)), sorted(set(margins))   # the indices below count from the smallest
    thr = F.array(*[F.lit(float(t)) for t in thresholds])
    mar = F.array(*[F.lit(float(m)) for m in margins])
    ph, pm = F.col(f"{prefix}{hi}"), F.col(f"{prefix}{mid}")
    gap = ph - pm
    cells = (pred.select(F.col(label).alias("y"), F.col(base).alias("b"),
                         F.size(F.filter(thr, lambda t: t <= ph)).alias("ti"),
                         (F.lit(len(margins)) - F.size(F.filter(mar, lambda m: m > gap))).alias("fm"))
             .groupBy("y", "b", "ti", "fm").agg(F.count(F.lit(1)).alias("n")))
    t_grid = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(float(t)).alias("threshold"))
                       for i, t in enumerate(thresholds)])
    m_grid = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(float(m)).alias("margin")) for j, m in enumerate(margins)])
    g = (cells.select("*", F.explode(t_grid).alias("tp")).select("*", F.explode(m_grid).alias("mp"))
         .select("*", "tp.*", "mp.*").drop("tp", "mp"))
    is_high = F.col("k") < F.col("ti")
    close = is_high & (F.col("margin") > 0) & (F.col("j") >= F.col("fm"))
    p = F.when(close, F.lit(mid)).when(is_high, F.lit(hi)).otherwise(F.col("b"))
    g = g.withColumn("p", p)
    return g


def grid_cross(pred: DataFrame, thresholds, margins, label: str = "label", base: str = "pred",
               hi: str = "high", mid: str = "mid", prefix: str = "p_") -> DataFrame:
    """Predicted-class counts for every (threshold, margin) pair over all predictions.

    The predictions are reduced to a bounded histogram first; only the histogram is
    expanded over the grid (no prediction x grid pairs are formed)."""
    g = _grid_cells(pred, thresholds, margins, label, base, hi, mid, prefix)
    return g.groupBy("threshold", "margin", F.col("p").alias("pred")).agg(F.sum("n").alias("n"))


def threshold_grid_scores(pred: DataFrame, thresholds, margins, label: str = "label", base: str = "pred",
                          hi: str = "high", mid: str = "mid", prefix: str = "p_") -> DataFrame:
    """K9: F1(high), F1(mid) and their sum for every (threshold, margin) pair (see :func:`_grid_cells`)."""
    g = _grid_cells(pred, thresholds, margins, label, base, hi, mid, prefix)

    def f1(c):
        tp = F.sum(F.when((F.col("y") == c) & (F.col("p") == c), F.col("n")).otherwise(0))
        fp = F.sum(F.when((F.col("y") != c) & (F.col("p") == c), F.col("n")).otherwise(0))
        fn = F.sum(F.when((F.col("y") == c) & (F.col("p") != c), F.col("n")).otherwise(0))
        return F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0)
    s = g.groupBy("threshold", "margin").agg(f1(hi).alias("f1_high"), f1(mid).alias("f1_mid"))
    return s.withColumn("score", F.col("f1_high") + F.col("f1_mid"))


def best_threshold(scores: DataFrame) -> DataFrame:
    """K9: the best (threshold, margin): highest score, then highest F1(high), then smallest grid values."""
    return scores.orderBy(F.col("score").desc(), F.col("f1_high").desc(), "threshold", "margin").limit(1)


def apply_threshold(pred: DataFrame, threshold: float, margin: float, base: str = "pred", hi: str = "high",
                    mid: str = "mid", prefix: str = "p_", out: str = "pred") -> DataFrame:
    ph, pm = F.col(f"{prefix}{hi}"), F.col(f"{prefix}{mid}")
    is_high = ph >= threshold
    close = is_high & F.lit(margin > 0) & ((ph - pm) < margin)
    return pred.withColumn(out, F.when(close, F.lit(mid)).when(is_high, F.lit(hi)).otherwise(F.col(base)))


def run_metrics(pred: DataFrame, run_id: str, model_name: str) -> DataFrame:
    """One runs-table row: accuracy, ordinal MAE, macro F1, balanced accuracy, macro OvR AUC."""
    both = summary_metrics(pred).withColumn("__k", F.lit(1)).join(roc_auc_ovr(pred).withColumn("__k", F.lit(1)), "__k").drop("__k")
    return both.select(F.lit(run_id).alias("run_id"), F.lit(model_name).alias("model_name"), "*")


def model_comparison(runs: DataFrame, by: str = "bal_acc") -> DataFrame:
    """The metric table of all models sorted by ``by`` (descending)."""
    return runs.orderBy(F.col(by).desc(), "model_name")


def select_best(runs: DataFrame, metric: str = "mae", minimize: bool = True) -> DataFrame:
    """The run with the best metric (minimum MAE by default; ties by model name)."""
    o = F.col(metric).asc() if minimize else F.col(metric).desc()
    return runs.orderBy(o, "model_name").limit(1)


def promote_best(registry: DataFrame, best: DataFrame, name: str) -> DataFrame:
    """Register ``best`` as a new version in Production; earlier Production versions become Archived."""
    nxt = registry.filter(F.col("name") == name).agg(F.coalesce(F.max("version"), F.lit(0)).alias("v"))
    new = (best.select("run_id", F.lit(1).alias("__k")).join(nxt.withColumn("__k", F.lit(1)), "__k")
           .select(F.lit(name).alias("name"), (F.col("v") + 1).cast("int").alias("version"),
                   F.lit("Production").alias("stage"), "run_id",
                   F.concat(F.lit("runs/"), F.col("run_id"), F.lit("/model")).alias("path")))
    old = registry.withColumn("stage", F.when((F.col("name") == name) & (F.col("stage") == "Production"),
                                              F.lit("Archived")).otherwise(F.col("stage")))
    return old.unionByName(new)


def latest_production(registry: DataFrame, name: str) -> DataFrame:
    """M3: newest Production version of a model and its path."""
    return (registry.filter((F.col("name") == name) & (F.col("stage") == "Production"))
            .agg(F.max("version").alias("version"), F.max_by("path", "version").alias("path"),
                 F.max_by("run_id", "version").alias("run_id")))
