"""The training job: cleaned splits -> encoder -> models -> metrics -> runs / registry.

The encoded training and test tables are persisted once (memory and disk) and
reused by every model; each fit is a distributed Spark ML job.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.operators import boosting as B
from tabforge.operators import eda as E
from tabforge.operators import metrics as M
from tabforge.operators import models as K
from tabforge.operators import quality as D
from tabforge.plans import cleaning
from tabforge.session import cut_lineage, spread, stored
from tabforge.sources.fixtures import listings

TARGET = cleaning.TARGET


@dataclass
class Prepared:
    enc: K.Encoder
    train: DataFrame        # row_id, label, label_idx, features, weight
    test: DataFrame
    n_features: int
    fit: cleaning.CleanFit
    clean_train: DataFrame
    clean_test: DataFrame


def prepare(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> Prepared:
    raw = raw if raw is not None else listings(spark, sf_dir)
    train, test, fit = cleaning.run(raw)
    train, test = D.filter_present(train, TARGET), D.filter_present(test, TARGET)   # D3 on both sides
    num, cat = K.split_columns(train.select(*fit.feature_order), TARGET)
    enc = K.fit_encoder(train, TARGET, num, cat)

    def encode(d):
        e = enc.transform(d, with_label=True).select(F.col("id").alias("row_id"), F.col(TARGET).alias("label"), K.LABEL_IDX, "features")
        return E.with_class_weight(e, "label", {"high": E.CLASS_BOOSTS["high"]})   # boosted trees also boost mid

    tr = cut_lineage(encode(spread(train, "id")))   # iterative fits wait for the largest part in every pass
    te = cut_lineage(encode(test))
    first = tr.select("features").first()
    n = first[0].size if first else 0
    return Prepared(enc, tr, te, n, fit, train, test)


KEEP = ("row_id", "label")


def fit_logreg(p: Prepared, train: DataFrame | None = None, weight: str = "weight") -> K.Classifier:
    return K.Classifier("plain", [K.logreg(weight).fit(p.train if train is None else train)])


def fit_random_forest(p: Prepared, train: DataFrame | None = None, num_trees: int = 300, max_depth: int = 10) -> K.Classifier:
    return K.Classifier("plain", [K.random_forest("weight", num_trees, max_depth=max_depth).fit(p.train if train is None else train)])


def class_weight_list(p: Prepared, labels: DataFrame, boosts=E.CLASS_BOOSTS) -> list[float]:
    """Class weights in label order; a class without rows weighs 0."""
    table = {r["label"]: r["weight"] for r in E.class_weights(labels, "label", boosts).collect()}   # a row per class
    return [float(table.get(c) or 0.0) for c in p.enc.classes]


def fit_gbt(p: Prepared, train: DataFrame | None = None, max_iter: int = 100) -> K.Classifier:
    """Boosted trees, a tree per class in each round, with boosts for high and mid; stopped early on a tenth of the rows."""
    from tabforge.operators.split import validation_flag
    tr = p.train if train is None else train
    held = validation_flag(tr, "row_id", 0.1).withColumn("is_validation", F.col("is_validation") == 1)
    return K.Classifier("boosted", B.fit_boosted(held, [class_weight_list(p, tr)], validation="is_validation", rounds=max_iter))


def fit_mlp(p: Prepared, train: DataFrame | None = None, max_iter: int = 400) -> K.Classifier:
    return K.Classifier("plain", [K.mlp(p.n_features, len(p.enc.classes), max_iter=max_iter).fit(p.train if train is None else train)])


def fit_pca_logreg(p: Prepared, share: float = 0.95) -> K.Classifier:
    """Logistic regression on the principal components that explain ``share`` of the variance, from one PCA."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorSlicer
    pca, ratios = K.pca_variance(p.train)
    first = VectorSlicer(inputCol="__pca", outputCol="__pca_k", indices=list(range(K.components_for(ratios, share))))
    reduced = first.transform(pca.transform(p.train))
    model = K.logreg("weight").setFeaturesCol("__pca_k").fit(reduced)
    return K.Classifier("plain", [PipelineModel([pca, first, model])])


def evaluate(name: str, pred: DataFrame) -> DataFrame:
    """One runs-table row: accuracy, macro F1, balanced accuracy, ordinal MAE, macro OvR AUC."""
    return M.run_metrics(pred, f"run-{name}", name)


MODEL_NAME = "occupancy-classifier"


def train_job(spark: SparkSession, p: Prepared, root: str, fits: dict, vote: bool = True) -> int:
    """The training job: fit every model, store its run with its bundle, promote the best run; returns the new version.

    ``fits`` maps a model name to a function from the prepared tables to a classifier; with ``vote``
    their soft vote is a model too.  A run's id is the model's name and a number that is still free.
    """
    from tabforge.operators.store import Registry, Runs
    from tabforge.plans.bundle import Bundle
    runs = Runs(spark, root)
    made: dict[str, K.Classifier] = {name: fit(p) for name, fit in fits.items()}
    if vote and len(made) > 1:
        made["ensemble"] = K.Classifier("vote", list(made.values()))
    done = []
    for name, clf in made.items():
        taken = set(runs.ids())
        run_id = next(i for i in (f"{name}-{n}" for n in itertools.count(1)) if i not in taken)
        bundle = Bundle(p.fit, p.enc, clf)
        done.append(runs.evaluate(run_id, name, clf.predict(p.test, p.enc.classes, KEEP), lambda folder, b=bundle: b.write(spark, folder)))
    best = M.select_best(runs.table().where(F.col("run_id").isin(done)), "mae")
    return Registry(spark, root).promote(MODEL_NAME, best)


def fold_counts(p: Prepared, fits: dict, k: int = 5, parallel: int = 4, seed_table: DataFrame | None = None) -> DataFrame:
    """``model_name, fold, label, pred, n``: confusion counts of every model on every left-out fold.

    The folds are written once; each fit reads its rows from there.  A fold's counts (a row per pair
    of classes) are taken as soon as its model is fitted, so no plan carries more than one model.
    Up to ``parallel`` fits run side by side: one fit alone leaves most of a cluster idle.
    """
    from pyspark.util import inheritable_thread_target
    from tabforge.operators.split import stratified_folds
    spark = p.train.sparkSession
    folded = stored(stratified_folds(seed_table if seed_table is not None else p.train, "label", "row_id", k), "folds")

    def one(task):
        name, fit, fold = task
        clf = fit(folded.filter(F.col("fold") != fold))
        pred = clf.predict(folded.filter(F.col("fold") == fold), p.enc.classes, KEEP)
        return [(name, fold, r["label"], r["pred"], r["n"]) for r in M.confusion_matrix(pred).collect()]   # classes squared

    tasks = [(name, fit, f) for name, fit in fits.items() for f in range(k)]
    with ThreadPool(parallel) as pool:
        rows = [r for part in pool.map(inheritable_thread_target(spark)(one), tasks, chunksize=1) for r in part]
    return spark.createDataFrame(rows, "model_name string, fold int, label string, pred string, n long")


def cross_validate(p: Prepared, fits: dict, k: int = 5) -> DataFrame:
    """K8: per model mean and population sd of balanced accuracy and macro F1 over ``k`` folds, and the rows they cover.

    ``fits`` maps a model name to a function from training rows to a classifier.
    """
    counts = fold_counts(p, fits, k)
    per = M.metrics_of_counts(counts, ["model_name", "fold"])
    return per.groupBy("model_name").agg(
        F.avg("bal_acc").alias("bal_acc_mean"), F.stddev_pop("bal_acc").alias("bal_acc_sd"), F.avg("f1_macro").alias("f1_mean"),
        F.stddev_pop("f1_macro").alias("f1_sd"), F.count(F.lit(1)).alias("folds"), F.sum("rows").alias("rows"))


def weight_search(p: Prepared, high_factors=(1.6, 1.8, 2.0), mid_factors=(1.0, 1.1, 1.2), k: int = 5, rounds: int = 60) -> DataFrame:
    """K7: boosted trees for each (high, mid) boost of the class weights; means over folds of F1(high), F1(mid) and
    balanced accuracy; best first.

    The models of all boosts and folds (nine boosts and five folds: 45) grow side by side in the same
    passes over one binned table; each left-out row is told by the models that left its fold out, and
    confusion counts are all that is gathered.
    """
    from tabforge.operators.split import stratified_folds
    folded = stored(stratified_folds(p.train.drop("weight"), "label", "row_id", k), "folds")
    grid = [(hf, mf) for hf in high_factors for mf in mid_factors]
    weights = [class_weight_list(p, p.train, {"high": hf, "mid": mf}) for hf, mf in grid]
    made = B.fit_boosted(folded, [w for w in weights for _ in range(k)], leave_out=[f for _ in grid for f in range(k)], fold="fold", rounds=rounds)
    counts = B.confusion_by_fold(folded, made, [f for _ in grid for f in range(k)], "fold", p.enc.classes)
    factors = p.train.sparkSession.createDataFrame([(i * k + f, hf, mf) for i, (hf, mf) in enumerate(grid) for f in range(k)],
                                                   "model int, high_factor double, mid_factor double")
    per = M.metrics_of_counts(counts, ["model", "fold"], classes=("high", "mid")).join(F.broadcast(factors), "model")   # a row per model
    out = per.groupBy("high_factor", "mid_factor").agg(
        F.avg(F.col("f1_high") + F.col("f1_mid")).alias("objective"), F.avg("f1_high").alias("f1_high"), F.avg("f1_mid").alias("f1_mid"),
        F.avg("bal_acc").alias("bal_acc"), F.sum("rows").alias("rows"))
    return out.orderBy(F.col("objective").desc(), F.col("f1_high").desc(), F.col("bal_acc").desc(), "high_factor", "mid_factor")
