"""Feature encoding and classifiers (E1-E7, K1-K5, I6); boosted trees are in :mod:`tabforge.operators.boosting`.

Every model is fitted by Spark ML's distributed estimators on a cached,
encoded training table; predictions come back as a table with one
probability column per class (``p_<class>``) so the SQL-checkable metric
operators in :mod:`tabforge.operators.metrics` apply unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import (PCA, Imputer, ImputerModel, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.scalars import nonfinite_to_null
from tabforge.operators.boosting import Boosted
from tabforge.operators.chained import fit_chained
from tabforge.operators.columns import round_int_like
from tabforge.operators.metrics import argmax_class
from tabforge.operators.neighbours import mi_of_cells
from tabforge.operators.quantiles import quantiles

LABEL_IDX = "label_idx"


@dataclass
class Encoder:
    """A fitted encoder: the Spark ``PipelineModel`` plus the text-column fill values."""
    model: PipelineModel          # feature stages only (usable on unlabeled rows)
    label_model: object           # StringIndexerModel for the target
    cat_fill: dict
    num_cols: list
    cat_cols: list
    classes: list

    def transform(self, df: DataFrame, with_label: bool = False) -> DataFrame:
        for c in self.num_cols + self.cat_cols:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("double" if c in self.num_cols else "string"))
        df = df.fillna({c: v for c, v in self.cat_fill.items()})
        out = self.model.transform(df)
        return self.label_model.transform(out) if with_label else out

    def slot_names(self) -> list:
        """A name per slot of the feature vector: the numeric columns, then ``column=level``; null for the slot of unseen levels."""
        told = [labels for st in self.model.stages if hasattr(st, "labelsArray") for labels in st.labelsArray]
        return self.num_cols + [n for c, labels in zip(self.cat_cols, told) for n in [*(f"{c}={v}" for v in labels), None]]


def split_columns(df: DataFrame, target: str, exclude=()) -> tuple[list, list]:
    num, cat = [], []
    for f in df.schema.fields:
        if f.name == target or f.name in exclude:
            continue
        if isinstance(f.dataType, T.NumericType):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            cat.append(f.name)
    return num, cat


def _median_imputer(train: DataFrame, num_cols, out_cols) -> ImputerModel:
    """The imputer of the columns' medians (NaN counts as missing, the lower of two middle values).

    It is fitted on one row that holds the exact medians of all columns, because its own fit sorts every value of every column.
    """
    types = dict(train.dtypes)
    known = train.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if types[c] in ("double", "float") else F.col(c) for c in num_cols])
    medians = quantiles(known, num_cols, [0.5], lower=True)
    row = train.sparkSession.createDataFrame([[medians[c][0] for c in num_cols]], T.StructType([T.StructField(c, T.DoubleType()) for c in num_cols]))
    return Imputer(strategy="median", inputCols=list(num_cols), outputCols=list(out_cols)).fit(row)


def fit_encoder(train: DataFrame, target: str, num_cols, cat_cols) -> Encoder:
    """E1 + E2: label index (alphabetical), numeric median fill + standardise, text mode fill + one-hot.

    Unseen or null levels encode as all zeros (StringIndexer 'keep' + OneHotEncoder dropLast).
    """
    from tabforge.operators.impute import global_modes
    cat_fill = global_modes(train, cat_cols)
    train = train.fillna(cat_fill)
    label_model = StringIndexer(inputCol=target, outputCol=LABEL_IDX, stringOrderType="alphabetAsc",
                                handleInvalid="skip").fit(train)
    stages = []
    imputed = [f"__imp_{c}" for c in num_cols]
    if num_cols:
        stages.append(_median_imputer(train, num_cols, imputed))
        stages.append(VectorAssembler(inputCols=imputed, outputCol="__num", handleInvalid="keep"))
        stages.append(StandardScaler(inputCol="__num", outputCol="__num_std", withMean=True, withStd=True))
    idx = [f"__idx_{c}" for c in cat_cols]
    ohe = [f"__ohe_{c}" for c in cat_cols]
    if cat_cols:
        stages.append(StringIndexer(inputCols=list(cat_cols), outputCols=idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="keep"))
    parts = (["__num_std"] if num_cols else []) + ohe
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    model = Pipeline(stages=stages).fit(train)
    classes = list(label_model.labels)
    return Encoder(model, label_model, cat_fill, list(num_cols), list(cat_cols), classes)


def standard_scale(df: DataFrame, cols, fit_df: DataFrame | None = None) -> DataFrame:
    """Z-score with the population standard deviation (column form)."""
    fit_df = fit_df if fit_df is not None else df
    row = fit_df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return df.withColumns({c: (F.col(c) - F.lit(row[f"m_{c}"])) / F.lit(row[f"s_{c}"]) for c in cols
                           if row[f"s_{c}"]})


def logreg(weight_col: str | None = None, max_iter: int = 500, reg: float = 0.0, tol: float = 1e-4):
    """K1: multinomial logistic regression (L-BFGS, stopping tolerance 1e-4)."""
    lr = LogisticRegression(featuresCol="features", labelCol=LABEL_IDX, family="multinomial", maxIter=max_iter,
                            regParam=reg, tol=tol)
    return lr.setWeightCol(weight_col) if weight_col else lr


def random_forest(weight_col: str | None = None, num_trees: int = 300, seed: int = 42, max_depth: int = 10,
                  min_leaf: int = 1):
    """K2: random forest.

    ``max_depth`` may be 0 to 30, Spark's limit; trees of unlimited depth do not exist in Spark.
    The default keeps cross-validation affordable; pass 30 for the deepest trees.
    """
    rf = RandomForestClassifier(featuresCol="features", labelCol=LABEL_IDX, numTrees=num_trees, seed=seed,
                                maxDepth=max_depth, minInstancesPerNode=min_leaf)
    return rf.setWeightCol(weight_col) if weight_col else rf


def mlp(n_features: int, n_classes: int, hidden=(128, 64), max_iter: int = 400, seed: int = 42):
    """K4: feed-forward network (sigmoid hidden layers, softmax output; Spark's MLP has no sample weights)."""
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol=LABEL_IDX,
                                          layers=[n_features, *hidden, n_classes], maxIter=max_iter, seed=seed)


def predictions(df: DataFrame, probabilities: str, classes, keep=("row_id", "label")) -> DataFrame:
    """Kept columns, ``p_<class>`` per class from an array of probabilities, and the most probable class ``pred``."""
    out = df.select(*keep, *[F.col(probabilities)[i].alias(f"p_{c}") for i, c in enumerate(classes)])
    return out.withColumn("pred", argmax_class(list(classes)))


@dataclass
class Classifier:
    """Fitted models and how their class probabilities combine.

    ``plain``: one Spark ML model; ``vote``: the mean of other classifiers (soft voting); ``boosted``: one
    multiclass model of :mod:`tabforge.operators.boosting`.  All members are applied in one pass
    over the table.
    """
    kind: str
    members: list

    def with_probabilities(self, df: DataFrame, out: str, each: bool = False) -> DataFrame:
        """``df`` with an array of class probabilities, in label order; with ``each`` a vote keeps its members' as ``<out>_<i>``."""
        cols, names = df.columns, []
        for i, m in enumerate(self.members):
            name = f"{out}_{i}"
            if self.kind in ("vote", "boosted"):
                df = m.with_probabilities(df, name)
            else:
                df = m.transform(df).withColumn(name, vector_to_array("probability")).select(*cols, *names, name)
            names.append(name)
        if self.kind in ("plain", "boosted"):
            return df.withColumnRenamed(names[0], out)
        # zipped outside the lambda: a model inlined into it would be applied once per class
        both = F.transform(F.arrays_zip(*names), lambda z: (z[names[0]] + sum((z[n] for n in names[1:]), F.lit(0.0))) / len(names))
        return df.withColumn(out, both).drop(*([] if each else names))

    def predict(self, df: DataFrame, classes, keep=("row_id", "label")) -> DataFrame:
        """Predictions table: kept columns, ``p_<class>`` per class and the most probable class ``pred``."""
        return predictions(self.with_probabilities(df, "__p"), "__p", classes, keep)

    def save(self, spark, path: str) -> None:
        from tabforge.operators.store import write_json
        write_json(spark, {"kind": self.kind, "members": len(self.members)}, f"{path}/kind")
        for i, m in enumerate(self.members):
            if self.kind == "vote":
                m.save(spark, f"{path}/{i}")
            elif self.kind == "boosted":
                write_json(spark, m.to_json(), f"{path}/{i}")
            else:
                PipelineModel([m]).write().save(f"{path}/{i}")

    @classmethod
    def load(cls, spark, path: str) -> "Classifier":
        from tabforge.operators.store import read_json
        meta = read_json(spark, f"{path}/kind")
        load = {"vote": lambda p: cls.load(spark, p), "boosted": lambda p: Boosted.from_json(read_json(spark, p))}.get(meta["kind"], PipelineModel.load)
        return cls(meta["kind"], [load(f"{path}/{i}") for i in range(meta["members"])])


def select_k_best(train: DataFrame, k: int = 20, label: str = LABEL_IDX, features: str = "features", out: str = "features_k"):
    """The slots of the feature vector with the greatest nearest-neighbour mutual information with the class.

    Takes min(k, all) slots, ties to the lower slot; returns (``VectorSlicer`` to apply, table of ``slot, mi``, slots taken).
    """
    slots = train.select(F.col(label).alias("cls"), F.posexplode(vector_to_array(features)).alias("feature", "x"))
    scores = mi_of_cells(slots).select(F.col("feature").alias("slot"), F.round("mi", 9).alias("mi"))
    taken = [r["slot"] for r in scores.orderBy(F.col("mi").desc(), "slot").limit(k).collect()]   # at most k
    return VectorSlicer(inputCol=features, outputCol=out, indices=taken), scores, taken


def pca_variance(train: DataFrame, features: str = "features", k: int | None = None):
    """Explained-variance ratio per principal component (Spark PCA centres the data)."""
    first = train.select(features).first()
    d = first[0].size if first else 0
    model = PCA(k=k or d, inputCol=features, outputCol="__pca").fit(train.select(features))
    return model, [float(x) for x in model.explainedVariance.toArray()]


def components_for(ratios, share: float) -> int:
    acc = 0.0
    for i, r in enumerate(ratios, start=1):
        acc += r
        if acc >= share:
            return i
    return len(ratios)


def mice_impute(train: DataFrame, cols, predictors=(), max_rounds: int = 20, tol: float = 1e-3,
                apply_to: DataFrame | None = None):
    """Chained-equation imputation by Bayesian ridge regressions, fitted on ``train``.

    Null, NaN and infinite cells (C23) of ``cols`` are filled; a column whose observed training values are
    all whole is rounded to whole numbers afterwards (C24).  See :func:`tabforge.operators.chained.fit_chained`.
    Returns (imputed train, imputed ``apply_to`` or None, rounds run).
    """
    fit = fit_chained(train, cols, predictors, max_rounds, tol)
    known = train.withColumns({c: nonfinite_to_null(F.col(c).cast("double")) for c in fit.cols})
    done = [round_int_like(fit.transform(df), fit.cols, known) if df is not None else None for df in (train, apply_to)]
    return done[0], done[1], len(fit.rounds)
