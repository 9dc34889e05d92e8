"""Imputation operators (I1-I5, I7): statistics fitted on one table, applied to any.

Fits are small aggregates (one row per group, or one row overall); they are
applied with checked-broadcast lookups or ``fillna`` on the lazily planned data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.lookup import lookup_join, nearest_key_join
from tabforge.operators.quantiles import group_quantile, quantiles
from tabforge.session import cut_lineage, stored


def fit_medians(fit_df: DataFrame, cols, accuracy: int | None = None) -> dict:
    """Medians of ``cols`` over ``fit_df``.

    Exact by default; ``accuracy`` uses ``percentile_approx`` (bounded memory per column).
    """
    cols = list(cols)
    if not cols:
        return {}
    if not accuracy:
        return {c: found[0] for c, found in quantiles(fit_df, cols, [0.5]).items()}
    row = fit_df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fill_with_median(df: DataFrame, cols, fit_df: DataFrame | None = None) -> DataFrame:
    med = fit_medians(fit_df if fit_df is not None else df, cols)
    return df.fillna({c: v for c, v in med.items() if v is not None})


def mode_by_group(df: DataFrame, group_cols, value_col: str, alias: str | None = None) -> DataFrame:
    """Most frequent non-null value per group (smallest value on ties); null groups dropped.

    Two partial aggregates: (group, value) counts, then ``min_by`` per group, so
    a group holding a large share of the rows is combined map-side.
    """
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    counts = (df.filter(F.col(value_col).isNotNull()).dropna(subset=group_cols)
              .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("__cnt")))
    return counts.groupBy(*group_cols).agg(
        F.min_by(F.col(value_col), F.struct(-F.col("__cnt"), F.col(value_col))).alias(alias or f"{value_col}_mode"))


def global_modes(df: DataFrame, cols) -> dict:
    """Most frequent non-null value of each column (smallest on ties), one job for all columns.

    The columns are unpivoted to (column, value), counted per pair (partial aggregation,
    so a value held by a third of the rows is combined map-side), and reduced with
    ``min_by`` per column; only one row per column comes back.
    """
    cols = list(cols)
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("__c"), F.col(c).cast("string").alias("__v")) for c in cols])).alias("s")
    ).select("s.*").filter(F.col("__v").isNotNull())
    counts = long.groupBy("__c", "__v").agg(F.count(F.lit(1)).alias("__n"))
    best = counts.groupBy("__c").agg(F.min_by("__v", F.struct(-F.col("__n"), F.col("__v"))).alias("__m"))
    return {r["__c"]: r["__m"] for r in best.collect()}


def median_by_grains(df: DataFrame, a: str, b: str, value_col: str) -> DataFrame:
    """Exact medians at (a, b), (a) and overall; ``grain`` = grouping id of a rollup.  No grain is one task's work."""
    src = stored(df.select(a, b, value_col), "grains")
    whole = lambda c: F.lit(None).cast(src.schema[c].dataType).alias(c)
    grains = [F.struct(a, b, F.lit(0).cast("long").alias("grain")), F.struct(a, whole(b), F.lit(1).cast("long").alias("grain")),
              F.struct(whole(a), whole(b), F.lit(3).cast("long").alias("grain"))]
    each = src.select(F.explode(F.array(*grains)).alias("g"), value_col).select("g.*", value_col)
    return group_quantile(each, [a, b, "grain"], value_col, 0.5, "median").select(a, b, "median", "grain")


@dataclass
class ModeFit:
    """Fitted statistics of one mode imputation: modes per reference value, and the median of what is left."""
    target: str
    ref: str
    modes: DataFrame
    median: float | None
    nearest: bool = False


def _from_modes(df: DataFrame, fit: ModeFit) -> DataFrame:
    out = lookup_join(df, fit.modes, fit.ref)
    if fit.nearest:
        out = nearest_key_join(out, fit.ref, fit.modes, fit.ref, "__mode")
        out = out.withColumn("__mode", F.coalesce("__mode", "__mode_nearest")).drop("__mode_nearest")
    return out.withColumn(fit.target, F.coalesce(F.col(fit.target), F.col("__mode").cast(df.schema[fit.target].dataType))).drop("__mode")


def fit_mode_impute(fit_df: DataFrame, target: str, ref: str, nearest: bool = False) -> ModeFit:
    """I1 fit: the mode per reference group, and for numbers the median of the column once modes are filled in."""
    fit = ModeFit(target, ref, mode_by_group(fit_df, ref, target, "__mode"), None, nearest)
    if isinstance(fit_df.schema[target].dataType, T.NumericType):
        fit.median = fit_medians(_from_modes(fit_df, fit).select(target), [target])[target]
    return fit


def apply_mode_impute(df: DataFrame, fit: ModeFit) -> DataFrame:
    """I1 apply: the mode of the row's group, else the fitted median."""
    out = _from_modes(df, fit)
    if fit.median is not None:
        out = out.fillna({fit.target: fit.median})
    return out.select(*df.columns)


def mode_impute_by(df: DataFrame, target: str, ref: str, fit_df: DataFrame | None = None,
                   nearest: bool = False) -> DataFrame:
    """I1 (and I2 step): fill ``target`` from the mode of its ``ref`` group; remaining -> median.

    With ``nearest=True`` a row whose numeric ``ref`` has no mode takes the mode of
    the nearest group key (J6) before the median fallback.
    """
    return apply_mode_impute(df, fit_mode_impute(fit_df if fit_df is not None else df, target, ref, nearest))


def mode_impute_chain(df: DataFrame, steps, fit_df: DataFrame | None = None) -> DataFrame:
    """Successive (target, ref) mode imputations; a ref with nulls is an error."""
    for target, ref in steps:
        if not df.filter(F.col(ref).isNull()).isEmpty():
            raise ValueError(f"reference column {ref!r} has nulls")
        numeric_ref = isinstance(df.schema[ref].dataType, T.NumericType)
        fitting = fit_df
        if fit_df is not None:  # later steps refer to columns that earlier ones fill, in the fitting rows too
            fit_df = cut_lineage(mode_impute_by(fitting, target, ref, nearest=numeric_ref))
        df = cut_lineage(mode_impute_by(df, target, ref, fit_df=fitting, nearest=numeric_ref))   # a step reads the last one's rows, not its plan
    return df


def fit_price_medians(train: DataFrame, price_col: str, a: str, b: str):
    """I3 fit: medians by (a, b), by a, and overall from the training rows."""
    grains = cut_lineage(median_by_grains(train, a, b, price_col))   # a row per group
    pair = grains.filter(F.col("grain") == 0).select(a, b, F.col("median").alias("__m_pair")).dropna()
    single = grains.filter(F.col("grain") == 1).select(a, F.col("median").alias("__m_one")).dropna()
    top = grains.filter(F.col("grain") == 3).select("median").first()
    overall = top["median"] if top else None
    return pair, single, overall


def price_impute(df: DataFrame, fit, price_col: str, a: str, b: str, out_col: str = "price_imputed") -> DataFrame:
    """I3 apply: price <- pair median <- single median <- global median, plus ``price_was_missing``."""
    pair, single, overall = fit
    out = lookup_join(lookup_join(df, pair, [a, b]), single, a)
    return (out.withColumn(out_col, F.coalesce(F.col(price_col), "__m_pair", "__m_one", F.lit(overall)))
            .withColumn("price_was_missing", F.col(price_col).isNull().cast("int"))
            .drop("__m_pair", "__m_one"))


def fit_remaining(train: DataFrame, exclude=()) -> dict:
    """I4 fit: numeric -> median, text -> mode (smallest on ties) or 'unknown'; one aggregate."""
    num, cat = [], []
    for f in train.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.NumericType):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            cat.append(f.name)
    row = fit_medians(train, num)
    modes = global_modes(train, cat)
    fill = {c: row[c] for c in num if row[c] is not None}
    fill.update({c: modes.get(c, "unknown") for c in cat})
    return fill


def apply_fill(df: DataFrame, fill: dict) -> DataFrame:
    """Fill nulls with fitted values, casting each value to the column's own type."""
    cols = []
    for f in df.schema.fields:
        if f.name in fill:
            cols.append(F.coalesce(F.col(f.name), F.lit(fill[f.name]).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def simple_imputer_fit(train: DataFrame, num_cols, cat_cols) -> dict:
    """Median for numeric columns, most frequent for text columns (inside the encoder)."""
    row = fit_medians(train, num_cols)
    out = {k: v for k, v in row.items() if v is not None}
    out.update(global_modes(train, cat_cols))
    return out


def constant_fill(df: DataFrame, values: dict) -> DataFrame:
    """Serving fallbacks (e.g. price 50.0; absent expected columns as 0)."""
    out = df
    for c, v in values.items():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(v))
    return apply_fill(out, values)
