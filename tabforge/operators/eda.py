"""Exploratory aggregates (A9-A24) and univariate feature scores.

Everything is a small number of aggregates over the data followed by work on
the (tiny) aggregated tables; correlations of one-hot dummies use the closed
form from per-level sums over an unpivoted long table instead of
materialising one column per dummy.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabforge.functions.nulls import MASK_TOKENS, is_missing
from tabforge.functions.scalars import numeric_coerce
from tabforge.operators.lookup import with_totals
from tabforge.operators.ordered import rank_correlation
from tabforge.operators.quantiles import group_quantile, group_quantiles
from tabforge.session import stored

# Occupancy bands (days, inclusive) and the top-code of the source.
OCC_TOP_CODE = 255
# Balanced class weights are boosted for these classes.
CLASS_BOOSTS = {"high": 1.8, "mid": 1.1}
# Missingness classification.
MECH_EFFECT_MIN = 0.05
MECH_DRIVER_MAX_MISSING_PCT = 50
MECH_MAX_LEVELS = 30
MECH_MIN_VALID_FRAC = 0.5


def _all() -> Window:
    return Window.partitionBy()


def skewness(df: DataFrame, col: str) -> DataFrame:
    """Adjusted sample skewness of ``col`` and of log1p over its positive values."""
    x = F.col(col).cast("double")
    lx = F.when(x > 0, F.log1p(x))

    def adj(e):
        n = F.count(e)
        return F.try_divide(F.skewness(e) * F.sqrt(n * (n - 1)), n - 2)
    return df.agg(adj(x).alias("skew_raw"), adj(lx).alias("skew_log1p"))


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """A10: equal-width bin counts over [lo, hi] (data range by default); last edge inclusive, all bins listed."""
    spark = df.sparkSession
    x = F.col(col).cast("double")
    if lo is None or hi is None:
        r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
        lo = r["lo"] if lo is None else lo
        hi = r["hi"] if hi is None else hi
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = (df.filter(x.isNotNull() & (x >= lo) & (x <= hi)).groupBy(b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def box_stats(df: DataFrame, cat: str, col: str) -> DataFrame:
    """Per category quartiles, IQR whisker ends (last datum within 1.5 IQR) and outlier count."""
    x = F.col(col).cast("double")
    df = stored(df.select(cat, col).filter(x.isNotNull()), "box-stats")
    q = group_quantiles(df, [cat], col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    joined = df.select(cat, x.alias("__x")).filter(F.col("__x").isNotNull()).join(q, cat)
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("__x") >= lo) & (F.col("__x") <= hi)
    return joined.groupBy(cat, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("__x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))


def price_vs_capacity(df: DataFrame, capacity: str, cat: str, price: str) -> DataFrame:
    """Count, median and mean price per (capacity, category)."""
    df = stored(df.select(capacity, cat, price).filter(F.col(price).isNotNull()), "price-capacity")
    medians = group_quantile(df, [capacity, cat], price, 0.5, "median_price").withColumnsRenamed({capacity: "__a", cat: "__b"})
    plain = df.groupBy(capacity, cat).agg(F.count(F.lit(1)).alias("n"), F.avg(price).alias("mean_price"))
    same = F.col(capacity).eqNullSafe(F.col("__a")) & F.col(cat).eqNullSafe(F.col("__b"))
    return plain.join(medians, same).select(capacity, cat, "n", "median_price", "mean_price")


def kde_grid(df: DataFrame, col: str, grid_points: int = 200, bins: int = 1024) -> DataFrame:
    """Gaussian density (Scott bandwidth) on an even grid over the data range.

    The data are first binned into ``bins`` equal-width bins (one aggregate); the
    density sums the kernel over bin centres weighted by counts, so the work after
    the scan is ``bins x grid_points`` regardless of the table size.
    """
    x = F.col(col).cast("double")
    st = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"), F.stddev_samp(x).alias("sd")).first()
    lo, hi, n, sd = st["lo"], st["hi"], st["n"], st["sd"]
    bw = sd * n ** (-0.2)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    centres = (df.filter(x.isNotNull()).groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("c"))
               .select((F.lit(lo) + (F.col("b") + 0.5) * F.lit(width)).alias("xc"), "c"))
    step = (hi - lo) / (grid_points - 1) if hi > lo else 0.0
    bw = bw if bw else 1.0
    grid = F.array(*[F.lit(lo + i * step) for i in range(grid_points)])
    pairs = centres.select("xc", "c", F.explode(grid).alias("g"))
    z = (F.col("g") - F.col("xc")) / F.lit(bw)
    norm = 1.0 / (n * bw * math.sqrt(2 * math.pi))
    return pairs.groupBy("g").agg((F.sum(F.col("c") * F.exp(-0.5 * z * z)) * F.lit(norm)).alias("density"))


def occupancy_bands(df: DataFrame, days_col: str, clip_max: int = 365, top_code: int = OCC_TOP_CODE) -> DataFrame:
    """Percent of ALL rows with 0 / 1-30 / 31-120 / >=121 days (after clip), top-code count and share."""
    d = numeric_coerce(days_col)
    d = F.when(d.isNull(), None).otherwise(F.least(F.greatest(d, F.lit(0.0)), F.lit(float(clip_max))))

    def pct(pred):
        return (F.avg(F.when(F.coalesce(pred, F.lit(False)), 1.0).otherwise(0.0)) * 100)
    raw = F.col(days_col).cast("double")
    return df.agg(pct(d == 0).alias("pct_zero"), pct(d.between(1, 30)).alias("pct_low"),
                  pct(d.between(31, 120)).alias("pct_mid"), pct(d >= 121).alias("pct_high"),
                  F.count_if(raw == top_code).alias("n_top_code"),
                  F.avg(F.when(F.coalesce(raw >= top_code, F.lit(False)), 1.0).otherwise(0.0)).alias("share_top_code"))


def target_audit(df: DataFrame, days_col: str, avail_col: str) -> DataFrame:
    """Agreement of the occupancy rate with 1 - availability/365."""
    rate = F.when(F.col(days_col).isNull(), None).otherwise(
        F.least(F.greatest(F.col(days_col).cast("double") / 365.0, F.lit(0.0)), F.lit(1.0)))
    approx = F.lit(1.0) - F.col(avail_col).cast("double") / 365.0
    return df.agg(F.corr(rate, approx).alias("corr"), F.max(F.abs(rate - approx)).alias("max_abs_diff"),
                  F.avg(F.abs(rate - approx)).alias("mae"))


def target_correlations(df: DataFrame, target: str, cols, scale: float = 365.0) -> DataFrame:
    """Pearson of the target rate with each column (pairwise complete), sorted by |r|."""
    y = F.col(target).cast("double") / scale
    wide = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "column_name", "corr")
    return long.filter(F.col("corr").isNotNull()).orderBy(F.abs("corr").desc(), "column_name")


def feature_target_corr(df: DataFrame, target: str, num_cols, cat_cols, scale: float = 365.0) -> DataFrame:
    """Pearson of each numeric feature and each one-hot dummy (first level dropped) with target/scale.

    Dummies never become columns: per (column, level) means over the unpivoted
    table give the binary-vs-continuous correlation in closed form.
    Zero-variance and all-null features are left out.
    """
    y = F.col(target).cast("double") / scale
    parts = []
    if num_cols:
        wide = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(c) for c in num_cols])
        parts.append(wide.unpivot([], list(num_cols), "feature", "corr"))
    if cat_cols:
        base = df.filter(y.isNotNull()).select(y.alias("__y"), *cat_cols)
        tot = base.agg(F.count(F.lit(1)).alias("n"), F.avg("__y").alias("m"), F.stddev_pop("__y").alias("s")).first()
        long = base.select("__y", F.explode(F.array(*[
            F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("level")) for c in cat_cols])).alias("s")
        ).select("__y", "s.*").filter(F.col("level").isNotNull())
        lv = long.groupBy("col", "level").agg((F.count(F.lit(1)) / F.lit(float(tot["n"]))).alias("share"), F.avg("__y").alias("mean"))
        first = lv.groupBy("col").agg(F.min("level").alias("__first"))
        lv = lv.join(first, "col").filter(F.col("level") != F.col("__first"))
        # correlation with a 0/1 column from means and the deviation, which lose no digits however many rows there are
        corr = (F.col("mean") - F.lit(tot["m"])) / F.lit(tot["s"]) * F.sqrt(F.col("share") / (1 - F.col("share")))
        parts.append(lv.select(F.concat_ws("_", "col", "level").alias("feature"),
                               F.when((F.col("share") < 1) & F.lit((tot["s"] or 0) > 0), corr).alias("corr")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("corr").isNotNull() & ~F.isnan("corr")).orderBy(F.abs("corr").desc(), "feature")


def null_pair_table(df: DataFrame, cols=None) -> DataFrame:
    """Per column pair (a before b): rows n, nulls of a, nulls of b and nulls of both.

    Each row is reduced to its null bits; every task adds up the matrix of products of the bit
    columns (a matrix product per batch), and the matrices, columns squared in size, are summed
    by cell.  So the cost does not depend on which nulls come together.
    """
    spark = df.sparkSession
    cols = list(cols or df.columns)
    k = len(cols)
    bits = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])

    def products(batches):
        total, n = np.zeros((k, k), np.int64), 0
        for batch in batches:
            raw = np.frombuffer("".join(batch.column(0).to_pylist()).encode(), np.uint8).reshape(-1, k)
            for at in range(0, len(raw), 1 << 20):   # counts up to here are exact in single precision
                part = (raw[at : at + (1 << 20)] == ord("1")).astype(np.float32)
                total += (part.T @ part).astype(np.int64)
            n += len(raw)
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1), pa.int32()), pa.array(np.append(j, -1), pa.int32()), pa.array(np.append(total[i, j], n), pa.int64())], ["i", "j", "n"])

    cells = df.select(bits.alias("bits")).mapInArrow(products, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()   # columns squared
    count = {(r["i"], r["j"]): r["n"] for r in cells}
    rows = [(a, b, count.get((-1, -1), 0), count.get((i, i), 0), count.get((j, j), 0), count.get((i, j), 0))
            for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    return spark.createDataFrame(rows, "col_a string, col_b string, n long, na long, nb long, nab long")


def null_correlation(df: DataFrame, cols=None) -> DataFrame:
    """Pearson (phi) between null indicators of columns that are sometimes but not always null."""
    t = null_pair_table(df, cols).select("col_a", "col_b", *[F.col(c).cast("double").alias(c)
                                                             for c in ("n", "na", "nb", "nab")])
    ok = (F.col("na") > 0) & (F.col("na") < F.col("n")) & (F.col("nb") > 0) & (F.col("nb") < F.col("n"))
    phi = ((F.col("n") * F.col("nab") - F.col("na") * F.col("nb"))
           / F.sqrt(F.col("na") * (F.col("n") - F.col("na")) * F.col("nb") * (F.col("n") - F.col("nb"))))
    return t.filter(ok).select("col_a", "col_b", phi.alias("corr"))


def null_distance(df: DataFrame, cols=None) -> DataFrame:
    """Euclidean distance between the null patterns of two columns (dendrogram input)."""
    t = null_pair_table(df, cols)
    return t.select("col_a", "col_b", F.sqrt(F.col("na") + F.col("nb") - 2 * F.col("nab")).alias("distance"))


def numeric_missing_effect(df: DataFrame, mask, x_col) -> DataFrame:
    """|mean(x | missing) - mean(x | present)| / sd(x); null when a side is empty or sd = 0."""
    x = x_col if not isinstance(x_col, str) else F.col(x_col).cast("double")
    m = F.coalesce(mask, F.lit(False))
    r = df.agg(F.avg(F.when(m, x)).alias("a"), F.avg(F.when(~m, x)).alias("b"), F.stddev_samp(x).alias("sd"))
    eff = F.when((F.col("sd") > 0) & F.col("a").isNotNull() & F.col("b").isNotNull(),
                 F.abs(F.col("a") - F.col("b")) / F.col("sd"))
    return r.select(eff.alias("effect"))


def categorical_missing_effect(df: DataFrame, mask, cat_col: str) -> DataFrame:
    """Max |share of a level among missing rows - share among present rows| (null level = 'Missing')."""
    m = F.coalesce(mask, F.lit(False))
    lvl = F.coalesce(F.col(cat_col).cast("string"), F.lit("Missing"))
    c = df.groupBy(lvl.alias("level")).agg(F.count_if(m).alias("a"), F.count_if(~m).alias("b"))
    d = with_totals(c, na="a", nb="b").select(F.abs(F.try_divide("a", "na") - F.try_divide("b", "nb")).alias("d"), "na", "nb")
    return d.agg(F.when((F.max("na") > 0) & (F.max("nb") > 0), F.max("d")).alias("effect"))


def driver_levels(df: DataFrame, columns=None, max_levels: int | None = MECH_MAX_LEVELS) -> DataFrame:
    """The text columns that may drive missingness, their distinct values and whether they are used (1..``max_levels``)."""
    cols = _text_columns(df, columns or df.columns)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, levels long, used boolean")
    # exact distinct counts of all text columns from one (column, value) aggregate; no Expand of
    # several COUNT(DISTINCT) aggregates
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols])).alias("s")).select("s.*")
    levels = pairs.distinct().groupBy("column_name").agg(F.count("v").alias("levels"))
    used = (F.col("levels") >= 1) & (F.lit(True) if max_levels is None else F.col("levels") <= max_levels)
    return levels.withColumn("used", used)


def _text_columns(df: DataFrame, cols) -> list:
    from pyspark.sql import types as T
    return [c for c in cols if isinstance(df.schema[c].dataType, (T.StringType, T.BooleanType))]


def _as_number(df: DataFrame, c: str):
    """``numeric_coerce``, without the way through text where the text of a number gives that number again."""
    from pyspark.sql import types as T
    kind, x = df.schema[c].dataType, F.col(c)
    if isinstance(kind, T.IntegralType):
        return x.cast("double")
    if isinstance(kind, T.DoubleType):   # others are written with an exponent, whose letter is dropped
        return F.when((F.abs(x) >= 1e-3) & (F.abs(x) < 1e7), x).otherwise(numeric_coerce(c))
    return F.lit(None).cast("double") if isinstance(kind, T.DateType) else numeric_coerce(c)


def _used_columns(df: DataFrame, names: dict, max_levels: int | None) -> set:
    """The names of the text columns (``names``: column -> name) with 1..``max_levels`` distinct values.

    A column with values in more hash cells than ``max_levels`` has more values, so only the others'
    values are told apart one by one.
    """
    cols = list(names)
    if not cols:
        return set()
    if max_levels is not None:
        cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.when(F.col(c).isNotNull(), F.pmod(F.xxhash64(c), F.lit(64 * (max_levels + 1)))).alias("h"))
                                              for c in cols])).alias("s")).select("s.*").distinct()
        cols = [r["c"] for r in cells.groupBy("c").agg(F.count("h").alias("n")).where(F.col("n").between(1, max_levels)).collect()]   # a row per column
    return {names[r["column_name"]] for r in driver_levels(df.select(*cols), None, max_levels).where("used").collect()} if cols else set()


def missingness_mechanism(df: DataFrame, columns=None, tokens=MASK_TOKENS, max_levels: int | None = MECH_MAX_LEVELS) -> DataFrame:
    """Classify each column with missing values as Estructural / MCAR / MAR / MNAR.

    Numeric drivers: columns whose numeric-coerced values parse for >= 50% of rows.
    Categorical drivers: text columns with 1..``max_levels`` distinct values (null -> 'Missing');
    None takes them all.  :func:`driver_levels` tells which columns that leaves out.
    All (column, driver) statistics come from two aggregates: one wide conditional
    aggregate for numeric drivers, one grouped aggregate over the unpivoted
    categorical drivers.  The best driver is the largest effect (ties: first driver).
    """
    cols = list(columns or df.columns)
    place = {c: i for i, c in enumerate(cols)}
    texts = _text_columns(df, cols)
    # masks, numbers and text are read by every aggregate: derived and written once
    df = stored(df.select(*[is_missing(c, tokens).alias(f"m{i}") for i, c in enumerate(cols)], *[_as_number(df, c).alias(f"x{i}") for i, c in enumerate(cols)],
                          *[F.col(c).cast("string").alias(f"t{place[c]}") for c in texts]), "masks")
    stats = df.agg(F.count(F.lit(1)).alias("__n"),
                   *[F.count_if(f"m{i}").alias(f"__m_{i}") for i in place.values()],
                   *[F.avg(F.col(f"x{i}").isNotNull().cast("double")).alias(f"__v_{i}") for i in place.values()]
                   ).first()
    n = stats["__n"]
    missing = {c: stats[f"__m_{i}"] for i, c in enumerate(cols)}
    num_drivers = [c for i, c in enumerate(cols) if (stats[f"__v_{i}"] or 0) >= MECH_MIN_VALID_FRAC]
    used = _used_columns(df, {f"t{place[c]}": c for c in texts}, max_levels)
    cat_drivers = [c for c in cols if c in used]
    targets = [c for c in cols if missing[c] > 0]
    spark = df.sparkSession
    if not targets:
        return spark.createDataFrame([], "column_name string, missing long, missing_pct double, category string,"
                                         " driver string, effect_size double")
    # numeric effects: drivers unpivoted to (driver, x) with the target masks alongside, then ONE grouped
    # aggregate per driver (conditional means per target + sd) instead of targets x drivers wide expressions
    eff_rows = []
    if num_drivers:
        mk = [f"__mk_{i}" for i in range(len(targets))]
        long = df.select(*[F.col(f"m{place[t]}").alias(mk[i]) for i, t in enumerate(targets)],
                         F.explode(F.array(*[F.struct(F.lit(j).alias("__j"), F.col(f"x{place[d]}").alias("__x"))
                                             for j, d in enumerate(num_drivers)])).alias("s")
                         ).select(*mk, "s.__j", "s.__x").filter(F.col("__x").isNotNull())
        aggs = [F.stddev_samp("__x").alias("sd")]
        for i in range(len(targets)):
            aggs += [F.avg(F.when(F.col(mk[i]), F.col("__x"))).alias(f"a_{i}"),
                     F.avg(F.when(~F.col(mk[i]), F.col("__x"))).alias(f"b_{i}")]
        for r in long.groupBy("__j").agg(*aggs).collect():   # one row per numeric driver
            j, sd = r["__j"], r["sd"]
            d = num_drivers[j]
            for i, t in enumerate(targets):
                if t == d:
                    continue
                a, b = r[f"a_{i}"], r[f"b_{i}"]
                if a is None or b is None or sd is None or sd == 0 or math.isnan(sd):
                    continue
                eff_rows.append((t, d, 0, j, float(abs(a - b) / sd)))
    # categorical effects: unpivot drivers, grouped conditional counts per target mask
    if cat_drivers:
        mk = [f"__mk_{i}" for i in range(len(targets))]
        long = df.select(*[F.col(f"m{place[t]}").cast("int").alias(mk[i]) for i, t in enumerate(targets)],
                         F.explode(F.array(*[F.struct(F.lit(d).alias("driver"),
                                                      F.coalesce(F.col(f"t{place[d]}"), F.lit("Missing")).alias("level"))
                                             for d in cat_drivers])).alias("s")).select(*mk, "s.driver", "s.level")
        g = long.groupBy("driver", "level").agg(F.count(F.lit(1)).alias("cnt"),
                                                *[F.sum(mk[i]).alias(f"m_{i}") for i in range(len(targets))])
        partial = {i: missing[t] for i, t in enumerate(targets) if missing[t] < n}
        gaps = [F.max(F.abs(F.col(f"m_{i}") / F.lit(mt) - (F.col("cnt") - F.col(f"m_{i}")) / F.lit(n - mt))).alias(f"e_{i}") for i, mt in partial.items()]
        if gaps:
            for row in g.groupBy("driver").agg(*gaps).collect():   # one row per categorical driver, however many levels
                j = cat_drivers.index(row["driver"])
                eff_rows += [(targets[i], row["driver"], 1, j, float(row[f"e_{i}"])) for i in partial if targets[i] != row["driver"]]
    return _classified(spark.createDataFrame([(t, int(missing[t])) for t in targets], "column_name string, missing long"),
                       spark.createDataFrame([(c, int(m)) for c, m in missing.items()], "driver string, driver_missing long"),
                       spark.createDataFrame(eff_rows, "column_name string, driver string, categorical int, place int, effect double"), n)


def _classified(targets: DataFrame, columns: DataFrame, effects: DataFrame, n: int) -> DataFrame:
    """The mechanism of each target column, from the effect of every driver on it (tables of columns, not rows).

    The strongest driver counts; ties go to numeric drivers, then to the earlier one.
    """
    percent = lambda c: F.round(c / F.lit(n) * 100, 2)
    strongest = effects.where(F.col("effect") > 0).groupBy("column_name").agg(
        F.max_by(F.struct("driver", "categorical", "effect"), F.struct("effect", -F.col("categorical"), -F.col("place"))).alias("d"))
    found = targets.join(strongest, "column_name", "left").withColumn("driver", F.col("d.driver")).join(columns, "driver", "left")
    all_gone = F.col("missing") == n
    category = (F.when(all_gone, "Estructural")
                .when(F.col("d").isNull() | (F.col("d.effect") < MECH_EFFECT_MIN), "MCAR")
                .when(percent(F.col("driver_missing")) < MECH_DRIVER_MAX_MISSING_PCT, "MAR").otherwise("MNAR"))
    shown = F.when(F.col("d.categorical") == 1, F.concat("driver", F.lit(" (categoría)"))).otherwise(F.col("driver"))
    return found.select("column_name", "missing", percent(F.col("missing")).alias("missing_pct"), category.alias("category"),
                        F.when(~all_gone, shown).alias("driver"), F.when(~all_gone, F.round("d.effect", 3)).alias("effect_size"))


def mechanism_summary(mech: DataFrame) -> DataFrame:
    """Columns and percent per category."""
    c = mech.groupBy("category").agg(F.count(F.lit(1)).alias("columns"))
    return c.withColumn("pct", F.col("columns") / F.sum("columns").over(_all()) * 100)


def top_effects(mech: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` columns whose missingness depends most on another column."""
    return mech.filter(F.col("effect_size").isNotNull()).orderBy(F.col("effect_size").desc(), "column_name").limit(k)


def class_weights(df: DataFrame, label: str, boosts=CLASS_BOOSTS) -> DataFrame:
    """Balanced weight n / (k * n_c) times a per-class boost, per class."""
    c = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w = _all()
    boost = F.create_map(*[v for k, b in boosts.items() for v in (F.lit(k), F.lit(float(b)))])[F.col(label)]
    return c.select(label, "n_c", (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c"))
                                   * F.coalesce(boost, F.lit(1.0))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, boosts=CLASS_BOOSTS, out: str = "weight") -> DataFrame:
    """Per-row weight column (the class table is at most one row per class)."""
    w = class_weights(df, label, boosts).select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(w), label, "left")


def anova_f(df: DataFrame, label: str, cols) -> DataFrame:
    """One-way ANOVA F per feature vs the class, from per-class n, mean and variance (one pass); nan/inf -> 0."""
    cols = list(cols)
    x = [F.col(c).cast("double") for c in cols]
    per = df.filter(F.col(label).isNotNull()).groupBy(label).agg(
        *[F.struct(F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v")).alias(f"__{i}") for i, v in enumerate(x)])
    long = per.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"__{i}.n").alias("n"), F.col(f"__{i}.m").alias("m"),
                                                   F.col(f"__{i}.v").alias("v")) for i, c in enumerate(cols)])).alias("s")).select("s.*").filter("n > 0")
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")   # a feature without values scores 0
    return names.join(f_of_classes(long), "feature", "left").select("feature", F.coalesce("f_stat", F.lit(0.0)).alias("f_stat"))


def f_of_classes(per: DataFrame) -> DataFrame:
    """``feature, f_stat`` from ``feature, n, m, v``: a row per class with its rows, mean and variance; nan/inf -> 0."""
    feature = Window.partitionBy("feature")   # one row per class
    long = per.withColumn("mean", F.sum(F.col("n") * F.col("m")).over(feature) / F.sum("n").over(feature))
    tot = long.groupBy("feature").agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("v")).alias("within"),
                                      F.sum(F.col("n") * (F.col("m") - F.col("mean")) * (F.col("m") - F.col("mean"))).alias("between"))
    f = F.try_divide(F.try_divide(F.col("between"), F.col("k") - 1), F.try_divide(F.col("within"), F.col("N") - F.col("k")))
    return tot.select("feature", F.when(f.isNull() | F.isnan(f) | (F.abs(f) == float("inf")), 0.0).otherwise(f).alias("f_stat"))


def mutual_information(df: DataFrame, label: str, cols, bins: int = 10) -> DataFrame:
    """MI (nats) between each feature, cut into ``bins`` equal-width bins, and the class.

    A plug-in contingency estimator (not the reference's k-NN estimator); the whole
    computation is one (feature, bin, class) count table.
    """
    rng = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo_{i}") for i, c in enumerate(cols)],
                 *[F.max(F.col(c).cast("double")).alias(f"hi_{i}") for i, c in enumerate(cols)]).first()
    structs = []
    for i, c in enumerate(cols):
        lo, hi = rng[f"lo_{i}"], rng[f"hi_{i}"]
        width = (hi - lo) / bins if (lo is not None and hi is not None and hi > lo) else 1.0
        x = F.col(c).cast("double")
        b = F.when(x.isNotNull(), F.least(F.floor((x - F.lit(lo if lo is not None else 0.0)) / F.lit(width)),
                                          F.lit(bins - 1))).cast("int")
        structs.append(F.struct(F.lit(c).alias("feature"), b.alias("bin")))
    long = (df.filter(F.col(label).isNotNull()).select(F.col(label).alias("__y"), F.explode(F.array(*structs)).alias("s"))
            .select("__y", "s.*").filter(F.col("bin").isNotNull()))
    cnt = long.groupBy("feature", "bin", "__y").agg(F.count(F.lit(1)).alias("nxy"))
    wf = Window.partitionBy("feature")
    t = cnt.select("feature", "bin", "__y", "nxy", F.sum("nxy").over(wf).alias("n"),
                   F.sum("nxy").over(Window.partitionBy("feature", "bin")).alias("nx"),
                   F.sum("nxy").over(Window.partitionBy("feature", "__y")).alias("ny"))
    d = {c: F.col(c).cast("double") for c in ("nxy", "n", "nx", "ny")}   # products of counts overflow a long
    term = d["nxy"] / d["n"] * F.log(d["nxy"] * d["n"] / (d["nx"] * d["ny"]))
    return t.groupBy("feature").agg(F.sum(term).alias("mi"))


def spearman(df: DataFrame, target: str, cols) -> DataFrame:
    """|Spearman| of each feature with the target (average ranks over pairwise-complete rows).

    One pass counts the distinct (feature, value, target) triples; a feature or target with one value
    has no correlation: null.
    """
    long = (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"),
                 F.col(target).cast("double").alias("t")) for c in cols])).alias("s"))
        .select("s.*").dropna(subset=["x", "t"]))
    found = rank_correlation(long.groupBy("feature", "x", "t").agg(F.count(F.lit(1)).alias("n")))
    return found.select("feature", F.abs("rho").alias("spearman"))
