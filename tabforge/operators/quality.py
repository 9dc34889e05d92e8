"""Data-quality and profiling operators.

All per-column statistics are computed in ONE wide aggregate (partial
aggregation on the map side) and then unpivoted; nothing loops over columns
with separate jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabforge.operators.quantiles import quantiles
from tabforge.session import stored

# Keyword groups of column names used by the missing-value share chart.
HOST_KEYWORDS = ("host", "night")
LISTING_KEYWORDS = (
    "listing_url", "scrape_id", "last_scraped", "source", "name", "description", "picture_url", "latitude",
    "longitude", "property_type", "room_type", "accommodates", "bathrooms", "bathrooms_text", "bedrooms", "beds",
    "amenities", "calendar_updated", "calendar_last_scraped", "license", "instant_bookable", "availability", "night",
    "tasa_ocupacion", "estimated_occupancy_l365d",
)
REVIEW_KEYWORDS = ("review",)
LOCATION_KEYWORDS = ("neighbourhood", "neighborhood_overview")
PRICE_COLUMNS = ("price", "estimated_revenue_l365d")
GROUP_LABELS = (("host", "Host info"), ("review", "Reviews"), ("price", "Price"),
                ("location", "Neighbourhood"), ("listing", "Listing"))


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """(column_name, missing, n) for every column, one aggregate."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["__n"], cols, "column_name", "missing")
    return long.withColumnRenamed("__n", "n")


def missing_table(df: DataFrame, cols=None) -> DataFrame:
    """A1: columns with nulls, count and percent (fraction rounded to 4 places, x100)."""
    nc = null_counts(df, cols)
    return (nc.filter(F.col("missing") > 0)
            .select("column_name", "missing",
                    (F.round(F.col("missing") / F.col("n"), 4) * 100).alias("percent"))
            .orderBy(F.col("missing").desc(), "column_name"))


def column_groups(columns) -> list[tuple[str, str]]:
    """Column -> semantic group pairs (a column may fall in several groups; unmatched -> 'other')."""
    pairs = []
    for c in columns:
        lc = c.lower()
        host = any(k in lc for k in HOST_KEYWORDS)
        groups = []
        if host:
            groups.append("host")
        if any(k in lc for k in REVIEW_KEYWORDS):
            groups.append("review")
        if c in PRICE_COLUMNS:
            groups.append("price")
        if any(k in lc for k in LOCATION_KEYWORDS) and not host:
            groups.append("location")
        if any(k in lc for k in LISTING_KEYWORDS):
            groups.append("listing")
        if not groups:
            groups.append("other")
        pairs.extend((c, g) for g in groups)
    return pairs


def null_share_by_group(df: DataFrame) -> DataFrame:
    """A2: nulls per column group and share of the total ('other' counts in the total only)."""
    spark = _spark(df)
    # schema-sized table (one row per column/group pair), built from names only
    mapping = spark.createDataFrame(column_groups(df.columns), "column_name string, grp string")
    labels = spark.createDataFrame(list(GROUP_LABELS), "grp string, label string")
    per_col = null_counts(df).select("column_name", "missing")
    per_group = (per_col.join(F.broadcast(mapping), "column_name")
                 .groupBy("grp").agg(F.sum("missing").alias("nulls")))
    total = F.sum("nulls").over(Window.partitionBy())
    shares = per_group.withColumn("total_nulls", total)
    return (shares.join(F.broadcast(labels), "grp")
            .select(F.col("label").alias("group_name"), F.col("nulls").cast("long").alias("nulls"),
                    F.round(F.col("nulls") / F.col("total_nulls") * 100, 4).alias("share_pct")))


def column_profile(df: DataFrame) -> DataFrame:
    """A3: position, name, non-null count and type of every column."""
    spark = _spark(df)
    meta = spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(df.dtypes)],
                                 "position int, column_name string, dtype string")
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    counts = wide.unpivot([], df.columns, "column_name", "non_null")
    return counts.join(F.broadcast(meta), "column_name").select("position", "column_name", "non_null", "dtype")


def dtype_histogram(df: DataFrame) -> DataFrame:
    """A3: number of columns per type."""
    spark = _spark(df)
    meta = spark.createDataFrame([(c, t) for c, t in df.dtypes], "column_name string, dtype string")
    return meta.groupBy("dtype").agg(F.count(F.lit(1)).alias("n_columns"))


def numeric_columns(df: DataFrame, exclude_patterns=()) -> list[str]:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType) and not any(p in f.name.lower() for p in exclude_patterns):
            out.append(f.name)
    return out


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_describe(df: DataFrame, exclude_patterns=("id",), decimals: int = 4,
                     currency_cols=(), approx: bool = False, accuracy: int = 100000) -> DataFrame:
    """A4: count, mean, sd (n-1), min, quartiles, max per numeric column, rounded.

    ``approx=True`` swaps the exact quartiles for ``percentile_approx`` (bounded
    memory per column on very large tables).
    """
    cols = numeric_columns(df, exclude_patterns)
    probs = [0.25, 0.5, 0.75]
    if not approx:
        df = stored(df.select(*cols), "describe")   # read once per narrowing pass
        exact = quantiles(df, cols, probs)
    stats = []
    for c in cols:
        x = F.col(c).cast("double")
        q = F.percentile_approx(x, probs, accuracy) if approx else F.array(*[F.lit(v).cast("double") for v in exact[c]])
        stats.append(F.struct(F.lit(c).alias("column_name"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                              F.stddev_samp(x).alias("std"), F.min(x).alias("min"), q.alias("q"),
                              F.max(x).alias("max")).alias(c))
    wide = df.agg(*stats)
    long = wide.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("s")).select("s.*")
    r = lambda c: F.round(c, decimals)
    out = long.select(
        "column_name", "count", r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"),
        r(F.col("min")).alias("min"), r(F.col("q")[0]).alias("q25"), r(F.col("q")[1]).alias("q50"),
        r(F.col("q")[2]).alias("q75"), r(F.col("max")).alias("max"))
    if currency_cols:
        out = out.withColumn("mean_text", F.when(F.col("column_name").isin(list(currency_cols)),
                                                 F.concat(F.lit("$"), F.format_number("mean", decimals))))
    return out


def categorical_describe(df: DataFrame, cols=None) -> DataFrame:
    """A5: count, unique, top (most frequent; smallest on ties) and its frequency per text column."""
    cols = list(cols or string_columns(df))
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select("s.*").filter(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("freq"))
    return counts.groupBy("column_name").agg(
        F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by(F.struct("value", "freq"), F.struct(-F.col("freq"), F.col("value"))).alias("top"),
    ).select("column_name", "count", "unique", F.col("top.value").alias("top"), F.col("top.freq").alias("freq"))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key repeats an earlier row, and rows with a null key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    return per_key.agg(F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).cast("long").alias("duplicates"),
                       F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("cnt"))), F.lit(0)).cast("long")
                       .alias("null_keys"))


def dedup_first(df: DataFrame, key: str, order_cols) -> DataFrame:
    """Keep the first row per key under an explicit order (null keys form one group).

    A row number filtered to 1 is planned with a group limit before the shuffle, so a hot
    key is reduced to one row per task there, and each row travels once.  Rows equal in the
    order columns are told apart by the other columns.
    """
    cols = [c for c in df.columns if c != key]
    order = dict.fromkeys([*order_cols, *cols])
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").select(key, *cols)


def filter_present(df: DataFrame, col: str) -> DataFrame:
    """D3."""
    return df.filter(F.col(col).isNotNull())


def clip_quantile(df: DataFrame, col: str, q: float = 0.99, fit_df: DataFrame | None = None,
                  accuracy: int | None = None) -> DataFrame:
    """Rows with ``col`` <= the ``q`` quantile of the fit table.

    Exact (linear interpolation) by default; ``accuracy`` switches to the bounded-memory
    ``percentile_approx`` sketch (relative rank error 1/accuracy) for very large tables.
    """
    fit_df = fit_df if fit_df is not None else df
    x = F.col(col).cast("double")
    cut = fit_df.agg(F.percentile_approx(x, q, accuracy).alias("cut")).first()["cut"] if accuracy else quantiles(fit_df, [col], [q])[col][0]
    return df.filter(F.col(col) <= F.lit(cut))


def overlap_check(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Distinct groups on each side and how many appear on both (must be 0)."""
    tagged = (train.select(key, F.lit(1).alias("tr"), F.lit(0).alias("te"))
              .unionByName(test.select(key, F.lit(0).alias("tr"), F.lit(1).alias("te"))))
    per_key = tagged.groupBy(key).agg(F.max("tr").alias("tr"), F.max("te").alias("te"))
    return per_key.agg(F.sum("tr").cast("long").alias("train_groups"), F.sum("te").cast("long").alias("test_groups"),
                       F.count_if((F.col("tr") == 1) & (F.col("te") == 1)).alias("shared_groups"))


def assert_no_overlap(train: DataFrame, test: DataFrame, key: str) -> None:
    shared = train.select(key).distinct().join(test.select(key).distinct(), key, "left_semi")
    if not shared.isEmpty():
        raise AssertionError(f"groups of {key!r} appear on both sides of the split")
