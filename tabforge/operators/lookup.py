"""Keyed lookups.

Lookup tables here are aggregates keyed by group; they are broadcast only
after their row count is checked against ``max_broadcast_rows`` (the count
runs on the already-aggregated table, so it is cheap).  Above the bound the
join is left to the planner (shuffle join, AQE may still switch at runtime).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabforge.operators.ordered import ranges_for
from tabforge.session import stored

MAX_BROADCAST_ROWS = 1_000_000


def checked_broadcast(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(small)`` when it has at most ``max_rows`` rows, else ``small`` unchanged.

    The candidate is kept in memory while it is counted, so the join that follows
    reuses the aggregate instead of recomputing it; a table over the bound is released.
    """
    kept = small.persist(StorageLevel.MEMORY_AND_DISK)
    n = kept.limit(max_rows + 1).count()
    if n <= max_rows:
        return F.broadcast(kept)
    kept.unpersist()
    return small


def with_totals(df: DataFrame, **totals: str) -> DataFrame:
    """``df`` with sums over all its rows (new column = column to sum).

    The sums are one aggregate, joined back as a one-row table, so no task sees all rows; a window
    over the whole table would send them to one.
    """
    sums = df.agg(*[F.sum(c).alias(o) for o, c in totals.items()]).withColumn("__one", F.lit(1))
    return df.withColumn("__one", F.lit(1)).join(F.broadcast(sums), "__one").drop("__one")   # one row


def lookup_join(df: DataFrame, lookup: DataFrame, keys, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left outer equi-join on one or more keys; unmatched or null key -> null values."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    clean = lookup.dropna(subset=keys)
    return df.join(checked_broadcast(clean, max_rows), keys, "left")


def split_members(df: DataFrame, members: DataFrame, key: str):
    """Rows whose key is in ``members`` and rows whose key is not."""
    m = members.select(key).distinct()
    return df.join(m, key, "left_semi"), df.join(m, key, "left_anti")


def freq_outer_align(df: DataFrame, cat_col: str, side_pred, normalize: bool = True) -> DataFrame:
    """Frequency of each category on the two sides of a predicate, aligned, missing -> 0.

    One ``groupBy`` with conditional counts replaces the full outer join of two tables.
    """
    side = F.coalesce(side_pred, F.lit(False))
    counts = df.groupBy(cat_col).agg(F.count_if(side).alias("n_a"), F.count_if(~side).alias("n_b"))
    if not normalize:
        return counts
    share = lambda n, total: F.coalesce(F.try_divide(F.col(n), F.col(total)), F.lit(0.0))
    return with_totals(counts, __a="n_a", __b="n_b").select(cat_col, share("n_a", "__a").alias("freq_a"), share("n_b", "__b").alias("freq_b"))


def nearest_key_join(df: DataFrame, ref_col: str, lookup: DataFrame, key_col: str, value_col: str,
                     n_buckets: int | None = None) -> DataFrame:
    """For each row, the lookup value of the key nearest to ``ref_col`` (ties -> smaller key).

    Exact and distributed, without forming (row, key) pairs: keys and the distinct
    row values are placed in ``n_buckets`` value ranges (bounds from
    ``approxQuantile`` of the keys; as many ranges as their number asks for unless
    named); the previous / next key is a window inside each range, and the carry
    from earlier / later ranges comes from a per-range table of at most
    ``n_buckets`` rows.  The result is looked up by the reference value, adding
    ``<value_col>_nearest``.
    """
    from pyspark.ml.feature import Bucketizer

    spark = df.sparkSession
    keys = (lookup.select(F.col(key_col).cast("double").alias("__k"), F.col(value_col).alias("__v"))
            .dropna(subset=["__k"]))
    keys = stored(keys, "keys")   # read for the bounds, the windows and the carries
    n_buckets = n_buckets or ranges_for(keys.count())
    bounds = sorted(set(keys.approxQuantile("__k", [i / n_buckets for i in range(1, n_buckets)], min(0.001, 0.25 / n_buckets))))
    splits = [float("-inf")] + bounds + [float("inf")]
    bz = Bucketizer(splits=splits, inputCol="__x", outputCol="__b", handleInvalid="keep")

    vtype = keys.schema["__v"].dataType
    k_side = bz.transform(keys.withColumn("__x", F.col("__k")))
    x_side = bz.transform(df.select(F.col(ref_col).cast("double").alias("__x")).dropna().distinct())
    events = (k_side.select("__b", "__x", F.lit(0).alias("__is_row"), "__k", "__v")
              .unionByName(x_side.select("__b", "__x", F.lit(1).alias("__is_row"),
                                         F.lit(None).cast("double").alias("__k"), F.lit(None).cast(vtype).alias("__v"))))
    kv = F.struct("__k", "__v")
    w_prev = Window.partitionBy("__b").orderBy("__x", "__is_row").rowsBetween(Window.unboundedPreceding, 0)
    # backwards with a growing frame: a frame up to the last row is gone through anew for every row
    w_next = Window.partitionBy("__b").orderBy(F.desc("__x"), F.desc("__is_row")).rowsBetween(Window.unboundedPreceding, 0)
    ev = events.select("__b", "__x", "__is_row",
                       F.last(F.when(F.col("__is_row") == 0, kv), ignorenulls=True).over(w_prev).alias("__prev"),
                       F.last(F.when(F.col("__is_row") == 0, kv), ignorenulls=True).over(w_next).alias("__next"))
    # carry across ranges: last key of earlier ranges, first key of later ranges (bounded table)
    per_b = k_side.groupBy("__b").agg(F.max_by(kv, "__k").alias("__hi"), F.min_by(kv, "__k").alias("__lo"))
    all_b = spark.range(len(splits) - 1).select(F.col("id").cast("double").alias("__b")).join(per_b, "__b", "left")
    wb_prev = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    wb_next = Window.orderBy("__b").rowsBetween(1, Window.unboundedFollowing)
    carry = all_b.select("__b", F.last("__hi", ignorenulls=True).over(wb_prev).alias("__cp"),
                         F.first("__lo", ignorenulls=True).over(wb_next).alias("__cn"))
    found = (ev.filter(F.col("__is_row") == 1).join(F.broadcast(carry), "__b", "left")
             .withColumn("__p", F.coalesce("__prev", "__cp")).withColumn("__n", F.coalesce("__next", "__cn")))
    dp = F.col("__x") - F.col("__p.__k")
    dn = F.col("__n.__k") - F.col("__x")
    pick = (F.when(F.col("__p").isNull(), F.col("__n.__v"))
            .when(F.col("__n").isNull(), F.col("__p.__v"))
            .when(dp <= dn, F.col("__p.__v")).otherwise(F.col("__n.__v")))
    nearest = found.select("__x", pick.alias(f"{value_col}_nearest"))
    # a row per value: a shuffle would send all rows of a common value to one task
    return lookup_join(df.withColumn("__x", F.col(ref_col).cast("double")), nearest, "__x").drop("__x")
