"""Distributed ordered statistics: running sums and average ranks without a global window.

Rows are first aggregated per distinct ordering value; that table is written once, so the input is
read once, and its values are placed in value ranges (as many as it needs; bounds from
``approxQuantile``; Bucketizer does a binary search per row).  Running totals are: offset of the
range (a window over the small per-range table) + running sum inside the range (a window
partitioned by range).  Exact for any data; a hot value is one row after the first aggregate.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabforge.session import stored

#: Values wanted in a range, and most ranges (the per-range tables have a row for each).
RANGE_VALUES, MAX_RANGES = 50_000, 4096


def ranges_for(values: int) -> int:
    """How many value ranges a table of ``values`` distinct values is cut into."""
    return min(MAX_RANGES, max(8, -(-values // RANGE_VALUES)))


def _range_bucket(df: DataFrame, col: str, n_buckets: int, out: str = "__rb") -> DataFrame:
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = sorted(set(b for b in df.approxQuantile(col, probs, min(0.001, 0.25 / n_buckets)) if b is not None))
    splits = [float("-inf")] + ([b for b in bounds if abs(b) < float("inf")] or [0.0]) + [float("inf")]   # an empty table has no bounds
    src = df.withColumn("__bx", F.col(col).cast("double"))
    return Bucketizer(splits=splits, inputCol="__bx", outputCol=out, handleInvalid="keep").transform(src).drop("__bx")


def running_totals(df: DataFrame, part_cols, order_col: str, sum_cols, n_buckets: int | None = None) -> DataFrame:
    """Per distinct (part, order value): the sums of ``sum_cols`` at that value and strictly below it.

    Output columns: part cols, ``order_col``, ``<c>`` (at value) and ``<c>_below`` for each c.  The
    number of ranges follows the number of distinct values unless ``n_buckets`` names it.
    """
    part_cols = list(part_cols)
    sums = [F.sum(c).alias(c) for c in sum_cols]
    agg = stored(df.groupBy(*part_cols, order_col).agg(*sums), "ordered")
    agg = _range_bucket(agg, order_col, n_buckets or ranges_for(agg.count()))
    per_b = agg.groupBy(*part_cols, "__rb").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    w_b = Window.partitionBy(*part_cols).orderBy("__rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_b.select(*part_cols, "__rb",
                           *[F.coalesce(F.sum(f"__t_{c}").over(w_b), F.lit(0)).alias(f"__o_{c}") for c in sum_cols])
    w_in = Window.partitionBy(*part_cols, "__rb").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    inner = agg.select(*part_cols, "__rb", order_col, *sum_cols,
                       *[F.coalesce(F.sum(c).over(w_in), F.lit(0)).alias(f"__i_{c}") for c in sum_cols])
    keys = [*part_cols, "__rb"]   # null-safe: a null partition key is a partition too
    offsets = offsets.withColumnsRenamed({c: f"__k_{c}" for c in keys})
    out = inner.join(offsets, reduce(and_, (F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in keys)))
    return out.select(*part_cols, order_col, *sum_cols,
                      *[(F.col(f"__o_{c}") + F.col(f"__i_{c}")).alias(f"{c}_below") for c in sum_cols])


def average_rank(df: DataFrame, col: str, part_cols=(), out: str = "rank") -> DataFrame:
    """1-based average rank of ``col`` (ties share the mean rank) within ``part_cols``; nulls get null."""
    part_cols = list(part_cols)
    src = df.filter(F.col(col).isNotNull()).withColumn("__one", F.lit(1))
    rt = running_totals(src, part_cols, col, ["__one"])
    ranks = rt.select(*part_cols, col, (F.col("__one_below") + (F.col("__one") + 1) / 2.0).alias(out))
    ranks = ranks.withColumnsRenamed({c: f"__k_{c}" for c in [*part_cols, col]})
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in [*part_cols, col]))
    return df.join(ranks, same, "left").drop(*[f"__k_{c}" for c in [*part_cols, col]])


def rank_correlation(points: DataFrame) -> DataFrame:
    """``feature, rho``: Spearman's correlation of ``x`` and ``t`` from ``feature, x, t, n`` (n rows hold that pair).

    Ranks are found per distinct value and joined to the counted pairs, never to rows; sums are taken
    around the mean rank.  Null where ``x`` or ``t`` has a single value.
    """
    points = stored(points, "pairs")

    def ranks(c):
        below = running_totals(points, ["feature"], c, ["n"])
        return below.select("feature", c, (F.col("n_below") + (F.col("n") + 1) / 2.0).alias(f"__r{c}"))

    total = points.groupBy("feature").agg(F.sum("n").alias("__N"))
    both = points.join(ranks("x"), ["feature", "x"]).join(ranks("t"), ["feature", "t"]).join(total, "feature")
    dx, dt = (F.col(c) - (F.col("__N") + 1) / 2.0 for c in ("__rx", "__rt"))
    sums = both.groupBy("feature").agg(F.sum(F.col("n") * dx * dt).alias("xt"), F.sum(F.col("n") * dx * dx).alias("xx"), F.sum(F.col("n") * dt * dt).alias("tt"))
    return sums.select("feature", F.try_divide("xt", F.sqrt("xx") * F.sqrt("tt")).alias("rho"))
