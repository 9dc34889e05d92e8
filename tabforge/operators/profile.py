"""Profiling aggregates: value shares (A6) and the numeric-coercion report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.scalars import numeric_coerce
from tabforge.operators.lookup import with_totals


def numeric_coerce_report(df: DataFrame, cols, min_valid_frac: float = 0.5) -> DataFrame:
    """Share of values that parse as numbers per column, and whether it reaches ``min_valid_frac``."""
    wide = df.agg(*[F.avg(numeric_coerce(c).isNotNull().cast("double")).alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "column_name", "valid_frac")
    return long.select("column_name", F.round("valid_frac", 6).alias("valid_frac"),
                       (F.col("valid_frac") >= min_valid_frac).cast("int").alias("usable"))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Count and share of each value (``value_counts(normalize=True)``)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return with_totals(counts, __total="n").withColumn("share", F.col("n") / F.col("__total")).drop("__total")
