from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def present(df: DataFrame, cols) -> list[str]:
    """Columns of ``cols`` that exist in ``df`` (schema-optional operators skip the rest)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def require_columns(df: DataFrame, cols) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"required columns not found: {missing}")
    return df
