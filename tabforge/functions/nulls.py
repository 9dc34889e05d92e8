"""Null spellings and missing masks (JVM-side expressions, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabforge.functions.common import as_col

# Text that must be read as "missing" (compared after trimming spaces).
# Union of the cleaning job's set, the notebook's reader list and pandas' default NA words.
NULL_TOKENS = (
    "", " ", "nan", "NaN", "null", "Null", "NULL", "none", "None", "NONE", "-", ".",
    "N/A", "NA", "na", "n/a",
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
)

# The smaller set the notebook's missingness study uses (no "-" or ".").
MASK_TOKENS = ("", " ", "nan", "NaN", "null", "Null", "NULL", "none", "None", "NONE")


def is_missing(c, tokens=NULL_TOKENS) -> Column:
    """True when null or when its trimmed text is one of ``tokens`` (never null)."""
    c = as_col(c)
    return c.isNull() | F.coalesce(F.trim(c.cast("string")).isin(list(tokens)), F.lit(False))


def normalize_missing(c, tokens=NULL_TOKENS) -> Column:
    """Value, or null when it spells a missing value."""
    c = as_col(c)
    return F.when(is_missing(c, tokens), F.lit(None)).otherwise(c)


def missing_mask(c, tokens=NULL_TOKENS) -> Column:
    """1 when the value is missing (C1 predicate), else 0."""
    return is_missing(c, tokens).cast("int")


def sql_token_list(tokens=NULL_TOKENS) -> str:
    """The token set as an SQL IN-list (used by the DuckDB oracles)."""
    return ", ".join("'" + t.replace("'", "''") + "'" for t in tokens)
