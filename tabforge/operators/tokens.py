"""Vocabulary, multi-hot / one-hot columns and reshaping."""

from __future__ import annotations

import re
from itertools import chain, count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.lists import SLUG_EMPTY, SLUG_PREFIX, parse_list_text

# The amenities the scoring service encodes.
SERVING_AMENITIES = ("wifi", "kitchen", "air_conditioning", "heating", "washer", "tv", "iron")


def topk(df: DataFrame, order, k: int) -> DataFrame:
    """Multi-key sort + first k rows (planned as a TakeOrdered, no full sort)."""
    return df.orderBy(*order).limit(k)


def top_vocabulary(df: DataFrame, list_col: str, k: int = 20) -> DataFrame:
    """Tokens by number of rows containing them, top ``k`` (ties by token)."""
    tokens = df.select(F.explode(F.array_distinct(F.col(list_col))).alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n_rows"))
    return topk(counts, [F.col("n_rows").desc(), F.col("token")], k)


def slug_names(tokens) -> list[str]:
    """Column names for vocabulary tokens; repeated slugs get _2, _3, ..."""
    used: dict[str, None] = {}  # names in order; membership is constant time
    for slug in (re.sub(r"[^a-z0-9]+", "_", t).strip("_") for t in tokens):
        first = SLUG_PREFIX + slug if slug else SLUG_EMPTY
        spellings = chain([first], (f"{first}_{n}" for n in count(2)))
        used[next(s for s in spellings if s not in used)] = None
    return list(used)


def fit_vocabulary(train: DataFrame, list_col: str, k: int = 20) -> list[str]:
    """The ``k`` (bounded) vocabulary tokens, in rank order."""
    return [r["token"] for r in top_vocabulary(train, list_col, k).collect()]


def multi_hot(df: DataFrame, list_col: str, vocabulary, count_col: str = "amenities_count",
              drop_source: bool = True) -> DataFrame:
    """List size plus one 0/1 column per vocabulary token, in one projection."""
    names = slug_names(vocabulary)
    arr = F.col(list_col)
    cols = [F.size(arr).cast("int").alias(count_col)]
    cols += [F.array_contains(arr, F.lit(t)).cast("int").alias(n) for t, n in zip(vocabulary, names)]
    out = df.select("*", *cols)
    return out.drop(list_col) if drop_source else out


def amenity_features(df: DataFrame, text_col: str, vocabulary, single: bool = False) -> DataFrame:
    """Parse list text and multi-hot it with a fitted vocabulary; the text column is dropped."""
    parsed = df.withColumn("__items", parse_list_text(text_col, single=single)).drop(text_col)
    return multi_hot(parsed, "__items", vocabulary)


def one_hot(df: DataFrame, col: str, levels, drop_first: bool = False, prefix: str | None = None) -> DataFrame:
    """T5 (column form): one 0/1 column per known level; unknown and null -> all zero."""
    levels = list(levels)[1:] if drop_first else list(levels)
    p = prefix or col
    return df.select("*", *[F.coalesce((F.col(col) == F.lit(lv)).cast("int"), F.lit(0)).alias(f"{p}_{lv}")
                            for lv in levels])


def fit_levels(train: DataFrame, col: str, max_levels: int = 1000) -> list:
    """Sorted distinct non-null levels (bounded: raises when more than ``max_levels``)."""
    lv = train.select(col).dropna().distinct().orderBy(col).limit(max_levels + 1).collect()
    if len(lv) > max_levels:
        raise ValueError(f"{col!r} has more than {max_levels} levels; use the vector encoder")
    return [r[0] for r in lv]


def union_labels(*dfs: DataFrame) -> DataFrame:
    """Row-concatenation by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def concat_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Side-by-side columns of two tables sharing a key."""
    return left.join(right, key, "inner")
