"""Target binning, splits and folds.

Splits are deterministic functions of a salted MD5 of the key, so they do not
depend on partitioning and survive recomputation after executor loss.  "First k
by hash" selections are a comparison with the hash at the boundary, so splitting
moves no rows.  Per-class ranks use a *bucketed rank*: rows are counted per (partition, 16-bit hash prefix) bucket, bucket offsets are a
running sum over that small count table, and the final rank is the offset plus
a row number inside one bucket.  No window ever spans a whole class or the
whole table, so a class holding a third of all rows is still spread over up to
65,536 independent window partitions.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabforge.session import cut_lineage

# Target bins (right-closed) and class names in order.
LEVELS = ("zero", "low", "mid", "high")
LEVEL_EDGES = (0, 30, 120)           # (-1,0] zero, (0,30] low, (30,120] mid, (120,366] high
CLIP_DAYS = 365
DEFAULT_SEED = 42


def occupancy_level(c, clip_max: float = CLIP_DAYS) -> Column:
    """G1: clip to [0, 365] then right-closed bins; null stays null."""
    x = F.col(c) if isinstance(c, str) else c
    x = F.when(x.isNull(), F.lit(None)).otherwise(F.least(F.greatest(x.cast("double"), F.lit(0.0)), F.lit(float(clip_max))))
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x <= LEVEL_EDGES[0], F.lit(LEVELS[0]))
            .when(x <= LEVEL_EDGES[1], F.lit(LEVELS[1]))
            .when(x <= LEVEL_EDGES[2], F.lit(LEVELS[2]))
            .otherwise(F.lit(LEVELS[3])))


def level_rank(c) -> Column:
    """Ordinal rank of a level name (zero=0 ... high=3)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.create_map(*[v for i, lv in enumerate(LEVELS) for v in (F.lit(lv), F.lit(i))])[x]


def salted_hash(key: Column, seed: int = DEFAULT_SEED) -> Column:
    """Hex MD5 of seed || key text (null key hashes as the empty text)."""
    return F.md5(F.concat(F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))))


def bucketed_rank(df: DataFrame, hash_col: str, part_cols=(), tiebreak=()) -> DataFrame:
    """Adds ``__rank``: 0-based position of each row ordered by (hash, tiebreak) within ``part_cols``."""
    part_cols = list(part_cols)
    b = F.substring(F.col(hash_col), 1, 4)
    with_b = df.withColumn("__bucket", b)
    counts = with_b.groupBy(*part_cols, "__bucket").agg(F.count(F.lit(1)).alias("__cnt"))
    w_off = Window.partitionBy(*part_cols).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(w_off), F.lit(0))).drop("__cnt")
    w_row = Window.partitionBy(*part_cols, "__bucket").orderBy(F.col(hash_col), *[F.col(c) for c in tiebreak])
    # null-safe: rows whose partition key is null are a partition too
    offsets = offsets.withColumnsRenamed({c: f"__k_{c}" for c in [*part_cols, "__bucket"]})
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in [*part_cols, "__bucket"]))
    ranked = (with_b.join(offsets, same).drop(*[f"__k_{c}" for c in [*part_cols, "__bucket"]])
              .withColumn("__rank", F.col("__off") + F.row_number().over(w_row) - 1))
    return ranked.drop("__bucket", "__off")


def hash_cut(keys: DataFrame, key: str, fraction: float, seed: int = DEFAULT_SEED) -> str:
    """The salted hash of the last of the ceil(fraction * n) distinct keys that come first by it ('' for none).

    The boundary is found from counts per hash prefix, one more 16-bit prefix a round, so only the
    hashes of one tiny bucket are ever ordered, and rows are then told apart by a comparison.
    """
    # the distinct hashes are read a few times: write them once
    hashes = cut_lineage(keys.select(salted_hash(F.col(key), seed).alias("__h")).distinct())
    k = int(math.ceil(fraction * hashes.count()))
    prefix, left = "", k
    if k == 0:
        return ""
    for size in (4, 8):
        inside = hashes.filter(F.col("__h").startswith(prefix)) if prefix else hashes
        counts = inside.groupBy(F.substring("__h", 1, size).alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()  # 65,536 rows at most
        for r in counts:
            if left <= r["n"]:
                prefix = r["p"]
                break
            left -= r["n"]
    return hashes.filter(F.col("__h").startswith(prefix)).orderBy("__h").limit(left).agg(F.max("__h")).first()[0]


def _in_first(df: DataFrame, key: Column, fraction: float, seed: int) -> Column:
    """Whether the row's key is among the first by hash; a null key is a key like any other."""
    cut = hash_cut(df.select(key.alias("__k")), "__k", fraction, seed)
    return salted_hash(key, seed) <= F.lit(cut)


def group_split(df: DataFrame, group_col: str, test_fraction: float = 0.2, seed: int = DEFAULT_SEED,
                null_group=-1):
    """Whole groups to test (ceil(fraction * groups) of them); returns (train, test).

    A null group key is its own group (``null_group``), as the cleaning job fills it.
    """
    test = _in_first(df, F.coalesce(F.col(group_col), F.lit(null_group)), test_fraction, seed)
    return df.filter(~test), df.filter(test)


def random_split(df: DataFrame, id_col: str, test_fraction: float = 0.2, seed: int = DEFAULT_SEED):
    """ceil(fraction * ids) ids to test, chosen by salted hash; rows without id go to one side together."""
    test = _in_first(df, F.col(id_col), test_fraction, seed)
    return df.filter(~test), df.filter(test)


def split_column(df: DataFrame, group_col: str | None, id_col: str, test_fraction: float = 0.2,
                 seed: int = DEFAULT_SEED) -> DataFrame:
    """Tag every row with split = 'train' / 'test' (group split when a group column exists)."""
    grouped = group_col and group_col in df.columns
    test = _in_first(df, F.coalesce(F.col(group_col), F.lit(-1)) if grouped else F.col(id_col), test_fraction, seed)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def stratified_folds(df: DataFrame, label_col: str, id_col: str, k: int = 5, seed: int = DEFAULT_SEED) -> DataFrame:
    """fold = (rank of the row's salted hash within its class) mod k; sizes differ by <= 1 per class."""
    h = df.withColumn("__h", salted_hash(F.col(id_col), seed))
    ranked = bucketed_rank(h, "__h", part_cols=[label_col], tiebreak=[id_col])
    return ranked.withColumn("fold", (F.col("__rank") % k).cast("int")).drop("__h", "__rank")


def validation_flag(df: DataFrame, id_col: str, fraction: float = 0.1, seed: int = DEFAULT_SEED) -> DataFrame:
    """is_validation = 1 for ceil(fraction * rows) rows chosen by salted hash."""
    return df.withColumn("is_validation", _in_first(df, F.col(id_col), fraction, seed).cast("int"))
