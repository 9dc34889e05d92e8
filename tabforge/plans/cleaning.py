"""The cleaning job as one lazy Spark plan: clean -> split -> fit(train) -> apply(both) -> write.

Every step is schema-optional (absent columns are skipped).  The only actions
are the small fit aggregates (medians, modes, vocabulary, split size) and the
final writes.  The listing ``id`` is kept as the row key (it is never a feature).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions import lists as LS
from tabforge.functions import nulls as N
from tabforge.functions import scalars as S
from tabforge.functions.common import present
from tabforge.operators import columns as P
from tabforge.operators import impute as I
from tabforge.operators import quality as D
from tabforge.operators import split as G
from tabforge.operators import tokens as TK
from tabforge.operators.quantiles import quantiles
from tabforge.session import cut_lineage, stored

TARGET = "occupancy_level"
DATE_COLS = ("last_scraped", "host_since", "first_review", "last_review")
BOOL_COLS = ("host_has_profile_pic", "host_identity_verified", "instant_bookable", "has_availability",
             "host_is_superhost")
ITEMS = "__items"   # the parsed amenities
AVAIL_COLS = ("availability_30", "availability_60", "availability_90", "availability_365")


@dataclass
class CleanFit:
    """Statistics fitted on the training split and applied to any split."""
    price: tuple
    ppp_median: float | None
    vocabulary: list
    fill: dict
    feature_order: list = field(default_factory=list)
    modes: list = field(default_factory=list)          # I.ModeFit per imputed column, in order
    inputs: list = field(default_factory=list)         # (name, type) of the raw columns


def clean_rows(df: DataFrame, dedup: bool = True) -> DataFrame:
    """Row-local cleaning (no fitted statistics): dates, booleans, neighbourhood, reviews, bathrooms, tenure.

    ``dedup`` keeps one row per id first; requests, which may repeat an id, are cleaned without it.
    """
    if dedup and "id" in df.columns:
        others = [c for c in df.columns if c != "id"]
        df = D.dedup_first(df, "id", others)
    df = P.drop_columns(df, [c for c in P.DROP_COLS if c != "id"] + list(P.HIGH_NULL_COLS))
    cols = set(df.columns)
    proj = {}
    for c in present(df, DATE_COLS):
        if not isinstance(df.schema[c].dataType, T.DateType):
            proj[c] = S.parse_date(c)
    df = df.withColumns(proj) if proj else df
    # booleans
    if "has_availability" in cols:
        df = df.withColumn("has_availability", S.infer_availability("has_availability", present(df, AVAIL_COLS)))
    if "host_is_superhost" in cols:
        df = df.withColumn("was_evaluated_for_superhost", S.was_evaluated_flag("host_is_superhost"))
    bools = {c: S.bool_yes_no(c, fill="no" if c == "host_is_superhost" else None) for c in present(df, BOOL_COLS)}
    df = df.withColumns(bools) if bools else df
    # neighbourhood
    if {"neighbourhood", "neighbourhood_cleansed"} <= cols:
        df = df.withColumn("neighbourhood", S.coalesce_columns("neighbourhood", "neighbourhood_cleansed"))
    nb = {c: S.blank_to_default(c) for c in present(df, ("neighborhood_overview", "host_neighbourhood"))}
    df = df.withColumns(nb) if nb else df
    # reviews
    scores = [c for c in df.columns if c.startswith("review_scores_")]
    flag = S.has_reviews_flag("number_of_reviews" if "number_of_reviews" in cols else None,
                              "first_review" if "first_review" in cols else None,
                              "last_review" if "last_review" in cols else None,
                              "reviews_per_month" if "reviews_per_month" in cols else None)
    df = df.withColumn("has_reviews_flag", flag)
    rv = {c: S.zero_review_score(c, "has_reviews_flag") for c in scores}
    if "last_scraped" in cols:
        for d, name in (("first_review", "days_since_first_review"), ("last_review", "days_since_last_review")):
            if d in cols:
                rv[name] = S.days_since("last_scraped", d, "has_reviews_flag")
    if "reviews_per_month" in cols:
        rv["reviews_per_month"] = S.fill_reviews_per_month("reviews_per_month", "has_reviews_flag")
    df = df.withColumns(rv).drop(*present(df, ("first_review", "last_review")))
    # bathrooms
    if "bathrooms_text" in cols:
        df = df.withColumn("bathrooms_text_num", S.parse_bathrooms("bathrooms_text"))
        if "bathrooms" in cols:
            df = df.withColumn("bathrooms", F.coalesce(S.numeric_coerce("bathrooms"), F.col("bathrooms_text_num")))
    # host tenure and group key
    if {"host_since", "last_scraped"} <= cols:
        df = df.withColumn("host_days_active", S.host_days_active("last_scraped", "host_since"))
        df = df.withColumn("host_is_new", S.host_is_new("host_days_active"))
    if "host_id" in cols:
        df = df.withColumn("host_id", F.coalesce(F.col("host_id"), F.lit(-1).cast(df.schema["host_id"].dataType)))
    if "price" in cols:
        df = df.withColumn("price_clean", S.price_digits("price"))
    return df


def split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """G2/G3: 'split' column - by host when there is a host column, else by row id."""
    return G.split_column(df, "host_id" if "host_id" in df.columns else None, "id", test_fraction, seed)


def fit(train: DataFrame, top_k: int = 20) -> CleanFit:
    """Fit price medians (I3), the price-per-person median (C27), the vocabulary (T2) on train."""
    price = (I.fit_price_medians(train, "price_clean", "neighbourhood_cleansed", "room_type")
             if "price_clean" in train.columns else None)
    ppp_med = None
    if price is not None:
        tmp = I.price_impute(train, price, "price_clean", "neighbourhood_cleansed", "room_type")
        acc = "accommodates" if "accommodates" in tmp.columns else None
        ppp = S.price_per_person("price_imputed", acc) if acc else F.col("price_imputed")
        ppp_med = quantiles(tmp.select(ppp.alias("ppp")), ["ppp"], [0.5])["ppp"][0]
    vocab = []
    if "amenities" in train.columns:
        vocab = TK.fit_vocabulary(train.withColumn(ITEMS, LS.parse_list_text("amenities")), ITEMS, top_k)
    elif ITEMS in train.columns:
        vocab = TK.fit_vocabulary(train, ITEMS, top_k)
    return CleanFit(price=price, ppp_median=ppp_med, vocabulary=vocab, fill={})


def apply_modes(df: DataFrame, f: CleanFit) -> DataFrame:
    """The fitted mode imputations, where the table has their columns."""
    for m in f.modes:
        if m.target in df.columns and m.ref in df.columns:
            df = I.apply_mode_impute(df, m)
    return df


def apply(df: DataFrame, f: CleanFit) -> DataFrame:
    """Price imputation, price per person, amenities, target, leakage strip (fitted parts from ``f``)."""
    if f.price is not None:
        df = I.price_impute(df, f.price, "price_clean", "neighbourhood_cleansed", "room_type")
        acc = "accommodates" if "accommodates" in df.columns else None
        ppp = S.price_per_person("price_imputed", acc) if acc else F.col("price_imputed")
        df = df.withColumn("price_per_person", F.coalesce(ppp, F.lit(f.ppp_median))).drop("price_clean", "price")
    if "amenities" in df.columns:
        df = TK.amenity_features(df, "amenities", f.vocabulary)
    elif ITEMS in df.columns:
        df = TK.multi_hot(df, ITEMS, f.vocabulary)
    if "estimated_occupancy_l365d" in df.columns:
        df = df.withColumn(TARGET, G.occupancy_level("estimated_occupancy_l365d"))
    return P.strip_leakage(df)


def run(raw: DataFrame, fit_modes_on: str = "train", test_fraction: float = 0.2):
    """Whole cleaning job; returns (train, test, fit).  Nothing is written here."""
    # the cleaned table feeds the split and several small fit aggregates: write it once in the shared folder; each
    # of them then reads its own columns, and a lost executor costs no recomputation.  The split is a cut of the
    # key's hash, an expression of the row, so it is not stored.
    # List text is parsed once, for the vocabulary and the columns from it.
    df = clean_rows(raw)
    if "amenities" in df.columns:
        df = df.withColumn(ITEMS, LS.parse_list_text("amenities")).drop("amenities")
    df = split(stored(df, "cleaned"), test_fraction)
    train = df.filter(F.col("split") == "train")
    mode_fit = df if fit_modes_on == "all" else train
    modes = [I.fit_mode_impute(mode_fit, target, "room_type") for target in ("bedrooms", "beds") if target in df.columns and "room_type" in df.columns]
    for m in modes:
        m.modes = cut_lineage(m.modes)   # a row per room type
        df = I.apply_mode_impute(df, m)
    train = df.filter(F.col("split") == "train")
    f = fit(train)
    f.modes, f.inputs = modes, raw.dtypes
    out = stored(apply(df, f), "applied", "split")
    train_o = out.filter(F.col("split") == "train")
    f.fill = I.fit_remaining(train_o, exclude=("id", "split", TARGET, "host_id"))
    out = I.apply_fill(out, f.fill)
    f.feature_order = P.feature_columns(out.columns, target=TARGET, extra_exclude=("id", "split", "host_id"))
    return out.filter(F.col("split") == "train"), out.filter(F.col("split") == "test"), f


def write_splits(train: DataFrame, test: DataFrame, out_dir: str) -> dict:
    """S3: parquet per split (overwrite), then S7 manifest (row counts and columns)."""
    paths = {"train": f"{out_dir.rstrip('/')}/train", "test": f"{out_dir.rstrip('/')}/test"}
    train.drop("split").write.mode("overwrite").parquet(paths["train"])
    test.drop("split").write.mode("overwrite").parquet(paths["test"])
    return paths


def run_manifest(spark, paths: dict) -> DataFrame:
    """One row per split with its row count and column list (read back from the written files)."""
    rows = []
    for name, p in paths.items():
        d = spark.read.parquet(p)
        rows.append(d.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("split"), "rows", F.lit(",".join(d.columns)).alias("columns")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def ensure_data(spark, paths: dict, target: str = TARGET):
    """Both splits must exist and carry the target."""
    out = []
    for name in ("train", "test"):
        try:
            d = spark.read.parquet(paths[name])
        except Exception as e:  # noqa: BLE001
            raise FileNotFoundError(f"processed split {name!r} not found at {paths[name]}") from e
        if target not in d.columns:
            raise ValueError(f"target column {target!r} not found in {name}")
        out.append(d)
    return tuple(out)


def null_tokens_to_null(df: DataFrame) -> DataFrame:
    """C1 over every text column."""
    return df.select(*[N.normalize_missing(c).alias(c) if isinstance(df.schema[c].dataType, T.StringType)
                       else F.col(c) for c in df.columns])
