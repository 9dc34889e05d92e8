"""Registered queries for projections, quality checks, lookups, profiling,
splits, imputation and vocabulary operators, with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions import lists as LS
from tabforge.functions import scalars as S
from tabforge.operators import columns as P
from tabforge.operators import impute as I
from tabforge.operators import lookup as J
from tabforge.operators import quality as D
from tabforge.operators import split as G
from tabforge.operators import tokens as T
from tabforge.operators.quantiles import group_quantile
from tabforge.plans.catalog_scalars import LIST_ITEMS_SQL, PRICE_DIGITS_SQL, with_listings
from tabforge.session import stored
from tabforge.sources.fixtures import listings, table

Q = {}
O = {}

# ---------------------------------------------------------------- SQL helpers
SPLIT_CTES = (
    "grp AS (SELECT DISTINCT coalesce(host_id, -1) AS g FROM listings)",
    "test_groups AS (SELECT g FROM (SELECT g, row_number() OVER (ORDER BY md5('42' || CAST(g AS VARCHAR)), g) AS rn,"
    " count(*) OVER () AS n FROM grp) WHERE rn <= ceil(CAST(0.2 AS DOUBLE) * n))",
    "split AS (SELECT l.*, CASE WHEN t.g IS NULL THEN 'train' ELSE 'test' END AS split FROM listings l"
    " LEFT JOIN test_groups t ON coalesce(l.host_id, -1) = t.g)",
)


def with_split(body: str, *ctes: str) -> str:
    return with_listings(body, *SPLIT_CTES, *ctes)


def _split(spark, sf):
    return G.split_column(listings(spark, sf), "host_id", "id")


def _priced(spark, sf):
    return listings(spark, sf).withColumn("price", S.price_digits("price"))


# ---------------------------------------------------------------- P*
def q_drop_columns(spark, sf):
    return P.drop_columns(listings(spark, sf), P.DROP_COLS + P.HIGH_NULL_COLS)


O["drop_columns"] = with_listings("SELECT * EXCLUDE (id) FROM listings")


def q_drop_high_null(spark, sf):
    return P.null_fractions(listings(spark, sf), threshold=0.3)


def _null_frac_sql(cols, thr):
    return with_listings(
        "SELECT column_name, null_frac, CAST(null_frac > " + str(thr) + " AS INTEGER) AS dropped FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6)"
                             f" AS null_frac FROM listings" for c in cols) + ")")


LISTING_COLS = ["id", "host_id", "neighbourhood_cleansed", "neighbourhood", "host_neighbourhood", "room_type",
                "property_type", "price", "accommodates", "bedrooms", "beds", "bathrooms_text", "host_is_superhost",
                "instant_bookable", "host_response_time", "host_response_rate", "host_since", "last_scraped",
                "first_review", "last_review", "number_of_reviews", "reviews_per_month", "review_scores_rating",
                "has_availability", "availability_365", "estimated_occupancy_l365d", "amenities"]
O["drop_high_null"] = _null_frac_sql(LISTING_COLS, 0.3)


def q_drop_high_null_columns(spark, sf):
    return P.drop_high_null(listings(spark, sf), threshold=0.3)


#: Of the derived listings these columns are null in more than 30 % of the rows: in a half and a third of them.
O["drop_high_null_columns"] = with_listings("SELECT * EXCLUDE (neighbourhood, host_is_superhost) FROM listings")


def q_strip_leakage(spark, sf):
    return P.strip_leakage(listings(spark, sf))


O["strip_leakage"] = with_listings(
    "SELECT * EXCLUDE (availability_365, has_availability, estimated_occupancy_l365d, number_of_reviews,"
    " review_scores_rating, reviews_per_month) FROM listings")


def q_feature_columns(spark, sf):
    df = listings(spark, sf)
    return df.select(*P.feature_columns(df.columns, extra_exclude=("id",)))


O["feature_columns"] = with_listings(
    "SELECT host_id, neighbourhood_cleansed, neighbourhood, host_neighbourhood, room_type, property_type, price,"
    " accommodates, bedrooms, beds, host_is_superhost, instant_bookable, host_response_time, host_response_rate,"
    " host_since, last_scraped, first_review, last_review FROM listings")


def q_common_numeric(spark, sf):
    df = _split(spark, sf)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    return train.select(*P.common_numeric(train, test))


O["common_numeric"] = with_split(
    "SELECT id, host_id, accommodates, bedrooms, beds, number_of_reviews, reviews_per_month, review_scores_rating,"
    " availability_365, estimated_occupancy_l365d FROM split WHERE split = 'train'")

ALIGN = ["id", "accommodates", "bedrooms", "beds", "price_imputed", "amenity_wifi"]


def q_align_schema(spark, sf):
    return P.align_schema(listings(spark, sf), ALIGN)


O["align_schema"] = with_listings(
    "SELECT id, accommodates, bedrooms, beds, 0 AS price_imputed, 0 AS amenity_wifi FROM listings")


# ---------------------------------------------------------------- D*
LI_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def q_dedup_first(spark, sf):
    return D.dedup_first(table(spark, sf, "lineitem"), "l_orderkey", LI_ORDER)


O["dedup_first"] = ("SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY "
                    + ", ".join(LI_ORDER) + ") AS rn FROM lineitem) WHERE rn = 1")


def q_duplicate_count(spark, sf):
    return D.duplicate_count(table(spark, sf, "lineitem"), "l_orderkey")


O["duplicate_count"] = ("SELECT CAST(coalesce(sum(cnt - 1), 0) AS BIGINT) AS duplicates, CAST(coalesce(sum(CASE WHEN "
                        "l_orderkey IS NULL THEN cnt END), 0) AS BIGINT) AS null_keys FROM (SELECT l_orderkey, "
                        "count(*) AS cnt FROM lineitem GROUP BY l_orderkey)")


def q_filter_target_present(spark, sf):
    return D.filter_present(listings(spark, sf), "host_since").select("id", "host_since")


O["filter_target_present"] = with_listings("SELECT id, host_since FROM listings WHERE host_since IS NOT NULL")


def q_clip_p99(spark, sf):
    return D.clip_quantile(_priced(spark, sf), "price", 0.99).select("id", "price")


O["clip_p99"] = with_listings(
    "SELECT id, price FROM p WHERE price <= (SELECT quantile_cont(price, 0.99) FROM p)",
    f"p AS (SELECT id, {PRICE_DIGITS_SQL} AS price FROM listings)")


def q_host_overlap_check(spark, sf):
    df = _split(spark, sf).withColumn("g", F.coalesce("host_id", F.lit(-1)))
    return D.overlap_check(df.filter("split = 'train'"), df.filter("split = 'test'"), "g")


O["host_overlap_check"] = with_split(
    "SELECT count(DISTINCT CASE WHEN split = 'train' THEN coalesce(host_id, -1) END) AS train_groups,"
    " count(DISTINCT CASE WHEN split = 'test' THEN coalesce(host_id, -1) END) AS test_groups,"
    " CAST(0 AS BIGINT) + (SELECT count(*) FROM (SELECT coalesce(host_id, -1) FROM split WHERE split = 'train'"
    " INTERSECT SELECT coalesce(host_id, -1) FROM split WHERE split = 'test')) AS shared_groups FROM split")


# ---------------------------------------------------------------- J*
MODE_SQL = ("SELECT {g}, {v} AS {alias} FROM (SELECT {g}, {v}, row_number() OVER (PARTITION BY {g} ORDER BY cnt DESC,"
            " {v}) AS rn FROM (SELECT {g}, {v}, count(*) AS cnt FROM {src} WHERE {v} IS NOT NULL AND {g} IS NOT NULL"
            " GROUP BY {g}, {v})) WHERE rn = 1")


def mode_sql(g, v, alias, src="listings"):
    return MODE_SQL.format(g=g, v=v, alias=alias, src=src)


def q_lookup_join(spark, sf):
    df = listings(spark, sf)
    modes = I.mode_by_group(df, "room_type", "bedrooms", "bedrooms_mode")
    return J.lookup_join(df, modes, "room_type").select("id", "room_type", "bedrooms_mode")


O["lookup_join"] = with_listings(
    "SELECT l.id, l.room_type, m.bedrooms_mode FROM listings l LEFT JOIN m ON l.room_type = m.room_type",
    "m AS (" + mode_sql("room_type", "bedrooms", "bedrooms_mode") + ")")


def q_lookup_join_composite(spark, sf):
    df = _priced(spark, sf)
    med = group_quantile(df, ["neighbourhood_cleansed", "room_type"], "price", 0.5, "price_median")
    return J.lookup_join(df, med.dropna(), ["neighbourhood_cleansed", "room_type"]).select(
        "id", "neighbourhood_cleansed", "room_type", "price_median")


O["lookup_join_composite"] = with_listings(
    "SELECT p.id, p.neighbourhood_cleansed, p.room_type, m.price_median FROM p LEFT JOIN m"
    " ON p.neighbourhood_cleansed = m.neighbourhood_cleansed AND p.room_type = m.room_type",
    f"p AS (SELECT id, neighbourhood_cleansed, room_type, {PRICE_DIGITS_SQL} AS price FROM listings)",
    "m AS (SELECT neighbourhood_cleansed, room_type, median(price) AS price_median FROM p"
    " GROUP BY ALL HAVING median(price) IS NOT NULL)")


def q_split_members(spark, sf):
    df = listings(spark, sf).withColumn("g", F.coalesce("host_id", F.lit(-1)))
    test_groups = G.group_split(df.select("g").distinct(), "g", 0.2)[1]
    members, others = J.split_members(df, test_groups, "g")
    side = lambda d, name: d.select("id", "host_id", F.lit(name).alias("side"))
    return side(members, "test").unionByName(side(others, "train"))


O["split_members"] = with_split("SELECT id, host_id, split AS side FROM split")


def q_freq_outer_align(spark, sf):
    df = _priced(spark, sf)
    out = J.freq_outer_align(df, "room_type", F.col("price").isNull())
    return out.select("room_type", F.round("freq_a", 9).alias("freq_missing"), F.round("freq_b", 9).alias("freq_present"))


O["freq_outer_align"] = with_listings(
    "SELECT room_type, round(coalesce(n_a / sum(n_a) OVER (), 0), 9) AS freq_missing,"
    " round(coalesce(n_b / sum(n_b) OVER (), 0), 9) AS freq_present FROM (SELECT room_type,"
    " CAST(count(*) FILTER (WHERE price IS NULL) AS DOUBLE) AS n_a, CAST(count(*) FILTER (WHERE price IS NOT NULL)"
    " AS DOUBLE) AS n_b FROM p GROUP BY room_type)",
    f"p AS (SELECT id, room_type, {PRICE_DIGITS_SQL} AS price FROM listings)")


def q_nearest_group_fallback(spark, sf):
    rows = stored(listings(spark, sf).select("id", "host_id", "price", "beds"), "rows")   # the split, the modes and the lookup read it
    df = G.split_column(rows, "host_id", "id").withColumn("price", S.price_digits("price"))
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    modes = I.mode_by_group(train, "price", "beds", "beds_mode")
    out = J.nearest_key_join(test.filter(F.col("beds").isNull()), "price", modes, "price", "beds_mode")
    return out.select("id", "price", F.col("beds_mode_nearest").alias("beds"))


O["nearest_group_fallback"] = with_split(
    "SELECT t.id, t.price, CASE WHEN t.price IS NOT NULL THEN (SELECT arg_min(m.beds_mode, (abs(m.price - t.price),"
    " m.price)) FROM m) END AS beds"
    " FROM (SELECT id, price FROM sp WHERE split = 'test' AND beds IS NULL) t",
    f"sp AS (SELECT * REPLACE ({PRICE_DIGITS_SQL} AS price) FROM split)",
    "m AS (" + mode_sql("price", "beds", "beds_mode", "(SELECT * FROM sp WHERE split = 'train')") + ")")


# ---------------------------------------------------------------- A1-A8, W4
def q_missing_table(spark, sf):
    return D.missing_table(listings(spark, sf))


O["missing_table"] = with_listings(
    "SELECT column_name, missing, round(missing / n, 4) * 100 AS percent FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS n FROM listings"
        for c in LISTING_COLS) + ") WHERE missing > 0")


def q_null_share_by_group(spark, sf):
    return D.null_share_by_group(listings(spark, sf))


def _null_share_sql():
    pairs = D.column_groups(LISTING_COLS)
    per = " UNION ALL ".join(
        f"SELECT '{g}' AS grp, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM listings" for c, g in pairs)
    labels = " UNION ALL ".join(f"SELECT '{g}' AS grp, '{lab}' AS label" for g, lab in D.GROUP_LABELS)
    return with_listings(
        "SELECT label AS group_name, CAST(nulls AS BIGINT) AS nulls, round(nulls / total * 100, 4) AS share_pct"
        " FROM (SELECT grp, sum(nulls) AS nulls, sum(sum(nulls)) OVER () AS total FROM (" + per + ") GROUP BY grp)"
        " JOIN (" + labels + ") USING (grp)")


O["null_share_by_group"] = _null_share_sql()


def q_column_profile(spark, sf):
    return D.column_profile(listings(spark, sf))


_DUCK_TO_SPARK = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'"
                  " WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' ELSE lower(typeof({c})) END")
O["column_profile"] = with_listings(" UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, count({c}) AS non_null,"
    f" (SELECT {_DUCK_TO_SPARK.format(c=c)} FROM listings LIMIT 1) AS dtype FROM listings"
    for i, c in enumerate(LISTING_COLS)))



def q_dtype_histogram(spark, sf):
    return D.dtype_histogram(listings(spark, sf))


O["dtype_histogram"] = "SELECT dtype, count(*) AS n_columns FROM (" + O["column_profile"] + ") GROUP BY dtype"

DESCRIBE_COLS = ["accommodates", "bedrooms", "beds", "number_of_reviews", "reviews_per_month", "review_scores_rating",
                 "availability_365", "estimated_occupancy_l365d"]


def q_numeric_describe(spark, sf):
    return D.numeric_describe(listings(spark, sf), exclude_patterns=("id",), decimals=4)


O["numeric_describe"] = with_listings(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,"
    f" round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,"
    f" round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max"
    f" FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM listings)" for c in DESCRIBE_COLS))

TEXT_LISTING_COLS = ["neighbourhood_cleansed", "neighbourhood", "host_neighbourhood", "room_type", "property_type",
                     "price", "bathrooms_text", "host_is_superhost", "instant_bookable", "host_response_time",
                     "host_response_rate", "has_availability", "amenities"]


def q_categorical_describe(spark, sf):
    return D.categorical_describe(listings(spark, sf))


O["categorical_describe"] = with_listings(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(sum(freq) AS BIGINT) AS count, count(*) AS unique, arg_min({c}, (-freq, {c})) AS top,"
    f" max(freq) AS freq FROM (SELECT {c}, count(*) AS freq FROM listings WHERE {c} IS NOT NULL GROUP BY {c})"
    for c in TEXT_LISTING_COLS))


def q_value_shares(spark, sf):
    from tabforge.operators.profile import value_shares
    return value_shares(listings(spark, sf), "room_type")


O["value_shares"] = with_listings(
    "SELECT room_type, n, n / sum(n) OVER () AS share FROM (SELECT room_type, count(*) AS n FROM listings"
    " GROUP BY room_type)")


def q_mode_by_group(spark, sf):
    df = listings(spark, sf)
    a = I.mode_by_group(df, "room_type", "bedrooms", "mode_value").withColumn("what", F.lit("bedrooms_by_room_type"))
    b = (I.mode_by_group(df, "neighbourhood_cleansed", "beds", "mode_value")
         .withColumnRenamed("neighbourhood_cleansed", "room_type").withColumn("what", F.lit("beds_by_neighbourhood")))
    return a.unionByName(b).withColumnRenamed("room_type", "group_key")


O["mode_by_group"] = with_listings(
    "SELECT room_type AS group_key, mode_value, 'bedrooms_by_room_type' AS what FROM ("
    + mode_sql("room_type", "bedrooms", "mode_value") + ") UNION ALL SELECT neighbourhood_cleansed, mode_value,"
    " 'beds_by_neighbourhood' FROM (" + mode_sql("neighbourhood_cleansed", "beds", "mode_value") + ")")


def q_median_by_group(spark, sf):
    return I.median_by_grains(_priced(spark, sf), "neighbourhood_cleansed", "room_type", "price")


O["median_by_group"] = with_listings(
    "SELECT neighbourhood_cleansed, room_type, median(price) AS median,"
    " CAST(grouping(neighbourhood_cleansed, room_type) AS BIGINT) AS grain FROM p"
    " GROUP BY ROLLUP (neighbourhood_cleansed, room_type)",
    f"p AS (SELECT neighbourhood_cleansed, room_type, {PRICE_DIGITS_SQL} AS price FROM listings)")


def q_share_of_total(spark, sf):
    df = listings(spark, sf).groupBy("neighbourhood_cleansed").agg(F.sum("estimated_occupancy_l365d").alias("occ"))
    return J.with_totals(df, __total="occ").select("neighbourhood_cleansed", "occ", F.round(F.col("occ") / F.col("__total"), 9).alias("share"))


O["share_of_total"] = with_listings(
    "SELECT neighbourhood_cleansed, occ, round(occ / sum(occ) OVER (), 9) AS share FROM (SELECT neighbourhood_cleansed,"
    " sum(estimated_occupancy_l365d) AS occ FROM listings GROUP BY neighbourhood_cleansed)")


# ---------------------------------------------------------------- T*
def q_topk(spark, sf):
    return T.topk(_priced(spark, sf).select("id", "price"), [F.col("price").desc_nulls_last(), F.col("id")], 10)


O["topk"] = with_listings(
    f"SELECT id, price FROM (SELECT id, {PRICE_DIGITS_SQL} AS price FROM listings)"
    " ORDER BY price DESC NULLS LAST, id LIMIT 10")


def _items(spark, sf):
    return listings(spark, sf).withColumn("items", LS.parse_list_text("amenities"))


def q_top_vocabulary(spark, sf):
    return T.top_vocabulary(_items(spark, sf), "items", 20)


ITEMS_CTE = f"it AS (SELECT id, CASE WHEN amenities IS NULL THEN []::VARCHAR[] ELSE {LIST_ITEMS_SQL} END AS items FROM listings)"
O["top_vocabulary"] = with_listings(
    "SELECT token, count(*) AS n_rows FROM (SELECT unnest(items) AS token FROM it) GROUP BY token"
    " ORDER BY n_rows DESC, token LIMIT 20", ITEMS_CTE)


def q_multi_hot(spark, sf):
    df = _split(spark, sf).withColumn("items", LS.parse_list_text("amenities"))
    vocab = T.fit_vocabulary(df.filter("split = 'train'"), "items", 20)
    names = T.slug_names(vocab)
    hot = T.multi_hot(df.filter("split = 'test'"), "items", vocab)
    return hot.select("id", "amenities_count", F.concat_ws("", *[F.col(n).cast("string") for n in names]).alias("hot"))


O["multi_hot"] = with_split(
    "SELECT t.id, CAST(len(t.items) AS INTEGER) AS amenities_count, array_to_string(list_transform(v.vocab,"
    " lambda x: CASE WHEN list_contains(t.items, x) THEN '1' ELSE '0' END), '') AS hot"
    " FROM (SELECT s.id, it.items FROM split s JOIN it USING (id) WHERE s.split = 'test') t, v",
    ITEMS_CTE,
    "v AS (SELECT list(token ORDER BY n_rows DESC, token) AS vocab FROM (SELECT token, count(*) AS n_rows FROM"
    " (SELECT unnest(it.items) AS token FROM it JOIN split USING (id) WHERE split = 'train') GROUP BY token"
    " ORDER BY n_rows DESC, token LIMIT 20))")


def q_multi_hot_serving(spark, sf):
    df = listings(spark, sf).select("id", "amenities")
    return T.amenity_features(df, "amenities", list(T.SERVING_AMENITIES), single=True)


O["multi_hot_serving"] = with_listings(
    "SELECT id, CAST(len(items) AS INTEGER) AS amenities_count, " + ", ".join(
        f"CAST(list_contains(items, '{a}') AS INTEGER) AS amenity_{a}" for a in T.SERVING_AMENITIES)
    + " FROM (SELECT id, CASE WHEN amenities IS NULL THEN []::VARCHAR[] "
    "WHEN NOT (amenities LIKE '[%' OR amenities LIKE '{%') THEN [lower(trim(amenities))] "
    "WHEN NOT json_valid(replace(translate(amenities, '{}', '[]'), chr(39), '\"')) THEN []::VARCHAR[] "
    f"ELSE {LIST_ITEMS_SQL} END AS items FROM listings)")


def q_one_hot(spark, sf):
    df = listings(spark, sf)
    levels = T.fit_levels(df, "room_type")
    hot = T.one_hot(df, "room_type", levels, drop_first=True, prefix="rt")
    names = [f"rt_{lv}" for lv in levels[1:]]
    return hot.select("id", "room_type", F.concat_ws("", *[F.col(n).cast("string") for n in names]).alias("hot"))


O["one_hot"] = with_listings(
    "SELECT id, room_type, array_to_string(list_transform(lv[2:], lambda x: CASE WHEN room_type = x THEN '1' ELSE '0'"
    " END), '') AS hot FROM listings, (SELECT list(DISTINCT room_type ORDER BY room_type) AS lv FROM listings)")


def q_union_labels(spark, sf):
    df = _split(spark, sf).withColumn("occupancy_level", G.occupancy_level("estimated_occupancy_l365d"))
    tr = df.filter("split = 'train'").select("id", "split", "occupancy_level")
    te = df.filter("split = 'test'").select("id", "split", "occupancy_level")
    return T.union_labels(tr, te)


LEVEL_SQL = ("CASE WHEN {x} IS NULL THEN NULL WHEN least(greatest({x}, 0), 365) <= 0 THEN 'zero'"
             " WHEN least(greatest({x}, 0), 365) <= 30 THEN 'low' WHEN least(greatest({x}, 0), 365) <= 120"
             " THEN 'mid' ELSE 'high' END")
O["union_labels"] = with_split(
    f"SELECT id, split, {LEVEL_SQL.format(x='estimated_occupancy_l365d')} AS occupancy_level FROM split")


def q_concat_columns(spark, sf):
    df = _priced(spark, sf)
    modes = I.mode_by_group(df, "room_type", "bedrooms", "bedrooms_mode")
    meds = group_quantile(df, ["room_type"], "price", 0.5, "price_median")
    return T.concat_columns(modes, meds, "room_type")


O["concat_columns"] = with_listings(
    "SELECT m.room_type, m.bedrooms_mode, d.price_median FROM m JOIN d ON m.room_type = d.room_type",
    "m AS (" + mode_sql("room_type", "bedrooms", "bedrooms_mode") + ")",
    f"d AS (SELECT room_type, median({PRICE_DIGITS_SQL}) AS price_median FROM listings GROUP BY room_type)")


# ---------------------------------------------------------------- G*
def q_occupancy_level(spark, sf):
    df = listings(spark, sf).withColumn("occupancy_level", G.occupancy_level("estimated_occupancy_l365d"))
    return df.select("id", "occupancy_level", G.level_rank("occupancy_level").alias("level_rank"))


O["occupancy_level"] = with_listings(
    "SELECT id, occupancy_level, CASE occupancy_level WHEN 'zero' THEN 0 WHEN 'low' THEN 1 WHEN 'mid' THEN 2"
    f" WHEN 'high' THEN 3 END AS level_rank FROM (SELECT id, {LEVEL_SQL.format(x='estimated_occupancy_l365d')}"
    " AS occupancy_level FROM listings)")


def q_group_split(spark, sf):
    return _split(spark, sf).select("id", "host_id", "split")


O["group_split"] = with_split("SELECT id, host_id, split FROM split")


def q_random_split(spark, sf):
    train, test = G.random_split(listings(spark, sf), "id", 0.2)
    return (train.select("id", F.lit("train").alias("split"))
            .unionByName(test.select("id", F.lit("test").alias("split"))))


O["random_split"] = with_listings(
    "SELECT id, CASE WHEN rn <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split FROM ("
    "SELECT id, row_number() OVER (ORDER BY md5('42' || CAST(id AS VARCHAR)), id) AS rn, count(*) OVER () AS n"
    " FROM listings)")


def q_stratified_folds(spark, sf):
    df = listings(spark, sf).withColumn("occupancy_level", G.occupancy_level("estimated_occupancy_l365d"))
    return G.stratified_folds(df.select("id", "occupancy_level"), "occupancy_level", "id", 5)


O["stratified_folds"] = with_listings(
    "SELECT id, occupancy_level, CAST((row_number() OVER (PARTITION BY occupancy_level ORDER BY"
    " md5('42' || CAST(id AS VARCHAR)), id) - 1) % 5 AS INTEGER) AS fold FROM"
    f" (SELECT id, {LEVEL_SQL.format(x='estimated_occupancy_l365d')} AS occupancy_level FROM listings)")


def q_validation_split(spark, sf):
    train = _split(spark, sf).filter("split = 'train'").select("id")
    return G.validation_flag(train, "id", 0.1)


O["validation_split"] = with_split(
    "SELECT id, CASE WHEN rn <= ceil(CAST(0.1 AS DOUBLE) * n) THEN 1 ELSE 0 END AS is_validation FROM ("
    "SELECT id, row_number() OVER (ORDER BY md5('42' || CAST(id AS VARCHAR)), id) AS rn, count(*) OVER () AS n"
    " FROM split WHERE split = 'train')")


# ---------------------------------------------------------------- I*
def q_mode_impute_by(spark, sf):
    df = listings(spark, sf)
    df = I.mode_impute_by(df, "bedrooms", "room_type")
    df = I.mode_impute_by(df, "beds", "room_type")
    return df.select("id", "room_type", "bedrooms", "beds")


O["mode_impute_by"] = with_listings(
    "SELECT l.id, l.room_type, coalesce(l.bedrooms, a.m) AS bedrooms, coalesce(l.beds, b.m) AS beds FROM listings l"
    " LEFT JOIN a ON l.room_type = a.room_type LEFT JOIN b ON l.room_type = b.room_type",
    "a AS (" + mode_sql("room_type", "bedrooms", "m") + ")",
    "b AS (" + mode_sql("room_type", "beds", "m") + ")")


def q_mode_impute_chain(spark, sf):
    df = listings(spark, sf)
    df = I.mode_impute_chain(df, [("bathrooms_text", "room_type"), ("bedrooms", "bathrooms_text"),
                                  ("beds", "bedrooms")])
    return df.select("id", "bathrooms_text", "bedrooms", "beds")


O["mode_impute_chain"] = with_listings(
    "SELECT s2.id, s2.bathrooms_text, s2.bedrooms, coalesce(s2.beds, c.m) AS beds FROM s2"
    " LEFT JOIN c ON s2.bedrooms = c.bedrooms",
    "a AS (" + mode_sql("room_type", "bathrooms_text", "m") + ")",
    "s1 AS (SELECT l.* REPLACE (coalesce(l.bathrooms_text, a.m) AS bathrooms_text) FROM listings l"
    " LEFT JOIN a ON l.room_type = a.room_type)",
    "b AS (" + mode_sql("bathrooms_text", "bedrooms", "m", "s1") + ")",
    "s2 AS (SELECT s1.* REPLACE (coalesce(s1.bedrooms, b.m) AS bedrooms) FROM s1"
    " LEFT JOIN b ON s1.bathrooms_text = b.bathrooms_text)",
    "c AS (" + mode_sql("bedrooms", "beds", "m", "s2") + ")")


def q_price_impute(spark, sf):
    df = _split(spark, sf).withColumn("price", S.price_digits("price"))
    fit = I.fit_price_medians(df.filter("split = 'train'"), "price", "neighbourhood_cleansed", "room_type")
    out = I.price_impute(df, fit, "price", "neighbourhood_cleansed", "room_type")
    return out.select("id", "split", "price_imputed", "price_was_missing")


O["price_impute"] = with_split(
    "SELECT s.id, s.split, coalesce(s.price, pm.m, nm.m, (SELECT median(price) FROM tr)) AS price_imputed,"
    " CAST(s.price IS NULL AS INTEGER) AS price_was_missing FROM sp s"
    " LEFT JOIN pm ON s.neighbourhood_cleansed = pm.neighbourhood_cleansed AND s.room_type = pm.room_type"
    " LEFT JOIN nm ON s.neighbourhood_cleansed = nm.neighbourhood_cleansed",
    f"sp AS (SELECT * REPLACE ({PRICE_DIGITS_SQL} AS price) FROM split)",
    "tr AS (SELECT * FROM sp WHERE split = 'train')",
    "pm AS (SELECT neighbourhood_cleansed, room_type, median(price) AS m FROM tr GROUP BY ALL"
    " HAVING median(price) IS NOT NULL)",
    "nm AS (SELECT neighbourhood_cleansed, median(price) AS m FROM tr GROUP BY ALL HAVING median(price) IS NOT NULL)")

REMAIN_COLS = ["accommodates", "bedrooms", "beds", "review_scores_rating", "host_response_time", "host_neighbourhood",
               "bathrooms_text"]


def q_impute_remaining(spark, sf):
    df = _split(spark, sf).select("id", "split", *REMAIN_COLS)
    fill = I.fit_remaining(df.filter("split = 'train'"), exclude=("id", "split"))
    return I.apply_fill(df.filter("split = 'test'"), fill).drop("split")


def _fill_sql(num, cat, default_unknown=True):
    parts = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM tr)) AS {c}" for c in num)
    cats = ", ".join(
        f"coalesce({c}, (SELECT {'coalesce(m, ' + repr('unknown') + ')' if default_unknown else 'm'} FROM"
        f" (SELECT max(m) AS m FROM (" + mode_sql("k", c, "m", f"(SELECT 1 AS k, {c} FROM tr)") + ")))) AS " + c
        for c in cat)
    return parts + (", " if parts and cats else "") + cats


O["impute_remaining"] = with_split(
    "SELECT id, CAST(coalesce(accommodates, (SELECT median(accommodates) FROM tr)) AS INTEGER) AS accommodates, "
    + _fill_sql(["bedrooms", "beds", "review_scores_rating"], ["host_response_time", "host_neighbourhood",
                                                                 "bathrooms_text"])
    + " FROM split WHERE split = 'test'",
    "tr AS (SELECT * FROM split WHERE split = 'train')")


def q_simple_imputer(spark, sf):
    df = _split(spark, sf).select("id", "split", "bedrooms", "beds", "host_response_time", "bathrooms_text")
    fill = I.simple_imputer_fit(df.filter("split = 'train'"), ["bedrooms", "beds"],
                                ["host_response_time", "bathrooms_text"])
    return I.apply_fill(df, fill).drop("split")


O["simple_imputer"] = with_split(
    "SELECT id, " + _fill_sql(["bedrooms", "beds"], ["host_response_time", "bathrooms_text"], False) + " FROM split",
    "tr AS (SELECT * FROM split WHERE split = 'train')")


def q_constant_fill(spark, sf):
    df = _priced(spark, sf).select("id", "price", "accommodates")
    return I.constant_fill(df, {"price": 50.0, "bathrooms": 0})


O["constant_fill"] = with_listings(
    f"SELECT id, coalesce({PRICE_DIGITS_SQL}, 50.0) AS price, accommodates, 0 AS bathrooms FROM listings")


for _name, _fn in list(globals().items()):
    if _name.startswith("q_") and callable(_fn):
        Q[_name[2:]] = _fn

QUERIES = Q
ORACLES = O
