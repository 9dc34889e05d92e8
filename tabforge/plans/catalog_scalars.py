"""Registered queries for the scalar cleaning functions.

Each query runs over the whole derived ``listings`` table and returns the
listing id with the cleaned columns; ``ORACLES`` holds the DuckDB text of
the same computation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions import lists as LS
from tabforge.functions import nulls as N
from tabforge.functions import scalars as S
from tabforge.operators.columns import round_int_like
from tabforge.operators.profile import numeric_coerce_report
from tabforge.sources.fixtures import LISTINGS_SQL, listings

TOK = N.sql_token_list()
MASK_TOK = N.sql_token_list(N.MASK_TOKENS)


def nm(c: str, tok: str = TOK) -> str:
    return f"(CASE WHEN {c} IS NULL OR trim(CAST({c} AS VARCHAR)) IN ({tok}) THEN NULL ELSE {c} END)"


def with_listings(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {LISTINGS_SQL}{extra}\n{body}"


Q = {}
O = {}


def q_normalize_missing(spark, sf):
    cols = ["price", "host_response_time", "host_neighbourhood", "host_response_rate"]
    return listings(spark, sf).select("id", *[N.normalize_missing(c).alias(c) for c in cols])


O["normalize_missing"] = with_listings(
    "SELECT id, " + ", ".join(f"{nm(c)} AS {c}" for c in
                              ["price", "host_response_time", "host_neighbourhood", "host_response_rate"])
    + " FROM listings")


def q_missing_mask(spark, sf):
    cols = ["price", "host_response_time", "host_neighbourhood", "neighbourhood", "bedrooms", "host_id"]
    return listings(spark, sf).select(
        "id", *[N.missing_mask(c, N.MASK_TOKENS).alias(f"{c}_missing") for c in cols])


O["missing_mask"] = with_listings(
    "SELECT id, " + ", ".join(
        f"CAST(({c} IS NULL OR coalesce(trim(CAST({c} AS VARCHAR)) IN ({MASK_TOK}), false)) AS INTEGER) AS {c}_missing"
        for c in ["price", "host_response_time", "host_neighbourhood", "neighbourhood", "bedrooms", "host_id"])
    + " FROM listings")


def q_parse_dates(spark, sf):
    df = listings(spark, sf)
    text = (F.when(F.col("id") % 13 == 0, F.lit("not a date"))
            .otherwise(F.col("host_since").cast("string")))
    return df.select("id", S.parse_date(text).alias("host_since"),
                     S.parse_date(F.col("last_review").cast("string")).alias("last_review"))


O["parse_dates"] = with_listings(
    "SELECT id, TRY_CAST(CASE WHEN id % 13 = 0 THEN 'not a date' ELSE CAST(host_since AS VARCHAR) END AS DATE) AS host_since, "
    "TRY_CAST(CAST(last_review AS VARCHAR) AS DATE) AS last_review FROM listings")


def q_price_signed(spark, sf):
    return listings(spark, sf).select("id", S.price_signed("price").alias("price"))


O["price_signed"] = with_listings(
    f"SELECT id, TRY_CAST(trim(regexp_replace({nm('price')}, '[€$£,]', '', 'g')) AS DOUBLE) AS price FROM listings")


def q_price_digits(spark, sf):
    return listings(spark, sf).select("id", S.price_digits("price").alias("price"))


PRICE_DIGITS_SQL = f"TRY_CAST(nullif(regexp_replace({nm('price')}, '[^0-9.]', '', 'g'), '') AS DOUBLE)"
O["price_digits"] = with_listings(f"SELECT id, {PRICE_DIGITS_SQL} AS price FROM listings")

COERCE_COLS = ["price", "host_response_rate", "bathrooms_text", "host_response_time", "accommodates", "host_since"]


def q_numeric_coerce(spark, sf):
    return numeric_coerce_report(listings(spark, sf), COERCE_COLS)


O["numeric_coerce"] = with_listings(
    "SELECT column_name, valid_frac, CAST(valid_frac >= 0.5 AS INTEGER) AS usable FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(CASE WHEN TRY_CAST(nullif(regexp_replace(CAST({c} AS VARCHAR), "
        f"'[^0-9.\\-]', '', 'g'), '') AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS valid_frac FROM listings"
        for c in COERCE_COLS) + ")")


def q_clean_percent(spark, sf):
    return listings(spark, sf).select("id", S.clean_percent("host_response_rate").alias("host_response_rate"))


O["clean_percent"] = with_listings(
    "SELECT id, TRY_CAST(nullif(regexp_replace(CAST(host_response_rate AS VARCHAR), '[^0-9.]+', '', 'g'), '') AS DOUBLE)"
    " / 100.0 AS host_response_rate FROM listings")


def q_bool_yes_no(spark, sf):
    return listings(spark, sf).select(
        "id", S.bool_yes_no("host_is_superhost", fill="no").alias("host_is_superhost"),
        S.bool_yes_no("instant_bookable").alias("instant_bookable"),
        S.bool_yes_no("has_availability").alias("has_availability"))


def _yn(c):
    return f"(CASE WHEN {c} IN ('t', 'true', 'True') THEN 'yes' WHEN {c} IN ('f', 'false', 'False') THEN 'no' ELSE {c} END)"


O["bool_yes_no"] = with_listings(
    f"SELECT id, coalesce({_yn('host_is_superhost')}, 'no') AS host_is_superhost, "
    f"{_yn('instant_bookable')} AS instant_bookable, {_yn('has_availability')} AS has_availability FROM listings")


def q_bool_to_int(spark, sf):
    cols = ["host_is_superhost", "instant_bookable", "has_availability"]
    return listings(spark, sf).select("id", *[S.bool_to_int(c).alias(c) for c in cols])


def _bi(c):
    return (f"(CASE WHEN lower(trim({c})) IN ('t', 'yes', 'true', '1') THEN 1 "
            f"WHEN lower(trim({c})) IN ('f', 'no', 'false', '0') THEN 0 ELSE NULL END)")


O["bool_to_int"] = with_listings(
    "SELECT id, " + ", ".join(f"{_bi(c)} AS {c}" for c in ["host_is_superhost", "instant_bookable", "has_availability"])
    + " FROM listings")


def q_infer_availability(spark, sf):
    return listings(spark, sf).select(
        "id", S.infer_availability("has_availability", ["availability_365"]).alias("has_availability"))


O["infer_availability"] = with_listings(
    "SELECT id, coalesce(has_availability, CASE WHEN coalesce(CAST(availability_365 AS DOUBLE), 0) <> 0 "
    "THEN 't' ELSE 'f' END) AS has_availability FROM listings")


def q_was_evaluated_flag(spark, sf):
    return listings(spark, sf).select("id", S.was_evaluated_flag("host_is_superhost").alias("was_evaluated_for_superhost"))


O["was_evaluated_flag"] = with_listings(
    "SELECT id, CAST(host_is_superhost IS NOT NULL AS INTEGER) AS was_evaluated_for_superhost FROM listings")


def q_coalesce_neighbourhood(spark, sf):
    return listings(spark, sf).select(
        "id", S.coalesce_columns("neighbourhood", "neighbourhood_cleansed").alias("neighbourhood"))


O["coalesce_neighbourhood"] = with_listings(
    "SELECT id, coalesce(neighbourhood, neighbourhood_cleansed) AS neighbourhood FROM listings")


def q_blank_to_default(spark, sf):
    return listings(spark, sf).select("id", S.blank_to_default("host_neighbourhood").alias("host_neighbourhood"))


O["blank_to_default"] = with_listings(
    "SELECT id, coalesce(CASE WHEN regexp_matches(host_neighbourhood, '^\\s*$') THEN NULL ELSE host_neighbourhood END,"
    " 'not-defined') AS host_neighbourhood FROM listings")

FLAG_SQL = ("CAST((coalesce(number_of_reviews > 0, false) OR first_review IS NOT NULL OR last_review IS NOT NULL "
            "OR coalesce(reviews_per_month, 0.0) > 0) AS INTEGER)")


def _flag():
    return S.has_reviews_flag("number_of_reviews", "first_review", "last_review", "reviews_per_month")


def q_has_reviews_flag(spark, sf):
    return listings(spark, sf).select("id", _flag().alias("has_reviews_flag"))


O["has_reviews_flag"] = with_listings(f"SELECT id, {FLAG_SQL} AS has_reviews_flag FROM listings")


def q_zero_review_scores(spark, sf):
    df = listings(spark, sf).withColumn("has_reviews_flag", _flag())
    return df.select("id", S.zero_review_score("review_scores_rating", "has_reviews_flag").alias("review_scores_rating"))


O["zero_review_scores"] = with_listings(
    f"SELECT id, CASE WHEN {FLAG_SQL} = 0 THEN 0.0 ELSE TRY_CAST(CAST(review_scores_rating AS VARCHAR) AS DOUBLE) END"
    " AS review_scores_rating FROM listings")


def q_days_since_review(spark, sf):
    df = listings(spark, sf).withColumn("f", _flag())
    return df.select("id", S.days_since("last_scraped", "first_review", "f").alias("days_since_first_review"),
                     S.days_since("last_scraped", "last_review", "f").alias("days_since_last_review"))


O["days_since_review"] = with_listings(
    "SELECT id, " + ", ".join(
        f"CAST(greatest(coalesce(CASE WHEN {FLAG_SQL} = 1 THEN date_diff('day', {d}, last_scraped) END, -1), -1) AS INTEGER)"
        f" AS days_since_{d}" for d in ["first_review", "last_review"]) + " FROM listings")


def q_fill_reviews_per_month(spark, sf):
    df = listings(spark, sf).withColumn("f", _flag())
    return df.select("id", S.fill_reviews_per_month("reviews_per_month", "f").alias("reviews_per_month"))


O["fill_reviews_per_month"] = with_listings(
    f"SELECT id, CASE WHEN {FLAG_SQL} = 0 AND reviews_per_month IS NULL THEN 0.0 ELSE reviews_per_month END"
    " AS reviews_per_month FROM listings")


def q_host_tenure(spark, sf):
    df = listings(spark, sf).withColumn("host_days_active", S.host_days_active("last_scraped", "host_since"))
    return df.select("id", "host_days_active", S.host_is_new("host_days_active").alias("host_is_new"))


O["host_tenure"] = with_listings(
    "SELECT id, host_days_active, CAST(coalesce(host_days_active >= 0 AND host_days_active < 90, false) AS INTEGER)"
    " AS host_is_new FROM (SELECT id, CAST(coalesce(date_diff('day', host_since, last_scraped), -1) AS INTEGER)"
    " AS host_days_active FROM listings)")


def q_parse_bathrooms(spark, sf):
    return listings(spark, sf).select("id", S.parse_bathrooms("bathrooms_text").alias("bathrooms_text_num"))


O["parse_bathrooms"] = with_listings(
    "SELECT id, TRY_CAST(nullif(regexp_extract(coalesce(bathrooms_text, ''), '([0-9]*\\.?[0-9]+)', 1), '') AS DOUBLE)"
    " AS bathrooms_text_num FROM listings")


def q_parse_half_bath(spark, sf):
    return listings(spark, sf).select("id", S.parse_half_bath("bathrooms_text").alias("bathrooms_text"))


O["parse_half_bath"] = with_listings(
    "SELECT id, TRY_CAST(nullif(regexp_extract(replace(lower(coalesce(bathrooms_text, '')), 'half-bath', '0.5 bath'),"
    " '([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE) AS bathrooms_text FROM listings")


def q_text_length_features(spark, sf):
    df = listings(spark, sf)
    out = ["id"]
    for c in ["amenities", "host_neighbourhood"]:
        out += [S.text_length(c).alias(f"{c}_length"), F.col(c).isNull().cast("int").alias(f"{c}_missing")]
    return df.select(*out)


O["text_length_features"] = with_listings(
    "SELECT id, " + ", ".join(
        f"CAST(length(regexp_replace(coalesce({c}, ''), '^\\s+|\\s+$', '', 'g')) AS INTEGER) AS {c}_length, "
        f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in ["amenities", "host_neighbourhood"]) + " FROM listings")


def q_ordinal_encode(spark, sf):
    return listings(spark, sf).select("id", S.ordinal_encode("host_response_time").alias("host_response_time"))


O["ordinal_encode"] = with_listings(
    "SELECT id, CASE lower(trim(host_response_time)) WHEN 'within an hour' THEN 0 WHEN 'within a few hours' THEN 1 "
    "WHEN 'within a day' THEN 2 WHEN 'a few days or more' THEN 3 ELSE NULL END AS host_response_time FROM listings")


def q_nonfinite_to_null(spark, sf):
    df = listings(spark, sf)
    raw = (F.when(F.col("id") % 7 == 0, F.lit(float("inf"))).when(F.col("id") % 5 == 0, F.lit(float("-inf")))
           .when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("review_scores_rating")))
    return df.select("id", S.nonfinite_to_null(raw).alias("review_scores_rating"))


O["nonfinite_to_null"] = with_listings(
    "SELECT id, CASE WHEN id % 7 = 0 OR id % 5 = 0 OR id % 3 = 0 THEN NULL ELSE review_scores_rating END"
    " AS review_scores_rating FROM listings")

INT_LIKE_COLS = ["bedrooms", "beds", "reviews_per_month", "review_scores_rating", "estimated_occupancy_l365d"]


def q_round_int_like(spark, sf):
    return round_int_like(listings(spark, sf), INT_LIKE_COLS).select("id", *INT_LIKE_COLS)


O["round_int_like"] = with_listings(
    "SELECT id, " + ", ".join(f"CASE WHEN f_{c} THEN round_even({c}, 0) ELSE {c} END AS {c}" for c in INT_LIKE_COLS)
    + " FROM listings CROSS JOIN flags",
    "flags AS (SELECT " + ", ".join(
        f"coalesce(bool_and(abs({c} - round({c})) <= 1e-8 + 1e-5 * abs(round({c}))), false) AS f_{c}"
        for c in INT_LIKE_COLS) + " FROM listings)")


def q_log1p_positive(spark, sf):
    df = listings(spark, sf).select("id", S.price_digits("price").alias("price"))
    return df.filter(F.col("price") > 0).select("id", F.round(S.log1p_positive("price"), 9).alias("log_price"))


O["log1p_positive"] = with_listings(
    "SELECT id, round(ln(1 + price), 9) AS log_price FROM (SELECT id, "
    f"{PRICE_DIGITS_SQL} AS price FROM listings) WHERE price > 0")


def q_occupancy_rate(spark, sf):
    df = listings(spark, sf).withColumn("occ_rate", S.occupancy_rate("estimated_occupancy_l365d"))
    return df.select("id", "occ_rate", (F.lit(1.0) - F.col("occ_rate")).alias("occ_complement"),
                     S.availability_proxy("availability_365").alias("availability_proxy"))


O["occupancy_rate"] = with_listings(
    "SELECT id, occ_rate, 1.0 - occ_rate AS occ_complement, availability_proxy FROM (SELECT id, "
    "least(greatest(TRY_CAST(nullif(regexp_replace(CAST(estimated_occupancy_l365d AS VARCHAR), '[^0-9.\\-]', '', 'g'), '')"
    " AS DOUBLE) / 365.0, 0.0), 1.0) AS occ_rate, 1.0 - CAST(availability_365 AS DOUBLE) / 365.0 AS availability_proxy"
    " FROM listings)")


def q_price_per_person(spark, sf):
    from tabforge.operators.impute import fill_with_median
    df = listings(spark, sf).select("id", S.price_per_person(S.price_digits("price"), "accommodates")
                                    .alias("price_per_person"))
    return fill_with_median(df, ["price_per_person"], fit_df=df).select("id", "price_per_person")


O["price_per_person"] = with_listings(
    "SELECT id, coalesce(ppp, (SELECT median(ppp) FROM base)) AS price_per_person FROM base",
    f"base AS (SELECT id, {PRICE_DIGITS_SQL} / CASE WHEN accommodates IS NULL OR accommodates = 0 THEN 1.0"
    " ELSE CAST(accommodates AS DOUBLE) END AS ppp FROM listings)")

# DuckDB reading of the list spellings present in the listings text: strip the
# brackets, split on commas, trim and unquote each item.
LIST_ITEMS_SQL = (
    "list_sort(list_distinct(list_filter(list_transform(string_split(regexp_replace(translate(trim(amenities), '{}', '[]'),"
    " '^[\\[\\]]+|[\\[\\]]+$', '', 'g'), ','), lambda x: lower(regexp_replace(regexp_replace(trim(x), '^\"+|\"+$', '', 'g'),"
    " '^''+|''+$', '', 'g'))), lambda x: length(x) > 0)))")


def q_parse_list_text(spark, sf):
    df = listings(spark, sf).select("id", LS.parse_list_text("amenities").alias("items"))
    return df.select("id", F.size("items").alias("n_items"), F.array_join("items", "|").alias("items"))


O["parse_list_text"] = with_listings(
    "SELECT id, CAST(len(items) AS INTEGER) AS n_items, array_to_string(items, '|') AS items FROM ("
    f"SELECT id, CASE WHEN amenities IS NULL THEN []::VARCHAR[] ELSE {LIST_ITEMS_SQL} END AS items FROM listings)")


def q_parse_list_text_single(spark, sf):
    df = listings(spark, sf).select("id", LS.parse_list_text("amenities", single=True).alias("items"))
    return df.select("id", F.size("items").alias("n_items"), F.array_join("items", "|").alias("items"))


O["parse_list_text_single"] = with_listings(
    "SELECT id, CAST(len(items) AS INTEGER) AS n_items, array_to_string(items, '|') AS items FROM ("
    "SELECT id, CASE WHEN amenities IS NULL THEN []::VARCHAR[] "
    "WHEN NOT (amenities LIKE '[%' OR amenities LIKE '{%') THEN [lower(trim(amenities))] "
    "WHEN NOT json_valid(replace(translate(amenities, '{}', '[]'), chr(39), '\"')) THEN []::VARCHAR[] "
    f"ELSE {LIST_ITEMS_SQL} END AS items FROM listings)")


def q_amenity_slug(spark, sf):
    df = listings(spark, sf).select(F.explode(LS.parse_list_text("amenities")).alias("token")).distinct()
    return df.select("token", LS.amenity_slug("token").alias("slug"))


O["amenity_slug"] = with_listings(
    "SELECT token, CASE WHEN length(s) = 0 THEN 'amenity_other' ELSE 'amenity_' || s END AS slug FROM ("
    "SELECT token, trim(regexp_replace(token, '[^a-z0-9]+', '_', 'g'), '_') AS s FROM ("
    f"SELECT DISTINCT unnest({LIST_ITEMS_SQL}) AS token FROM listings WHERE amenities IS NOT NULL))")


for _name, _fn in list(globals().items()):
    if _name.startswith("q_") and callable(_fn):
        Q[_name[2:]] = _fn

QUERIES = Q
ORACLES = O
