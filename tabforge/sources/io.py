"""Sources and sinks: the listings CSV reader (S1) and scoring requests as JSON.

Object-store paths (``s3a://...``) need only the usual Hadoop filesystem
settings on the session; the readers take any path Spark can read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.nulls import normalize_missing

CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# Scoring request fields, their types and defaults.
REQUEST_FIELDS = (
    ("host_since", "string", "2020-01-01"), ("host_response_time", "string", "within an hour"),
    ("host_response_rate", "string", "100%"), ("host_acceptance_rate", "string", "95%"),
    ("host_is_superhost", "string", "t"), ("host_listings_count", "long", 1),
    ("host_total_listings_count", "long", 1), ("host_has_profile_pic", "string", "t"),
    ("host_identity_verified", "string", "t"), ("neighbourhood_cleansed", "string", "Palermo"),
    ("latitude", "double", -34.58), ("longitude", "double", -58.42),
    ("property_type", "string", "Entire rental unit"), ("room_type", "string", "Entire home/apt"),
    ("accommodates", "long", 2), ("bathrooms", "double", 1.0), ("bedrooms", "double", 1.0), ("beds", "double", 1.0),
    ("price", "string", "$50.00"), ("minimum_nights", "long", 2), ("maximum_nights", "long", 30),
    ("minimum_minimum_nights", "long", 2), ("maximum_minimum_nights", "long", 2),
    ("minimum_maximum_nights", "long", 1125), ("maximum_maximum_nights", "long", 1125),
    ("minimum_nights_avg_ntm", "double", 2.0), ("maximum_nights_avg_ntm", "double", 1125.0),
    ("has_availability", "string", "t"), ("availability_30", "long", 10), ("availability_60", "long", 20),
    ("availability_90", "long", 30), ("availability_365", "long", 100), ("number_of_reviews", "long", 10),
    ("number_of_reviews_ltm", "long", 2), ("number_of_reviews_l30d", "long", 0),
    ("review_scores_rating", "double", 4.8), ("review_scores_accuracy", "double", 4.9),
    ("review_scores_cleanliness", "double", 4.8), ("review_scores_checkin", "double", 4.9),
    ("review_scores_communication", "double", 4.9), ("review_scores_location", "double", 4.9),
    ("review_scores_value", "double", 4.7), ("reviews_per_month", "double", 0.5),
    ("amenities", "string", '["Wifi", "Kitchen", "Air conditioning"]'),
)


def write_csv(df: DataFrame, path: str) -> str:
    """Header CSV with quoted, escaped text (the raw listings format)."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def read_listings(spark: SparkSession, path: str, types: dict | None = None, multi_line: bool = True) -> DataFrame:
    """Header CSV read as text, every null spelling -> null (C1), then ``try_cast`` to declared types.

    With ``multi_line`` a quoted field may hold line breaks, and then each file is read by one
    task, so large input must come as many files; without it files are split.
    """
    options = CSV_OPTIONS | {"multiLine": str(multi_line).lower()}
    raw = spark.read.options(**options).csv(path)   # no inference: all columns are text
    types = types or {}
    cols = []
    for c in raw.columns:
        v = normalize_missing(c)
        t = types.get(c)
        cols.append((v.try_cast(t) if t and t != "string" else v).alias(c))
    return raw.select(*cols)


def request_schema(inputs=()) -> T.StructType:
    """Schema of request files: the request fields, and training ``inputs`` (name, type) beyond them; numbers and text as they come in JSON."""
    own = {n: t for n, t, _ in REQUEST_FIELDS}
    extra = {n: "string" if t in ("date", "timestamp") else t for n, t in inputs if n not in own and n not in ("id", "complete")}
    item = T.StructType([T.StructField("id", T.StringType(), True), T.StructField("complete", T.BooleanType(), True),
                         *(T.StructField(n, T._parse_datatype_string(t), True) for n, t in (own | extra).items())])
    return T.StructType([T.StructField("data", T.ArrayType(item), True)])


def read_requests(spark: SparkSession, path: str, id_col: str | None = "request_id") -> DataFrame:
    """JSON lines ``{"data": [ListingData, ...]}`` -> one row per listing with defaults filled."""
    raw = spark.read.schema(request_schema()).json(path)
    if id_col:
        raw = raw.withColumn("__line", F.monotonically_increasing_id())
    rows = raw.select(*(["__line"] if id_col else []), F.posexplode("data").alias("__pos", "r"))
    out = [F.coalesce(F.col(f"r.{n}"), F.lit(d).cast(t)).alias(n) for n, t, d in REQUEST_FIELDS]
    keys = [F.concat_ws("-", F.col("__line").cast("string"), F.col("__pos").cast("string")).alias(id_col)] if id_col else []
    return rows.select(*keys, *out)


def requests_from(df: DataFrame, path: str, key: str = "id", inputs=(), complete: bool = False) -> str:
    """Write one JSON request line per row of ``df``: request fields and ``inputs`` it has; ``complete`` marks the rest as missing."""
    item = request_schema(inputs)["data"].dataType.elementType
    have = [f for f in item.fields if f.name in df.columns and f.name not in ("id", "complete")]
    record = F.struct(F.col(key).cast("string").alias("id"), *([F.lit(True).alias("complete")] if complete else []),
                      *[F.col(f.name).cast(f.dataType).alias(f.name) for f in have])
    df.select(F.to_json(F.struct(F.array(record).alias("data"))).alias("value")).write.mode("overwrite").text(path)
    return path
