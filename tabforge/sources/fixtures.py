"""Test inputs derived from the driver tables.

``listings`` is the wide, messy listings table the operators are written for,
derived (one row per order) from ``orders customer nation lineitem part``;
nulls, bad tokens and list spellings are injected from key remainders.
``LISTINGS_SQL`` is the same derivation as DuckDB SQL, used by the oracles.

``predictions`` is a deterministic synthetic class-probability table keyed by
listing id, so that the metric operators can be checked exactly without a model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.session import tune


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mod(c: str, m: int) -> Column:
    return F.col(c) % F.lit(m)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    li = (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_rev"),
            F.min("l_shipdate").alias("first_review_ts"),
            F.max("l_shipdate").alias("last_review_ts"),
            F.sum("l_quantity").alias("occ"),
            F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("disc"),
            F.array_join(F.sort_array(F.collect_set("p_name")), "|").alias("am"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation has a fixed 25 rows: broadcast is size-bounded by construction
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    base = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    )
    k = "o_orderkey"
    am = F.col("am")

    def wrap(open_: str, sep: str, close: str) -> Column:
        return F.concat(F.lit(open_), F.replace(am, F.lit("|"), F.lit(sep)), F.lit(close))

    return base.select(
        F.col(k).alias("id"),
        F.when(_mod("o_custkey", 97) == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("host_id"),
        F.col("n_name").alias("neighbourhood_cleansed"),
        F.when(_mod(k, 2) == 0, F.lit(None)).otherwise(F.col("n_name")).alias("neighbourhood"),
        F.when(_mod(k, 4) == 0, F.lit(None)).when(_mod(k, 4) == 1, F.lit("  "))
        .otherwise(F.col("c_mktsegment")).alias("host_neighbourhood"),
        F.col("o_orderpriority").alias("room_type"),
        F.col("c_mktsegment").alias("property_type"),
        F.when(_mod(k, 23) == 0, F.lit("-")).when(_mod(k, 7) == 0, F.lit(None))
        .when(_mod(k, 29) == 0, F.lit("N/A"))
        .otherwise(F.concat(F.lit("$"), F.floor("o_totalprice").cast("bigint").cast("string"), F.lit(".50")))
        .alias("price"),
        _mod("o_custkey", 9).cast("int").alias("accommodates"),
        F.when(_mod(k, 11) == 0, F.lit(None)).otherwise((1 + _mod(k, 4)).cast("double")).alias("bedrooms"),
        F.when(_mod(k, 6) == 0, F.lit(None)).otherwise((1 + _mod(k, 5)).cast("double")).alias("beds"),
        F.when(_mod(k, 5) == 0, F.lit("1 bath")).when(_mod(k, 5) == 1, F.lit("1.5 shared baths"))
        .when(_mod(k, 5) == 2, F.lit("Half-bath")).when(_mod(k, 5) == 3, F.lit(None))
        .otherwise(F.lit("2 baths")).alias("bathrooms_text"),
        F.when(F.col("o_orderstatus") == "O", F.lit("t")).when(F.col("o_orderstatus") == "F", F.lit("f"))
        .alias("host_is_superhost"),
        F.when(_mod("o_custkey", 3) == 0, F.lit("t")).otherwise(F.lit("f")).alias("instant_bookable"),
        F.when(_mod("o_custkey", 6) == 0, F.lit("within an hour"))
        .when(_mod("o_custkey", 6) == 1, F.lit("Within a few hours"))
        .when(_mod("o_custkey", 6) == 2, F.lit(" within a day"))
        .when(_mod("o_custkey", 6) == 3, F.lit("a few days or more"))
        .when(_mod("o_custkey", 6) == 4, F.lit("N/A")).alias("host_response_time"),
        F.when(_mod(k, 9) == 0, F.lit(None))
        .otherwise(F.concat(_mod("o_custkey", 101).cast("string"), F.lit("%"))).alias("host_response_rate"),
        F.when(_mod(k, 31) == 0, F.lit(None)).otherwise(F.col("o_orderdate")).cast("date").alias("host_since"),
        F.lit("2002-01-01").cast("date").alias("last_scraped"),
        F.col("first_review_ts").cast("date").alias("first_review"),
        F.col("last_review_ts").cast("date").alias("last_review"),
        F.coalesce(F.col("n_rev"), F.lit(0).cast("bigint")).alias("number_of_reviews"),
        (F.col("n_rev").cast("double") / 12).alias("reviews_per_month"),
        (5 - F.col("disc").cast("double") / F.col("n_rev") / 10).alias("review_scores_rating"),
        F.when(_mod(k, 10) == 0, F.lit(None)).otherwise(F.lit("t")).alias("has_availability"),
        F.when(_mod(k, 20) == 0, F.lit(0)).otherwise(_mod(k, 366)).cast("int").alias("availability_365"),
        F.coalesce(F.col("occ"), F.lit(0.0)).alias("estimated_occupancy_l365d"),
        F.when(am.isNull() | (_mod(k, 19) == 0), F.lit(None))
        .when(_mod(k, 17) == 0, wrap("[", ", ", "]"))
        .when(_mod(k, 13) == 0, wrap("['", "', '", "']"))
        .when(_mod(k, 11) == 0, wrap('{"', '", "', '"}'))
        .otherwise(wrap('["', '", "', '"]')).alias("amenities"),
    )


# DuckDB text of the same derivation (the oracle side).
LISTINGS_SQL = """
listings AS (
WITH li AS (
  SELECT l_orderkey, count(*) AS n_rev, min(l_shipdate) AS first_review, max(l_shipdate) AS last_review,
         sum(l_quantity) AS occ, sum(CAST(round(l_discount * 100) AS BIGINT)) AS disc,
         array_to_string(list_sort(list(DISTINCT p_name)), '|') AS am
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
SELECT o_orderkey AS id,
  CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE o_custkey END AS host_id,
  n_name AS neighbourhood_cleansed,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE n_name END AS neighbourhood,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE c_mktsegment END AS host_neighbourhood,
  o_orderpriority AS room_type, c_mktsegment AS property_type,
  CASE WHEN o_orderkey % 23 = 0 THEN '-' WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'N/A'
       ELSE concat('$', CAST(floor(o_totalprice) AS BIGINT), '.50') END AS price,
  CAST(o_custkey % 9 AS INT) AS accommodates,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 4 AS DOUBLE) END AS bedrooms,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 5 AS DOUBLE) END AS beds,
  CASE o_orderkey % 5 WHEN 0 THEN '1 bath' WHEN 1 THEN '1.5 shared baths' WHEN 2 THEN 'Half-bath' WHEN 3 THEN NULL ELSE '2 baths' END AS bathrooms_text,
  CASE o_orderstatus WHEN 'O' THEN 't' WHEN 'F' THEN 'f' ELSE NULL END AS host_is_superhost,
  CASE WHEN o_custkey % 3 = 0 THEN 't' ELSE 'f' END AS instant_bookable,
  CASE o_custkey % 6 WHEN 0 THEN 'within an hour' WHEN 1 THEN 'Within a few hours' WHEN 2 THEN ' within a day'
       WHEN 3 THEN 'a few days or more' WHEN 4 THEN 'N/A' ELSE NULL END AS host_response_time,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat(o_custkey % 101, '%') END AS host_response_rate,
  CAST(CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderdate END AS DATE) AS host_since,
  DATE '2002-01-01' AS last_scraped,
  CAST(first_review AS DATE) AS first_review, CAST(last_review AS DATE) AS last_review,
  coalesce(n_rev, 0) AS number_of_reviews,
  CAST(n_rev AS DOUBLE) / 12 AS reviews_per_month,
  5 - CAST(disc AS DOUBLE) / n_rev / 10 AS review_scores_rating,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 't' END AS has_availability,
  CAST(CASE WHEN o_orderkey % 20 = 0 THEN 0 ELSE o_orderkey % 366 END AS INT) AS availability_365,
  coalesce(occ, CAST(0 AS DOUBLE)) AS estimated_occupancy_l365d,
  CASE WHEN am IS NULL OR o_orderkey % 19 = 0 THEN NULL
       WHEN o_orderkey % 17 = 0 THEN concat('[', replace(am, '|', ', '), ']')
       WHEN o_orderkey % 13 = 0 THEN concat('[', chr(39), replace(am, '|', concat(chr(39), ', ', chr(39))), chr(39), ']')
       WHEN o_orderkey % 11 = 0 THEN concat('{"', replace(am, '|', '", "'), '"}')
       ELSE concat('["', replace(am, '|', '", "'), '"]') END AS amenities
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN li ON l_orderkey = o_orderkey
)"""


# Synthetic score parameters (multiplier, modulus) per class, in column order.
SCORE_PARAMS = (("high", 7, 11), ("low", 5, 13), ("mid", 3, 17), ("zero", 11, 19))
# A second, differently parameterised member for ensemble checks.
SCORE_PARAMS_B = (("high", 3, 11), ("low", 7, 13), ("mid", 11, 17), ("zero", 5, 19))


def predictions(spark: SparkSession, sf_dir: str, params=SCORE_PARAMS, rows: DataFrame | None = None) -> DataFrame:
    """Synthetic class probabilities per listing: raw score 1 + (id * a) % m per class, normalised;
    label = occupancy level of the listing; pred = most probable class (first class wins ties).
    ``rows`` is the listings table where it is at hand."""
    from tabforge.operators.metrics import argmax_class
    from tabforge.operators.split import occupancy_level
    base = (listings(spark, sf_dir) if rows is None else rows).select("id", "estimated_occupancy_l365d")
    raw = {c: (1 + (F.col("id") * a) % m).cast("double") for c, a, m in params}
    total = sum(raw.values(), F.lit(0.0))
    out = base.select(F.col("id").alias("row_id"), occupancy_level("estimated_occupancy_l365d").alias("label"),
                      *[(raw[c] / total).alias(f"p_{c}") for c, _, _ in params])
    return out.withColumn("pred", argmax_class([c for c, _, _ in params]))


def predictions_sql(params=SCORE_PARAMS, name: str = "pr") -> str:
    """DuckDB CTE text of :func:`predictions` (needs the ``listings`` CTE)."""
    raws = ", ".join(f"CAST(1 + (id * {a}) % {m} AS DOUBLE) AS r_{c}" for c, a, m in params)
    tot = " + ".join(f"r_{c}" for c, _, _ in params)
    probs = ", ".join(f"r_{c} / ({tot}) AS p_{c}" for c, _, _ in params)
    cls = [c for c, _, _ in params]
    # a class wins when it is >= every later class and > every earlier one (first max wins)
    cases = []
    for i, c in enumerate(cls):
        conds = [f"p_{c} > p_{d}" for d in cls[:i]] + [f"p_{c} >= p_{d}" for d in cls[i + 1:]]
        cases.append(f"WHEN {' AND '.join(conds) if conds else 'true'} THEN '{c}'")
    level = ("CASE WHEN estimated_occupancy_l365d IS NULL THEN NULL WHEN least(greatest(estimated_occupancy_l365d, 0),"
             " 365) <= 0 THEN 'zero' WHEN least(greatest(estimated_occupancy_l365d, 0), 365) <= 30 THEN 'low'"
             " WHEN least(greatest(estimated_occupancy_l365d, 0), 365) <= 120 THEN 'mid' ELSE 'high' END")
    return (f"{name} AS (SELECT row_id, label, {', '.join('p_' + c for c in cls)}, CASE {' '.join(cases)} END AS pred"
            f" FROM (SELECT id AS row_id, {level} AS label, {probs} FROM (SELECT id, estimated_occupancy_l365d, {raws}"
            " FROM listings)))")
