"""Cleaning functions on hand-made edge tables (every null token, odd prices, bin edges, list spellings)."""

from pyspark.sql import functions as F

from tabforge.functions import lists as LS
from tabforge.functions import nulls as N
from tabforge.functions import scalars as S
from tabforge.operators import split as G
from tabforge.operators import tokens as TK


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_normalize_missing_tokens(spark):
    vals = [None, "", " ", "nan", "NaN", "null", "Null", "NULL", "none", "None", "NONE", "-", ".", "N/A", "NA",
            "na", "n/a", "0", " x "]
    out = col_values(spark, vals, N.normalize_missing)
    assert out[:-2] == [None] * (len(vals) - 2)
    assert out[-2:] == ["0", " x "]
    masks = col_values(spark, vals, lambda c: N.missing_mask(c, N.MASK_TOKENS))
    # the notebook's mask set has no '-', '.', 'N/A' ... spellings
    assert masks == [1] * 11 + [0] * 8


def test_prices(spark):
    vals = ["$1,200.50", "€10", "£-5", "-5", "1.2.3", "abc", "", None, "nan"]
    assert col_values(spark, vals, S.price_signed) == [1200.5, 10.0, -5.0, -5.0, None, None, None, None, None]
    assert col_values(spark, vals, S.price_digits) == [1200.5, 10.0, 5.0, 5.0, None, None, None, None, None]
    assert col_values(spark, vals, S.numeric_coerce) == [1200.5, 10.0, -5.0, -5.0, None, None, None, None, None]


def test_percent_and_bools(spark):
    assert col_values(spark, ["95%", "100 %", "N/A", "", None], S.clean_percent) == [0.95, 1.0, None, None, None]
    vals = ["t", "f", "yes", "no", "True", "false", "1", "0", "maybe", None]
    assert col_values(spark, vals, S.bool_to_int) == [1, 0, 1, 0, 1, 0, 1, 0, None, None]


def test_bathrooms(spark):
    vals = ["1.5 shared baths", "Half-bath", "Shared half-bath", ".5 bath", "baths", None]
    assert col_values(spark, vals, S.parse_bathrooms) == [1.5, None, None, 0.5, None, None]
    assert col_values(spark, vals, S.parse_half_bath) == [1.5, 0.5, 0.5, 5.0, None, None]


def test_days_since_and_tenure(spark):
    df = spark.createDataFrame(
        [("2024-01-10", "2024-01-01", 1), ("2024-01-01", "2024-01-10", 1), ("2024-01-01", None, 1),
         ("2024-01-10", "2024-01-01", 0)], "s string, d string, f int"
    ).select(F.col("s").cast("date").alias("s"), F.col("d").cast("date").alias("d"), "f")
    out = [r[0] for r in df.select(S.days_since("s", "d", "f")).collect()]
    assert out == [9, -1, -1, -1]
    t = spark.createDataFrame([(-1,), (0,), (89,), (90,)], "d int").select(S.host_is_new("d")).collect()
    assert [r[0] for r in t] == [0, 1, 1, 0]


def test_parse_list_text(spark):
    vals = ['["Wifi","TV","wifi"]', '{"a","b"}', "['a','b']", "[a, b]", '["it\'s"]', '["bad', "[]", "", "Wifi", "5",
            None]
    out = col_values(spark, vals, lambda c: F.array_join(LS.parse_list_text(c), "|"))
    assert out == ["tv|wifi", "a|b", "a|b", "a|b", "it's", "bad", "", "", "wifi", "5", ""]
    single = col_values(spark, vals, lambda c: F.array_join(LS.parse_list_text(c, single=True), "|"))
    assert single == ["tv|wifi", "a|b", "a|b", "", "it's", "", "", "", "wifi", "5", ""]


def test_slugs_and_collisions(spark):
    assert TK.slug_names(["wi-fi", "wi fi", "***"]) == ["amenity_wi_fi", "amenity_wi_fi_2", "amenity_other"]
    out = col_values(spark, ["wi-fi", "***"], LS.amenity_slug)
    assert out == ["amenity_wi_fi", "amenity_other"]


def test_occupancy_bins(spark):
    vals = [-5.0, 0.0, 0.5, 1.0, 30.0, 30.5, 31.0, 120.0, 121.0, 255.0, 365.0, 400.0, None]
    out = col_values(spark, vals, G.occupancy_level, "double")
    assert out == ["zero", "zero", "low", "low", "low", "mid", "mid", "mid", "high", "high", "high", "high", None]


def test_ordinal_encode(spark):
    vals = ["Within an hour", " within a day", "a few days or more", "N/A", None]
    assert col_values(spark, vals, S.ordinal_encode) == [0, 2, 3, None, None]
