"""Flagship query: the smallest slice of the cleaning job that answers one real question.

listings -> price parse (C1, C5) -> group split by host (G2) -> price medians fitted on
train (A8) -> price imputation (I3) -> price per person (C27) -> target levels (G1) ->
average imputed price, price per person and row count by occupancy level and room type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions import scalars as S
from tabforge.operators import impute as I
from tabforge.operators import split as G
from tabforge.sources.fixtures import listings


def price_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = G.split_column(listings(spark, sf_dir), "host_id", "id").withColumn("price", S.price_digits("price"))
    fit = I.fit_price_medians(df.filter("split = 'train'"), "price", "neighbourhood_cleansed", "room_type")
    priced = I.price_impute(df, fit, "price", "neighbourhood_cleansed", "room_type")
    out = (priced.withColumn("price_per_person", S.price_per_person("price_imputed", "accommodates"))
           .withColumn("occupancy_level", G.occupancy_level("estimated_occupancy_l365d")))
    return (out.groupBy("split", "occupancy_level", "room_type")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.round(F.avg("price_imputed"), 6).alias("avg_price_imputed"),
                 F.round(F.avg("price_per_person"), 6).alias("avg_price_per_person")))
