"""Boundary features as rows: property map and geometry text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES_SCHEMA = "features array<struct<properties: map<string,string>, geometry: string>>"


# How the JSON reader renders a bare NaN token in a text field.
_NAN_TOKEN = '"NaN"'


def scrub_nan(properties: Column) -> Column:
    """Drop keys whose value is NaN; nulls stay."""

    def is_nan(value: Column) -> Column:
        return F.coalesce((value == _NAN_TOKEN) | F.isnan(value.try_cast("double")), F.lit(False))

    return F.map_filter(properties, lambda k, v: ~is_nan(v))


def features(text: DataFrame, province_key: str | None = None, province: str | None = None) -> DataFrame:
    """(value) holding one feature collection per row -> one row per feature.

    With a province the layer is cut to it, without one it stays national.
    """
    options = {"allowNonNumericNumbers": "true"}
    parsed = text.select(F.from_json("value", FEATURES_SCHEMA, options).alias("c"))
    rows = parsed.select(F.inline("c.features")).withColumn("properties", scrub_nan(F.col("properties")))
    return rows if province_key is None else rows.where(F.col("properties")[province_key] == province)


def read_features(spark: SparkSession, path: str, province_key: str | None = None, province: str | None = None) -> DataFrame:
    return features(spark.read.option("wholetext", "true").text(path), province_key, province)
