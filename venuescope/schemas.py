"""Declared schemas: nothing is inferred."""

from pyspark.sql.types import (
    BooleanType, DoubleType, LongType, StringType, StructField, StructType,
)

RAW_COLUMNS = (
    "name", "city", "area", "cusine", "rating", "rating_count", "cost_for_two",
    "online_order", "table_reservation", "delivery_only", "famous_food",
)

# The raw file is read as text only; every column is cast explicitly later.
RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])

CLEAN_SCHEMA = StructType([
    StructField("name", StringType(), True),
    StructField("city_clean", StringType(), True),
    StructField("city_tier", StringType(), False),
    StructField("location", StringType(), True),
    StructField("cusine", StringType(), True),
    StructField("rating", DoubleType(), True),
    StructField("votes", LongType(), False),
    StructField("cost_for_two", DoubleType(), True),
    StructField("price_tier", StringType(), False),
    StructField("has_online_order", BooleanType(), True),
    StructField("has_table_booking", BooleanType(), True),
    StructField("delivery_only", BooleanType(), True),
])

CUISINE_SCHEMA = StructType([
    StructField("name", StringType(), True),
    StructField("city_clean", StringType(), True),
    StructField("cuisine", StringType(), True),
    StructField("rating", DoubleType(), True),
    StructField("cost_for_two", DoubleType(), True),
])
