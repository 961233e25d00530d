"""Profiling of a raw or clean table: shape, nulls, value counts, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuescope.operators.quality import duplicate_rows


def shape(df: DataFrame) -> DataFrame:
    """One row per column: name, position, Spark type, and the table's row
    and column counts (the count is a scalar subquery over the data)."""
    spark = df.sparkSession
    n = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    meta = spark.createDataFrame(
        [(f.name, i + 1, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "column_name string, position int, data_type string")
    return meta.select("*", n.alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, most first: one aggregate pass, then unpivot."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = agg.unpivot([], df.columns, "column_name", "null_count")
    return long.orderBy(F.col("null_count").desc(), F.col("column_name").asc())


def value_counts(df: DataFrame, col: str, top: int | None = 15, dropna: bool = False) -> DataFrame:
    """``value_counts`` top-k (nulls kept unless ``dropna``); ties by value."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    out = (src.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
           .orderBy(F.col("count").desc(), F.col(col).asc_nulls_first()))
    return out.limit(top) if top else out


def contains_count(df: DataFrame, col: str, needle: str = ",") -> DataFrame:
    """How many values contain ``needle`` (missing values never do)."""
    return df.agg(F.count_if(F.coalesce(F.col(col).cast("string").contains(needle), F.lit(False)))
                  .alias("n_containing"))


def exact_duplicates(df: DataFrame, cols=None) -> DataFrame:
    return duplicate_rows(df, cols).select("duplicates")


def logical_duplicates(df: DataFrame, keys) -> DataFrame:
    """Rows repeating an earlier row's ``keys`` (sum of n - 1 per key)."""
    return duplicate_rows(df, keys).select("duplicates")


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Exact distinct non-null values (``nunique``)."""
    return df.agg(F.countDistinct(col).alias("n_distinct"))


def data_loss(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """What each cleaning step nulled, and the valid cost+city share.

    ``raw`` and ``clean`` share their rows, so all counts come from two
    one-row aggregates (raw rows as a scalar subquery)."""
    rows_read = raw.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    valid = F.col("cost_for_two").isNotNull() & F.col("city_clean").isNotNull()
    n = F.count(F.lit(1))
    return clean.agg(
        n.alias("rows_kept"),
        F.count_if(F.col("rating").isNull()).alias("unrated"),
        (F.lit(100.0) * F.count_if(F.col("rating").isNull()) / n).alias("unrated_pct"),
        F.count_if(F.col("cost_for_two").isNull()).alias("invalid_costs"),
        F.countDistinct("city_clean").alias("distinct_cities"),
        F.count_if(valid).alias("valid_cost_city"),
        (F.lit(100.0) * F.count_if(valid) / n).alias("valid_pct"),
    ).select(rows_read.alias("rows_read"), "*")
