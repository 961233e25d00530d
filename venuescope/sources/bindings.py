"""The test tables re-shaped as raw venue listings.

The generated test data is a TPC-H-like star schema; the venue operators need
listing-shaped text.  ``raw_venues`` joins lineitem with its order, customer,
nation and part and writes each listing field as text, messy values
included ('NEW', '0', 'Nov...', '1,234').  One lineitem = one listing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing-shaped text view over lineitem ⨝ orders ⨝ customer ⨝ nation ⨝ part.

    Plan: orders ⨝ customer on custkey (shuffle), nation broadcast (25 rows,
    fixed), then lineitem ⨝ that on orderkey and ⨝ part on partkey (two
    shuffles, the minimum for two different keys).  Only the referenced
    columns reach the scans."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")

    buyers = (o.join(c, o.o_custkey == c.c_custkey)
              .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)   # 25 rows by definition
              .select("o_orderkey", "c_name", "n_name"))
    j = (li.join(buyers, li.l_orderkey == buyers.o_orderkey)
         .join(p, li.l_partkey == p.p_partkey))

    rating = (F.when(F.col("l_discount") == 0, F.lit("NEW"))
              .when(F.col("l_linenumber") == 7, F.lit("0"))
              .when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "R"), F.lit("Nov..."))
              .otherwise((F.col("l_discount") * 50).cast("decimal(3,1)").cast("string")))
    cost = (F.when(F.col("l_quantity") < 2, F.lit("0"))
            .otherwise(F.format_number(F.floor(F.col("l_extendedprice") / 50), 0)))
    return j.select(
        F.col("c_name").alias("name"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("city"),
        F.col("p_brand").alias("area"),
        F.when(F.col("p_size") == 1, F.lit("0"))
         .otherwise(F.replace(F.col("p_name"), F.lit(" "), F.lit(", "))).alias("cusine"),
        rating.alias("rating"),
        F.col("l_quantity").cast("int").cast("string").alias("rating_count"),
        cost.alias("cost_for_two"),
        (F.col("l_returnflag") == "N").alias("online_order"),
        (F.col("l_linestatus") == "O").alias("table_reservation"),
        (F.col("l_linenumber") == 1).alias("delivery_only"),
    )
