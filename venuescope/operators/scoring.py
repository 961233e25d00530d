"""Five-factor city opportunity score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuescope.config import Params, REFERENCE

FACTORS = (  # (column, weight key)
    ("avg_rating", "rating"),
    ("demand_index", "demand"),
    ("online_pct", "online"),
    ("market_gap", "gap"),
    ("competition_density", "competition"),
)


def minmax(x: str, stats: Column) -> Column:
    """(x - min) / (max - min) over the surviving rows; a constant factor
    scales to 0 (not MLlib's 0.5)."""
    lo, hi = stats.getField(f"min_{x}"), stats.getField(f"max_{x}")
    return F.coalesce((F.col(x) - lo) / F.nullif(hi - lo, F.lit(0)), F.lit(0.0))


def city_metrics(clean: DataFrame, params: Params = REFERENCE, city: str = "city_clean") -> DataFrame:
    """Per-city factors.  ``market_gap`` divides by *all* venues: an unrated
    venue counts as not high-rated.  Null cities are dropped (groupby)."""
    high = F.coalesce(F.col("rating") >= params.high_rating, F.lit(False)).cast("double")
    return (clean.where(F.col(city).isNotNull())
            .groupBy(city)
            .agg(F.count(F.lit(1)).alias("restaurant_count"),
                 F.avg("rating").alias("avg_rating"),
                 F.sum("votes").cast("bigint").alias("demand_index"),
                 (F.avg(F.col("has_online_order").cast("double")) * 100).alias("online_pct"),
                 (F.avg(high) * 100).alias("market_gap"))
            .withColumn("competition_density", F.col("restaurant_count")))


def city_opportunity(clean: DataFrame, params: Params = REFERENCE, city: str = "city_clean") -> DataFrame:
    """Aggregate (one shuffle on city) -> drop unrated and small cities ->
    min-max over the survivors -> weighted sum x 100, best first.

    Everything after the aggregate has one row per city; the min/max row is
    a scalar subquery, not a join."""
    m = city_metrics(clean, params, city)
    m = m.where(F.col("avg_rating").isNotNull() & (F.col("restaurant_count") >= params.min_city_venues))
    return score_metrics(m, params, city)


def score_metrics(m: DataFrame, params: Params = REFERENCE, city: str = "city_clean") -> DataFrame:
    """Min-max each factor over the rows given, weight, x 100, best first."""
    stats = m.agg(F.struct(*[f(F.col(x)).alias(f"{n}_{x}")
                             for x, _ in FACTORS for f, n in ((F.min, "min"), (F.max, "max"))]).alias("s"))
    m = m.withColumn("_mm", stats.select("s").scalar())   # one scalar subquery, read per row
    s = F.col("_mm")
    w = params.weights
    score = None
    for x, k in FACTORS:
        term = F.lit(w[k]) * minmax(x, s)
        score = term if score is None else score + term
    return (m.select(city, "restaurant_count", "avg_rating", "demand_index", "online_pct",
                     "market_gap", "competition_density", (score * 100).alias("opportunity_score"))
            .orderBy(F.col("opportunity_score").desc(), F.col(city).asc()))
