"""The eight business queries over the published venue tables.

Each is filter -> groupBy -> agg -> having -> top-k: one shuffle on the
group key with partial (map-side) aggregation, so a city holding a third of
all rows costs one row per map task in the shuffle.  The group key is the
last sort key so that LIMIT is deterministic under ties; rounding goes
through ``round_half_up`` so ties break the same way in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuescope.config import Params, REFERENCE, PRICE_TIER_UNKNOWN, CUISINE_UNKNOWN, CUISINE_MISSING
from venuescope.functions import round_half_up

c = F.col


def n_true(flag: str) -> Column:
    """SUM(CASE WHEN flag THEN 1 ELSE 0 END) as BIGINT (null counts 0)."""
    return F.sum(F.when(c(flag), F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def pct(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / whole


def q1_city_market_size(r: DataFrame, p: Params = REFERENCE) -> DataFrame:
    return (r.where(c("city_clean").isNotNull())
            .groupBy("city_clean", "city_tier")
            .agg(F.count(F.lit(1)).alias("total_restaurants"),
                 round_half_up(F.avg("rating"), 2).alias("avg_rating"),
                 round_half_up(F.avg("cost_for_two"), 0).alias("avg_cost"))
            .orderBy(c("total_restaurants").desc(), c("city_clean").asc(), c("city_tier").asc())
            .limit(p.q1_limit))


def q2_cuisine_gap(rc: DataFrame, p: Params = REFERENCE) -> DataFrame:
    """Distinct *names* per cuisine (a chain counts once): exact
    count-distinct, planned as a (cuisine, name) pre-aggregation first."""
    return (rc.where(~c("cuisine").isin(CUISINE_UNKNOWN, CUISINE_MISSING) & c("rating").isNotNull())
            .groupBy("cuisine")
            .agg(F.countDistinct("name").alias("restaurant_count"),
                 round_half_up(F.avg("rating"), 2).alias("avg_rating"),
                 round_half_up(F.avg("cost_for_two"), 0).alias("avg_cost"))
            .where(c("restaurant_count") > p.q2_min_names)
            .orderBy(c("avg_rating").desc_nulls_last(), c("restaurant_count").asc(), c("cuisine").asc())
            .limit(p.q2_limit))


def q3_online_adoption(r: DataFrame, p: Params = REFERENCE) -> DataFrame:
    """All rows; a missing city is a group of its own (SQL semantics)."""
    return (r.groupBy("city_clean")
            .agg(F.count(F.lit(1)).alias("total"), n_true("has_online_order").alias("online_count"))
            .where(c("total") > p.q3_min_total)
            .select("city_clean", "total", "online_count",
                    round_half_up(pct(c("online_count"), c("total")), 1).alias("online_pct"))
            .orderBy(c("online_pct").asc(), c("city_clean").asc_nulls_first()))


def q4_price_tier_sweet_spot(r: DataFrame, p: Params = REFERENCE) -> DataFrame:
    hi = F.count(F.when(c("rating") >= p.high_rating, F.lit(1)))
    return (r.where((c("price_tier") != PRICE_TIER_UNKNOWN) & c("rating").isNotNull())
            .groupBy("price_tier")
            .agg(F.count(F.lit(1)).alias("restaurant_count"),
                 round_half_up(F.avg("rating"), 2).alias("avg_rating"),
                 hi.alias("high_rated_count"),
                 round_half_up(pct(hi, F.count(F.lit(1))), 1).alias("high_rated_pct"))
            .orderBy(c("avg_rating").desc(), c("price_tier").asc()))


def q5_tier2_opportunity(r: DataFrame, p: Params = REFERENCE) -> DataFrame:
    """HAVING on the *rounded* average, as the original's alias does."""
    return (r.where((c("city_tier") == p.q5_tier) & c("rating").isNotNull())
            .groupBy("city_clean")
            .agg(F.count(F.lit(1)).alias("restaurant_count"),
                 round_half_up(F.avg("rating"), 2).alias("avg_rating"),
                 round_half_up(F.avg("cost_for_two"), 0).alias("avg_cost"),
                 n_true("has_online_order").alias("online_ready"))
            .where(c("restaurant_count").between(p.q5_min_count, p.q5_max_count)
                   & (c("avg_rating") >= p.q5_min_avg_rating))
            .orderBy(c("avg_rating").desc(), c("restaurant_count").asc(), c("city_clean").asc_nulls_first())
            .limit(p.q5_limit))


def q6_locality_gaps(r: DataFrame, p: Params = REFERENCE) -> DataFrame:
    return (r.where((c("city_clean") == p.q6_city) & c("rating").isNotNull())
            .groupBy("location")
            .agg(F.count(F.lit(1)).alias("restaurants"),
                 round_half_up(F.avg("rating"), 2).alias("avg_rating"),
                 round_half_up(F.avg("cost_for_two"), 0).alias("avg_cost"),
                 n_true("has_online_order").alias("online_count"))
            .where(c("restaurants") >= p.q6_min_count)
            .orderBy(c("avg_rating").asc(), c("restaurants").desc(), c("location").asc_nulls_first())
            .limit(p.q6_limit))


def q7_competitive_density(rc: DataFrame, p: Params = REFERENCE) -> DataFrame:
    return (rc.where(c("cuisine").isin(*p.q7_cuisines) & c("city_clean").isin(*p.q7_cities))
            .groupBy("city_clean", "cuisine")
            .agg(F.count(F.lit(1)).alias("count"), round_half_up(F.avg("rating"), 2).alias("avg_rating"))
            .orderBy(c("city_clean").asc(), c("count").desc(), c("cuisine").asc()))


def q8_recommendation_matrix(r: DataFrame, p: Params = REFERENCE) -> DataFrame:
    """Composite over *rated* venues only (differs from the city
    opportunity table, which counts every venue)."""
    n = F.count(F.lit(1))
    online = pct(n_true("has_online_order"), n)
    score = F.avg("rating") * 20 + online * 0.3 - n * 0.001
    return (r.where(c("rating").isNotNull())
            .groupBy("city_clean", "city_tier")
            .agg(n.alias("restaurant_count"),
                 round_half_up(F.avg("rating"), 2).alias("avg_rating"),
                 round_half_up(online, 1).alias("online_pct"),
                 round_half_up(F.avg("cost_for_two"), 0).alias("avg_cost"),
                 round_half_up(score, 1).alias("opportunity_score"))
            .where(c("restaurant_count") >= p.q8_min_count)
            .orderBy(c("opportunity_score").desc(), c("city_clean").asc_nulls_first(), c("city_tier").asc())
            .limit(p.q8_limit))


BUSINESS_QUERIES = {
    "q1": (q1_city_market_size, "restaurants"),
    "q2": (q2_cuisine_gap, "restaurant_cuisines"),
    "q3": (q3_online_adoption, "restaurants"),
    "q4": (q4_price_tier_sweet_spot, "restaurants"),
    "q5": (q5_tier2_opportunity, "restaurants"),
    "q6": (q6_locality_gaps, "restaurants"),
    "q7": (q7_competitive_density, "restaurant_cuisines"),
    "q8": (q8_recommendation_matrix, "restaurants"),
}
