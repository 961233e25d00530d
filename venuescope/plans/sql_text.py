"""The eight business queries as Spark SQL text over the published views.

``swap_in`` publishes ``restaurants`` and ``restaurant_cuisines`` as views,
so ``spark.sql(business_sql()["q1"])`` runs against the current version.
Same semantics as ``operators.business`` (which the job and the catalogue
use): booleans are used as booleans (``flag = 1`` is a type error under
ANSI), averages round half-up through DECIMAL, and the group key is the
last sort key so LIMIT is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from venuescope.config import PRICE_TIER_UNKNOWN, REFERENCE, Params


def _r(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(xs) -> str:
    return ", ".join(_q(x) for x in xs)


def business_sql(p: Params = REFERENCE) -> dict[str, str]:
    online = "CAST(SUM(CASE WHEN has_online_order THEN 1 ELSE 0 END) AS BIGINT)"
    online_pct = "100.0 * SUM(CASE WHEN has_online_order THEN 1 ELSE 0 END) / COUNT(*)"
    high = f"COUNT(CASE WHEN rating >= {p.high_rating} THEN 1 END)"
    return {
        "q1": f"""
SELECT city_clean, city_tier, COUNT(*) AS total_restaurants,
       {_r('AVG(rating)', 2)} AS avg_rating, {_r('AVG(cost_for_two)', 0)} AS avg_cost
FROM restaurants WHERE city_clean IS NOT NULL
GROUP BY city_clean, city_tier
ORDER BY total_restaurants DESC, city_clean, city_tier
LIMIT {p.q1_limit}""",
        "q2": f"""
SELECT cuisine, COUNT(DISTINCT name) AS restaurant_count,
       {_r('AVG(rating)', 2)} AS avg_rating, {_r('AVG(cost_for_two)', 0)} AS avg_cost
FROM restaurant_cuisines
WHERE cuisine NOT IN ('Unknown', '0') AND rating IS NOT NULL
GROUP BY cuisine
HAVING restaurant_count > {p.q2_min_names}
ORDER BY avg_rating DESC NULLS LAST, restaurant_count ASC, cuisine
LIMIT {p.q2_limit}""",
        "q3": f"""
SELECT city_clean, COUNT(*) AS total, {online} AS online_count, {_r(online_pct, 1)} AS online_pct
FROM restaurants
GROUP BY city_clean
HAVING total > {p.q3_min_total}
ORDER BY online_pct ASC, city_clean ASC NULLS FIRST""",
        "q4": f"""
SELECT price_tier, COUNT(*) AS restaurant_count, {_r('AVG(rating)', 2)} AS avg_rating,
       {high} AS high_rated_count, {_r(f'100.0 * {high} / COUNT(*)', 1)} AS high_rated_pct
FROM restaurants
WHERE price_tier != {_q(PRICE_TIER_UNKNOWN)} AND rating IS NOT NULL
GROUP BY price_tier
ORDER BY avg_rating DESC, price_tier""",
        "q5": f"""
SELECT city_clean, COUNT(*) AS restaurant_count, {_r('AVG(rating)', 2)} AS avg_rating,
       {_r('AVG(cost_for_two)', 0)} AS avg_cost, {online} AS online_ready
FROM restaurants
WHERE city_tier = {_q(p.q5_tier)} AND rating IS NOT NULL
GROUP BY city_clean
HAVING restaurant_count BETWEEN {p.q5_min_count} AND {p.q5_max_count} AND avg_rating >= {p.q5_min_avg_rating}
ORDER BY avg_rating DESC, restaurant_count ASC, city_clean ASC NULLS FIRST
LIMIT {p.q5_limit}""",
        "q6": f"""
SELECT location, COUNT(*) AS restaurants, {_r('AVG(rating)', 2)} AS avg_rating,
       {_r('AVG(cost_for_two)', 0)} AS avg_cost, {online} AS online_count
FROM restaurants
WHERE city_clean = {_q(p.q6_city)} AND rating IS NOT NULL
GROUP BY location
HAVING restaurants >= {p.q6_min_count}
ORDER BY avg_rating ASC, restaurants DESC, location ASC NULLS FIRST
LIMIT {p.q6_limit}""",
        "q7": f"""
SELECT city_clean, cuisine, COUNT(*) AS count, {_r('AVG(rating)', 2)} AS avg_rating
FROM restaurant_cuisines
WHERE cuisine IN ({_in(p.q7_cuisines)}) AND city_clean IN ({_in(p.q7_cities)})
GROUP BY city_clean, cuisine
ORDER BY city_clean, count DESC, cuisine""",
        "q8": f"""
SELECT city_clean, city_tier, COUNT(*) AS restaurant_count, {_r('AVG(rating)', 2)} AS avg_rating,
       {_r(online_pct, 1)} AS online_pct, {_r('AVG(cost_for_two)', 0)} AS avg_cost,
       {_r(f'AVG(rating) * 20 + {online_pct} * 0.3 - COUNT(*) * 0.001', 1)} AS opportunity_score
FROM restaurants
WHERE rating IS NOT NULL
GROUP BY city_clean, city_tier
HAVING restaurant_count >= {p.q8_min_count}
ORDER BY opportunity_score DESC, city_clean ASC NULLS FIRST, city_tier
LIMIT {p.q8_limit}""",
    }


def run_sql(spark: SparkSession, p: Params = REFERENCE) -> dict[str, DataFrame]:
    """Every business query as a lazy DataFrame over the published views."""
    return {name: spark.sql(text) for name, text in business_sql(p).items()}
