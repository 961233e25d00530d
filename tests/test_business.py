"""The eight queries on hand-made venues: ties, nulls, rounding, HAVING."""

from pyspark.sql import functions as F

from venuescope.config import REFERENCE
from venuescope.operators import business as B

SCHEMA = ("name string, city_clean string, city_tier string, location string, rating double, "
          "cost_for_two double, price_tier string, has_online_order boolean")


def venues(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_q1_tie_break_and_round(spark):
    rows = []
    for city, n in (("B", 3), ("A", 3), ("C", 1)):
        for i in range(n):
            rows.append((f"v{i}", city, "Tier 2+", "l", [2.67, 2.68, 2.675][i % 3], 100.0 + i, "Budget (<300)", True))
    p = REFERENCE.replace(q1_limit=2)
    got = [tuple(r) for r in B.q1_city_market_size(venues(spark, rows), p).collect()]
    # equal counts -> city ascending; avg 2.675 rounds half up to 2.68
    assert got == [("A", "Tier 2+", 3, 2.68, 101.0), ("B", "Tier 2+", 3, 2.68, 101.0)]


def test_q3_keeps_null_city_group(spark):
    rows = [("v", None, "Tier 2+", "l", 4.0, 100.0, "Budget (<300)", i % 2 == 0) for i in range(3)]
    rows += [("w", "X", "Tier 2+", "l", 4.0, 100.0, "Budget (<300)", False) for _ in range(3)]
    got = {r["city_clean"]: tuple(r)[1:] for r in B.q3_online_adoption(venues(spark, rows), REFERENCE.replace(q3_min_total=2)).collect()}
    assert got == {None: (3, 2, 66.7), "X": (3, 0, 0.0)}


def test_q2_counts_distinct_names(spark):
    rc = spark.createDataFrame(
        [("chain", "X", "Pizza", 4.0, 100.0)] * 5 + [("solo", "X", "Pizza", 3.0, None), ("z", "X", "Unknown", 5.0, 1.0)],
        "name string, city_clean string, cuisine string, rating double, cost_for_two double")
    got = [tuple(r) for r in B.q2_cuisine_gap(rc, REFERENCE.replace(q2_min_names=1)).collect()]
    assert got == [("Pizza", 2, round(23 / 6, 2), 100.0)]


def test_q4_high_rated_share(spark):
    rows = [("v", "X", "Tier 1", "l", r, 100.0, "Budget (<300)", True) for r in (4.0, 3.9, 4.5, None)]
    rows += [("v", "X", "Tier 1", "l", 4.9, None, "Unknown", True)]
    got = [tuple(r) for r in B.q4_price_tier_sweet_spot(venues(spark, rows)).collect()]
    assert got == [("Budget (<300)", 3, 4.13, 2, 66.7)]


def test_q5_having_on_rounded_average(spark):
    # raw average 3.4466.. rounds to 3.45 and passes the >= 3.45 filter
    rows = [("v", "T", "Tier 2+", "l", r, 100.0, "Budget (<300)", True) for r in (3.44, 3.45, 3.45)]
    p = REFERENCE.replace(q5_min_count=1)
    got = [tuple(r) for r in B.q5_tier2_opportunity(venues(spark, rows), p).collect()]
    assert got == [("T", 3, 3.45, 100.0, 3)]


def test_q8_composite(spark):
    rows = [("v", "X", "Tier 2+", "l", 4.0, 100.0, "Budget (<300)", i < 3) for i in range(4)]
    rows += [("v", "X", "Tier 2+", "l", None, 100.0, "Budget (<300)", True)]   # unrated: excluded
    got = B.q8_recommendation_matrix(venues(spark, rows), REFERENCE.replace(q8_min_count=1)).collect()[0]
    assert got["restaurant_count"] == 4 and got["online_pct"] == 75.0
    assert got["opportunity_score"] == round(4.0 * 20 + 75.0 * 0.3 - 4 * 0.001, 1)


def test_q6_q7_filters(spark):
    rows = [("v", "Bengaluru", "Tier 1", loc, 3.0, 100.0, "Budget (<300)", True) for loc in ("a", "a", "b")]
    got = [tuple(r) for r in B.q6_locality_gaps(venues(spark, rows), REFERENCE.replace(q6_min_count=2)).collect()]
    assert got == [("a", 2, 3.0, 100.0, 2)]
    rc = spark.createDataFrame([("n", "Pune", "Chinese", 4.0, 1.0), ("n", "Pune", "Thai", 4.0, 1.0),
                                ("n", "Goa", "Chinese", 4.0, 1.0)],
                               "name string, city_clean string, cuisine string, rating double, cost_for_two double")
    assert [tuple(r) for r in B.q7_competitive_density(rc).collect()] == [("Pune", "Chinese", 1, 4.0)]
