"""Cleaning rules and the semantic traps (hand-made edge rows)."""

import math

import pytest
from pyspark.sql import functions as F

from venuescope.config import REFERENCE, Params
from venuescope.functions import (city_tier, clean_cost, clean_location, clean_rating, clean_votes,
                                  coerce_flag, price_tier, standardise_city, strip_ws)
from venuescope.operators.transform import explode_cuisines, transform
from venuescope.schemas import RAW_SCHEMA


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_rating_edge_rows(spark):
    got = one_col(spark, ["4.1", " 4.1 ", "NEW", "new", "0", "0.0", "-", "", "Nov...", None], clean_rating)
    assert got == [4.1, 4.1, None, None, None, 0.0, None, None, None, None]


def test_rating_python_float_syntax(spark):
    # underscores between digits are accepted, Spark-only suffixes are not,
    # NaN never survives, infinity is a number, any whitespace is stripped
    got = one_col(spark, ["1_000", "4.1d", "4.1f", "NaN", "-nan", "inf", " 4.5\t", "1e1", ".5", "5.", "1__0"],
                  clean_rating)
    assert got[:4] == [1000.0, None, None, None]
    assert got[4] is None
    assert math.isinf(got[5])
    assert got[6:] == [4.5, 10.0, 0.5, 5.0, None]


def test_cost_edge_rows(spark):
    got = one_col(spark, ["1,200", "0", "-5", "abc", "nan", None, " 450 ", "1,00,000"], clean_cost)
    assert got == [1200.0, None, None, None, None, None, 450.0, 100000.0]


def test_price_tier_half_open(spark):
    got = one_col(spark, [299.99, 300.0, 700.0, 1500.0, None, 699.999], price_tier, "double")
    assert got == ["Budget (<300)", "Mid-range (300-700)", "Premium (700-1500)", "Luxury (1500+)", "Unknown",
                   "Mid-range (300-700)"]


def test_city_alias_and_tier(spark):
    got = one_col(spark, [" Gurgaon ", "gurgaon", None, "Bangalore", "Pune"], standardise_city)
    assert got == ["Delhi NCR", "gurgaon", None, "Bengaluru", "Pune"]
    tiers = one_col(spark, got, city_tier)
    assert tiers == ["Tier 1", "Tier 2+", "Tier 2+", "Tier 1", "Tier 1"]


def test_votes(spark):
    assert one_col(spark, ["12", "12.7", "-3.9", "abc", None, "1,200", "9e99", "3000000000"], clean_votes) == [
        12, 12, -3, 0, 0, 0, 0, 3000000000]


def test_location_strip_keeps_null(spark):
    assert one_col(spark, ["  Indiranagar\n", None, ""], clean_location) == ["Indiranagar", None, ""]


def test_strip_matches_python(spark):
    samples = [" a ", "\ta b\n", " x　", "\x1cy\x85", "  "]
    assert one_col(spark, samples, strip_ws) == [s.strip() for s in samples]


def test_flags_text_boolean_and_legacy(spark):
    from pyspark.sql.types import BooleanType, StringType
    txt = ["True", "false", "Yes", "no", "1", "maybe", "", None]
    assert one_col(spark, txt, lambda c: coerce_flag(c, StringType())) == \
        [True, False, True, False, True, None, None, None]
    # astype(bool): any non-empty text and a missing value are True
    assert one_col(spark, txt, lambda c: coerce_flag(c, StringType(), legacy=True)) == \
        [True, False, True, False, True, True, False, True]
    assert one_col(spark, [True, False, None], lambda c: coerce_flag(c, BooleanType()), "boolean") == \
        [True, False, None]


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def make_raw(name="A", city=" Gurgaon ", area=" Sector 29 ", cusine="North Indian, Chinese", rating="4.1",
             rating_count="10", cost="1,200", online="True", table="False", delivery="False", famous=None):
    return (name, city, area, cusine, rating, rating_count, cost, online, table, delivery, famous)


def test_transform_contract_and_no_row_dropped(spark):
    raw = raw_rows(spark, [make_raw(), make_raw(rating="NEW", cost="0", city=None, area=None),
                           make_raw(rating=None, rating_count=None, cost=None, cusine=None)])
    out = transform(raw)
    assert out.columns == ["name", "city_clean", "city_tier", "location", "cusine", "rating", "votes",
                           "cost_for_two", "price_tier", "has_online_order", "has_table_booking", "delivery_only"]
    got = out.collect()
    assert len(got) == 3
    assert got[0]["city_clean"] == "Delhi NCR" and got[0]["city_tier"] == "Tier 1"
    assert got[0]["location"] == "Sector 29" and got[0]["price_tier"] == "Premium (700-1500)"
    assert got[0]["has_online_order"] is True and got[0]["has_table_booking"] is False
    assert got[1]["rating"] is None and got[1]["cost_for_two"] is None and got[1]["city_tier"] == "Tier 2+"
    assert got[1]["location"] is None and got[1]["price_tier"] == "Unknown"
    assert got[2]["votes"] == 0


def test_explode_cuisines_edge_rows(spark):
    cells = ["A, B", "A,A", "0", None, ",", "A,,0"]
    clean = spark.createDataFrame([(f"v{i}", "X", c, 4.0, 100.0) for i, c in enumerate(cells)],
                                  "name string, city_clean string, cusine string, rating double, cost_for_two double")
    got = explode_cuisines(clean).collect()
    per = {}
    for r in got:
        per.setdefault(r["name"], []).append(r["cuisine"])
    assert per == {"v0": ["A", "B"], "v1": ["A", "A"], "v2": ["Unknown"], "v3": ["Unknown"], "v5": ["A"]}
    assert explode_cuisines(clean).columns == ["name", "city_clean", "cuisine", "rating", "cost_for_two"]
    # the lenient variant keeps '0' (cell and piece) and only maps a missing cell
    lenient = {}
    for r in explode_cuisines(clean, drop_zero=False).collect():
        lenient.setdefault(r["name"], []).append(r["cuisine"])
    assert lenient["v2"] == ["0"] and lenient["v3"] == ["Unknown"] and lenient["v5"] == ["A", "0"]


def test_explode_preserves_token_count(spark):
    cells = ["a,b,c", "d", "e, f", "g,h,i,j"]
    clean = spark.createDataFrame([(c,) for c in cells], "cusine string") \
        .select(F.lit("n").alias("name"), F.lit("c").alias("city_clean"), "cusine",
                F.lit(None).cast("double").alias("rating"), F.lit(None).cast("double").alias("cost_for_two"))
    assert explode_cuisines(clean).count() == sum(len(c.split(",")) for c in cells)


def test_params_override_city_map(spark):
    p = REFERENCE.replace(city_map={"X1": "X"}, tier1_cities=("X",))
    raw = raw_rows(spark, [make_raw(city="X1"), make_raw(city="Gurgaon")])
    got = transform(raw, p).select("city_clean", "city_tier").collect()
    assert [tuple(r) for r in got] == [("X", "Tier 1"), ("Gurgaon", "Tier 2+")]
    assert isinstance(p, Params)


def test_round_half_up_ties_and_unrepresentable(spark):
    from venuescope.functions import round_half_up
    got = one_col(spark, [2.675, 1.005, -2.5, float("inf"), float("-inf"), 1e20, None],
                  lambda c: round_half_up(c, 2), "double")
    assert got[:3] == [2.68, 1.01, -2.5]
    assert got[3] == float("inf") and got[4] == float("-inf") and got[5] == 1e20 and got[6] is None


def test_round_half_up_rounds_once(spark):
    from venuescope.functions import round_half_up

    df = spark.createDataFrame([(2.6249996,), (2.625,), (-2.625,), (0.1 + 0.2,), (1e30,), (12345678901234567890.0,), (None,), (float("inf"),)], "v double")
    got = [r[0] for r in df.select(round_half_up("v", 2)).collect()]
    assert got == [2.62, 2.63, -2.63, 0.3, 1e30, 12345678901234567890.0, None, float("inf")]
