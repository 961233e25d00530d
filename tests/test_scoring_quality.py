"""Opportunity score (golden rows), quality report and gate."""

import pytest
from pyspark.sql import functions as F

from venuescope.config import REFERENCE
from venuescope.operators import scoring
from venuescope.operators.quality import QualityGateError, duplicate_rows, gate, validate

# Published per-city factors and scores of the original
# pipeline.  These rows hold the minimum and maximum of every factor among
# all scored cities, so min-max over them equals min-max over all cities.
GOLDEN = [
    ("Bengaluru", 20283, 3.6110743193524653, 2827838, 47.17250899768279, 13.903268747226742, 20283, 65.79034906000645),
    ("Mumbai", 25692, 3.512843986102686, 3614821, 47.64128911723493, 10.474077533862681, 25692, 62.0858261362606),
    ("Delhi NCR", 38699, 3.5166462818003916, 4049661, 50.78425799116256, 9.690172872684048, 38699, 61.889511376715475),
    ("Jhansi", 580, 3.4622356495468276, 15330, 72.93103448275862, 7.06896551724138, 580, 48.36274893483481),
    ("Patna", 1337, 3.456880733944954, 90224, 51.60807778608826, 7.6290201944652205, 1337, 42.92156451743747),
    ("Junagadh", 390, 3.7, 1, 0.0, 0.0, 390, 34.91254172380779),
    ("Tirupati", 52, 3.266666666666667, 6, 0.0, 0.0, 52, 13.713481159186495),
    ("Amravati", 347, 2.9875, 7, 0.0, 0.0, 347, -0.07629488729927589),
]


def test_golden_scores(spark):
    m = spark.createDataFrame([g[:7] for g in GOLDEN],
                              "city_clean string, restaurant_count long, avg_rating double, demand_index long, "
                              "online_pct double, market_gap double, competition_density long")
    got = {r["city_clean"]: r["opportunity_score"] for r in scoring.score_metrics(m).collect()}
    for g in GOLDEN:
        assert got[g[0]] == pytest.approx(g[7], abs=1e-12)
    order = [r["city_clean"] for r in scoring.score_metrics(m).collect()]
    assert order == [g[0] for g in sorted(GOLDEN, key=lambda g: -g[7])]


def test_minmax_constant_factor_is_zero(spark):
    m = spark.createDataFrame([("a", 60, 4.0, 10, 50.0, 0.0, 60), ("b", 60, 4.0, 10, 50.0, 0.0, 60)],
                              "city_clean string, restaurant_count long, avg_rating double, demand_index long, "
                              "online_pct double, market_gap double, competition_density long")
    assert [r["opportunity_score"] for r in scoring.score_metrics(m).collect()] == [0.0, 0.0]


def test_market_gap_counts_unrated_as_not_high(spark):
    clean = spark.createDataFrame([("X", 4.5, 1, True), ("X", None, 1, False), (None, 5.0, 1, True)],
                                  "city_clean string, rating double, votes int, has_online_order boolean")
    m = scoring.city_metrics(clean).collect()
    assert len(m) == 1   # null city dropped
    assert m[0]["market_gap"] == 50.0 and m[0]["online_pct"] == 50.0 and m[0]["avg_rating"] == 4.5


def test_opportunity_filters_before_scaling(spark):
    rows = [("A", 4.0, 1, True)] * 60 + [("B", 3.0, 1, False)] * 60 + [("C", 5.0, 100, True)] * 10 + \
        [("D", None, 1, True)] * 70
    clean = spark.createDataFrame(rows, "city_clean string, rating double, votes int, has_online_order boolean")
    got = {r["city_clean"]: r["opportunity_score"] for r in scoring.city_opportunity(clean).collect()}
    assert set(got) == {"A", "B"}    # C too small, D unrated: neither enters min/max
    assert got["A"] == pytest.approx((0.35 + 0.20 + 0.10) * 100) and got["B"] == 0.0


def _clean(spark, rows):
    return spark.createDataFrame(rows, "city_clean string, rating double, cost_for_two double")


def test_validate_pass_and_counts(spark):
    raw = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "p string, q string")
    clean = _clean(spark, [("X", None, 100.0), ("X", 4.0, 100.0), (None, 3.0, None)])
    r = validate(raw, clean, REFERENCE.replace(quality_threshold=60.0)).collect()[0].asDict()
    assert r == {"rows_read": 3, "rows_after_cleaning": 3, "duplicate_rows_in_raw": 1,
                 "missing_ratings_new_restaurants": 1, "missing_costs": 1, "invalid_cities": 1,
                 "structurally_valid_rows": 2, "data_quality_pct": 66.67, "pipeline_status": "PASS"}
    gate(r)


def test_validate_fail_blocks(spark):
    raw = spark.createDataFrame([("a",), ("b",)], "p string")
    clean = _clean(spark, [("X", 4.0, None), ("X", 4.0, 100.0)])
    r = validate(raw, clean).collect()[0].asDict()
    assert r["data_quality_pct"] == 50.0
    assert r["pipeline_status"] == "FAIL - quality 50.0% below 90.0% threshold"
    with pytest.raises(QualityGateError):
        gate(r)


def test_validate_empty_input(spark):
    raw = spark.createDataFrame([], "p string")
    clean = _clean(spark, [])
    r = validate(raw, clean).collect()[0]
    assert r["rows_read"] == 0 and r["data_quality_pct"] == 0.0 and r["pipeline_status"].startswith("FAIL")


def test_duplicates_treat_nulls_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 1), ("a", 1)], "a string, b int")
    assert duplicate_rows(df).collect()[0][0] == 2
