"""Every operator family over deliberately messy listings: +-inf, NaN, huge
numbers, junk text, unicode whitespace, null cities.  Nothing may fail under
ANSI mode."""

import random

import pytest

from venuescope.config import REFERENCE
from venuescope.operators import anomaly, business, eda, profile, scoring, stats
from venuescope.operators.transform import explode_cuisines, transform
from venuescope.schemas import RAW_SCHEMA

P = REFERENCE.replace(q2_min_names=1, q3_min_total=1, q5_min_count=1, q6_min_count=1, q8_min_count=1,
                      min_city_venues=5)


@pytest.fixture(scope="module")
def messy(spark):
    rnd = random.Random(3)
    ratings = ["4.1", "inf", "-inf", "nan", "NEW", "0", "1e308", "1_000", "Nov...", " 3.5\t", None, "4.1d"]
    costs = ["1,200", "inf", "0", "-5", "9" * 25, "1e400", "abc", None, " 300 ", "1_500"]
    cities = ["Bangalore", " Mumbai ", None, "Pune", "　Delhi", ""]
    rows = [(f"n{i % 37}", rnd.choice(cities), rnd.choice(["a", None, " b "]),
             rnd.choice(["North Indian, Chinese", "0", None, ",", "Cafe"]), rnd.choice(ratings),
             rnd.choice(["12", "x", None, "1e99", "-3"]), rnd.choice(costs), rnd.choice(["True", "False", "yes", None]),
             rnd.choice(["True", "False"]), rnd.choice(["True", "False"]), None) for i in range(400)]
    raw = spark.createDataFrame(rows, RAW_SCHEMA)
    clean = transform(raw).cache()
    return raw, clean, explode_cuisines(clean)


OPS = {
    "histogram_rating": lambda r, c, rc: eda.histogram(c, "rating"),
    "histogram_cost": lambda r, c, rc: eda.histogram(c, "cost_for_two"),
    "box_stats": lambda r, c, rc: eda.box_stats(c, "city_clean", "cost_for_two"),
    "ordered_share": lambda r, c, rc: eda.ordered_share(c),
    "service_mix": lambda r, c, rc: eda.service_mix(c),
    "sample": lambda r, c, rc: eda.deterministic_sample(c, 50),
    "describe": lambda r, c, rc: stats.describe(c, ["rating", "cost_for_two", "votes"]),
    "descriptive": lambda r, c, rc: stats.descriptive(c, "rating"),
    "corr_matrix": lambda r, c, rc: stats.corr_matrix(c, ["rating", "cost_for_two", "votes"]),
    "zscore_share": lambda r, c, rc: stats.zscore_share(c, "rating"),
    "mean_ci": lambda r, c, rc: stats.mean_ci(c, "rating"),
    "null_counts": lambda r, c, rc: profile.null_counts(c),
    "shape": lambda r, c, rc: profile.shape(r),
    "opportunity": lambda r, c, rc: scoring.city_opportunity(c, P),
    "iqr": lambda r, c, rc: anomaly.iqr_flag(c, "cost_for_two"),
    "zscore": lambda r, c, rc: anomaly.zscore_flag(c, "cost_for_two"),
    "business_risk": lambda r, c, rc: anomaly.business_risk_flag(c, P),
}
for _k, (_fn, _src) in business.BUSINESS_QUERIES.items():
    OPS[_k] = (lambda r, c, rc, _fn=_fn, _src=_src: _fn(c if _src == "restaurants" else rc, P))


@pytest.mark.parametrize("name", sorted(OPS))
def test_operator_survives_messy_values(messy, name):
    raw, clean, cuisines = messy
    assert OPS[name](raw, clean, cuisines).count() >= 0


def test_no_nan_survives_cleaning(messy):
    from pyspark.sql import functions as F
    _, clean, _ = messy
    assert clean.where(F.isnan("rating") | F.isnan("cost_for_two")).count() == 0
