"""Exact distributed quantiles and the IQR / z-score / business-rule flags."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from venuescope.config import REFERENCE
from venuescope.operators import anomaly
from venuescope.operators.quantile import exact_percentiles


def test_exact_percentiles_match_numpy_with_groups_ties_and_skew(spark):
    rng = np.random.default_rng(0)
    hot = np.round(rng.normal(10, 3, 3000), 1)           # one group holds most rows, many ties
    rows = [("hot", float(v)) for v in hot] + [("small", float(v)) for v in (5.0, 1.0, 3.0)] + \
        [("one", 7.0), ("hot", None), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["g"]: r for r in exact_percentiles(df, "v", probs, by=["g"]).collect()}
    assert set(got) == {"hot", "small", "one"}           # null group dropped
    for g, vals in (("hot", hot), ("small", [5.0, 1.0, 3.0]), ("one", [7.0])):
        want = np.percentile(np.array(vals, dtype=float), [p * 100 for p in probs])
        for p, w in zip(probs, want):
            assert got[g][f"p{round(p * 100):g}"] == pytest.approx(w, abs=1e-9)


def test_exact_percentiles_global_and_weighted(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (10.0, 2)], "v double, w long")
    r = exact_percentiles(df, "v", [0.5, 0.9], names=["med", "p90"], weight="w").collect()[0]
    expanded = [1.0, 1.0, 1.0, 2.0, 10.0, 10.0]
    assert r["med"] == pytest.approx(np.percentile(expanded, 50))
    assert r["p90"] == pytest.approx(np.percentile(expanded, 90))


def test_exact_percentiles_invariant_to_partitioning(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(x),) for x in rng.exponential(5, 2000)], "v double")
    a = exact_percentiles(df, "v", [0.25, 0.75]).collect()[0]
    b = exact_percentiles(df.repartition(13), "v", [0.25, 0.75]).collect()[0]
    assert tuple(a) == tuple(b)


def test_iqr_flags_strict_and_null_false(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0, None, -50.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    got = {r["id"]: r["anom_iqr"] for r in anomaly.iqr_flag(df, "v").collect()}
    s = pd.Series(vals, dtype=float).dropna()
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert got == {i: (v is not None and (v < lo or v > hi)) for i, v in enumerate(vals)}


def test_zscore_population_sd_and_constant(spark):
    vals = [10.0] * 20 + [50.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    got = {r["id"]: r["anom_zscore"] for r in anomaly.zscore_flag(df, "v", threshold=3.0).collect()}
    s = np.array(vals[:-1])
    z = (s - s.mean()) / s.std(ddof=0)
    assert [got[i] for i in range(21)] == list(np.abs(z) > 3) and got[21] is False
    const = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert [r["anom_zscore"] for r in anomaly.zscore_flag(const, "v").collect()] == [False, False]


def test_business_risk_per_city_p75(spark):
    rows = [("A", 100.0, 2.0), ("A", 200.0, 2.0), ("A", 300.0, 2.0), ("A", 400.0, 2.5), ("A", 400.0, None),
            ("B", 1000.0, 4.0), ("B", 5000.0, 3.5), (None, 9999.0, 1.0), ("A", None, 1.0)]
    clean = spark.createDataFrame(rows, "city_clean string, cost_for_two double, rating double")
    got = [r["operational_risk"] for r in anomaly.business_risk_flag(clean, REFERENCE).collect()]
    # A's p75 of (100,200,300,400,400) = 400: nothing strictly above; B has no low rating
    assert got == [False] * 9
    rows[3] = ("A", 450.0, 2.5)
    clean = spark.createDataFrame(rows, "city_clean string, cost_for_two double, rating double")
    got = [r["operational_risk"] for r in anomaly.business_risk_flag(clean, REFERENCE).collect()]
    assert got == [False, False, False, True, False, False, False, False, False]


@pytest.mark.parametrize("conf", [{}, {"spark.sql.exchange.reuse": "false"}, {"spark.sql.adaptive.enabled": "false"}])
@pytest.mark.parametrize("dist", ["heavy", "ties", "const", "inf", "huge"])
def test_percentiles_agree_with_numpy_under_any_plan(spark, dist, conf):
    rng = np.random.default_rng(11)
    x = {"heavy": np.concatenate([rng.exponential(1, 3000), [1e9, 5e8]]),
         "ties": np.round(rng.normal(3.5, 0.5, 3000), 1),
         "const": np.full(500, 7.0),
         "inf": np.concatenate([rng.normal(0, 1, 500), [np.inf, -np.inf]]),
         "huge": np.concatenate([rng.normal(5, 1, 5000), [1e300, -1e300, 1e-300]])}[dist]
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = exact_percentiles(df, "v", probs).collect()[0]
        by = exact_percentiles(df.withColumn("g", F.lit(1)), "v", probs, by=["g"]).collect()[0][1:]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = np.percentile(x, [p * 100 for p in probs])
    for i, w in enumerate(want):
        if np.isfinite(w):
            assert got[i] == pytest.approx(w) and by[i] == pytest.approx(w)
        elif np.isnan(w):            # -inf + (-inf - -inf) * f: NaN in numpy and Spark alike
            assert np.isnan(got[i]) and np.isnan(by[i])
        else:
            assert got[i] == w and by[i] == w


def test_percentiles_read_their_input_a_fixed_number_of_times(spark, tmp_path):
    """Three scans for any number of ranks: cut points, cell counts, wanted cells."""
    spark.range(5000).selectExpr("cast(id as double) as v").write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    for probs in ([0.5], [i / 10 for i in range(11)]):
        plan = exact_percentiles(df, "v", probs)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 2           # the cut points are in the plan already


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert exact_percentiles(empty, "v", [0.5]).collect()[0][0] is None
    assert exact_percentiles(empty, "v", [0.5], by=["g"]).count() == 0
