"""Exploratory charts' data, descriptive statistics and forecasting."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from venuescope.functions.stats import t_quantile
from venuescope.operators import eda, forecast, stats


def test_histogram_matches_numpy(spark):
    vals = [0.5 + 0.5 * (i % 10) for i in range(200)] + [2.3, 4.95]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    got = eda.histogram(df, "x", 30).collect()
    counts, edges = np.histogram(np.array(vals), bins=30)
    assert [r["count"] for r in got] == list(counts)
    assert [r["bin_lower"] for r in got] == pytest.approx(list(edges[:-1]))
    assert got[0]["mean"] == pytest.approx(np.mean(vals))


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    counts, _ = np.histogram(np.array([2.0, 2.0]), bins=30)
    assert [r["count"] for r in eda.histogram(df, "x", 30).collect()] == list(counts)


def test_box_stats_match_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [("A", float(v)) for v in rng.lognormal(6, 0.5, 500)] + [("B", float(v)) for v in (1, 2, 3, 100)] + \
        [("C", 5.0)]
    df = spark.createDataFrame(rows, "city_clean string, cost_for_two double")
    got = {r["city_clean"]: r for r in eda.box_stats(df, "city_clean", "cost_for_two", top=2).collect()}
    assert set(got) == {"A", "B"}
    for g in ("A", "B"):
        x = np.array([v for c, v in rows if c == g])
        q1, med, q3 = np.percentile(x, [25, 50, 75])
        iqr = q3 - q1
        lo, hi = x[x >= q1 - 1.5 * iqr].min(), x[x <= q3 + 1.5 * iqr].max()
        r = got[g]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, med, q3))
        assert (r["whisker_low"], r["whisker_high"]) == pytest.approx((lo, hi))
        assert r["n_outliers"] == int(((x < q1 - 1.5 * iqr) | (x > q3 + 1.5 * iqr)).sum())


def test_deterministic_sample(spark):
    df = spark.range(10000).select(F.col("id"), (F.col("id") % 7).cast("double").alias("v"))
    a = sorted(r["id"] for r in eda.deterministic_sample(df, 500, 42).collect())
    b = sorted(r["id"] for r in eda.deterministic_sample(df.repartition(7), 500, 42).collect())
    assert a == b and len(a) == 500
    assert eda.deterministic_sample(df.limit(10), 500, 42).count() == 10


def test_ordered_share_excludes_unknown(spark):
    df = spark.createDataFrame([("Budget (<300)",)] * 3 + [("Luxury (1500+)",)] + [("Unknown",)] * 5, "price_tier string")
    got = [tuple(r) for r in eda.ordered_share(df).collect()]
    assert got == [("Budget (<300)", 1, 3, 75.0), ("Luxury (1500+)", 4, 1, 25.0)]


def test_describe_and_descriptive_match_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"rating": rng.normal(3.5, 0.4, 300).round(1), "votes": rng.integers(0, 900, 300)})
    pdf.loc[::7, "rating"] = np.nan
    df = spark.createDataFrame(pdf)
    d = {r["column_name"]: r for r in stats.describe(df, ["rating", "votes"]).collect()}
    want = pdf.describe()
    for c in ("rating", "votes"):
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert d[c][ours] == pytest.approx(want.loc[theirs, c])
    r = stats.descriptive(df, "rating").collect()[0]
    s = pdf["rating"].dropna()
    assert (r["mean"], r["median"], r["variance"], r["std"]) == pytest.approx((s.mean(), s.median(), s.var(), s.std()))


def test_corr_matrix_pairwise_complete(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0, None], "b": [2.0, 4.1, 5.9, 8.2, 1.0], "c": [5, 3, 4, 1, 2]})
    df = spark.createDataFrame(pdf)
    got = {(r["x"], r["y"]): r["corr"] for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    want = pdf.corr()
    for (x, y), v in got.items():
        assert v == pytest.approx(want.loc[x, y])


def test_t_quantile_for_every_sample_size(spark):
    # textbook values of the two-sided 95 % point
    want = {1: 12.706204736, 2: 4.302652730, 3: 3.182446305, 9: 2.262157163, 10: 2.228138852, 30: 2.042272456, 100: 1.983971519,
            101: 1.983731003, 1000: 1.962339081}
    df = spark.createDataFrame([(d,) for d in [0, *want]], "dof long")
    got = {r[0]: r[1] for r in df.select("dof", t_quantile(0.975, F.col("dof"))).collect()}
    assert got.pop(0) is None
    assert got == pytest.approx(want, abs=2e-9)
    for n in (2, 3, 10):
        ci = stats.mean_ci(spark.createDataFrame([(float(i),) for i in range(n)], "rating double"), "rating").collect()[0]
        assert ci["ci_low"] == pytest.approx((n - 1) / 2 - want[n - 1] * ci["sem"])


def test_zscore_share_and_mean_ci(spark):
    vals = [3.0] * 50 + [4.0] * 50 + [9.0]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "rating double")
    r = stats.zscore_share(df, "rating", 2.0).collect()[0]
    x = np.array(vals)
    z = (x - x.mean()) / x.std()
    assert (r["n"], r["outliers"]) == (101, int((np.abs(z) > 2).sum()))
    ci = stats.mean_ci(df, "rating").collect()[0]
    sem = x.std(ddof=1) / np.sqrt(len(x))
    assert ci["sem"] == pytest.approx(sem)
    assert ci["ci_low"] == pytest.approx(x.mean() - ci["t_crit"] * sem)


def test_forecast_linear_and_moving_average(spark):
    adoption = [32, 34, 35, 38, 40, 41, 44, 46, 47, 49, 51, 53]
    series = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(adoption)], "x long, value double")
    got = forecast.linear_forecast(series, 6).collect()
    slope, intercept = np.polyfit(np.arange(1, 13), adoption, 1)
    assert [r["x"] for r in got] == list(range(13, 19))
    assert got[0]["slope"] == pytest.approx(slope) and got[0]["intercept"] == pytest.approx(intercept)
    assert [r["forecast"] for r in got] == pytest.approx([intercept + slope * x for x in range(13, 19)])
    s4 = spark.createDataFrame([(i, float(i)) for i in (1, 2, 3, 4)], "x long, value double")
    assert [r["moving_avg"] for r in forecast.moving_average(s4, 3).orderBy("x").collect()] == [None, None, 2.0, 3.0]


def test_monthly_counts_use_all_months(spark):
    import datetime as dt
    ts = [dt.datetime(2020, 1, 5), dt.datetime(2020, 1, 9), dt.datetime(2020, 2, 1), dt.datetime(2020, 3, 31, 23, 59), None]
    df = spark.createDataFrame([(t,) for t in ts], "o_orderdate timestamp")
    got = [tuple(r) for r in forecast.monthly_counts(df, "o_orderdate").collect()]
    assert got == [(1, "2020-01", 2.0), (2, "2020-02", 1.0), (3, "2020-03", 1.0)]
    got = [tuple(r) for r in forecast.monthly_counts(df, "o_orderdate", end="2020-03-01").collect()]
    assert got == [(1, "2020-01", 2.0), (2, "2020-02", 1.0)]


def by_md5(df, n, seed):
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns])
    rows = df.withColumn("h", F.md5(text.cast("binary"))).collect()
    return sorted(tuple(r[:-1]) for r in sorted(rows, key=lambda r: (r["h"], *map(str, r[:-1])))[:n])


@pytest.mark.parametrize("digits", [1, 5])
def test_sample_with_hot_duplicate_matches_brute_force(spark, digits):
    rows = [("hot", 1.0)] * 3000 + [(f"r{i}", float(i % 17)) for i in range(6000)]
    df = spark.createDataFrame(rows, "name string, v double").repartition(9)
    for n in (1, 2500, 9000, 20000):
        got = sorted(tuple(r) for r in eda.deterministic_sample(df, n, 42, digits=digits).collect())
        assert len(got) == min(n, 9000) and got == by_md5(df, n, 42)
    assert eda.deterministic_sample(df.limit(0), 5).count() == 0


@pytest.mark.parametrize("digits", [1, 2, 5])
def test_sample_is_the_same_whatever_the_digits(spark, digits):
    """Crowded digits are counted again by more of them."""
    df = spark.range(3000).selectExpr("id % 2500 AS k", "cast(id % 7 AS string) AS s").union(spark.range(400).selectExpr("5 AS k", "'x' AS s"))
    rows = [(r.k, r.s) for r in df.collect()]
    import hashlib
    order = sorted(rows, key=lambda r: (hashlib.md5(f"42|{r[0]}|{r[1]}".encode()).hexdigest(), r))
    for n in (0, 1, 10, 500, 4000):
        assert sorted(tuple(r) for r in eda.deterministic_sample(df, n, digits=digits).collect()) == sorted(order[:n])
