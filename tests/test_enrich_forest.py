"""Group statistics brought to rows, and forests that do not depend on how rows are laid out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from venuescope.config import REFERENCE
from venuescope.operators import anomaly, enrich, iforest
from venuescope.operators.quantile import column_percentiles, exact_percentiles


@pytest.fixture(scope="module")
def hot(spark):
    """40 % of the rows in one city, many without a city or a feature."""
    rng = np.random.default_rng(3)
    n = 20000
    pick = rng.random(n)
    rows = [("Hot" if p < 0.4 else None if p < 0.6 else f"C{int(c)}", None if r < 0.2 else round(float(r) * 5, 1), None if x < 200 else float(x), i)
            for i, (p, c, r, x) in enumerate(zip(pick, rng.integers(0, 300, n), rng.random(n), np.round(rng.lognormal(6, 0.6, n))))]
    return spark.createDataFrame(rows, "city_clean string, rating double, cost_for_two double, id long").repartition(7).cache()


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_attach_equals_a_plain_lookup(hot, max_bytes):
    stats = hot.groupBy("city_clean").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last")).where("city_clean <> 'C7'").na.drop()
    known = {r.city_clean: (r.n, r["last"]) for r in stats.collect()}
    got = enrich.attach(hot, stats, ["city_clean"], max_bytes).collect()
    assert len(got) == hot.count()
    assert all((r.n, r["last"]) == known.get(r.city_clean, (None, None)) for r in got)


def test_only_cold_keys_are_shuffled(spark, hot):
    """Beyond the broadcast bound, neither the hot city nor rows without a city meet in an exchange."""
    found = {r.city_clean for r in enrich.hot_keys(hot.where("city_clean is not null").select("city_clean"), ["city_clean"], 4).collect()}
    assert found == {"Hot"}
    stats = hot.groupBy("city_clean").agg(F.count(F.lit(1)).alias("n")).na.drop()
    out = enrich.attach(hot, stats, ["city_clean"], 0)
    place = out.withColumn("p", F.spark_partition_id()).groupBy("p", "city_clean").count().collect()
    share = {r.p: 0 for r in place}
    for r in place:
        share[r.p] += r["count"]
    assert len({r.p for r in place if r.city_clean == "Hot"}) == 7          # where the rows were read
    assert max(share.values()) < 0.4 * hot.count()


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_business_risk_and_forest_are_the_same_in_both_joins(hot, max_bytes):
    flagged = anomaly.business_risk_flag(hot, REFERENCE, max_bytes=max_bytes)
    pdf = hot.toPandas()
    p75 = pdf.groupby("city_clean")["cost_for_two"].transform(lambda x: x.quantile(0.75))
    want = set(pdf[(pdf["cost_for_two"] > p75) & (pdf["rating"] < REFERENCE.low_rating)]["id"])
    assert {r.id for r in flagged.where("operational_risk").collect()} == want and want
    out = iforest.isolation_forest_flag(hot, params=REFERENCE, max_bytes=max_bytes)
    assert out.count() == hot.count()
    assert out.where("anom_isoforest and (rating is null or cost_for_two is null)").count() == 0


def flags(df):
    return {r.id for r in iforest.isolation_forest_flag(df, params=REFERENCE).where("anom_isoforest").collect()}


def test_forest_does_not_depend_on_layout(hot):
    first = flags(hot)
    assert first and flags(hot.repartition(13, "rating")) == first and flags(hot.coalesce(1).orderBy("cost_for_two")) == first


def test_forest_equals_a_plain_run_on_the_same_draws(hot):
    feats = ["rating", "cost_for_two"]
    values = iforest.feature_values(hot, feats)
    draws = iforest.draw_samples(values, feats, 100, 256, 42).toPandas()
    assert (draws.groupby("tree").size() == 256).all() and len(draws) == 25600
    pdf = hot.toPandas()
    full = pdf.dropna(subset=feats)
    depth = np.zeros(len(full))
    X = full[feats].to_numpy()
    for t, part in draws.groupby("tree"):
        f, th, le, ri, sz, de = iforest.grow_tree(part[feats].to_numpy(), np.random.default_rng([42, int(t)]), 8)
        for i, x in enumerate(X):
            node = 0
            while f[node] >= 0:
                node = le[node] if x[f[node]] < th[node] else ri[node]
            m = sz[node]
            depth[i] += de[node] + (0 if m <= 1 else 1 if m == 2 else 2 * (np.log(m - 1) + 0.5772156649015329) - 2 * (m - 1) / m)
    c = 2 * (np.log(255) + 0.5772156649015329) - 2 * 255 / 256
    score = 2 ** -(depth / 100 / c)
    want = set(full["id"][score > np.quantile(score, 1 - REFERENCE.contamination) + 1e-12])
    assert flags(hot) == want


def test_copies_are_drawn_in_proportion():
    w = np.array([1, 10, 1000, 100000] * 500)
    key = iforest._uniform(np.arange(len(w)), 7).view(np.uint64)
    got = iforest.copies_below(key, w, 0.01)
    for m in (1, 10, 1000, 100000):
        mean = got[w == m].mean()
        assert abs(mean - 0.01 * m) < 5 * np.sqrt(0.01 * 0.99 * m / 500)
    assert (iforest.copies_below(key, w, 1.0) == w).all()


@pytest.mark.parametrize("limit", [1, 50, 1_000_000])
def test_crowded_cells_are_cut_again(spark, limit):
    rng = np.random.default_rng(5)
    near = 1000 + rng.random(3000) * 1e-6                    # all in one cell of the grid
    rows = [("a", float(x)) for x in near] + [("b", float(x)) for x in rng.exponential(3, 500)] + [("b", 7.0)] * 900 + [(None, -1e300)] * 5
    rows += [("c", x) for x in (float("inf"), float("-inf"), 1e308, -1e308, 5e-324, 0.0, -0.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    by_group, whole = column_percentiles(df, "v", [(["g"], probs, names), ([], probs, names)], limit=limit)
    for r in by_group.collect():
        v = np.sort([x for g, x in rows if g == r.g])
        want = [_between(v, p) for p in probs]
        assert [r[n] for n in names] == pytest.approx(want, rel=1e-12, nan_ok=True)
    r = whole.first()
    assert [r[n] for n in names] == pytest.approx([_between(np.sort([x for _, x in rows]), p) for p in probs], rel=1e-12, nan_ok=True)
    assert exact_percentiles(df.limit(0), "v", [0.5], limit=limit).first()[0] is None


def _between(v, p):
    pos = p * (len(v) - 1)
    lo, up = v[int(np.floor(pos))], v[int(np.ceil(pos))]
    with np.errstate(invalid="ignore", over="ignore"):
        return lo + (up - lo) * (pos - np.floor(pos))


def test_statistics_for_all_detectors(hot):
    s = anomaly.column_statistics(hot)
    pdf = hot.toPandas()
    cost = pdf["cost_for_two"].dropna()
    assert s.moments.first().m == pytest.approx(cost.mean()) and s.moments.first().sd == pytest.approx(cost.std(ddof=0))
    assert (s.iqr.first().q1, s.iqr.first().q3) == (cost.quantile(0.25), cost.quantile(0.75))
    want = pdf.groupby("city_clean")["cost_for_two"].quantile(0.75)
    assert {r.city_clean: r._city_p75 for r in s.p75.collect()} == pytest.approx(want.to_dict())
