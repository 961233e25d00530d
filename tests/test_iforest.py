"""Isolation forest: planted outliers, contamination share, small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from venuescope.config import REFERENCE
from venuescope.operators.iforest import avg_path_length, grow_tree, isolation_forest_flag


def test_average_path_length():
    assert list(avg_path_length([0, 1, 2])) == [0.0, 0.0, 1.0]
    assert avg_path_length([256])[0] == pytest.approx(2 * (np.log(255) + 0.5772156649) - 2 * 255 / 256)


def test_grow_tree_isolates_and_respects_depth():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(256, 2))
    f, th, l, r, size, depth = grow_tree(X, rng, 8)
    assert max(depth) <= 8 and size[0] == 256
    leaves = [i for i in range(len(f)) if f[i] < 0]
    assert sum(size[i] for i in leaves) == 256


def test_planted_outliers_and_share(spark):
    rng = np.random.default_rng(42)
    normal = rng.normal([3.5, 500.0], [0.3, 80.0], size=(4000, 2))
    planted = np.array([[0.5, 5000.0], [5.0, 9000.0], [1.0, 20.0], [4.9, 7500.0]])
    X = np.vstack([normal, planted])
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(X)] + [(99999, None, 300.0)]
    df = spark.createDataFrame(rows, "id long, rating double, cost_for_two double").repartition(5)
    out = isolation_forest_flag(df, params=REFERENCE, keep_score=True).cache()
    flags = {r["id"]: r["anom_isoforest"] for r in out.collect()}
    assert all(flags[4000 + k] for k in range(4))          # every planted outlier is flagged
    assert flags[99999] is False                             # missing feature -> normal
    share = sum(flags[i] for i in range(len(X))) / len(X)
    assert share == pytest.approx(REFERENCE.contamination, abs=0.01)
    scores = [r["_if_score"] for r in out.where(F.col("id") >= 4000).where(F.col("id") < 4004).collect()]
    assert min(scores) > 0.6


def test_small_input_uses_every_row(spark):
    rows = [(float(i % 5), float(i)) for i in range(30)] + [(4.0, 10000.0)]
    df = spark.createDataFrame(rows, "rating double, cost_for_two double")
    got = isolation_forest_flag(df, params=REFERENCE).collect()
    assert len(got) == 31
    assert [r["anom_isoforest"] for r in got if r["cost_for_two"] == 10000.0] == [True]


def test_no_complete_rows(spark):
    df = spark.createDataFrame([(None, 1.0)], "rating double, cost_for_two double")
    assert [r["anom_isoforest"] for r in isolation_forest_flag(df).collect()] == [False]
