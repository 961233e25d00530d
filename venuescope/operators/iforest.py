"""Isolation forest (Liu, Ting & Zhou, 2008) as Spark jobs.

* values: rows with all features, collapsed to distinct feature vectors with
  their counts, staged once for all that follows;
* sample: a seeded hash of a vector's content gives its copies their ranks: the
  least of w uniform numbers and the ones after it follow from the count alone, so
  no copy is made to be thrown away.  A pool of about 4*psi*trees copies (a
  size set by the parameters) is kept that way, then every tree keeps the ``psi``
  of them with the smallest hash of content, copy number and tree.  Nothing depends on
  row order, files or partitions;
* train: ``groupBy(tree).applyInPandas`` grows one small tree per group
  (<= psi rows each) with NumPy;
* score: the forest (<= trees * (2*psi - 1) nodes) is broadcast and only the
  distinct vectors are scored with ``mapInPandas``; scores come back to the rows by
  ``enrich.attach``: broadcast within a measured size, else a shuffle without hot vectors
  and without rows that miss a feature;
* cut: a row is anomalous when its score is strictly above the exact
  ``1 - contamination`` quantile of all scores (weighted by multiplicity),
  the rule scikit-learn's ``contamination`` applies.  Rows with a missing
  feature are normal.

Flags do not equal scikit-learn's row for row (another random stream); the
flagged share, the planted-outlier behaviour and the score formula do.
"""

from __future__ import annotations

import math
import sys
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StructField, StructType)

from venuescope.config import Params, REFERENCE
from venuescope.operators.enrich import BROADCAST_BYTES, attach
from venuescope.operators.quantile import exact_percentiles

# The task-side helpers below travel with the tasks (pickled by value), so
# executors need NumPy and pandas but not this package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

EULER = 0.5772156649015329
SCORE = "_if_score"


def avg_path_length(n) -> np.ndarray:
    """c(n): mean path length of an unsuccessful binary-search-tree lookup."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def grow_tree(X: np.ndarray, rng: np.random.Generator, max_depth: int):
    """One isolation tree: random feature among the non-constant ones,
    random split in (min, max]; stop at ``max_depth`` or a single row."""
    feat, thr, left, right, size, depth = [], [], [], [], [], []

    def new():
        for a, v in ((feat, -1), (thr, 0.0), (left, -1), (right, -1), (size, 0), (depth, 0)):
            a.append(v)
        return len(feat) - 1

    todo = [(new(), np.arange(len(X)), 0)]
    while todo:
        nid, idx, d = todo.pop()
        size[nid], depth[nid] = len(idx), d
        if d >= max_depth or len(idx) <= 1:
            continue
        xi = X[idx]
        lo, hi = xi.min(axis=0), xi.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            continue
        f = int(rng.choice(cand))
        s = lo[f] + (hi[f] - lo[f]) * (1.0 - rng.random())
        go_left = xi[:, f] < s
        ln, rn = new(), new()
        feat[nid], thr[nid], left[nid], right[nid] = f, float(s), ln, rn
        todo.append((rn, idx[~go_left], d + 1))
        todo.append((ln, idx[go_left], d + 1))
    return feat, thr, left, right, size, depth


NODE_SCHEMA = StructType([
    StructField("tree", IntegerType()), StructField("node", IntegerType()),
    StructField("feature", IntegerType()), StructField("threshold", DoubleType()),
    StructField("left", IntegerType()), StructField("right", IntegerType()),
    StructField("size", LongType()), StructField("depth", IntegerType()),
])


def _trainer(features, seed: int):
    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        X = pdf[list(features)].to_numpy(dtype=float)
        psi = len(X)                                  # every tree gets exactly psi rows
        max_depth = max(int(math.ceil(math.log2(psi))), 1) if psi > 1 else 1
        rng = np.random.default_rng([seed, t])
        f, th, le, ri, sz, de = grow_tree(X, rng, max_depth)
        k = len(f)
        return pd.DataFrame({"tree": np.full(k, t, dtype=np.int32), "node": np.arange(k, dtype=np.int32),
                             "feature": np.array(f, dtype=np.int32), "threshold": np.array(th, dtype=float),
                             "left": np.array(le, dtype=np.int32), "right": np.array(ri, dtype=np.int32),
                             "size": np.array(sz, dtype=np.int64), "depth": np.array(de, dtype=np.int32)})
    return train


class Forest:
    """Dense per-tree node arrays; ``score`` walks all rows of a batch down
    one tree at a time (vectorised, <= max_depth steps per tree)."""

    def __init__(self, nodes: pd.DataFrame, psi: int, max_depth: int):
        trees = sorted(nodes["tree"].unique())
        m = int(nodes.groupby("tree")["node"].max().max()) + 1
        T = len(trees)
        self.feature = np.full((T, m), -1, dtype=np.int64)
        self.threshold = np.zeros((T, m))
        self.left = np.zeros((T, m), dtype=np.int64)
        self.right = np.zeros((T, m), dtype=np.int64)
        self.path = np.zeros((T, m))
        pos = {t: i for i, t in enumerate(trees)}
        ti = nodes["tree"].map(pos).to_numpy()
        ni = nodes["node"].to_numpy()
        self.feature[ti, ni] = nodes["feature"].to_numpy()
        self.threshold[ti, ni] = nodes["threshold"].to_numpy()
        self.left[ti, ni] = np.maximum(nodes["left"].to_numpy(), 0)
        self.right[ti, ni] = np.maximum(nodes["right"].to_numpy(), 0)
        self.path[ti, ni] = nodes["depth"].to_numpy() + avg_path_length(nodes["size"].to_numpy())
        self.c_psi = float(avg_path_length([psi])[0]) or 1.0
        self.max_depth = max_depth

    def score(self, X: np.ndarray) -> np.ndarray:
        n = len(X)
        rows = np.arange(n)
        total = np.zeros(n)
        for t in range(self.feature.shape[0]):
            node = np.zeros(n, dtype=np.int64)
            for _ in range(self.max_depth + 1):
                f = self.feature[t, node]
                inner = f >= 0
                if not inner.any():
                    break
                go_left = X[rows, np.maximum(f, 0)] < self.threshold[t, node]
                node = np.where(inner, np.where(go_left, self.left[t, node], self.right[t, node]), node)
            total += self.path[t, node]
        return np.power(2.0, -(total / self.feature.shape[0]) / self.c_psi)


def _key(c: str):
    """A feature as the key of its vector: null where it is missing."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def feature_values(df: DataFrame, features) -> DataFrame:
    """(features.., _w), staged: the distinct complete feature vectors with their counts."""
    feats = list(features)
    rows = df.select(*[_key(c).alias(c) for c in feats])
    return _stage(rows.na.drop("any").groupBy(*feats).agg(F.count(F.lit(1)).alias("_w")), "values")


def _stage(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared checkpoint folder: cuts the lineage, and what reads it twice computes it once.
    (A reliable DataFrame.checkpoint would run Python scorers a second time to write its files.)"""
    from venuescope.session import scratch_path

    path = scratch_path(df.sparkSession, f"iforest/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _unit(*c):
    """A uniform number in [0, 1) from a hash of columns."""
    h = F.xxhash64(*c).bitwiseAND(F.lit(0x7FFFFFFFFFFFFC00))
    return h.cast("double") / float(2 ** 63)


def _uniform(key: np.ndarray, j: int) -> np.ndarray:
    """The j-th uniform number in [0, 1) of each key (splitmix64)."""
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / 2.0 ** 53


def copies_below(key: np.ndarray, w: np.ndarray, rho: float) -> np.ndarray:
    """How many of each vector's ``w`` uniform numbers lie below ``rho``, from order statistics: with the smallest j
    known to lie at u, the next is 1 - (1 - u) (1 - x) ** (1 / (w - j)) for a uniform x."""
    if rho >= 1.0:
        return w.copy()
    out, at, u, j = np.zeros(len(w), np.int64), np.arange(len(w)), np.zeros(len(w)), 0
    while len(at):
        x = _uniform(key[at], j)
        u = 1.0 - (1.0 - u) * np.exp(np.log1p(-x) / (w[at] - j))
        below = u < rho
        at, u, j = at[below], u[below], j + 1
        out[at] += 1
        more = w[at] > j
        at, u = at[more], u[more]
    return out


def draw_samples(values: DataFrame, features, n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> DataFrame:
    """(features.., tree): the rows that each tree is grown from, psi = min(max_samples, n) for each.

    ``values``: result of ``feature_values``.  The same rows give the same draw however they are laid out."""
    feats = list(features)
    n = values.agg(F.sum("_w")).first()[0] or 0
    psi = min(max_samples, n)
    rho = min(1.0, 4.0 * n_trees * psi / n) if n else 1.0
    tau = min(1.0, 4.0 * psi / (rho * n)) if n else 1.0
    kinds = ", ".join(f"`{c}` double" for c in feats)

    def copies(it):
        for pdf in it:
            k = copies_below(pdf["_h"].to_numpy(), pdf["_w"].to_numpy(), rho)
            rest = pdf.loc[k > 0, feats]
            k = k[k > 0]
            for a in range(0, len(k), 1024):               # a vector with many copies spans many rows
                part = k[a:a + 1024]
                at = np.repeat(np.arange(len(part)), part)
                nth = np.arange(len(at)) - np.repeat(np.cumsum(part) - part, part)
                yield rest.iloc[a:a + 1024].iloc[at].assign(_copy=nth)

    keyed = values.select(*feats, "_w", F.xxhash64(F.lit(seed), *feats).alias("_h"))
    pool = keyed.mapInPandas(copies, f"{kinds}, _copy long")
    cand = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
    cand = cand.where(_unit(F.lit(seed + 1), *feats, F.col("_copy"), F.col("tree")) < tau)
    # ties of the hash go by content and copy, which are all there is to tell copies apart
    w = Window.partitionBy("tree").orderBy(_unit(F.lit(seed + 2), *feats, F.col("_copy"), F.col("tree")), *feats, "_copy")
    return cand.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= psi).select(*feats, "tree")


def fit_forest(values: DataFrame, features, n_trees: int = 100, max_samples: int = 256, seed: int = 42):
    """Sample and train; return the node table (pandas) or None without rows.

    ``values``: result of ``feature_values``.  The node table is bounded by the parameters
    (trees * (2*psi - 1) rows), so collecting it to broadcast is safe."""
    feats = list(features)
    picked = draw_samples(values, feats, n_trees, max_samples, seed)
    # one tree per group; an explicit partition count keeps AQE from packing
    # all trees into one or two Python workers
    k = max(1, min(n_trees, values.sparkSession.sparkContext.defaultParallelism))
    nodes = (picked.repartition(k, "tree").groupBy("tree")
             .applyInPandas(_trainer(feats, seed), NODE_SCHEMA).toPandas())
    return nodes if len(nodes) else None


def isolation_forest_scores(df: DataFrame, features=("rating", "cost_for_two"), n_trees: int = 100,
                            max_samples: int = 256, seed: int = 42):
    """Anomaly score per *distinct* feature vector, with its multiplicity:
    (features..., _w, _if_score), staged.  ``None`` when no row has all features."""
    feats = list(features)
    values = feature_values(df, feats)
    nodes = fit_forest(values, feats, n_trees, max_samples, seed)
    if nodes is None:
        return None
    roots = nodes[nodes["node"] == 0]
    psi = int(roots["size"].max())
    max_depth = int(nodes["depth"].max())
    bc = df.sparkSession.sparkContext.broadcast((nodes, psi, max_depth))

    def score_batches(it):
        nd, p, md = bc.value
        forest = Forest(nd, p, md)
        for pdf in it:
            X = pdf[feats].to_numpy(dtype=float)
            yield pdf.assign(**{SCORE: forest.score(X) if len(X) else np.zeros(0)})

    schema = StructType(list(values.schema.fields) + [StructField(SCORE, DoubleType())])
    return _stage(values.mapInPandas(score_batches, schema), "scores")


def isolation_forest_flag(df: DataFrame, features=("rating", "cost_for_two"), params: Params = REFERENCE,
                          out: str = "anom_isoforest", keep_score: bool = False, scores=False,
                          max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` plus a boolean column: score strictly above the exact
    (1 - contamination) quantile of all rows' scores; rows that miss a feature are normal.  ``scores`` may be a
    result of ``isolation_forest_scores`` computed earlier on the same rows."""
    feats = list(features)
    if scores is False:
        scores = isolation_forest_scores(df, feats, params.iforest_trees, params.iforest_max_samples, params.seed)
    if scores is None:
        res = df.withColumn(out, F.lit(False))
        return res.withColumn(SCORE, F.lit(None).cast("double")) if keep_score else res
    # the score table is already one row per distinct feature vector with its
    # multiplicity
    cut = exact_percentiles(scores, SCORE, [1.0 - params.contamination], names=["q"], weight="_w").select("q").scalar()
    keys = [f"_if_k{i}" for i in range(len(feats))]
    keyed = df.select("*", *[_key(c).alias(k) for c, k in zip(feats, keys)])
    j = attach(keyed, scores.select(*[F.col(c).alias(k) for c, k in zip(feats, keys)], SCORE), keys, max_bytes)
    res = j.withColumn(out, F.coalesce(F.col(SCORE) > cut, F.lit(False)))
    cols = list(df.columns) + [out] + ([SCORE] if keep_score else [])
    return res.select(*cols)
