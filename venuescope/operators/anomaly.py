"""Anomaly flags: IQR, z-score, business rule; ``detect_all`` adds the forest.

Statistics of a whole column are one-row aggregates read back as scalar
subqueries (computed once, then a literal for every row); the per-city
quantile of the business rule is a small per-city table joined on city.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuescope.config import Params, REFERENCE
from venuescope.operators.enrich import BROADCAST_BYTES, attach
from venuescope.operators.quantile import cell_counts, column_percentiles, exact_percentiles
from venuescope.session import scratch_path


def iqr_bounds(df: DataFrame, value: str, k: float = 1.5) -> DataFrame:
    """One row: q1, q3, iqr, lower, upper (exact, linear interpolation)."""
    return _bounds(exact_percentiles(df, value, [0.25, 0.75], names=["q1", "q3"]), k)


def _bounds(q: DataFrame, k: float) -> DataFrame:
    return q.select("q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                    (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower"),
                    (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper"))


def iqr_flag(df: DataFrame, value: str, out: str = "anom_iqr", k: float = 1.5,
             bounds: DataFrame | None = None) -> DataFrame:
    """Strictly outside [lower, upper]; null value -> False.  ``bounds``:
    the one-row ``iqr_bounds`` result when it was computed ahead."""
    bounds = iqr_bounds(df, value, k) if bounds is None else bounds
    b = bounds.select(F.struct("lower", "upper").alias("b")).select("b").scalar()
    v = F.col(value)
    t = df.withColumn("_iqr_b", b)
    flag = F.coalesce((v < F.col("_iqr_b.lower")) | (v > F.col("_iqr_b.upper")), F.lit(False))
    return t.withColumn(out, flag).drop("_iqr_b")


def _moments(df: DataFrame, value: str) -> DataFrame:
    """One row: mean and population sd."""
    return df.agg(F.avg(value).alias("m"), F.stddev_pop(value).alias("sd"))


def moments_of(counts: DataFrame) -> DataFrame:
    """The same from ``cell_counts``, which hold each cell's sum of weights, mean and squared deviations: the
    pairwise update of variances, so that no difference of large sums is taken."""
    n, mean = F.sum("_n").cast("double"), F.sum(F.col("_n") * F.col("_mean")) / F.sum("_n")
    whole = counts.agg(mean.alias("m")).select("m").scalar()
    c = counts.withColumn("_m", whole)
    return c.agg(F.first("_m").alias("m"), F.sqrt(F.sum(F.col("_m2") + F.col("_n") * F.pow(F.col("_mean") - F.col("_m"), 2)) / n).alias("sd"))


def zscore_flag(df: DataFrame, value: str, out: str = "anom_zscore", threshold: float = 3.0, moments: DataFrame | None = None) -> DataFrame:
    """|x - mean| / population sd strictly above ``threshold``; null -> False;
    a zero sd flags nothing.  ``moments``: the one row of mean and sd when it was computed ahead."""
    st = _moments(df, value) if moments is None else moments
    st = st.select(F.struct("m", "sd").alias("s")).select("s").scalar()
    t = df.withColumn("_z_s", st)
    z = (F.col(value) - F.col("_z_s.m")) / F.nullif(F.col("_z_s.sd"), F.lit(0.0))
    return t.withColumn(out, F.coalesce(F.abs(z) > threshold, F.lit(False))).drop("_z_s")


def city_percentile(clean: DataFrame, city: str = "city_clean", cost: str = "cost_for_two", counts: DataFrame | None = None) -> DataFrame:
    """(city, _city_p75), staged: one row for each city with a cost."""
    p75 = column_percentiles(clean, cost, [([city], [0.75], ["_city_p75"])], counts=counts)[0]
    path = scratch_path(clean.sparkSession, f"city-percentile/{uuid.uuid4().hex}")
    p75.write.parquet(path)
    return clean.sparkSession.read.schema(p75.schema).parquet(path)


def business_risk_flag(clean: DataFrame, params: Params = REFERENCE, out: str = "operational_risk",
                       city: str = "city_clean", cost: str = "cost_for_two",
                       rating: str = "rating", p75: DataFrame | None = None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Cost strictly above the venue's own city's 75th percentile AND rating
    below the low cut-off; anything null -> False.  ``p75``: ``city_percentile`` of the
    same rows when it was computed ahead.

    The per-city table is measured and broadcast within ``max_bytes``; beyond it only cities below a
    partition's share of the rows are shuffled (``enrich.attach``)."""
    p75 = city_percentile(clean, city, cost) if p75 is None else p75
    j = attach(clean, p75, [city], max_bytes)
    flag = F.coalesce((F.col(cost) > F.col("_city_p75")) & (F.col(rating) < params.low_rating), F.lit(False))
    return j.withColumn(out, flag).select(*clean.columns, out)


@dataclass
class Statistics:
    """What the detectors need to know of a column: IQR bounds, mean and population sd (one row each, of staged
    tables), and the per-city percentile, staged."""
    iqr: DataFrame
    moments: DataFrame
    p75: DataFrame


def column_statistics(clean: DataFrame, value: str = "cost_for_two", city: str = "city_clean", k: float = 1.5) -> Statistics:
    """The statistics of all detectors from two passes over the table: one counts cells by city (with sums
    for the moments), one reads the rows of the wanted cells."""
    counts = cell_counts(clean, value, [city])
    q, p75 = column_percentiles(clean, value, [([], [0.25, 0.75], ["q1", "q3"]), ([city], [0.75], ["_city_p75"])], counts=counts)
    # one row each, read from small tables where they are needed; the per-city table is measured and joined
    path = scratch_path(clean.sparkSession, f"city-percentile/{uuid.uuid4().hex}")
    p75.write.parquet(path)
    return Statistics(_bounds(q, k), moments_of(counts), clean.sparkSession.read.schema(p75.schema).parquet(path))


def detect_all(clean: DataFrame, params: Params = REFERENCE, with_forest: bool = True,
               value: str = "cost_for_two", forest_scores=False, statistics: Statistics | None = None):
    """Four flag columns and a one-row summary of their counts.
    ``forest_scores`` / ``statistics``: forest scores and column statistics computed ahead
    (optional)."""
    from venuescope.operators.iforest import isolation_forest_flag

    s = column_statistics(clean, value) if statistics is None else statistics
    df = iqr_flag(clean, value, "anom_iqr_cost", bounds=s.iqr)
    df = zscore_flag(df, value, "anom_zscore_cost", moments=s.moments)
    if with_forest:
        scores = forest_scores
        if scores is False:
            from venuescope.operators.iforest import isolation_forest_scores
            scores = isolation_forest_scores(clean, ["rating", value], params.iforest_trees, params.iforest_max_samples, params.seed)
        df = isolation_forest_flag(df, params=params, out="anom_isoforest", scores=scores)
    else:
        df = df.withColumn("anom_isoforest", F.lit(False))
    df = business_risk_flag(df, params, cost=value, p75=s.p75)
    return df, anomaly_summary(df)


def summary_columns():
    return [F.count_if("anom_iqr_cost").alias("iqr_cost_anomalies"),
            F.count_if("anom_zscore_cost").alias("zscore_cost_anomalies"),
            F.count_if("anom_isoforest").alias("isolation_forest_anomalies"),
            F.count_if("operational_risk").alias("operational_risk_flags")]


def anomaly_summary(flagged: DataFrame) -> DataFrame:
    return flagged.agg(*summary_columns())
