"""Descriptive statistics, correlation, z-score share and a t interval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuescope.functions.stats import t_quantile
from venuescope.operators.quantile import exact_percentiles


def _long(df: DataFrame, cols) -> DataFrame:
    cols = list(cols)
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "value").where(F.col("value").isNotNull())


def describe(df: DataFrame, cols) -> DataFrame:
    """count, mean, std (ddof 1), min, 25/50/75% (exact), max per column.

    Long form: one row per column, so all columns share one scan, one
    aggregate and one quantile pass (grouped by column name)."""
    lg = _long(df, cols)
    base = lg.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_percentiles(lg, "value", [0.25, 0.5, 0.75], by=["column_name"], names=["p25", "p50", "p75"])
    return (base.join(q, "column_name", "left")
            .select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")
            .orderBy("column_name"))


def descriptive(df: DataFrame, col: str) -> DataFrame:
    """Mean, median, sample variance and sample sd of the non-null values."""
    med = exact_percentiles(df, col, [0.5], names=["median"]).select("median").scalar()
    return df.where(F.col(col).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg(col).alias("mean"),
        F.var_samp(col).alias("variance"), F.stddev_samp(col).alias("std")
    ).select("n", "mean", med.alias("median"), "variance", "std")


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form, from one aggregate."""
    cols = list(cols)
    pairs = [(a, b) for a in cols for b in cols]
    agg = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    lg = agg.unpivot([], [f"{a}__{b}" for a, b in pairs], "pair", "corr")
    parts = F.split(F.col("pair"), "__")
    return lg.select(parts[0].alias("x"), parts[1].alias("y"), "corr")


def zscore_share(df: DataFrame, col: str, threshold: float = 2.0) -> DataFrame:
    """Count and % of non-null values with |z| > threshold (population sd)."""
    s = df.where(F.col(col).isNotNull())
    st = s.agg(F.struct(F.avg(col).alias("m"), F.stddev_pop(col).alias("sd")).alias("s")).select("s").scalar()
    s = s.withColumn("_z_s", st)
    z = (F.col(col) - F.col("_z_s.m")) / F.nullif(F.col("_z_s.sd"), F.lit(0.0))
    flag = F.coalesce(F.abs(z) > threshold, F.lit(False))
    return s.agg(F.count(F.lit(1)).alias("n"), F.count_if(flag).alias("outliers"),
                 (F.lit(100.0) * F.count_if(flag) / F.count(F.lit(1))).alias("outlier_pct"))


def mean_ci(df: DataFrame, col: str, level: float = 0.95) -> DataFrame:
    """Mean, standard error and a two-sided t interval of the mean."""
    s = df.where(F.col(col).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"))
    sem = F.col("sd") / F.sqrt(F.col("n").cast("double"))
    t = t_quantile(0.5 + level / 2.0, F.col("n") - 1)
    return s.select("n", "mean", sem.alias("sem"), t.alias("t_crit"),
                    (F.col("mean") - t * sem).alias("ci_low"), (F.col("mean") + t * sem).alias("ci_high"))
