"""Monthly series, least-squares trend forecast and trailing moving average."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def monthly_counts(df: DataFrame, ts: str, end: str | None = None) -> DataFrame:
    """Rows per calendar month, numbered 1..n, over all rows; with ``end`` (a date such as
    "2024-04-01") over those before it, for data whose last month is known to be partial.  The aggregate is partial per
    task; everything after it has one row per month, so the ordered window
    (one partition) holds a few hundred rows at most."""
    keep = F.col(ts).isNotNull() if end is None else F.col(ts) < F.lit(end).cast("timestamp")
    m = (df.where(keep)
         .groupBy(F.date_trunc("month", F.col(ts)).alias("month_start"))
         .agg(F.count(F.lit(1)).cast("double").alias("value")))
    w = Window.orderBy("month_start")
    return m.select(F.row_number().over(w).cast("bigint").alias("x"),
                    F.date_format("month_start", "yyyy-MM").alias("month"), "value")


def linear_forecast(series: DataFrame, horizon: int = 6, x: str = "x", y: str = "value") -> DataFrame:
    """OLS of y on x; predictions for the ``horizon`` steps after the last x."""
    fit = series.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                     F.max(x).alias("last_x"))
    steps = fit.select("slope", "intercept",
                       F.explode(F.sequence(F.col("last_x") + 1, F.col("last_x") + horizon)).alias("x"))
    return steps.select("x", (F.col("intercept") + F.col("slope") * F.col("x")).alias("forecast"),
                        "slope", "intercept")


def moving_average(series: DataFrame, window: int = 3, x: str = "x", y: str = "value") -> DataFrame:
    """Trailing mean over ``window`` rows; null until ``window`` values exist."""
    w = Window.orderBy(x).rowsBetween(-(window - 1), 0)
    return series.select(x, y, F.when(F.count(y).over(w) == window, F.avg(y).over(w)).alias("moving_avg"))
