"""Data-quality report and the publish gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuescope.config import Params, REFERENCE
from venuescope.functions import round_half_up


class QualityGateError(RuntimeError):
    """Raised when the structural quality is below the threshold."""


def duplicate_rows(df: DataFrame, cols=None) -> DataFrame:
    """One row: ``rows``, and ``duplicates``, the rows equal (nulls equal) to an earlier row: sum(n - 1)
    over groups of identical rows.  Rows are grouped by a 256-bit digest of their JSON form, so
    long texts do not cross the shuffle; partial aggregation collapses copies
    before it, so a value repeated a billion times costs one row per map task."""
    cols = list(cols or df.columns)
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}), 256)
    return (df.groupBy(digest.alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows")))


def clean_count_columns():
    """The report's counts over the clean table (aggregate expressions, so a
    job can also observe them while it writes the table)."""
    valid = F.col("cost_for_two").isNotNull() & F.col("city_clean").isNotNull()
    return [F.count(F.lit(1)).alias("rows_after_cleaning"),
            F.count_if(F.col("rating").isNull()).alias("missing_ratings_new_restaurants"),
            F.count_if(F.col("cost_for_two").isNull()).alias("missing_costs"),
            F.count_if(F.col("city_clean").isNull()).alias("invalid_cities"),
            F.count_if(valid).alias("structurally_valid_rows")]


def report_from_counts(counts: DataFrame, params: Params = REFERENCE) -> DataFrame:
    """Quality % and PASS / FAIL text from a one-row table of counts
    (rows_read, rows_after_cleaning, duplicate_rows_in_raw, the missing /
    invalid counts and structurally_valid_rows)."""
    rows_read = F.col("rows_read")
    pct = F.when(rows_read > 0, round_half_up(F.lit(100.0) * F.col("structurally_valid_rows") / rows_read, 2)) \
        .otherwise(F.lit(0.0))
    thr = float(params.quality_threshold)
    out = counts.select(
        "rows_read", "rows_after_cleaning", "duplicate_rows_in_raw", "missing_ratings_new_restaurants",
        "missing_costs", "invalid_cities", "structurally_valid_rows", pct.alias("data_quality_pct"))
    status = F.when(F.col("data_quality_pct") >= thr, F.lit("PASS")).otherwise(
        F.concat(F.lit("FAIL - quality "), F.col("data_quality_pct").cast("string"),
                 F.lit(f"% below {thr}% threshold")))
    return out.withColumn("pipeline_status", status)


def validate(raw: DataFrame, clean: DataFrame, params: Params = REFERENCE) -> DataFrame:
    """One-row report: counts, structural quality % and PASS / FAIL text.

    ``raw`` and ``clean`` have the same rows (cleaning drops none), so one
    aggregate over ``clean`` gives every count except the raw rows and
    their duplicates, which come from one other aggregate as a scalar subquery."""
    seen = duplicate_rows(raw).select(F.struct("rows", "duplicates").alias("s")).select("s").scalar()
    agg = clean.agg(*clean_count_columns()).withColumn("_raw", seen)
    counts = agg.select(F.col("_raw.rows").alias("rows_read"), "*", F.col("_raw.duplicates").alias("duplicate_rows_in_raw"))
    return report_from_counts(counts, params)


def validate_written(raw: DataFrame, rows_read: int, clean_counts: dict, params: Params = REFERENCE) -> DataFrame:
    """The same report from what the writes of the raw and the clean table have counted already
    (``clean_count_columns`` observed): only the duplicates are left to look for."""
    seen = duplicate_rows(raw).select("duplicates", "rows")
    counts = seen.select(F.lit(rows_read).cast("bigint").alias("rows_read"),
                         *[F.lit(int(v)).cast("bigint").alias(k) for k, v in clean_counts.items()],
                         F.col("duplicates").alias("duplicate_rows_in_raw"))
    return report_from_counts(counts, params)


def gate(report_row) -> None:
    """Stop before any publish when the report says FAIL."""
    status = report_row["pipeline_status"]
    if not status.startswith("PASS"):
        raise QualityGateError(status)
