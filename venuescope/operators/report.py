"""Headline findings and the run report (the content of the PDF, as rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuescope.functions import round_half_up


def _fixed(x: Column, digits: int) -> Column:
    """'%.nf' of a value rounded half-up first, so every engine prints the
    same digits."""
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f", round_half_up(x, digits)))


def key_findings(clean: DataFrame, opportunity: DataFrame, anomaly_summary: DataFrame,
                 city: str = "city_clean") -> DataFrame:
    """Five sentences: top city with score and rating; unrated count and
    share; mean rating of rated venues; risk count; online share.  A sentence
    whose number does not exist (no city qualifies, nothing is rated, an empty
    table) is left out, the others stay.

    Every input is one row (the top city is a top-1, the rest are one-row
    aggregates read as scalar subqueries)."""
    st = clean.agg(F.struct(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("rating").isNull()).alias("unrated"),
        F.avg("rating").alias("mean_rated"),
        F.avg(F.col("has_online_order").cast("double")).alias("online"),
    ).alias("s")).select("s").scalar()
    risk = anomaly_summary.select("operational_risk_flags").scalar()
    best = (opportunity.orderBy(F.col("opportunity_score").desc(), F.col(city).asc()).limit(1)
            .select(F.struct(city, "opportunity_score", "avg_rating").alias("top")).select("top").scalar())
    top = clean.sparkSession.range(1).select(best.alias("_top"), st.alias("_st"), risk.alias("_risk"))
    st, risk, first = F.col("_st"), F.col("_risk"), F.col("_top")
    sentences = [
        F.concat(F.lit("Top opportunity city: "), first[city], F.lit(" (score "),
                 _fixed(first["opportunity_score"], 1), F.lit(", avg rating "),
                 _fixed(first["avg_rating"], 2), F.lit(").")),
        F.concat(F.format_number(st["unrated"], 0), F.lit(" restaurants are unrated (new) - "),
                 _fixed(F.lit(100.0) * st["unrated"] / F.nullif(st["n"], F.lit(0)), 1), F.lit("% of the dataset.")),
        F.concat(F.lit("Average rating across rated restaurants is "), _fixed(st["mean_rated"], 2),
                 F.lit(" on a 5-point scale.")),
        F.concat(F.format_number(risk, 0),
                 F.lit(" restaurants flagged as operational risk (high cost + low rating).")),
        F.concat(F.lit("Online ordering enabled at "), _fixed(F.lit(100.0) * st["online"], 1),
                 F.lit("% of restaurants.")),
    ]
    rows = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("finding_no"), s.alias("finding"))
                               for i, s in enumerate(sentences)])).alias("f")
    return top.select(rows).select("f.finding_no", "f.finding").where(F.col("finding").isNotNull())


def run_report(quality: DataFrame, anomaly_summary: DataFrame | None, findings: DataFrame,
               run_date: Column | None = None, run_id: str | None = None) -> DataFrame:
    """(run_date, run_id, section, item, value) rows: quality items in report order,
    anomaly counts, findings.  Meant to be appended to a table partitioned
    by ``run_date``; ``run_id`` tells the runs of one day apart.  Without an
    ``anomaly_summary`` (nothing was computed) that section is left out."""
    run_date = F.current_date() if run_date is None else run_date

    def long(df: DataFrame, section: str, order_base: int) -> DataFrame:
        cols = df.columns
        arr = F.array(*[F.struct(F.lit(order_base + i).alias("item_no"), F.lit(c).alias("item"),
                                 F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)])
        return df.select(F.lit(section).alias("section"), F.explode(arr).alias("r")).select(
            "section", "r.item_no", "r.item", "r.value")

    q = long(quality, "data_quality", 1)
    f = findings.select(F.lit("key_findings").alias("section"), F.col("finding_no").alias("item_no"),
                        F.concat(F.lit("finding_"), F.col("finding_no").cast("string")).alias("item"),
                        F.col("finding").alias("value"))
    if anomaly_summary is not None:
        q = q.unionByName(long(anomaly_summary, "anomaly_detection", 1))
    return q.unionByName(f).select(run_date.alias("run_date"), F.lit(run_id).cast("string").alias("run_id"), "section", "item_no", "item", "value")
