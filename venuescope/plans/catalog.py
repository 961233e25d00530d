"""The named query catalogue: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every entry reads the test tables (through the venue binding or directly)
and returns a DataFrame over the whole tables.  Entries that read the listings
several times stage the columns they need first, so the joins and the parsing are
done once; quantiles settle their cells while the plan is built, the forest its
trees, and the publish and export entries write their files; all else is lazy.
Doubles that the original pipeline leaves unrounded are presented at 9
decimals (``round_doubles``) so results do not depend on summation order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuescope.config import TEST_BINDING as P
from venuescope.functions import clean_cost, clean_location, clean_rating, clean_votes, standardise_city
from venuescope.functions.text import round_doubles
from venuescope.operators import anomaly, business, eda, forecast, profile, quality, scoring, stats
from venuescope.operators.transform import explode_cuisines, transform
from venuescope.plans import sql_text
from venuescope.session import scratch_path, staged
from venuescope.sources import sinks
from venuescope.sources.bindings import raw_venues, table

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        CATALOG[name] = fn
        return fn
    return deco


def raw(spark, d):
    return raw_venues(spark, d)


def restaurants(spark, d):
    return transform(raw(spark, d), P)


def staged_restaurants(spark, d, *cols):
    """The cleaned listings (or some of their columns), written once for entries that read them several times."""
    c = restaurants(spark, d)
    return staged(c.select(*cols) if cols else c, "listings")


def restaurant_cuisines(spark, d):
    return explode_cuisines(restaurants(spark, d))


def _mapping(raw_col: str, out_col: str, rule) -> Query:
    """How one cleaning rule maps every raw value seen in the table."""
    def run(spark, d):
        r = raw(spark, d)
        return (r.select(F.col(raw_col).alias(f"{raw_col}_raw"), rule(F.col(raw_col)).alias(out_col))
                .groupBy(f"{raw_col}_raw", out_col).agg(F.count(F.lit(1)).alias("n")))
    return run


# --- the eight business queries --------------------------------------------
for _name, (_fn, _src) in business.BUSINESS_QUERIES.items():
    def _q(spark, d, _fn=_fn, _src=_src):
        src = restaurants(spark, d) if _src == "restaurants" else restaurant_cuisines(spark, d)
        return _fn(src, P)
    CATALOG[_name] = _q

# --- cleaning rules, one column each, then the whole projection --------------
CATALOG["clean_rating"] = _mapping("rating", "rating", clean_rating)
CATALOG["clean_cost"] = _mapping("cost_for_two", "cost_for_two", clean_cost)
CATALOG["clean_votes"] = _mapping("rating_count", "votes", clean_votes)
CATALOG["standardise_city"] = _mapping("city", "city_clean", lambda c: standardise_city(c, P.city_map))
CATALOG["clean_location"] = _mapping("area", "location", clean_location)


@register("price_tier")
def _price_tier(spark, d):
    c = restaurants(spark, d)
    return (c.groupBy("price_tier")
            .agg(F.count(F.lit(1)).alias("n"), F.min("cost_for_two").alias("min_cost"),
                 F.max("cost_for_two").alias("max_cost")))


@register("city_tier")
def _city_tier(spark, d):
    c = restaurants(spark, d)
    return c.groupBy("city_clean", "city_tier").agg(F.count(F.lit(1)).alias("n"))


@register("clean_flags")
def _flags(spark, d):
    c = restaurants(spark, d)
    return (c.groupBy("has_online_order", "has_table_booking", "delivery_only")
            .agg(F.count(F.lit(1)).alias("n")))


@register("transform")
def _transform(spark, d):
    return restaurants(spark, d)


@register("explode_cuisines")
def _explode(spark, d):
    return restaurant_cuisines(spark, d)


@register("explode_cuisines_lenient")
def _explode_lenient(spark, d):
    return explode_cuisines(restaurants(spark, d), drop_zero=False)


# --- publish and export ------------------------------------------------------
@register("publish_tables")
def _publish(spark, d):
    """Stages both tables in the shared folder, verifies and publishes them together, and returns the
    row counts and residual '0' cuisines of the files."""
    out = scratch_path(spark, f"published-{uuid.uuid4().hex}")
    rows: dict[str, int] = {}
    paths = sinks.stage_tables({"restaurants": restaurants(spark, d)}, out, rows=rows)
    paths |= sinks.stage_tables({"restaurant_cuisines": explode_cuisines(spark.read.parquet(paths["restaurants"]))}, out, rows=rows)
    sinks.publish(spark, paths, rows, out)
    return sinks.published_counts(spark, paths)


@register("query_export_counts")
def _export_counts(spark, d):
    """Publishes the tables, runs the eight queries from their SQL text, writes each result as a file and
    counts the rows of the files."""
    CATALOG["publish_tables"](spark, d)
    out = scratch_path(spark, f"exports-{uuid.uuid4().hex}")
    sinks.export_queries(sql_text.run_sql(spark, P), out)
    parts = [spark.read.option("header", True).csv(f"{out}/{q}_results.csv").agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(f"{q}_results.csv").alias("file_name"), "rows")
             for q in business.BUSINESS_QUERIES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- quality and profiling ---------------------------------------------------
@register("quality_report")
def _quality(spark, d):
    return quality.validate(raw(spark, d), restaurants(spark, d), P)


@register("profile_shape")
def _shape(spark, d):
    return profile.shape(raw(spark, d))


@register("profile_nulls")
def _nulls(spark, d):
    return profile.null_counts(restaurants(spark, d))


@register("profile_raw_nulls")
def _raw_nulls(spark, d):
    return profile.null_counts(raw(spark, d))


@register("profile_value_counts")
def _value_counts(spark, d):
    return profile.value_counts(raw(spark, d), "rating", top=15, dropna=False)


@register("profile_comma_count")
def _comma(spark, d):
    return profile.contains_count(raw(spark, d), "cost_for_two", ",")


@register("profile_exact_dups")
def _exact_dups(spark, d):
    return profile.exact_duplicates(table(spark, d, "documents").select("lang", "source", "text"))


@register("profile_logical_dups")
def _logical_dups(spark, d):
    return profile.logical_duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("profile_distinct")
def _distinct(spark, d):
    return profile.distinct_count(restaurants(spark, d), "city_clean")


@register("profile_data_loss")
def _data_loss(spark, d):
    return round_doubles(profile.data_loss(raw(spark, d), restaurants(spark, d)))


# --- scoring and anomalies ---------------------------------------------------
@register("city_opportunity")
def _opportunity(spark, d):
    return round_doubles(scoring.city_opportunity(restaurants(spark, d), P))


@register("anom_iqr")
def _iqr(spark, d):
    ev = table(spark, d, "events").select("event_id", "value")
    return anomaly.iqr_flag(ev, "value", "anom_iqr")


@register("anom_iqr_bounds")
def _iqr_bounds(spark, d):
    return round_doubles(anomaly.iqr_bounds(table(spark, d, "events"), "value"))


@register("anom_zscore")
def _zscore(spark, d):
    ev = table(spark, d, "events").select("event_id", "value")
    return anomaly.zscore_flag(ev, "value", "anom_zscore", 3.0)


@register("anom_business_risk")
def _risk(spark, d):
    return anomaly.business_risk_flag(staged_restaurants(spark, d), P)


# --- exploratory questions ---------------------------------------------------
@register("e1_city_counts")
def _e1(spark, d):
    return eda.top_counts(restaurants(spark, d), "city_clean", P.e1_top)


@register("e2_rating_histogram")
def _e2(spark, d):
    return round_doubles(eda.histogram(restaurants(spark, d), "rating", P.e2_bins))


@register("e3_online_rating")
def _e3(spark, d):
    return round_doubles(eda.mean_by(restaurants(spark, d), "has_online_order", ["rating"]))


@register("e4_top_cuisines")
def _e4(spark, d):
    return eda.top_counts(restaurant_cuisines(spark, d), "cuisine", P.e4_top)


@register("e5_box_top_cities")
def _e5(spark, d):
    return round_doubles(eda.box_stats(staged_restaurants(spark, d, "city_clean", "cost_for_two"), "city_clean", "cost_for_two", P.e5_top_cities))


@register("e6_service_mix")
def _e6(spark, d):
    return round_doubles(eda.service_mix(restaurants(spark, d)))


@register("e7_sample")
def _e7s(spark, d):
    c = staged_restaurants(spark, d, "name", "city_clean", "rating", "cost_for_two")
    return eda.deterministic_sample(c, P.e7_sample_size, P.seed, dropna=["rating", "cost_for_two"])


@register("e7_rating_cost_corr")
def _e7c(spark, d):
    return round_doubles(eda.correlation(restaurants(spark, d), "rating", "cost_for_two"))


@register("e8_city_localities")
def _e8(spark, d):
    return eda.city_localities(restaurants(spark, d), P)


@register("e9_tier_compare")
def _e9(spark, d):
    return round_doubles(eda.mean_by(restaurants(spark, d), "city_tier", ["rating", "cost_for_two"]))


@register("e10_price_tier_share")
def _e10(spark, d):
    return round_doubles(eda.ordered_share(restaurants(spark, d), "price_tier"))


# --- statistics and forecasting ----------------------------------------------
STAT_COLS = ("rating", "cost_for_two", "votes")


@register("stats_describe")
def _describe(spark, d):
    return round_doubles(stats.describe(restaurants(spark, d), STAT_COLS))


@register("stats_descriptive")
def _descriptive(spark, d):
    return round_doubles(stats.descriptive(restaurants(spark, d), "rating"))


@register("stats_corr_matrix")
def _corr(spark, d):
    return round_doubles(stats.corr_matrix(restaurants(spark, d), STAT_COLS))


@register("stats_zscore_share")
def _zshare(spark, d):
    return round_doubles(stats.zscore_share(restaurants(spark, d), "rating", 2.0))


@register("stats_mean_ci")
def _ci(spark, d):
    return round_doubles(stats.mean_ci(restaurants(spark, d), "rating", 0.95))


def _monthly(spark, d):
    return forecast.monthly_counts(table(spark, d, "orders"), "o_orderdate")


@register("forecast_linear")
def _linear(spark, d):
    return round_doubles(forecast.linear_forecast(_monthly(spark, d), 6), 6)


@register("forecast_moving_avg")
def _ma(spark, d):
    return round_doubles(forecast.moving_average(_monthly(spark, d), 3))


# --- isolation forest, summary, risk export, findings, report ----------------
DETECTOR_COLS = ("city_clean", "rating", "cost_for_two")
FINDING_COLS = (*DETECTOR_COLS, "votes", "has_online_order")


@register("anom_isolation_forest")
def _iforest(spark, d):
    from venuescope.operators.iforest import isolation_forest_flag
    return isolation_forest_flag(staged_restaurants(spark, d), params=P)


@register("anom_summary_statistical")
def _anom_summary_statistical(spark, d):
    """The summary's three counts that need no forest."""
    c = staged_restaurants(spark, d, *DETECTOR_COLS)
    return anomaly.detect_all(c, P, with_forest=False)[1].drop("isolation_forest_anomalies")


@register("operational_risk_venues")
def _risk_venues(spark, d):
    """The risk export without the forest's flag."""
    flagged, _ = anomaly.detect_all(staged_restaurants(spark, d), P, with_forest=False)
    return flagged.where(F.col("operational_risk")).drop("anom_isoforest")


@register("anom_summary")
def _anom_summary(spark, d):
    return anomaly.detect_all(staged_restaurants(spark, d, *DETECTOR_COLS), P)[1]


@register("operational_risk_rows")
def _risk_rows(spark, d):
    flagged, _ = anomaly.detect_all(staged_restaurants(spark, d), P)
    return flagged.where(F.col("operational_risk"))


@register("key_findings")
def _findings(spark, d):
    from venuescope.operators.report import key_findings
    c = staged_restaurants(spark, d, *FINDING_COLS)
    # the risk count alone (no forest): what the findings sentence needs
    risk = anomaly.business_risk_flag(c, P).agg(F.count_if("operational_risk").alias("operational_risk_flags"))
    return key_findings(c, scoring.city_opportunity(c, P), risk)


def _report(spark, d, with_forest=True):
    """The run report's rows: the raw listings are landed and their cleaned columns staged, as in the job."""
    from venuescope.operators.report import key_findings, run_report
    landed = staged(raw(spark, d), "landed")
    c = staged(transform(landed, P).select(*FINDING_COLS), "listings")
    _, summary = anomaly.detect_all(c, P, with_forest=with_forest)
    if not with_forest:
        summary = summary.drop("isolation_forest_anomalies")
    summary = staged(summary, "summary")        # one row, read by the findings and the report
    f = key_findings(c, scoring.city_opportunity(c, P), summary)
    return run_report(quality.validate(landed, c, P), summary, f)


@register("run_report")
def _run_report(spark, d):
    return _report(spark, d)


@register("run_report_statistical")
def _run_report_statistical(spark, d):
    """The archived report's rows without the forest's count, the run's date and number."""
    return _report(spark, d, with_forest=False).drop("run_date", "run_id")
