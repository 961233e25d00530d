"""The end-to-end pipeline as one Spark application.

extract -> land raw (Parquet) -> clean + explode to a staged version ->
validate (gate) -> swap the staged version in -> eight business queries ->
opportunity scores -> anomaly flags -> findings -> archived report.

Every stage after the landing reads Parquet written by an earlier stage,
so lineage is cut at each table (a lost executor recomputes one stage, not
the join that produced the raw view) and nothing needs to be cached.
"""

from __future__ import annotations

import os
import sys
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from venuescope.config import Params, REFERENCE
from venuescope.operators import anomaly, business, report, scoring
from venuescope.operators.quality import QualityGateError, clean_count_columns, gate, validate_written
from venuescope.operators.transform import explode_cuisines, transform
from venuescope.session import in_pool
from venuescope.sources import sinks


@dataclass
class JobResult:
    status: str
    quality: dict
    timings: dict = field(default_factory=dict)
    exported: list = field(default_factory=list)
    anomalies: dict = field(default_factory=dict)
    findings: list = field(default_factory=list)
    paths: dict = field(default_factory=dict)


class _Timer:
    """Wall time per stage; also labels the stage's Spark jobs (event log)."""

    def __init__(self, spark: SparkSession | None = None):
        self.t = {}
        self.spark = spark

    def __call__(self, name):
        timer = self

        class _Ctx:
            def __enter__(self):
                if timer.spark is not None:
                    timer.spark.sparkContext.setJobDescription(f"venuescope:{name}")
                self.s = time.perf_counter()

            def __exit__(self, *exc):
                timer.t[name] = round(time.perf_counter() - self.s, 3)
        return _Ctx()


QUALITY_SCHEMA = ("rows_read long, rows_after_cleaning long, duplicate_rows_in_raw long, "
                  "missing_ratings_new_restaurants long, missing_costs long, invalid_cities long, "
                  "structurally_valid_rows long, data_quality_pct double, pipeline_status string")
SUMMARY_SCHEMA = ("iqr_cost_anomalies long, zscore_cost_anomalies long, isolation_forest_anomalies long, "
                  "operational_risk_flags long")


def _one_row(spark: SparkSession, d: dict, schema: str) -> DataFrame:
    """A one-row DataFrame from values already on the driver (a report row)."""
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(d[n] for n in names)], schema)


def run_job(spark: SparkSession, raw: DataFrame, out_dir: str, params: Params = REFERENCE,
            with_forest: bool = True, write_clean_csv: bool = True, rebalance_landing: bool = False, database: str | None = None) -> JobResult:
    """Run the whole pipeline; raise ``QualityGateError`` (after archiving
    the report) when the structural quality is below the threshold.

    ``database`` also publishes the two tables as catalog tables there, which
    other applications can open; without it they are session views.

    ``rebalance_landing`` adds a REBALANCE before the raw landing write: AQE
    then cuts advisory-size files and splits skew.  It is a full shuffle of
    the raw table, worth it only when the source arrives as a few or very
    uneven partitions (a CSV source is already split evenly)."""
    tm = _Timer(spark)
    run_id = uuid.uuid4().hex[:12]
    run_date = F.lit(datetime.now(timezone.utc).date())
    stage = os.path.join(out_dir, "tables")
    out_csv = os.path.join(out_dir, "outputs")
    report_path = os.path.join(out_dir, "reports")
    pool = ThreadPoolExecutor(max_workers=6)

    def timed(name, fn, *a, pool_name=None):
        in_pool(spark, pool_name)
        spark.sparkContext.setJobGroup(run_id, name, interruptOnCancel=True)
        spark.sparkContext.setJobDescription(f"venuescope:{name}")
        t = time.perf_counter()
        v = fn(*a)
        return name, round(time.perf_counter() - t, 3), v

    try:
        with tm("extract"):
            raw_path = os.path.join(stage, "raw_listings", f"v={run_id}")
            raw_obs, clean_obs = Observation("raw"), Observation("clean")
            (raw.hint("rebalance") if rebalance_landing else raw).observe(raw_obs, F.count(F.lit(1)).alias("rows")) \
                .write.mode("errorifexists").parquet(raw_path)
            raw_t = spark.read.parquet(raw_path)

        with tm("transform"):
            clean_path = os.path.join(stage, "restaurants", f"v={run_id}")
            transform(raw_t, params).observe(clean_obs, *clean_count_columns()).write.mode("errorifexists").parquet(clean_path)
            clean = spark.read.parquet(clean_path)
            cuis_path = os.path.join(stage, "restaurant_cuisines", f"v={run_id}")
            cuis_obs = Observation("cuisines")

            def write_cuisines():
                (explode_cuisines(clean).observe(cuis_obs, F.count(F.lit(1)).alias("rows"),
                                                 F.count_if(F.col("cuisine") == "0").alias("zero_cuisines"))
                 .write.mode("errorifexists").parquet(cuis_path))
            # the cuisine table and the quality report both need only the
            # clean table: written / computed side by side
            cuis_fut = pool.submit(timed, "explode", write_cuisines)
        paths = {"restaurants": clean_path, "restaurant_cuisines": cuis_path}

        # The forest only reads the staged table and publishes nothing, so it
        # trains and scores while the quality gate is evaluated.
        forest = None
        if with_forest:
            from venuescope.operators.iforest import isolation_forest_scores
            forest = pool.submit(timed, "forest", isolation_forest_scores, clean, ["rating", "cost_for_two"],
                                 params.iforest_trees, params.iforest_max_samples, params.seed,
                                 pool_name="critical")
        # what the other detectors know of the costs, in two passes: also ahead
        stat_fut = pool.submit(timed, "statistics", anomaly.column_statistics, clean, "cost_for_two", pool_name="critical")

        with tm("validate"):
            # the writes have counted all but the duplicates
            q = validate_written(raw_t, raw_obs.get["rows"], clean_obs.get, params).collect()[0].asDict()
            tm.t["explode"] = cuis_fut.result()[1]
            cuisines = spark.read.parquet(cuis_path)
        try:
            gate(q)
        except QualityGateError:
            empty = spark.createDataFrame([], "finding_no int, finding string")
            # no anomaly was counted, so none is archived
            sinks.append_report(report.run_report(_one_row(spark, q, QUALITY_SCHEMA), None, empty, run_date, run_id), report_path)
            raise

        with tm("publish"):
            # the staged files are read back and must hold what was written before the swap
            expected = {"restaurants": q["rows_after_cleaning"], "restaurant_cuisines": cuis_obs.get["rows"]}
            counts = sinks.publish(spark, paths, expected, stage, database)

        # Everything below depends only on the published tables: independent
        # Spark jobs submitted from a small thread pool, so short jobs do not
        # queue behind each other (the FAIR scheduler interleaves their tasks).
        r, rc = spark.table("restaurants"), spark.table("restaurant_cuisines")
        results = {name: fn(r if src == "restaurants" else rc, params)
                   for name, (fn, src) in business.BUSINESS_QUERIES.items()}
        flags_path = os.path.join(stage, "venue_flags", f"v={run_id}")
        anom_obs = Observation("anomalies")

        def score():
            opp = scoring.city_opportunity(clean, params)
            sinks.write_csv(opp, os.path.join(out_csv, "city_opportunity_scores.csv"), single_file=True)

        def anomalies():
            scores = False
            if forest is not None:
                name, secs, scores = forest.result()
                tm.t[name] = secs
            name, secs, known = stat_fut.result()
            tm.t[name] = secs
            flagged, _ = anomaly.detect_all(clean, params, with_forest=with_forest, forest_scores=scores, statistics=known)
            flagged.observe(anom_obs, *anomaly.summary_columns()).write.mode("errorifexists").parquet(flags_path)
            sinks.write_csv(spark.read.parquet(flags_path).where(F.col("operational_risk")),
                            os.path.join(out_csv, "operational_risk_restaurants.csv"))

        def one_query(name):
            return sinks.export_queries({name: results[name]}, out_csv)[0]

        with tm("analytics"):
            futs = [pool.submit(timed, "anomalies", anomalies, pool_name="critical"),
                    pool.submit(timed, "score", score)]
            if write_clean_csv:
                futs.append(pool.submit(timed, "load_csv", sinks.load_csv_pair, clean, cuisines,
                                        os.path.join(out_dir, "cleaned")))
            futs += [pool.submit(timed, f"sql_{qn}", one_query, qn) for qn in results]
            done = [f.result() for f in futs]
        exported = [v for name, _, v in done if name.startswith("sql_")]
        tm.t.update({name: secs for name, secs, _ in done})

        with tm("report"):
            s = dict(anom_obs.get)
            summary = _one_row(spark, s, SUMMARY_SCHEMA)
            opp_t = spark.read.option("header", True).schema(scoring.city_opportunity(clean, params).schema) \
                .csv(os.path.join(out_csv, "city_opportunity_scores.csv"))
            findings = report.key_findings(clean, opp_t, summary)
            rep = report.run_report(_one_row(spark, q, QUALITY_SCHEMA), summary, findings, run_date, run_id)
            sinks.append_report(rep, report_path)
            f = [row.value for row in spark.read.parquet(report_path)
                 .where((F.col("run_date") == run_date) & (F.col("run_id") == run_id) & (F.col("section") == "key_findings"))
                 .orderBy("item_no").collect()]
    finally:
        # on a failed gate nobody waits for the forest
        spark.sparkContext.setJobDescription(None)
        if sys.exc_info()[0] is not None:
            spark.sparkContext.cancelJobGroup(run_id)
        pool.shutdown(wait=True, cancel_futures=True)

    return JobResult(status=q["pipeline_status"], quality=q, timings=tm.t, exported=exported,
                     anomalies=s, findings=f, paths=dict(paths, flags=flags_path, reports=report_path,
                                                          counts=counts))
