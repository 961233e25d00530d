"""Sources, sinks, the publish swap and the end-to-end job."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from venuescope.config import TEST_BINDING
from venuescope.operators.quality import QualityGateError
from venuescope.operators.transform import explode_cuisines, transform
from venuescope.plans.job import run_job
from venuescope.sources import files, sinks
from venuescope.sources.bindings import raw_venues

from conftest import SF_SMALL


CSV = '''name,city,area,cusine,rating,rating_count,cost_for_two,online_order,table_reservation,delivery_only,famous_food
"Cafe, One",Bangalore, Koramangala ,"Cafe, Bakery",4.1,120,"1,200",True,False,False,NA
"Two
Lines",Mumbai,,0,NEW,0,0,False,False,True,
Three,N/A,Andheri,Chinese,Nov...,abc,350,True,True,False,Pizza
'''


def test_extract_text_only_and_na_tokens(spark, tmp_out):
    p = os.path.join(tmp_out, "raw.csv")
    with open(p, "w") as f:
        f.write(CSV)
    raw = files.extract(spark, p, multiline=True)
    assert all(t == "string" for _, t in raw.dtypes)
    got = raw.collect()
    assert len(got) == 3
    assert got[0]["name"] == "Cafe, One" and got[0]["cost_for_two"] == "1,200" and got[0]["famous_food"] is None
    assert got[1]["name"] == "Two\nLines" and got[1]["area"] is None
    assert got[2]["city"] is None            # 'N/A' is missing, as pandas reads it
    clean = transform(raw).collect()
    assert [r["cost_for_two"] for r in clean] == [1200.0, None, 350.0]
    assert [r["city_clean"] for r in clean] == ["Bengaluru", "Mumbai", None]
    assert [r["has_online_order"] for r in clean] == [True, False, True]


def test_clean_csv_round_trip(spark, tmp_out):
    clean = transform(raw_venues(spark, SF_SMALL), TEST_BINDING)
    cuis = explode_cuisines(clean)
    sinks.load_csv_pair(clean, cuis, tmp_out)
    back = files.read_clean_csv(spark, os.path.join(tmp_out, "venues_clean.csv"))
    assert back.count() == clean.count()
    assert back.exceptAll(clean).count() == 0 and clean.exceptAll(back).count() == 0


def test_stage_count_and_swap(spark, tmp_out):
    clean = transform(raw_venues(spark, SF_SMALL), TEST_BINDING)
    paths = sinks.stage_tables({"restaurants": clean, "restaurant_cuisines": explode_cuisines(clean)},
                               os.path.join(tmp_out, "t"), "v1")
    counts = {r["table_name"]: (r["rows"], r["zero_cuisines"])
              for r in sinks.published_counts(spark, paths).collect()}
    assert counts["restaurants"][0] == clean.count() and counts["restaurant_cuisines"][1] == 0
    sinks.swap_in(spark, paths)
    assert spark.sql("SELECT COUNT(*) FROM restaurants").collect()[0][0] == clean.count()
    # a second version swaps in without touching the first
    paths2 = sinks.stage_tables({"restaurants": clean.limit(5)}, os.path.join(tmp_out, "t"), "v2")
    sinks.swap_in(spark, paths2)
    assert spark.table("restaurants").count() == 5
    assert spark.read.parquet(paths["restaurants"]).count() == clean.count()


def test_job_end_to_end(spark, tmp_out):
    res = run_job(spark, raw_venues(spark, SF_SMALL), tmp_out, TEST_BINDING)
    assert res.status == "PASS"
    assert len(res.exported) == 8
    for name, n in res.exported:     # counts observed during the write = rows in the file
        path = os.path.join(tmp_out, "outputs", name)
        assert glob.glob(os.path.join(path, "part-*.csv"))
        assert spark.read.option("header", True).csv(path).count() == n
    assert glob.glob(os.path.join(tmp_out, "outputs", "city_opportunity_scores.csv", "part-*.csv"))
    risk = spark.read.option("header", True).csv(os.path.join(tmp_out, "outputs", "operational_risk_restaurants.csv"))
    assert risk.count() == res.anomalies["operational_risk_flags"]
    rep = spark.read.parquet(res.paths["reports"])
    assert set(r["section"] for r in rep.collect()) == {"data_quality", "anomaly_detection", "key_findings"}
    assert len(res.findings) == 5 and res.findings[0].startswith("Top opportunity city: ")
    assert res.anomalies["isolation_forest_anomalies"] > 0


def test_job_gate_failure_stops_publish(spark, tmp_out):
    p = TEST_BINDING.replace(quality_threshold=99.99)
    with pytest.raises(QualityGateError):
        run_job(spark, raw_venues(spark, SF_SMALL), tmp_out, p)
    assert not os.path.exists(os.path.join(tmp_out, "outputs"))
    rep = spark.read.parquet(os.path.join(tmp_out, "reports"))
    status = [r["value"] for r in rep.collect() if r["item"] == "pipeline_status"]
    assert status and status[0].startswith("FAIL - quality")


def test_sql_text_equals_dataframe_queries(spark):
    from venuescope.operators import business
    from venuescope.plans.sql_text import run_sql
    clean = transform(raw_venues(spark, SF_SMALL), TEST_BINDING)
    clean.createOrReplaceTempView("restaurants")
    explode_cuisines(clean).createOrReplaceTempView("restaurant_cuisines")
    sql = run_sql(spark, TEST_BINDING)
    for name, (fn, src) in business.BUSINESS_QUERIES.items():
        df = fn(spark.table(src), TEST_BINDING)
        assert sql[name].columns == df.columns, name
        assert sorted(map(tuple, sql[name].collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr), name


def test_catalog_table_pointer_swap(spark, tmp_out):
    a = sinks.stage_tables({"venues_demo": spark.range(5)}, os.path.join(tmp_out, "t"), "a")
    sinks.swap_in(spark, a, catalog_tables=True)
    assert spark.sql("SELECT COUNT(*) FROM default.venues_demo").collect()[0][0] == 5
    b = sinks.stage_tables({"venues_demo": spark.range(8)}, os.path.join(tmp_out, "t"), "b")
    sinks.swap_in(spark, b, catalog_tables=True)
    assert spark.sql("SELECT COUNT(*) FROM default.venues_demo").collect()[0][0] == 8
    spark.sql("DROP TABLE default.venues_demo")


def test_job_survives_messy_values(spark, tmp_out):
    """inf / NaN / huge / junk values everywhere: no ANSI failure anywhere."""
    from venuescope.config import REFERENCE
    from venuescope.schemas import RAW_SCHEMA
    import random
    rnd = random.Random(3)
    ratings = ["4.1", "inf", "-inf", "nan", "NEW", "0", "1e308", "1_000", "Nov...", " 3.5\t", None, "4.1d"]
    costs = ["1,200", "inf", "0", "-5", "9" * 25, "1e400", "abc", None, " 300 ", "1_500"]
    cities = ["Bangalore", " Mumbai ", None, "Pune", "　Delhi", ""]
    rows = []
    for i in range(400):
        rows.append((f"n{i % 37}", rnd.choice(cities), rnd.choice(["a", None, " b "]),
                     rnd.choice(["North Indian, Chinese", "0", None, ",", "Cafe"]), rnd.choice(ratings),
                     rnd.choice(["12", "x", None, "1e99", "-3"]), rnd.choice(costs),
                     rnd.choice(["True", "False", "yes", None]), rnd.choice(["True", "False"]),
                     rnd.choice(["True", "False"]), None))
    raw = spark.createDataFrame(rows, RAW_SCHEMA)
    res = run_job(spark, raw, tmp_out, REFERENCE.replace(quality_threshold=10.0, min_city_venues=5,
                                                          iforest_trees=20))
    assert res.status == "PASS" and len(res.findings) >= 4       # no top city where every score is NaN
    assert res.quality["rows_read"] == 400


def test_job_is_reproducible(spark, tmp_path):
    """Two runs over the same input give the same exports, scores, findings
    and forest flag count (the forest's pool draw is seeded per input split)."""
    a = run_job(spark, raw_venues(spark, SF_SMALL), str(tmp_path / "a"), TEST_BINDING)
    b = run_job(spark, raw_venues(spark, SF_SMALL), str(tmp_path / "b"), TEST_BINDING)
    assert a.exported == b.exported and a.findings == b.findings and a.anomalies == b.anomalies
    for name in ["q1_results.csv", "q8_results.csv", "city_opportunity_scores.csv"]:
        ra = spark.read.option("header", True).csv(str(tmp_path / "a" / "outputs" / name))
        rb = spark.read.option("header", True).csv(str(tmp_path / "b" / "outputs" / name))
        assert ra.exceptAll(rb).count() == 0 and rb.exceptAll(ra).count() == 0


def test_report_archive_appends_by_run_date(spark, tmp_out):
    import datetime as dt
    from venuescope.operators.report import run_report
    q = spark.createDataFrame([(1, "PASS")], "rows_read long, pipeline_status string")
    s = spark.createDataFrame([(0,)], "operational_risk_flags long")
    f = spark.createDataFrame([(1, "x")], "finding_no int, finding string")
    path = os.path.join(tmp_out, "reports")
    for run, day in (("a", dt.date(2026, 1, 1)), ("b", dt.date(2026, 1, 2)), ("c", dt.date(2026, 1, 2))):
        sinks.append_report(run_report(q, s, f, F.lit(day), run), path)
    sinks.append_report(run_report(q, None, f.limit(0), F.lit(dt.date(2026, 1, 2)), "failed"), path)
    got = spark.read.parquet(path)
    assert got.count() == 14 and got.select("run_date").distinct().count() == 2
    assert [r.value for r in got.where("run_id = 'c' and section = 'key_findings'").collect()] == ["x"]
    assert {r.section for r in got.where("run_id = 'failed'").collect()} == {"data_quality"}     # no invented zeros
    assert sorted(os.listdir(path))[:2] == ["_SUCCESS", "run_date=2026-01-01"] or \
        any(p.startswith("run_date=") for p in os.listdir(path))


def test_csv_columns_are_found_by_name(spark, tmp_out):
    p = os.path.join(tmp_out, "raw.csv")
    cols = ["id", "city", "name", *[c for c in CSV.split("\n")[0].split(",") if c not in ("name", "city")]]
    with open(p, "w") as f:
        f.write(",".join(cols) + "\n" + ",".join(f"v_{c}" for c in cols) + "\n")
    got = files.extract(spark, p).collect()[0].asDict()
    assert "id" not in got and all(v == f"v_{k}" for k, v in got.items()) and len(got) == 11
    with open(p, "w") as f:
        f.write("name,city\nx,y\n")
    with pytest.raises(ValueError, match="cusine"):
        files.extract(spark, p)


def test_clean_csv_keeps_newlines_and_quotes(spark, tmp_out):
    raw = spark.createDataFrame([('A "b"\nc, d', "Pune", " x ", "Cafe", "4.1", "3000000000", "1,200", "True", "False", "False", None)],
                                "name string, city string, area string, cusine string, rating string, rating_count string, "
                                "cost_for_two string, online_order string, table_reservation string, delivery_only string, famous_food string")
    clean = transform(raw)
    sinks.load_csv_pair(clean, explode_cuisines(clean), tmp_out)
    back = files.read_clean_csv(spark, os.path.join(tmp_out, "venues_clean.csv")).collect()
    assert back == clean.collect() and back[0]["name"] == 'A "b"\nc, d' and back[0]["votes"] == 3000000000


def test_swap_needs_the_expected_rows():
    ok = [{"table_name": "t", "rows": 3, "zero_cuisines": 0}]
    sinks.verify_counts(ok, {"t": 3})
    for bad in ({"rows": 2, "zero_cuisines": 0}, {"rows": 3, "zero_cuisines": 1}):
        with pytest.raises(ValueError, match="nothing was swapped"):
            sinks.verify_counts([{"table_name": "t", **bad}], {"t": 3})


def test_findings_survive_without_a_top_city(spark):
    from venuescope.operators import report, scoring

    clean = transform(raw_venues(spark, SF_SMALL), TEST_BINDING)
    p = TEST_BINDING.replace(min_city_venues=10**9)
    risk = spark.createDataFrame([(3,)], "operational_risk_flags long")
    got = [r.finding_no for r in report.key_findings(clean, scoring.city_opportunity(clean, p), risk).collect()]
    assert got == [2, 3, 4, 5]
    assert len(report.key_findings(clean.limit(0), scoring.city_opportunity(clean.limit(0), p), risk).collect()) <= 2
