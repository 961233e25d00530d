"""The driver contract: entry, the catalogue and its DuckDB oracle."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from venuescope.plans.catalog import CATALOG
from venuescope.sources.bindings import TABLES

from conftest import SF_SMALL

ROWS_ONLY = {"anom_isolation_forest", "anom_summary", "operational_risk_rows", "run_report"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "opportunity_score" in df.columns


def test_catalogue_and_oracle_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(CATALOG) - set(o) == ROWS_ONLY


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].astype(object).itertuples(index=False):
        out.append(tuple(None if (isinstance(x, float) and math.isnan(x)) or x is None else x for x in rec))
    return cols, sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(CATALOG)))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(E.oracle_sql()[name]).fetchdf()
    assert canon(got) == canon(want)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() >= 0


def test_raw_nulls_are_those_before_cleaning(spark):
    raw = {r.column_name: r.null_count for r in E.queries()["profile_raw_nulls"](spark, SF_SMALL).collect()}
    clean = {r.column_name: r.null_count for r in E.queries()["profile_nulls"](spark, SF_SMALL).collect()}
    assert "rating_count" in raw and "votes" not in raw
    assert raw["rating"] < clean["rating"]                 # rejected ratings are not missing ones
