"""Listings are joined and parsed once by the entries that read them several times."""

import pytest

from venuescope.operators.transform import transform
from venuescope.plans import catalog
from venuescope.sources.bindings import raw_venues
from tests.conftest import SF_SMALL

SEVERAL = ("run_report", "operational_risk_rows", "run_report_statistical", "anom_summary", "key_findings",
           "anom_summary_statistical", "operational_risk_venues", "anom_isolation_forest", "e5_box_top_cities",
           "anom_business_risk", "e7_sample")


@pytest.mark.parametrize("name", SEVERAL)
def test_entry_builds_the_listings_once(spark, monkeypatch, name):
    built = []
    monkeypatch.setattr(catalog, "raw_venues", lambda s, d: built.append(d) or raw_venues(s, d))
    df = catalog.CATALOG[name](spark, SF_SMALL)
    assert len(built) == 1
    # what is left to run reads staged tables alone
    assert "lineitem" not in df._jdf.queryExecution().toString()


def test_cleaning_builds_a_text_once(spark):
    plan = transform(raw_venues(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_number") == 1
