"""Every registered query equals its DuckDB oracle SQL (whole tables)."""

import os

import pytest

import __spark_entry__ as E
from skyledger.plans.queries import QUERIES
from tools.oracle_check import compare

SF = os.environ.get("SKYLEDGER_TEST_SF", "/root/testdata/sf0.01")


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_parity(spark):
    report = compare(spark, SF, list(QUERIES))
    bad = {k: v for k, v in report.items() if not (v.get("names_match") and v.get("values_match"))}
    assert not bad, bad


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["batch_no", "agency_most_flight_segs", "num_of_flight_segs"]
    assert df.count() > 0
