"""Counts of the stand-in feed at sf0.01 (FIXTURES.md section 2)."""

import os

import pytest
from pyspark.sql import functions as F

from skyledger.plans.queries import AGENCY, FLIGHT, feed_lines, feed_records
from skyledger.operators import agency_winners, agency_winners_latest, parse_records, speed_stats

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def test_counts(spark):
    parsed = parse_records(feed_lines(spark, SF))
    assert parsed.records.count() == 9798
    assert parsed.rejects.count() == 202
    winners = agency_winners(feed_records(spark, SF))
    assert winners.count() == 1667
    assert winners.filter(F.col("agency_most_flight_segs").contains(",")).count() == 691
    assert agency_winners_latest(winners).count() == 30
    records = feed_records(spark, SF)
    assert speed_stats(records, AGENCY, label=FLIGHT).count() == 1219
    assert speed_stats(records, AGENCY, flight=FLIGHT).count() == 191
