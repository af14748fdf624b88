import os

import pytest

import __spark_entry__ as entry
from registry import oracle, queries
from registry.check import compare, duck

SF = "/root/testdata/sf0.001"
QUICK = [
    "load_districts", "haversine_pairs", "event_strength", "severity_counts",
    "event_district_impact", "event_priority_rank", "top_priority_districts", "live_risk",
    "json_decode_events", "normalized_events", "quarantined_events", "event_dedup",
    "normalize_text", "facility_names", "facility_name_dedup", "prepared_facilities",
    "facility_pool", "facility_rankings", "logistics_recommendations", "risk_level_thresholds",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_every_query_has_its_sql():
    assert set(queries.QUERIES) == set(oracle.all_sql())
    assert set(queries.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_query_takes_part_of_its_tables():
    for text in oracle.all_sql().values():
        assert "LIMIT" not in text.upper() and "SAMPLE" not in text.upper()


@pytest.mark.parametrize("name", QUICK)
def test_query_against_sql(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck(SF).execute(entry.oracle_sql()[name]).df()
    assert compare(got, want) == "" and len(want) > 0
