"""Registered queries against their SQL. EVPIPE_ORACLE=all runs every one of them."""

import os

import pytest
from oracle_check import compare

import __spark_entry__ as driver

QUICK = [
    "read_raw_batch_text", "parse_events", "read_patient_dim", "payload_json", "record_key",
    "base_record", "validate_stream", "validate_local", "is_late_stream", "route_stream",
    "route_local", "patient_signal_state_local", "alerts_with_cooldown_stream", "mark_duplicates",
    "enrich", "count_for_keys", "run_totals", "latency_summary", "throughput_buckets",
    "upsert_quarantine", "insert_if_absent", "top_reason", "latest_alerts_by_type",
]
ORACLES = driver.oracle_sql()
NAMES = list(ORACLES) if os.environ.get("EVPIPE_ORACLE") == "all" else QUICK


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(driver.queries()[name](spark, sf_dir), sf_dir, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(driver.queries())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) > 5


def test_golden_counts(spark):
    """Outcome counts of a sequential run over the 10,000-event table."""
    from evpipe.plans import catalog

    got = {
        r["reason"]: r["n"]
        for r in catalog.QUERIES["count_by_reason"](spark, "/root/testdata/sf0.01").collect()
    }
    assert got == {
        "late_event": 225, "duplicate_event_id": 181, "missing_patient_id": 104,
        "unknown_event_type": 98, "bad_event_time": 97, "contains_direct_phi": 91,
        "bad_medication_dose": 29, "missing_department": 28, "missing_medication": 26,
        "lab_out_of_range": 11, "vital_out_of_range": 7,
    }


def test_every_code_occurs_on_the_edge_records(spark, sf_dir):
    """All rules but the one for broken stored payloads, which no raw record can have."""
    from evpipe.plans import edges

    for profile, n_codes in (("stream", 17), ("local", 17)):
        rows = edges._edges(spark, sf_dir, profile).collect()
        codes = {c for r in rows for c in r["errors"].split("|") if c}
        assert len(codes) >= n_codes, sorted(codes)
