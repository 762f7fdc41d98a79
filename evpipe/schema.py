"""Names, fixed values and column layouts shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

PROFILES = ("stream", "local")

# ---------------------------------------------------------------------------
# Record contract and rule limits. Results depend on them.
# ---------------------------------------------------------------------------
SCHEMA_VERSION = "ehr.v1"
EVENT_TYPES = ("vital", "lab", "medication", "admission")
REQUIRED_FIELDS = (
    "event_id",
    "event_time",
    "event_type",
    "patient_id",
    "payload",
    "schema_version",
    "source",
)
PHI_TEXT_NAMES = ("patient_name", "ssn", "address")
PHI_TOP_LEVEL_KEYS = ("patient_name", "ssn", "address", "phone", "email")

VITAL_NAMES = ("heart_rate", "systolic_bp", "diastolic_bp", "temperature_c", "spo2")
LAB_TESTS = ("wbc", "lactate", "creatinine")

# Inclusive (low, high) limits per signal.
STREAM_VITAL_RANGES = {"heart_rate": (20, 250), "temperature_c": (25, 45), "spo2": (50, 100)}
STREAM_LAB_RANGE = (0, 80)
LOCAL_VITAL_RANGES = {
    "heart_rate": (20, 250),
    "systolic_bp": (40, 260),
    "diastolic_bp": (20, 160),
    "temperature_c": (25, 45),
    "spo2": (50, 100),
}
LOCAL_LAB_RANGES = {"wbc": (0, 80), "lactate": (0, 20), "creatinine": (0, 20)}
ACUITY_RANGE = (1, 5)

# Alert rule.
ALERT_TYPE = "possible_sepsis"
ALERT_RULE_TEXT = "HR >= 110 and temp >= 38 and (WBC >= 12 or lactate >= 2.2)"
ALERT_LIMITS = {"heart_rate": 110.0, "temperature_c": 38.0, "wbc": 12.0, "lactate": 2.2}
ALERT_COOLDOWN_MS = 600_000
RULE_SIGNALS = ("heart_rate", "temperature_c", "wbc", "lactate")
ALL_SIGNALS = VITAL_NAMES + LAB_TESTS

# Lookup marker stored when the patient dimension cannot be read.
LOOKUP_FAILED_JSON = '{"redis_lookup":"failed"}'

# Keys that the run summary counts, in report order.
SUMMARY_EVENT_TYPES = ("admission", "lab", "medication", "vital")
SUMMARY_REASONS = (
    "late_event",
    "duplicate_event_id",
    "bad_event_time",
    "contains_direct_phi",
    "missing_patient_id",
    "unknown_event_type",
    "vital_out_of_range",
    "lab_out_of_range",
    "missing_department",
    "missing_medication",
    "bad_medication_dose",
)

# Columns of an experiment row, and the short selection used in reports.
EXPERIMENT_COLUMNS = (
    "run",
    "events_sent",
    "patients",
    "rate_limit",
    "producer_events_per_sec",
    "valid",
    "quarantine",
    "alerts",
    "accepted_percent",
    "quarantine_percent",
    "avg_latency_ms",
    "p50_latency_ms",
    "p95_latency_ms",
    "max_latency_ms",
    "top_quarantine_reason",
    "event_mix",
)
EXPERIMENT_REPORT_COLUMNS = (
    "run",
    "events_sent",
    "patients",
    "rate_limit",
    "producer_events_per_sec",
    "valid",
    "quarantine",
    "accepted_percent",
    "avg_latency_ms",
    "p95_latency_ms",
    "top_quarantine_reason",
)
# ---------------------------------------------------------------------------

DEFAULT_LATENESS_SEC = 30
THROUGHPUT_BUCKET = 1000

RAW_SCHEMA = T.StructType(
    [
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("raw", T.StringType()),
        T.StructField("processed_ms", T.LongType()),
    ]
)

PRODUCER_SCHEMA = T.StructType(
    [
        T.StructField("sent", T.LongType()),
        T.StructField("elapsed_seconds", T.DoubleType()),
        T.StructField("throughput_events_per_sec", T.DoubleType()),
        T.StructField("patients", T.LongType()),
        T.StructField("rate_limit_events_per_sec", T.DoubleType()),
        T.StructField("allowed_lateness_sec", T.LongType()),
        T.StructField("invalid_rate", T.DoubleType()),
        T.StructField("duplicate_rate", T.DoubleType()),
        T.StructField("out_of_order_rate", T.DoubleType()),
        T.StructField("late_rate", T.DoubleType()),
        T.StructField("seed", T.LongType()),
    ]
)

TOTALS_SCHEMA = T.StructType(
    [
        T.StructField("valid", T.LongType()),
        T.StructField("quarantine", T.LongType()),
        T.StructField("alerts", T.LongType()),
        T.StructField("processed", T.LongType()),
        T.StructField("accepted_percent", T.DoubleType()),
    ]
)

LATENCY_SCHEMA = T.StructType(
    [
        T.StructField("avg_ms", T.DoubleType()),
        T.StructField("p50_ms", T.DoubleType()),
        T.StructField("p95_ms", T.DoubleType()),
        T.StructField("max_ms", T.DoubleType()),
    ]
)

COUNT_MAP = T.MapType(T.StringType(), T.LongType())

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("generated_at_epoch_ms", T.LongType()),
        T.StructField("totals", TOTALS_SCHEMA),
        T.StructField("event_counts", COUNT_MAP),
        T.StructField("quarantine_reasons", COUNT_MAP),
        T.StructField("latency_ms", LATENCY_SCHEMA),
        T.StructField("producer", PRODUCER_SCHEMA),
    ]
)

EXPERIMENT_SCHEMA = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("events_sent", T.LongType()),
        T.StructField("patients", T.LongType()),
        T.StructField("rate_limit", T.DoubleType()),
        T.StructField("producer_events_per_sec", T.DoubleType()),
        T.StructField("valid", T.LongType()),
        T.StructField("quarantine", T.LongType()),
        T.StructField("alerts", T.LongType()),
        T.StructField("accepted_percent", T.DoubleType()),
        T.StructField("quarantine_percent", T.DoubleType()),
        T.StructField("avg_latency_ms", T.DoubleType()),
        T.StructField("p50_latency_ms", T.DoubleType()),
        T.StructField("p95_latency_ms", T.DoubleType()),
        T.StructField("max_latency_ms", T.DoubleType()),
        T.StructField("top_quarantine_reason", T.StringType()),
        T.StructField("event_mix", T.StringType()),
    ]
)


def check_profile(profile: str) -> str:
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}, got {profile!r}")
    return profile
