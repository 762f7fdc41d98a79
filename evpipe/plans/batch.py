"""The batch run: raw records to routed events, alerts and tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evpipe.operators.alerts import alerts_with_cooldown
from evpipe.operators.enrich import enrich, patient_metadata
from evpipe.operators.parse import parse_events
from evpipe.operators.route import route, route_local
from evpipe.operators.skew import find_hot_patients
from evpipe.operators.validate import validate
from evpipe.plans.staging import stage
from evpipe.schema import ALERT_COOLDOWN_MS, DEFAULT_LATENESS_SEC
from evpipe.sources.readers import spread

# What routing, alerts and counts need; record and payload text stay out unless asked for.
CORE_COLUMNS = (
    "arrival_seq",
    "processed_ms",
    "raw_hash",
    "record_key",
    "event_id",
    "patient_id",
    "event_type",
    "event_ms",
    "emit_ms",
    "signal",
    "signal_value",
    "errors",
)
TEXT_COLUMNS = ("raw", "event_time", "source", "payload_json")


def checked_events(
    raw: DataFrame, profile: str = "stream", extra: Sequence[str] = ()
) -> DataFrame:
    """Parse and validate raw records once, into a staged table."""
    events = validate(parse_events(spread(raw), profile), profile)
    return stage(events.select(*CORE_COLUMNS, *extra), f"checked-{profile}")


@dataclass
class BatchRun:
    """Outputs of one batch run; all but the counts are lazy."""

    events: DataFrame
    accepted: DataFrame
    quarantined: DataFrame
    alerts: DataFrame


def run_batch(
    raw: DataFrame,
    dim: DataFrame | None,
    profile: str = "stream",
    lateness_sec: int = DEFAULT_LATENESS_SEC,
    cooldown_ms: int = ALERT_COOLDOWN_MS,
    seen: DataFrame | None = None,
) -> BatchRun:
    """Route all records, enrich the accepted ones and raise alerts.

    Routed events are staged as well, because the tables, the alerts and the counts all read them.
    `seen` holds the `event_id`s that earlier local runs accepted.
    """
    checked = checked_events(raw, profile, TEXT_COLUMNS)
    hot = find_hot_patients(checked)
    if seen is None:
        routed = route(checked, profile, lateness_sec)
    else:
        routed = route_local(checked, lateness_sec, seen=seen)
    metadata = None if dim is None else patient_metadata(dim)
    enriched = enrich(routed, metadata, F.col("accepted"), hot)
    events = stage(enriched, f"routed-{profile}")
    accepted = events.filter("accepted")
    return BatchRun(
        events=events,
        accepted=accepted,
        quarantined=events.filter("not accepted"),
        alerts=alerts_with_cooldown(accepted, cooldown_ms, hot),
    )
