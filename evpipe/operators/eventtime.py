"""Event time: running maximum, out-of-order and late flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evpipe.functions.time import ts_or_ingest
from evpipe.operators.prefix import running_max
from evpipe.operators.validate import is_valid
from evpipe.schema import DEFAULT_LATENESS_SEC, check_profile


def event_ts_ms(profile: str) -> Column:
    """The time an arrival contributes to the running maximum, NULL when it does not count.

    stream: every record counts, those without a usable time with their ingest time.
    local: only valid records count.
    """
    if profile == "stream":
        return ts_or_ingest(F.col("event_ms"), F.col("processed_ms"))
    return F.when(is_valid(), F.col("event_ms"))


def running_max_event_time(events: DataFrame, profile: str = "stream") -> DataFrame:
    """Add `max_event_ms` over all arrivals so far: with this row (local), without it (stream)."""
    check_profile(profile)
    timed = events.withColumn("_ts", event_ts_ms(profile))
    found = running_max(timed, "arrival_seq", "_ts", "max_event_ms", inclusive=profile == "local")
    return found.drop("_ts")


def flag_out_of_order() -> Column:
    return F.coalesce(F.col("event_ms") < F.col("max_event_ms"), F.lit(False))


def is_late(profile: str, lateness_sec: int = DEFAULT_LATENESS_SEC) -> Column:
    """Late test on `max_event_ms`.

    local: behind the running maximum by more than the allowed lateness. stream: the watermark
    trails the earlier arrivals by the lateness and 1 ms, and the test allows the lateness once
    more.
    """
    allowed = lateness_sec * 1000
    if check_profile(profile) == "local":
        late = F.col("event_ms") < F.col("max_event_ms") - allowed
    else:
        late = (F.col("event_ms") > 0) & (
            F.col("event_ms") + allowed < F.col("max_event_ms") - allowed - 1
        )
    return F.coalesce(late, F.lit(False))


def with_event_time(
    events: DataFrame, lateness_sec: int = DEFAULT_LATENESS_SEC, column: str = "event_ts"
) -> DataFrame:
    """Streaming form: event timestamp with ingest-time fallback, and a watermark on it."""
    ts = F.timestamp_millis(ts_or_ingest(F.col("event_ms"), F.col("processed_ms")))
    return events.withColumn(column, ts).withWatermark(column, f"{lateness_sec} seconds")
