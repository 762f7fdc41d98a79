"""Duplicate detection and the outcome of every arrival, in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evpipe.operators.eventtime import flag_out_of_order, is_late, running_max_event_time
from evpipe.operators.skew import HOT_ROWS, hot_keys, left_join_hot
from evpipe.operators.validate import first_reason, is_valid, joined_reason
from evpipe.plans.staging import stage
from evpipe.schema import DEFAULT_LATENESS_SEC, check_profile

DUPLICATE = "duplicate_event_id"
LATE = "late_event"


def mark_duplicates(
    events: DataFrame,
    key: str = "record_key",
    ok: str = "ok",
    hot_rows: int = HOT_ROWS,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Add `duplicate`: an earlier arrival with the same key was accepted.

    Only `ok` arrivals can be accepted, and the first of them is; so one minimum per key decides.
    Keys that occur once need no lookup and do not enter the join. `events` is read twice, so it
    should be a stored table. `seen` holds keys that were accepted before these events arrived; it
    may be large, only those that occur among `events` are looked at.
    `arrival_seq` must be unique.
    """
    seq = F.col("arrival_seq")
    per_key = events.groupBy(key).agg(
        F.min(F.when(F.col(ok), seq)).alias("accepted_seq"), F.count(F.lit(1)).alias("n_rows")
    )
    decided = (F.col("n_rows") > 1) & F.col("accepted_seq").isNotNull()
    if seen is not None:
        # The keys of the events are the small side, which Spark broadcasts when it may.
        asked = seen.select(key).join(per_key.select(key), key, "left_semi")
        before = asked.distinct().withColumn("_seen", F.lit(True))
        first = F.when(F.col("_seen"), F.lit(-(1 << 62)).cast("bigint")).otherwise(F.col("accepted_seq"))
        per_key = per_key.join(before, key, "left").withColumn("accepted_seq", first)
        decided = decided | F.col("_seen").isNotNull()
    needed = per_key.filter(decided | (F.col("n_rows") >= hot_rows))
    # Written out, since the hot keys and the join both read it; with its size known, Spark can
    # also tell whether the join fits a broadcast.
    stored = stage(needed.select(key, "accepted_seq", "n_rows"), "repeated")
    hot = hot_keys(stored, "n_rows", hot_rows)
    repeated = stored.filter(F.col("accepted_seq").isNotNull())
    if hot.isEmpty():
        found = events.join(repeated, key, "left").select(*events.columns, "accepted_seq")
    else:
        found = left_join_hot(events, repeated, key, hot, seq).drop("n_rows")
    after = F.coalesce(seq > F.col("accepted_seq"), F.lit(False))
    return found.withColumn("duplicate", after).drop("accepted_seq")


def _flagged(events: DataFrame, profile: str, lateness_sec: int, hot_rows: int, **before):
    if before.get("fixed"):
        # Within a micro-batch the watermark stands still: only earlier ones have moved it.
        timed = events.withColumn("max_event_ms", F.lit(None).cast("bigint"))
    else:
        timed = running_max_event_time(events, profile)
    if before.get("max_event_ms") is not None:
        carried = F.lit(before["max_event_ms"]).cast("bigint")
        timed = timed.withColumn("max_event_ms", F.greatest("max_event_ms", carried))
    flagged = timed.withColumns(
        {
            "valid": is_valid(),
            "out_of_order": flag_out_of_order(),
            "late": is_late(profile, lateness_sec),
        }
    ).withColumn("ok", F.col("valid") & ~F.col("late"))
    if profile == "stream":
        return mark_duplicates(flagged, "record_key", "ok", hot_rows, before.get("seen"))
    # The local profile compares the ids of valid events as they are; a null id is one too.
    local_id = F.coalesce("event_id", F.lit("None"))
    keyed = flagged.withColumn("_id", F.when(F.col("valid"), local_id).otherwise(F.col("raw_hash")))
    seen = before.get("seen")
    known = None if seen is None else seen.select(F.col("event_id").alias("_id"))
    return mark_duplicates(keyed, "_id", "ok", hot_rows, known).drop("_id")


def route_stream(
    events: DataFrame,
    lateness_sec: int = DEFAULT_LATENESS_SEC,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Final `errors` and `reason` of validated events, all error codes kept.

    A duplicate is reported next to other errors, a late event only if nothing else is wrong.
    """
    return _stream_outcome(_flagged(events, "stream", lateness_sec, hot_rows))


def route_micro_batch(
    events: DataFrame,
    lateness_sec: int = DEFAULT_LATENESS_SEC,
    max_event_ms: int | None = None,
    seen: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The stream profile for one micro-batch, where earlier ones left off.

    `max_event_ms` is the largest event time (or ingest time, where a record has none) of all earlier
    micro-batches; lateness compares with the watermark that follows from it, which does not move
    within a micro-batch. `seen` holds `record_key`s that earlier ones accepted.
    """
    before = {"max_event_ms": max_event_ms, "seen": seen, "fixed": True}
    return _stream_outcome(_flagged(events, "stream", lateness_sec, hot_rows, **before))


def _stream_outcome(flagged: DataFrame) -> DataFrame:
    late_only = F.col("valid") & ~F.col("duplicate") & F.col("late")
    extra = (
        F.when(F.col("duplicate"), F.array(F.lit(DUPLICATE)))
        .when(late_only, F.array(F.lit(LATE)))
        .otherwise(F.array().cast("array<string>"))
    )
    routed = flagged.withColumn("errors", F.concat("errors", extra))
    return _outcome(routed, first_reason(F.col("errors")))


def route_local(
    events: DataFrame,
    lateness_sec: int = DEFAULT_LATENESS_SEC,
    hot_rows: int = HOT_ROWS,
    **before,
) -> DataFrame:
    """Final `errors` and `reason`: invalid, else duplicate, else late, else accepted.

    `max_event_ms` and `seen` (a table of accepted `event_id`s) carry on an earlier run.
    """
    flagged = _flagged(events, "local", lateness_sec, hot_rows, **before)
    errors = (
        F.when(~F.col("valid"), F.col("errors"))
        .when(F.col("duplicate"), F.array(F.lit(DUPLICATE)))
        .when(F.col("late"), F.array(F.lit(LATE)))
        .otherwise(F.array().cast("array<string>"))
    )
    return _outcome(flagged.withColumn("errors", errors), joined_reason(F.col("errors")))


def _outcome(routed: DataFrame, reason) -> DataFrame:
    accepted = F.size("errors") == 0
    return routed.withColumns(
        {"accepted": accepted, "reason": F.when(accepted, F.lit("accepted")).otherwise(reason)}
    ).drop("valid", "ok", "duplicate", "late")


def route(
    events: DataFrame,
    profile: str = "stream",
    lateness_sec: int = DEFAULT_LATENESS_SEC,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    step = route_stream if check_profile(profile) == "stream" else route_local
    return step(events, lateness_sec, hot_rows)
