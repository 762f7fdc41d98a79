"""Timestamps as epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRICT = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d{1,9})?[Zz]$"
_LENIENT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def strict_millis(text: Column) -> Column:
    """ISO instant ending in Z as epoch ms; -1 for anything else."""
    ts = F.when(text.rlike(_STRICT), F.try_to_timestamp(F.translate(text, "tz", "TZ")))
    return F.coalesce(F.unix_millis(ts), F.lit(-1).cast("long"))


# Date (calendar or week), any one separator, time and offset; with or without dashes and colons.
_ISO = (
    r"^(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})|(\d{4})-?W(\d{2})(?:-?([1-7]))?)"
    r"(?:[\s\S](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
    r"(?:(Z)|([+-])(\d{2})(?::?(\d{2})(?::?(\d{2})(?:\.\d+)?)?)?)?)?$"
)


def lenient_millis(text: Column) -> Column:
    """ISO date or date-time, offset optional (UTC when absent), as epoch ms; NULL when not one."""
    dotted = F.translate(text, ",", ".")
    common = F.when(text.rlike(_LENIENT), F.try_to_timestamp(dotted))
    # The rarer forms are put together from their parts; only text of no common form pays for it.
    return F.when(text.rlike(_LENIENT), F.unix_millis(common)).when(
        text.rlike(_ISO), _millis_of_parts(text)
    )


def _millis_of_parts(text: Column) -> Column:
    part = lambda i: F.nullif(F.regexp_extract(text, _ISO, i), F.lit(""))
    whole = lambda i: F.coalesce(part(i).cast("int"), F.lit(0))
    calendar = F.concat_ws(
        "-", *(F.coalesce(part(i), part(i + 3)) for i in (1, 2, 3))
    ).try_cast("date")
    # Week 1 holds January 4th; weeks begin on Monday.
    fourth = F.concat(part(7), F.lit("-01-04")).try_cast("date")
    day = F.coalesce(part(9).cast("int"), F.lit(1))
    monday = F.date_sub(fourth, F.weekday(fourth))
    of_week = F.date_add(monday, (whole(8) - 1) * 7 + day - 1)
    # The Thursday of a week tells its year, which rules out week 0 and a week 53 that isn't there.
    thursday = F.date_add(monday, (whole(8) - 1) * 7 + 3)
    of_week = F.when((whole(8) > 0) & (F.year(thursday) == part(7).cast("int")), of_week)
    date = F.coalesce(F.when(part(7).isNull(), calendar), of_week)
    hour, minute, second = whole(10), whole(11), whole(12)
    sane = (hour < 24) & (minute < 60) & (second < 60) & (whole(16) < 24) & (whole(17) < 60)
    sane = sane & (whole(18) < 60)
    fraction = F.rpad(F.coalesce(F.substring(part(13), 1, 3), F.lit("0")), 3, "0").cast("int")
    behind = whole(16) * 3600 + whole(17) * 60 + whole(18)
    offset = F.when(part(15) == "-", -behind).otherwise(behind)
    seconds = F.unix_date(date).cast("long") * 86400 + hour * 3600 + minute * 60 + second - offset
    return F.when(sane, seconds * 1000 + fraction)


def ts_or_ingest(event_ms: Column, ingest_ms: Column) -> Column:
    """Event time, or the ingest time when the event has no usable one."""
    return F.when(event_ms > 0, event_ms).otherwise(ingest_ms)


def ingest_latency(processed_ms: Column, emit_ms: Column) -> Column:
    return F.when(emit_ms > 0, (processed_ms - emit_ms).cast("double")).otherwise(F.lit(0.0))


def iso_z(epoch_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(epoch_ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
