"""Text predicates and keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITESPACE = " \t\n\x0b\f\r"
# Five dash-separated hex groups, each at most a non-negative 64-bit number.
_UUID_GROUP = "0*[0-7]?[0-9a-fA-F]{1,15}"
UUID_PATTERN = f"^{_UUID_GROUP}(-{_UUID_GROUP}){{4}}$"


def is_blank(value: Column) -> Column:
    # Nearly all texts are settled by their first character, without trimming a copy.
    starts_blank = F.substring(value, 1, 1).isin("", *_WHITESPACE)
    blank = starts_blank & (F.btrim(value, F.lit(_WHITESPACE)) == "")
    return F.coalesce(blank, F.lit(True))


def is_uuid(value: Column) -> Column:
    return F.coalesce((F.length(value) <= 36) & value.rlike(UUID_PATTERN), F.lit(False))


def raw_hash(raw: Column) -> Column:
    """First 24 hex digits of SHA-256 of the record text."""
    return F.substring(F.sha2(raw.cast("binary"), 256), 1, 24)


def record_key(event_id: Column, hash_: Column) -> Column:
    return F.when(is_blank(event_id), hash_).otherwise(event_id)


def contains_any_quoted(raw: Column, names: Iterable[str]) -> Column:
    """True when any name occurs in double quotes anywhere in the text."""
    hit = F.lit(False)
    for name in names:
        hit = hit | F.contains(raw, F.lit(f'"{name}"'))
    return F.coalesce(hit, F.lit(False))


def valid_patient_id(value: Column) -> Column:
    return F.coalesce(value.startswith("P"), F.lit(False))


def preview(text: Column, n_chars: int = 220) -> Column:
    return F.substring(text, 1, n_chars)
