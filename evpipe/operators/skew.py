"""Helpers that keep one very frequent key from ending up in a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evpipe.plans.staging import stage

# A key with at least HOT_ROWS rows is hot; the cold histories of patients are folded in one row
# each, so their bound is tighter.
HOT_ROWS = 1_000_000
HOT_PATIENT_ROWS = 100_000
# Tables of hot keys are broadcast up to this size, measured on all their rows as JSON. Larger ones
# are joined by key, where Spark splits the partitions that hot keys fill.
BROADCAST_BYTES = 64 << 20
SALTS = 1024

# Leads the join keys of records that look up nothing: a noncharacter, so no patient is named so.
NOBODY = "\ufdd0"


def hot_keys(counts: DataFrame, n_rows: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """The hot rows of a per-key count table, however many they are."""
    return counts.filter(F.col(n_rows) >= min_rows)


def fits_broadcast(table: DataFrame) -> bool:
    """Whether a stored table is at most BROADCAST_BYTES large."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))) + 16)
    return (table.agg(size).first()[0] or 0) <= BROADCAST_BYTES


def by_size(table: DataFrame) -> DataFrame:
    """`table` as one side of a join: broadcast if it fits, else by a sort of both sides."""
    return F.broadcast(table) if fits_broadcast(table) else table.hint("merge")


def key_or_nobody(key: Column, spread: Column) -> Column:
    """The join key, in place of null one of SALTS keys that meet nothing.

    Null keys would send all their rows to one task.
    """
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("string")
    return F.coalesce(key, F.concat(F.lit(NOBODY), salt))


def find_hot_patients(events: DataFrame, min_rows: int = HOT_PATIENT_ROWS) -> DataFrame | None:
    """Ids of the hot patients as a staged table, None when there are none.

    One narrow counting pass; whether it finds any decides which plan is built.
    """
    counts = events.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"))
    known = counts.filter(F.col("patient_id").isNotNull())
    hot = stage(hot_keys(known, "n", min_rows).select("patient_id"), "hot")
    return None if hot.isEmpty() else hot


def mark_hot(events: DataFrame, hot_patients: DataFrame, out: str) -> DataFrame:
    """Add the boolean column `out`: whether `hot_patients` lists the patient."""
    marks = hot_patients.select(F.col("patient_id").alias("_hot_id"), F.lit(True).alias("_mark"))
    key = key_or_nobody(F.col("patient_id"), F.col("arrival_seq"))
    marked = events.join(by_size(marks), key == F.col("_hot_id"), "left")
    return marked.withColumn(out, F.coalesce("_mark", F.lit(False))).drop("_mark", "_hot_id")


def left_join_hot(
    left: DataFrame, right: DataFrame, key: str, hot: DataFrame, spread: Column
) -> DataFrame:
    """`left` left-outer-join `right` (one row per key) when some keys fill much of `left`.

    `hot` holds the rows of `right` for the hot keys. If they fit, they are broadcast, and the left
    rows they serve are dealt over SALTS partitions by `spread` instead of meeting in one; all
    others are joined by key. If not, all are joined by key: a row of `right` serves any part of the
    left rows of its key, so Spark splits a partition that a hot key fills.
    """
    values = [c for c in right.columns if c != key]
    if not fits_broadcast(hot):
        found = left.join(right.hint("merge"), key, "left")
        return found.select(*left.columns, *values)
    marked = left.join(
        F.broadcast(hot.select(key, F.struct(*values).alias("_hot"))), key, "left"
    )
    salt = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(
        F.lit(1) + F.pmod(F.xxhash64(spread), F.lit(SALTS))
    )
    # Always 0, but not a literal: a literal would drop out of the join keys.
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    cold = right.select(key, zero.alias("_salt"), F.struct(*values).alias("_cold"))
    found = marked.withColumn("_salt", salt.cast("long")).join(cold, [key, "_salt"], "left")
    pick = [F.coalesce(f"_hot.{c}", f"_cold.{c}").alias(c) for c in values]
    return found.select(*left.columns, *pick)
