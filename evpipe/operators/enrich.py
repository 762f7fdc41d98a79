"""Patient attributes for accepted records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evpipe.operators.skew import by_size, key_or_nobody, left_join_hot
from evpipe.plans.staging import stage
from evpipe.schema import LOOKUP_FAILED_JSON


def patient_metadata(dim: DataFrame) -> DataFrame:
    """`patient_id` and all other columns as a string map."""
    pairs = []
    for name in dim.columns:
        if name != "patient_id":
            pairs += [F.lit(name), F.col(name).cast("string")]
    return dim.select("patient_id", F.create_map(*pairs).alias("metadata"))


def enrich(
    events: DataFrame,
    dim: DataFrame | None,
    accepted: Column | None = None,
    hot_patients: DataFrame | None = None,
) -> DataFrame:
    """Add `patient_metadata` JSON: `{}` without a match and for records not accepted.

    `dim` has one row per patient (`patient_id`, `metadata`). It is not hinted: Spark broadcasts
    it when its size allows, otherwise it is a key join. For patients known to fill much of
    `events` the entries are broadcast, if they fit, and the rows spread. Without a dimension the
    failure marker is stored and the records still pass.
    """
    ok = F.lit(True) if accepted is None else accepted
    if dim is None:
        text = F.when(ok, F.lit(LOOKUP_FAILED_JSON)).otherwise(F.lit("{}"))
        return events.withColumn("patient_metadata", text)
    lookup = dim.select("patient_id", F.to_json("metadata").alias("_json"))
    # Records that are not accepted, and those without a patient, have nothing to look up. A null key
    # would send all of them to one task, so they get keys of their own that no patient has.
    asked = events.withColumn("_patient", F.col("patient_id"))
    key = key_or_nobody(F.when(ok, F.col("patient_id")), F.col("arrival_seq"))
    events = asked.withColumn("patient_id", key)
    if hot_patients is not None:
        # Written out, since its size decides how it is joined.
        hot = stage(lookup.join(by_size(hot_patients), "patient_id", "left_semi"), "hot-metadata")
        found = left_join_hot(events, lookup, "patient_id", hot, F.col("arrival_seq"))
    else:
        found = events.join(lookup, "patient_id", "left").select(*events.columns, "_json")
    found = found.withColumn("patient_id", F.col("_patient")).drop("_patient")
    return found.withColumn("patient_metadata", F.coalesce("_json", F.lit("{}"))).drop("_json")
