"""Keyed reads of the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def scan_latencies(events_by_id: DataFrame) -> DataFrame:
    """The latency column alone, without nulls."""
    return events_by_id.select("ingestion_latency_ms").filter(
        F.col("ingestion_latency_ms").isNotNull()
    )


def count_partition(table: DataFrame, key: str, value: str) -> DataFrame:
    return table.filter(F.col(key) == value).agg(F.count(F.lit(1)).alias("n"))


def get_event(events_by_id: DataFrame, event_id: str) -> DataFrame:
    return events_by_id.filter(F.col("event_id") == event_id)


def latest_n(df: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """First `n` rows per key; Spark keeps only `n` per key and task before the exchange."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def latest_alerts_by_patient(alerts: DataFrame, n: int) -> DataFrame:
    return latest_n(alerts, "patient_id", [F.desc("alert_time")], n)


def latest_alerts_by_type(alerts: DataFrame, n: int) -> DataFrame:
    return latest_n(alerts, "alert_type", [F.desc("alert_time"), F.asc("patient_id")], n)


def latest_quarantine_by_reason(quarantine: DataFrame, n: int) -> DataFrame:
    return latest_n(quarantine, "reason", [F.desc("observed_at"), F.asc("event_id")], n)


def events_of_type(events_by_type: DataFrame, event_type: str) -> DataFrame:
    return events_by_type.filter(F.col("event_type") == event_type).orderBy("event_id")
