"""Sources of raw records, the patient dimension and run summaries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evpipe.operators.enrich import patient_metadata
from evpipe.operators.prefix import running_max
from evpipe.schema import EXPERIMENT_SCHEMA, PRODUCER_SCHEMA, RAW_SCHEMA, SUMMARY_SCHEMA


def _now_ms():
    return F.unix_millis(F.current_timestamp())


# What a stored topic keeps of a message.
TOPIC_SCHEMA = "value binary, partition int, offset bigint, timestamp timestamp"


def topic_records(messages: DataFrame) -> DataFrame:
    """(arrival_seq, raw, processed_ms, partition, offset) of the messages of a topic.

    The sequence number is the offset with the partition behind it: unique over all partitions (up
    to 2^16 of them) and rising within each. It names a message; it does not order messages of
    different partitions, whose offsets don't compare. `by_broker_time` does.
    """
    place = F.shiftleft("offset", 16).bitwiseOR(F.col("partition").cast("bigint"))
    return messages.select(
        place.alias("arrival_seq"),
        F.col("value").cast("string").alias("raw"),
        F.unix_millis("timestamp").alias("processed_ms"),
        "partition",
        "offset",
    )


def by_broker_time(records: DataFrame) -> DataFrame:
    """Topic records with `broker_ms`, by which partitions are merged: the largest broker time of the
    partition up to the record. (broker_ms, partition, offset) keeps the order of each partition
    even where its clock went back."""
    return running_max(records, "offset", "processed_ms", "broker_ms", ["partition"])


def read_raw_stream(spark: SparkSession, fmt: str, options: dict[str, str]) -> DataFrame:
    """Raw records as a stream of (arrival_seq, raw, processed_ms).

    `kafka` starts at the earliest offset, `topic_files` are Parquet files of stored messages
    (TOPIC_SCHEMA); both have `partition` and `offset` too. `parquet` files hold the three columns;
    `text` files hold one record per line; lines that come in one micro-batch have one number in
    common, and `unnumbered` says so.
    """
    if fmt == "topic_files":
        files = spark.readStream.format("parquet").schema(TOPIC_SCHEMA).options(**options)
        return topic_records(files.load())
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        return topic_records(reader.option("startingOffsets", "earliest").options(**options).load())
    if fmt == "parquet":
        return reader.schema(RAW_SCHEMA).options(**options).load()
    lines = reader.options(**options).load()
    return lines.select(
        _now_ms().alias("arrival_seq"), F.col("value").alias("raw"), _now_ms().alias("processed_ms"),
        F.lit(True).alias("unnumbered"),
    )


def read_raw_batch(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """Raw records of files as (arrival_seq, raw, processed_ms).

    `parquet` files bring these columns along. Text has no order of its own: the sequence numbers
    follow files and lines in the order in which Spark splits them.
    """
    if fmt == "parquet":
        return spark.read.schema(RAW_SCHEMA).parquet(path)
    lines = spark.read.format(fmt).load(path)
    return lines.select(
        F.monotonically_increasing_id().alias("arrival_seq"),
        F.col("value").alias("raw"),
        _now_ms().alias("processed_ms"),
    )


def number_arrivals(rows: DataFrame, *order: str) -> DataFrame:
    """`rows` with a unique `arrival_seq` that rises in the given order.

    A distributed sort deals the rows over tasks in ranges; a row's number is its range and its
    place there. Rows that are alike in `order` (say broker time, partition, offset) get numbers of
    their own in no particular order.
    """
    return rows.orderBy(*order).withColumn("arrival_seq", F.monotonically_increasing_id())


def spread(rows: DataFrame) -> DataFrame:
    """`rows` dealt over all cores when they come in fewer splits, as one small file does. Reading
    records is what costs, so that is worth sending their text once; a large input is left alone."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def read_patient_dim(spark: SparkSession, path: str) -> DataFrame:
    """Patient attributes as (patient_id, metadata map)."""
    return patient_metadata(spark.read.parquet(path))


def patients_or_none(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The patient table, None when there is none to read."""
    if path is None:
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def _read_json_or_none(spark: SparkSession, path: str, schema, many_lines: bool = True):
    try:
        return spark.read.schema(schema).option("multiLine", many_lines).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The producer's metrics document; no row when there is no file."""
    found = _read_json_or_none(spark, path, PRODUCER_SCHEMA)
    return spark.createDataFrame([], PRODUCER_SCHEMA) if found is None else found


def read_run_summaries(
    spark: SparkSession, folder: str, pattern: str = "*/summary.json"
) -> DataFrame:
    """All run summary documents under a folder, each named by the directory that holds it."""
    run = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    found = (
        spark.read.schema(SUMMARY_SCHEMA).option("multiLine", True).json(f"{folder}/{pattern}")
    )
    return found.select(F.url_decode(run).alias("run"), "*")


def load_experiments(spark: SparkSession, folder: str) -> DataFrame:
    """The stored comparison table when there is one, else built from the summaries."""
    from evpipe.operators.experiments import experiment_rows

    stored = _read_json_or_none(spark, f"{folder}/experiment_summary.json", EXPERIMENT_SCHEMA)
    return experiment_rows(read_run_summaries(spark, folder)) if stored is None else stored
