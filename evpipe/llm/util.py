"""Staged tables and small checks that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evpipe.plans.staging import new_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write `df` to the cluster's shared folder, or to `path`, and return the written table.

    Lineage ends there, so a lost executor repeats nothing before it. The shuffle files behind it
    are of no further use and are dropped with the write.
    """
    spark = df.sparkSession
    path = path or new_path(spark, label)
    with setting(spark, _CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand fewer rows at once to Python: texts are long, and a batch is held as a whole.

    It holds for the session, as results are lazy. Rows that are longer still, such as blocks of
    ids, are limited by Spark's own bound on the bytes of a batch.
    """
    if int(spark.conf.get(_BATCH)) > rows:
        spark.conf.set(_BATCH, str(rows))


def one_row(df: DataFrame) -> dict:
    """The single row of an aggregate as a dictionary."""
    return df.first().asDict()


def bucket_of(id_column: str = "doc_id") -> Column:
    """Unsigned crc32 of an id written as text, by which contracts hold rows out."""
    return F.crc32(F.col(id_column).cast("string").cast("binary"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unused_name(df: DataFrame, name: str) -> str:
    """`name`, or that with underscores behind, such that `df` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def add_columns(
    df: DataFrame, column: str, fields: list[tuple[str, str]], make: Callable[[pa.Array], list]
) -> DataFrame:
    """`df` with the columns that `make` works out from `column`, batch by batch.

    A column of `df` that has one of the new names is replaced. All others pass through as Arrow
    buffers.
    """
    spark = df.sparkSession
    small_batches(spark)
    names = [name for name, _ in fields]
    kept = [c for c in df.columns if c not in names]
    new = T._parse_datatype_string(", ".join(f"`{n}` {kind}" for n, kind in fields))
    schema = T.StructType([*df.select(*(f"`{c}`" for c in kept)).schema.fields, *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(batch.column(column))
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[*kept, *names])

    needed = df if column not in names else df.select("*")
    return needed.mapInArrow(run, schema)


def ragged(values, offsets, kind=None) -> pa.Array:
    """A list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
