"""Exact order statistics without sorting everything in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A bucket is about 0.01 % wide. Values up to 10^18 in size fall into fewer than a million
# buckets, which bounds the table that is cumulated in one task.
_BUCKETS_PER_E = 10_000
# A range of values that holds more rows is cut into PIECES narrower ones, as often as needed.
NARROW_ROWS = 1_000_000
PIECES = 100_000


def _bucket(value: Column) -> Column:
    """Bucket number that never falls when the value rises."""
    return F.floor(F.log1p(F.abs(value)) * F.signum(value) * _BUCKETS_PER_E)


def _find_ranks(bucketed: DataFrame, wanted: Column) -> list[dict]:
    """Of each rank (`name`, `part`, `k` in `wanted`) the bucket it falls into: smallest and largest
    value `low` and `high`, `rows`, and `k`, the rank within the bucket.

    `bucketed` has `part`, `bucket` and `v`; buckets of a part are ordered like their values.
    """
    per_bucket = bucketed.groupBy("part", "bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    part = Window.partitionBy("part")
    cumulated = per_bucket.select(
        F.col("part").alias("own"), "rows", "low", "high",
        F.sum("rows").over(part).alias("n"),
        (F.sum("rows").over(part.orderBy("bucket")) - F.col("rows")).alias("below"),
    )
    inside = (F.col("k") >= F.col("below")) & (F.col("k") < F.col("below") + F.col("rows"))
    found = cumulated.select("*", F.inline(wanted)).filter((F.col("own") == F.col("part")) & inside)
    # One row a rank.
    rows = found.select("name", "low", "high", "rows", (F.col("k") - F.col("below")).alias("k"))
    return [r.asDict() for r in rows.collect()]


def _ranges(found: list[dict]) -> list[tuple[float, float]]:
    return sorted({(r["low"], r["high"]) for r in found})


def _in_range(values: DataFrame, ranges: list[tuple[float, float]]) -> DataFrame:
    """The values inside the ranges, which do not overlap, with the number of the range as `part`."""
    v, part = F.col("v"), F.lit(None).cast("int")
    for i, (low, high) in enumerate(ranges):
        part = F.when((v >= F.lit(low)) & (v <= F.lit(high)), F.lit(i)).otherwise(part)
    return values.select("v", part.alias("part")).filter(F.col("part").isNotNull())


def _wanted(found: list[dict], ranges: list[tuple[float, float]]) -> Column:
    return F.array(*[
        F.struct(
            F.lit(r["name"]).alias("name"), F.lit(ranges.index((r["low"], r["high"]))).alias("part"),
            F.lit(r["k"]).cast("long").alias("k"),
        )
        for r in found
    ])


def _narrowed(values: DataFrame, found: list[dict]) -> list[dict]:
    """The same ranks after each range is cut into PIECES equal steps between its ends."""
    ranges = _ranges(found)
    v, step = F.col("v"), F.lit(None).cast("double")
    for i, (low, high) in enumerate(ranges):
        # Neither difference nor quotient ever falls when the value rises, and the ends differ.
        place = (v - F.lit(low)) / F.lit(high - low)
        step = F.when(F.col("part") == i, place).otherwise(step)
    pieces = _in_range(values, ranges).withColumn("bucket", F.floor(step * PIECES))
    return _find_ranks(pieces, _wanted(found, ranges))


def values_at_ranks(df: DataFrame, column: str, ranks: dict[str, Column]) -> DataFrame:
    """One row with the k-th smallest value (from 0) per entry of `ranks`, NULL when empty.

    A rank is an expression over `n`, the number of non-null values. A histogram finds the bucket
    of each rank. A bucket of very many rows, as when nearly all values are close together, is cut
    into ever narrower ranges until the one that holds the rank has few rows or a single value; only
    then values are counted one by one. So no task sees more than a million rows of counts, however
    the values lie. `df` is read once for each step, so it should be a stored table.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    first = F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(0).alias("part"), k.cast("long").alias("k"))
        for n, k in ranks.items()
    ])
    found = _find_ranks(values.select("v", F.lit(0).alias("part"), _bucket(F.col("v")).alias("bucket")), first)
    while True:
        wide = [r for r in found if r["rows"] > NARROW_ROWS and r["low"] < r["high"]]
        if not wide:
            break
        found = [r for r in found if r not in wide] + _narrowed(values, wide)
    # A rank that no value has is NULL, one in a range of a single value is known.
    open_ = [r for r in found if r["low"] < r["high"]]
    known = dict.fromkeys(ranks) | {r["name"]: r["low"] for r in found}
    known = [
        F.lit(value).cast("double").alias(n)
        for n, value in known.items() if n not in {r["name"] for r in open_}
    ]
    if not open_:
        return df.sparkSession.range(1).select(*known).select(*ranks)
    parts = _ranges(open_)
    counted = _in_range(values, parts).groupBy("part", "v").agg(F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("part").orderBy("v"))
    placed = counted.withColumn("upto", upto)
    at = [
        F.min(F.when(
            (F.col("part") == parts.index((r["low"], r["high"]))) & (F.col("upto") > r["k"]), F.col("v")
        )).alias(r["name"])
        for r in open_
    ]
    return placed.agg(*at).select("*", *known).select(*ranks)


def floor_rank(fraction: float) -> Column:
    """min(n - 1, floor(fraction * n))."""
    return F.least(F.col("n") - 1, F.floor(F.col("n") * F.lit(fraction)))


def nearest_rank(percentile: int) -> Column:
    """round(percentile / 100 * (n - 1)), halves to even, at most n - 1."""
    return F.least(F.col("n") - 1, F.bround(F.lit(percentile / 100) * (F.col("n") - 1), 0))


def percentile_floor(df: DataFrame, column: str, fraction: float, out: str) -> DataFrame:
    found = values_at_ranks(df, column, {"v": floor_rank(fraction)})
    return found.select(F.coalesce("v", F.lit(0.0)).alias(out))


def percentile_nearest(df: DataFrame, column: str, percentiles: dict[str, int]) -> DataFrame:
    ranks = {name: nearest_rank(p) for name, p in percentiles.items()}
    found = values_at_ranks(df, column, ranks)
    return found.select(*[F.coalesce(n, F.lit(0.0)).alias(n) for n in percentiles])


def grouped_latency(
    df: DataFrame, group: str, column: str = "ingestion_latency_ms"
) -> DataFrame:
    """`group`, `p50_ms` (mean of the middle two) and `p95_ms` (floor rank) of each group.

    Equal values of a group are counted before they meet, so a group's task has one row per
    distinct value: a latency is a whole number of milliseconds.
    """
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(group, F.col(column).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    whole = Window.partitionBy(group)
    placed = counted.select(
        group,
        "v",
        F.sum("rows").over(whole).alias("n"),
        F.sum("rows").over(whole.orderBy("v")).alias("upto"),
        (F.sum("rows").over(whole.orderBy("v")) - F.col("rows")).alias("below"),
    )
    n = F.col("n")

    def at(rank: Column) -> Column:
        rank = rank.cast("long")
        return F.max(F.when((rank >= F.col("below")) & (rank < F.col("upto")), F.col("v")))

    middle = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2
    return placed.groupBy(group).agg(middle.alias("p50_ms"), at(floor_rank(0.95)).alias("p95_ms"))


def latency_summary(df: DataFrame, column: str = "ingestion_latency_ms") -> DataFrame:
    """avg, median (mean of the middle two), p95 and max; four zeros for an empty input."""
    n = F.col("n")
    ranks = {
        "low": F.floor((n - 1) / 2),
        "high": F.floor(n / 2),
        "p95": floor_rank(0.95),
    }
    at = values_at_ranks(df, column, ranks)
    whole = df.agg(F.avg(column).alias("avg"), F.max(column).alias("max"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return whole.crossJoin(at).select(
        zero(F.col("avg")).alias("avg_ms"),
        zero((F.col("low") + F.col("high")) / 2).alias("p50_ms"),
        zero(F.col("p95")).alias("p95_ms"),
        zero(F.col("max").cast("double")).alias("max_ms"),
    )
