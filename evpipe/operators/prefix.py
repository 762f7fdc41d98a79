"""Running values over the order of arrival without putting all rows in one task.

Rows are cut into chunks of consecutive sequence numbers. A chunk holds at most `CHUNK` rows,
since sequence numbers are unique, so no window partition is large however the data are
distributed. What earlier chunks contribute comes from a table with one row per chunk, itself cut
into blocks of chunks, and those into blocks of blocks. Only the table of the last level, one row per
CHUNK * BLOCK ** LEVELS = 2^38 sequence numbers, is read in one piece: a few rows when numbers are
dense, and one for every 32 tasks when each task numbers its rows in a range of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHUNK = 1 << 14
BLOCK = 1 << 12
LEVELS = 2


def _before(columns: Sequence[str], order: str):
    return (
        Window.partitionBy(*columns).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )


def max_before_chunk(
    per_chunk: DataFrame,
    value: str,
    out: str,
    keys: Sequence[str] = (),
    block: int = BLOCK,
    levels: int = LEVELS,
) -> DataFrame:
    """Largest `value` of all earlier chunks, from a table of one row per (keys, _chunk)."""
    if levels == 0:
        return per_chunk.select(
            *keys, "_chunk", F.max(value).over(_before(keys, "_chunk")).alias(out)
        )
    chunks = per_chunk.withColumn("_block", F.expr(f"_chunk div {block}"))
    blocks = chunks.groupBy(*keys, F.col("_block").alias("_chunk")).agg(
        F.max(value).alias("_block_max")
    )
    earlier = max_before_chunk(blocks, "_block_max", "_from_blocks", keys, block, levels - 1)
    in_block = F.max(value).over(_before([*keys, "_block"], "_chunk"))
    return (
        chunks.withColumn("_in_block", in_block)
        .join(earlier.withColumnRenamed("_chunk", "_block"), [*keys, "_block"])
        .select(*keys, "_chunk", F.greatest("_from_blocks", "_in_block").alias(out))
    )


def sum_before_chunk(
    per_chunk: DataFrame, value: str, out: str, block: int = BLOCK, levels: int = LEVELS
) -> DataFrame:
    """Sum of `value` over all earlier chunks, from a table of one row per `_chunk`."""
    if levels == 0:
        before = F.sum(value).over(_before([], "_chunk"))
        return per_chunk.select("_chunk", F.coalesce(before, F.lit(0)).alias(out))
    chunks = per_chunk.withColumn("_block", F.expr(f"_chunk div {block}"))
    blocks = chunks.groupBy(F.col("_block").alias("_chunk")).agg(F.sum(value).alias("_block_sum"))
    earlier = sum_before_chunk(blocks, "_block_sum", "_from_blocks", block, levels - 1)
    in_block = F.coalesce(F.sum(value).over(_before(["_block"], "_chunk")), F.lit(0))
    return (
        chunks.withColumn("_in_block", in_block)
        .join(earlier.withColumnRenamed("_chunk", "_block"), "_block")
        .select("_chunk", (F.col("_from_blocks") + F.col("_in_block")).alias(out))
    )


def dense_positions(
    df: DataFrame, seq: str, out: str, chunk: int = CHUNK, block: int = BLOCK
) -> DataFrame:
    """Add the number of rows with a smaller `seq`: 0, 1, 2 and so on without gaps.

    `seq` is unique and not negative but may have gaps, as offsets and numbers given out by tasks do.
    Rows are counted by chunk, the counts summed up over the chunks before, and each chunk numbers its
    own rows from there.
    """
    chunked = df.withColumn("_chunk", F.expr(f"{seq} div {chunk}"))
    per_chunk = chunked.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    before = sum_before_chunk(per_chunk, "_rows", "_earlier", block)
    place = F.row_number().over(Window.partitionBy("_chunk").orderBy(seq)) - 1
    return (
        chunked.withColumn("_place", place)
        .join(before, "_chunk")
        .select(*df.columns, (F.col("_earlier") + F.col("_place")).cast("bigint").alias(out))
    )


def running_max(
    df: DataFrame,
    seq: str,
    value: str,
    out: str,
    keys: Sequence[str] = (),
    inclusive: bool = True,
    chunk: int = CHUNK,
    block: int = BLOCK,
) -> DataFrame:
    """Add the largest non-null `value` among arrivals up to this row (or before it)."""
    chunked = df.withColumn("_chunk", F.expr(f"{seq} div {chunk}"))
    per_chunk = chunked.groupBy(*keys, "_chunk").agg(F.max(value).alias("_chunk_max"))
    before = max_before_chunk(per_chunk, "_chunk_max", "_earlier", keys, block)
    window = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(seq)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return (
        chunked.withColumn("_own", F.max(value).over(window))
        .join(before, [*keys, "_chunk"])
        .withColumn(out, F.greatest("_earlier", "_own"))
        .select(*df.columns, out)
    )


def last_values(
    df: DataFrame,
    key: str,
    seq: str,
    signals: dict[str, object],
    hot: str | None = None,
    chunk: int = 1 << 20,
) -> DataFrame:
    """Per key, the latest non-null value of every signal up to this row, in arrival order.

    `signals` maps output names to value columns. Keys marked in the boolean column `hot` are
    cut into chunks by sequence number and start each chunk with the values carried over.
    """
    names = list(signals)
    rows = df.select("*", *[c.alias(f"_v_{n}") for n, c in signals.items()])
    parts = [key]
    if hot is not None:
        piece = F.when(F.col(hot), F.expr(f"{seq} div {chunk}")).otherwise(F.lit(-1))
        rows = rows.withColumn("_chunk", piece)
        parts = [key, "_chunk"]
    window = (
        Window.partitionBy(*parts).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    )
    own = rows.select(
        *df.columns,
        *parts[1:],
        *[F.last(f"_v_{n}", ignorenulls=True).over(window).alias(n) for n in names],
    )
    if hot is None:
        return own
    latest = lambda n: F.max_by(
        f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(seq))
    )
    ends = rows.filter(hot).groupBy(key, "_chunk").agg(*[latest(n).alias(n) for n in names])
    earlier = _before([key], "_chunk")
    carried = ends.select(
        key,
        "_chunk",
        *[F.last(n, ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in names],
    )
    return own.join(carried, parts, "left").select(
        *df.columns, *[F.coalesce(n, f"_c_{n}").alias(n) for n in names]
    )
