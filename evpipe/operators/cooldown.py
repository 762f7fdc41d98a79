"""Keep the first of a run of hits and suppress those that follow within the cool-down.

A hit is kept when there is no kept hit yet or it lies at least the cool-down after the last kept
one, going through the hits of an entity in arrival order. Kept times therefore only rise, and a
hit can be kept only if its time exceeds all earlier hits of the entity: any earlier hit was kept
itself, or lay less than a cool-down after a kept one. Entities with few hits are folded in one
expression. For the others the rising hits are cut into blocks of time:

* every block works out, for each hit by which it can be entered, which hit would be the last one
  kept in the block (`reduce_blocks`); blocks are then merged to wider blocks in the same way,
* top down, the hit by which each block is really entered becomes known, down to the single hits
  (`open_blocks`).

Only hits within one cool-down of the block start (and the next one) can be an entry, so every
level passes on a fraction of its rows, and no task ever sees an entity's full history.

A block spans two cool-downs at least, so its rows grow with the cool-down. Where that passes the
bound of a group, each hit gets a pointer to the one that would be kept after it, and pointers are
doubled round by round (`keep_by_pointers`): joins by time only, and no groups at all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evpipe.operators.prefix import running_max
from evpipe.plans.staging import stage

# Blocks of the first level span up to BLOCK_COOLDOWNS cool-downs, each further level as many blocks.
# Rising hits differ in their millisecond, so a block of GROUP_MS holds at most as many, however many
# hits the entity has; blocks of further levels hold one cool-down of hits of each block below.
BLOCK_COOLDOWNS = 16
GROUP_MS = 4_800_000


def check_cooldown(cooldown_ms: int) -> None:
    """A cool-down of 0 keeps every hit that is not behind the one kept before; less is refused."""
    if cooldown_ms < 0:
        raise ValueError(f"the cool-down must not be negative, got {cooldown_ms}")


def keep_by_fold(hits: DataFrame, key: str, cooldown_ms: int) -> DataFrame:
    """One fold per entity; for entities whose hits are known to fit in one row."""
    check_cooldown(cooldown_ms)
    values = [c for c in hits.columns if c != key]
    hit = F.struct("arrival_seq", *[c for c in values if c != "arrival_seq"])
    grouped = hits.groupBy(key).agg(F.array_sort(F.collect_list(hit)).alias("_hits"))
    none_yet = F.struct(
        F.lit(None).cast("bigint").alias("last"), F.array().cast("array<int>").alias("at")
    )

    def step(state, position):
        time = F.get("_hits", position)["event_ms"]
        keep = state["last"].isNull() | (time - state["last"] >= cooldown_ms)
        kept = F.struct(time.alias("last"), F.array_append(state["at"], position).alias("at"))
        return F.when(keep, kept).otherwise(state)

    positions = F.sequence(F.lit(0), F.size("_hits") - 1)
    kept_at = F.aggregate(positions, none_yet, step)["at"]
    kept = F.transform(kept_at, lambda i: F.get("_hits", i))
    return grouped.select(key, kept.alias("_kept")).select(key, F.inline("_kept")).select(
        *hits.columns
    )


def _block_number(width_ms: int):
    """floor(event_ms / width), in whole numbers also before 1970."""
    return F.expr(f"(event_ms - pmod(event_ms, {width_ms}L)) div {width_ms}L")


def _next_index(times: np.ndarray, exits: np.ndarray, cooldown_ms: int) -> np.ndarray:
    return np.searchsorted(times, exits + cooldown_ms, side="left")


def _rows(key: str, group: tuple, **columns: np.ndarray) -> pd.DataFrame:
    """Result rows of one (entity, block) group."""
    n = len(next(iter(columns.values())))
    return pd.DataFrame({key: pd.Series([group[0]] * n, dtype=object), **columns})


def reduce_blocks(steps: DataFrame, key: str, cooldown_ms: int, width_ms: int) -> DataFrame:
    """Entries of wider blocks from the entries (`event_ms`, `exit_ms`) of narrower ones."""

    def entries(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("event_ms")
        times, exits = pdf["event_ms"].to_numpy(), pdf["exit_ms"].to_numpy()
        following = _next_index(times, exits, cooldown_ms)
        out = exits.copy()
        for i in range(len(out) - 2, -1, -1):
            if following[i] < len(out):
                out[i] = out[following[i]]
        start = int(group[1]) * width_ms
        enough = int(np.searchsorted(times, start + cooldown_ms, side="left")) + 1
        return _rows(key, group, event_ms=times[:enough], exit_ms=out[:enough])

    key_type = steps.schema[key].dataType.simpleString()
    return (
        steps.withColumn("_block", _block_number(width_ms))
        .groupBy(key, "_block")
        .applyInPandas(entries, f"{key} {key_type}, event_ms bigint, exit_ms bigint")
    )


def open_blocks(
    steps: DataFrame, entered: DataFrame, key: str, cooldown_ms: int, width_ms: int
) -> DataFrame:
    """Times at which the narrower blocks inside each entered wider block are entered."""

    def walk(group: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return _rows(key, group, event_ms=np.empty(0, "int64"))
        left = left.sort_values("event_ms")
        times, exits = left["event_ms"].to_numpy(), left["exit_ms"].to_numpy()
        following = _next_index(times, exits, cooldown_ms)
        at = int(np.searchsorted(times, right["event_ms"].iloc[0], side="left"))
        picked = []
        while at < len(times):
            picked.append(at)
            at = int(following[at])
        return _rows(key, group, event_ms=times[picked])

    key_type = steps.schema[key].dataType.simpleString()
    block = _block_number(width_ms).alias("_block")
    return (
        steps.select("*", block)
        .groupBy(key, "_block")
        .cogroup(entered.select("*", block).groupBy(key, "_block"))
        .applyInPandas(walk, f"{key} {key_type}, event_ms bigint")
    )


def keep_by_blocks(
    hits: DataFrame,
    key: str,
    cooldown_ms: int,
    span_ms: int,
    block_cooldowns: int = BLOCK_COOLDOWNS,
    chunk: int = 1 << 20,
) -> DataFrame:
    """Same result as the fold for entities of any size, in a few rounds of bounded groups.

    `span_ms` bounds the distance between the first and last hit; it sets the number of levels.
    Cool-downs of which not even two fit into a block of GROUP_MS go by pointers.
    """
    check_cooldown(cooldown_ms)
    hits = hits.select(key, "arrival_seq", "event_ms")
    before = running_max(
        hits, "arrival_seq", "event_ms", "_before", keys=[key], inclusive=False, chunk=chunk
    )
    if cooldown_ms == 0:
        return before.filter(
            F.col("_before").isNull() | (F.col("event_ms") >= F.col("_before"))
        ).drop("_before")
    rising = before.filter(F.col("_before").isNull() | (F.col("event_ms") > F.col("_before")))
    block_cooldowns = min(block_cooldowns, GROUP_MS // cooldown_ms)
    if block_cooldowns < 2:
        return keep_by_pointers(rising.drop("_before"), key, cooldown_ms, chunk)
    levels = [rising.select(key, "event_ms", F.col("event_ms").alias("exit_ms"))]
    widths = []
    width = cooldown_ms * block_cooldowns
    while True:
        widths.append(width)
        levels.append(reduce_blocks(levels[-1], key, cooldown_ms, width))
        if width > span_ms:
            break
        width *= block_cooldowns
    # The first hit of an entity is always kept; it enters the widest block that holds it. An
    # entity spans at most two of those, and the second is entered from the first.
    entered = _enter_widest(levels[-1], key, cooldown_ms)
    for steps, block_width in zip(reversed(levels[:-1]), reversed(widths), strict=True):
        entered = open_blocks(steps, entered, key, cooldown_ms, block_width)
    return rising.join(entered, [key, "event_ms"], "left_semi").drop("_before")


def _next_kept(times: DataFrame, key: str, cooldown_ms: int, chunk: int) -> DataFrame:
    """`to`: of each hit, the first one of the entity at least the cool-down later; only hits that
    have one. A running minimum from the last hit to the first, over hits and asked times."""
    top = times.agg(F.max("event_ms")).first()[0] or 0
    none = F.lit(None).cast("bigint")
    hits = times.select(key, F.col("event_ms").alias("at"), none.alias("asked"))
    asked = times.select(key, (F.col("event_ms") + cooldown_ms).alias("at"), F.col("event_ms").alias("asked"))
    # A hit comes before the question for its own time, as it lies late enough.
    place = (F.lit(top + cooldown_ms).cast("bigint") - F.col("at")) * 2
    marks = hits.unionByName(asked).select(
        key, "asked", (place + F.col("asked").isNotNull().cast("int")).alias("place"),
        F.when(F.col("asked").isNull(), -F.col("at")).alias("minus"),
    )
    found = running_max(marks, "place", "minus", "least", keys=[key], chunk=chunk)
    return found.filter("asked is not null and least is not null").select(
        key, F.col("asked").alias("event_ms"), (-F.col("least")).alias("to")
    )


def keep_by_pointers(rising: DataFrame, key: str, cooldown_ms: int, chunk: int) -> DataFrame:
    """The kept ones of hits (`arrival_seq`, `event_ms`) of which each is later than all before.

    From the first hit of an entity on, the kept hits are where its pointers lead. Round by round the
    pointers span twice as many kept hits, and twice as many of those are known; pointers that lead
    past the last hit are dropped. So there are as many rounds as the logarithm of the kept hits of
    an entity, and a join meets one entity at one time, never its history.
    """
    times = stage(rising.select(key, "event_ms"), "hit-times")
    known = times.groupBy(key).agg(F.min("event_ms").alias("event_ms"))
    pointers = stage(_next_kept(times, key, cooldown_ms, chunk), "pointers")
    while not pointers.isEmpty():
        further = known.join(pointers, [key, "event_ms"]).select(key, F.col("to").alias("event_ms"))
        known = stage(known.unionByName(further), "kept-times")
        ahead = pointers.select(key, F.col("event_ms").alias("to"), F.col("to").alias("_beyond"))
        pointers = stage(
            pointers.join(ahead, [key, "to"]).select(key, "event_ms", F.col("_beyond").alias("to")),
            "pointers",
        )
    return rising.join(known, [key, "event_ms"], "left_semi").select(rising.columns)


def _enter_widest(top: DataFrame, key: str, cooldown_ms: int) -> DataFrame:
    first = F.min("event_ms").over(Window.partitionBy(key))
    marked = top.withColumn("_first", first)
    exit_of_first = F.max(F.when(F.col("event_ms") == F.col("_first"), F.col("exit_ms"))).over(
        Window.partitionBy(key)
    )
    after = marked.withColumn("_exit", exit_of_first)
    enters_next = F.min(
        F.when(F.col("event_ms") >= F.col("_exit") + cooldown_ms, F.col("event_ms"))
    ).over(Window.partitionBy(key))
    return (
        after.withColumn("_second", enters_next)
        .filter((F.col("event_ms") == F.col("_first")) | (F.col("event_ms") == F.col("_second")))
        .select(key, "event_ms")
    )
