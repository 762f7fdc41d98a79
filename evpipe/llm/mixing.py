"""Mixing sources to target weights by pivotal dependent rounding.

Sources share the words of all documents by weight; a source that would be repeated more than
`MOST_COPIES` times is held at that and the excess goes to the others by weight, until none is
above. Every document of a source is then due `target / source size` copies: the whole part for
certain, and one more with the remaining probability.

The pivotal method rounds those probabilities so that their sum is kept: two fractional units meet
and one passes mass to the other at random until one of them is 0 or 1, with chances that keep every
unit's own probability. Documents are dealt into groups of about `GROUP` of similar size, each of
which is rounded in one task and leaves at most one fractional unit; the residual units are dealt
into groups again, level by level, until each source has one left, which is rounded alone. Random
numbers are hashes of the seed, the level and the unit, so a rerun takes the same documents.

Defined results: a null or empty text has size 0 and is rounded like any other; sources of no words
have target 0 and are not taken; a null source is a source; rows that are alike in id, source and
size are one unit and share its copies. An empty table gives an empty one. Input columns named like
the results are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evpipe.llm.util import add_columns, stage
from evpipe.llm.words import white_space_words, word_blocks
from evpipe.operators.prefix import dense_positions

MOST_COPIES = 3
GROUP = 2048
SEED = 20
WEIGHTS = (1.0, 2.0, 3.0)


def with_sizes(docs: DataFrame, text: str = "text", out: str = "size") -> DataFrame:
    """`docs` with the number of words `[^\\x20\\x09-\\x0D]+` of the text."""

    def make(column: pa.Array) -> list[pa.Array]:
        counts = [b.counts() for b in word_blocks(column, white_space_words())]
        return [pa.array(np.concatenate(counts) if counts else [], pa.int64())]

    return add_columns(docs, text, [(out, "long")], make)


def pivot(p: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Round probabilities one against the next. Returns them with at most one fractional entry
    left, and the place of that (-1 if there is none)."""
    p = p.copy()
    held = -1
    for i in range(len(p)):
        if not _fraction(p[i]):
            continue
        if held < 0:
            held = i
            continue
        a, b = p[held], p[i]
        if a + b < 1:
            # One of them gives all it has.
            if draws[i] * (a + b) < a:
                p[held], p[i] = a + b, 0.0
            else:
                p[held], p[i], held = 0.0, a + b, i
        elif draws[i] * (2 - a - b) < 1 - b:
            p[held], p[i], held = 1.0, a + b - 1, i
        else:
            p[held], p[i] = a + b - 1, 1.0
        if not _fraction(p[held]):
            p[held] = round(p[held])
            held = -1
    return p, held


def _fraction(x: float) -> bool:
    return 1e-9 < x < 1 - 1e-9


def _draw(level: int) -> Column:
    """A number from 0 to 1 for each unit."""
    bits = F.xxhash64(F.lit(SEED), F.lit(level), "id", "source", "size")
    return F.pmod(bits, F.lit(1 << 52)).cast("double") / float(1 << 52)


def _round_groups(units: DataFrame, level: int) -> DataFrame:
    """Round within groups of about GROUP units of one source and of similar size.

    A group is a hash of its units, as many groups to a band of sizes as its number of units asks
    for: a hot source has many, and no group depends on the number of units beyond chance.
    """
    band = F.floor(F.log2(F.col("size") + 1.0) * 4) if level == 0 else F.lit(0)
    keyed = units.withColumn("band", band.cast("long"))
    counts = keyed.groupBy("source", "band").agg(F.count("*").alias("in_band"))
    spread = keyed.join(
        counts.select(F.col("source").alias("s2"), F.col("band").alias("b2"), "in_band"),
        F.col("source").eqNullSafe(F.col("s2")) & (F.col("band") == F.col("b2")),
    ).drop("s2", "b2")
    groups = F.ceil(F.col("in_band") / GROUP)
    place = F.pmod(F.xxhash64(F.lit(SEED + 1), F.lit(level), "id", "size"), groups)
    dealt = spread.withColumns({"place": place, "draw": _draw(level)})

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "id"], kind="stable", na_position="first")
        p, held = pivot(frame["p"].to_numpy(), frame["draw"].to_numpy())
        frame["p"] = p
        frame["open"] = np.arange(len(p)) == held
        return frame[["id", "source", "size", "n", "whole", "p", "open"]]

    schema = "id long, source string, size long, n long, whole long, p double, open boolean"
    return dealt.groupBy("source", "band", "place").applyInPandas(run, schema)


def source_weights(totals: DataFrame, weights: dict | None) -> DataFrame:
    """`totals` with the `weight` of each source. Without `weights` the sources, by code point with
    null last, weigh 1, 2, 3 in turn; sources that `weights` does not name weigh nothing."""
    if weights is None:
        ordered = totals.orderBy(F.col("source").isNull(), "source")
        numbered = stage(ordered.withColumn("seq", F.monotonically_increasing_id()), "sources")
        placed = dense_positions(numbered, "seq", "place").drop("seq")
        turns = F.array(*(F.lit(w) for w in WEIGHTS))
        turn = F.pmod(F.col("place"), F.lit(len(WEIGHTS))).cast("int") + 1
        return placed.withColumn("weight", F.element_at(turns, turn)).drop("place")
    given = totals.sparkSession.createDataFrame(
        [(s, float(w)) for s, w in weights.items()], "s string, w double"
    )
    met = totals.join(given, F.col("source").eqNullSafe(F.col("s")), "left")
    return met.withColumn("weight", F.coalesce("w", F.lit(0.0))).drop("s", "w")


def source_targets(sizes: DataFrame, weights: dict | None = None, cap: int = MOST_COPIES) -> DataFrame:
    """`source`, `source_size`, `target` from `source`, `size`: 100 % of all by weight, none above
    `cap` times its size.

    Each round is one sum over the sources: those above their cap are held at it, and the rest is
    shared again by the weights of the others. A share only grows from round to round, so who is
    held follows from the last shares alone, and the rounds end when no source is added. A round
    carries one row; the sources stay a table, however many there are. Sums are decimals, so they
    don't depend on the order of the rows.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    table = stage(source_weights(totals, weights), "weighted-sources")
    limit = F.col("source_size") * F.lit(cap)
    left, weight, over, before = None, None, F.lit(False), -1
    while True:
        state = table.agg(
            F.sum("source_size").alias("total"),
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0)).alias("held"),
            F.sum(F.when(~over, F.col("weight").cast("decimal(30,12)"))).alias("weight"),
            F.count_if(over).alias("n"),
        ).first()
        if state["n"] == before:
            break
        before = state["n"]
        left, weight = float((state["total"] or 0) - state["held"]), float(state["weight"] or 0)
        due = F.lit(left) * F.col("weight") / F.lit(weight) if weight else F.lit(0.0)
        over = due > limit
    target = F.when(over, limit.cast("double")).otherwise(due)
    return table.select("source", "source_size", target.alias("target"))


def copies(sizes: DataFrame, weights: dict | None = None) -> DataFrame:
    """For rows of `id`, `source`, `size`: one row for equal ones with their number `n` and the
    `copies` of each."""
    staged = stage(sizes.select("id", "source", "size"), "sizes")
    return _rounded(staged, stage(source_targets(staged, weights), "targets"))


def _rounded(sizes: DataFrame, due: DataFrame) -> DataFrame:
    units = sizes.groupBy("id", "source", "size").agg(F.count("*").alias("n"))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    due = due.select(F.col("source").alias("s"), share.alias("share"))
    units = units.join(due, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    whole = F.floor(F.col("share") + 1e-9)
    units = units.select(
        "id", "source", "size", "n", whole.cast("long").alias("whole"),
        F.greatest(F.col("share") - whole, F.lit(0.0)).alias("p"),
    )
    level, done = 0, None
    while True:
        rounded = stage(_round_groups(units, level), f"rounded-{level}")
        settled = rounded.filter("NOT open")
        done = settled if done is None else done.unionByName(settled)
        rest = rounded.filter("open").drop("open")
        most = rest.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            break
        units, level = rest, level + 1
    last = rest.withColumn("p", (_draw(level + 1) < F.col("p")).cast("double"))
    final = done.drop("open").unionByName(last)
    taken = F.col("whole") + F.round("p").cast("long")
    return final.select("id", "source", "size", "n", taken.alias("copies"))


def mix_digest(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """`doc_id`, `size`, `source_size`, `target`, `taken` of every row of `docs`."""
    sized = with_sizes(docs.select("doc_id", "source", "text")).select(
        F.col("doc_id").cast("long").alias("id"), "source", "size"
    )
    sized = stage(sized, "sizes")
    due = stage(source_targets(sized, weights), "targets")
    rounded = stage(_rounded(sized, due), "copies")
    due = due.withColumnRenamed("source", "s")
    rows = rounded.join(due, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    repeated = rows.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return repeated.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "source", "copies",
    )


def mixed(docs: DataFrame, weights: dict | None = None, key: str = "doc_id", source: str = "source",
          text: str = "text") -> DataFrame:
    """The mixture itself: the rows of `docs`, each as often as it is taken."""
    columns = docs.columns
    named = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"),
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{source}`").alias("source"),
        F.col(f"`{text}`").alias("text"),
    )
    sized = with_sizes(named, "text").drop("text")
    narrow = with_sizes(docs.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{source}`").alias("source"),
        F.col(f"`{text}`").alias("text"),
    )).drop("text")
    taken = stage(copies(narrow, weights).filter("copies > 0"), "copies").select(
        F.col("id").alias("i"), F.col("source").alias("s"), F.col("size").alias("z"), "copies"
    )
    same = F.col("id").eqNullSafe(F.col("i")) & F.col("source").eqNullSafe(F.col("s"))
    rows = sized.join(taken, same & (F.col("size") == F.col("z")))
    repeated = rows.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*(F.col("row")[c].alias(c) for c in columns))
