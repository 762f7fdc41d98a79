"""Near-duplicate documents by min-max hashing.

A document's set is its distinct 5-word shingles over A-Z-lower-cased words; with fewer words, the
whole sequence is the only one. Under each of `PERMUTATIONS` hash functions both the smallest and
the largest value are kept, which gives twice as many signature values as hash evaluations, each
equal in two documents with a probability of their Jaccard similarity. The values are banded in
`BANDS` bands of `ROWS`; documents that agree in a band are candidates. At the least similarity
that links, 0.85, a pair misses all bands with a probability under one in a million.

Documents with equal sets are one class and go on as one. Candidates are gathered into groups, the
components of the graph in which each band's bucket is a star. Within a group all pairs of classes
are compared on their full sets: a task takes a group as a whole or, when its sets are many or
large together, one pair of blocks of it, and passes on only a spanning forest of the links it finds.
The components of those forests are the result.

Defined results: a null or word-free text has an empty set, is its own component and is kept; rows
of equal id and set share the class; classes with the same smallest id count as one; a row without an id gets no component, takes no part and is
kept. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evpipe.llm.components import components
from evpipe.llm.util import ragged, small_batches, stage, unused_name
from evpipe.llm.words import (
    Block,
    gram_hashes,
    lower_ascii,
    mix,
    white_space_words,
    word_blocks,
)

SHINGLE = 5
PERMUTATIONS = 126
ROWS = 7
BANDS = 2 * PERMUTATIONS // ROWS
SEED = 11
SIMILARITY_PERCENT = 85
# Shingles of a block of a group: about two such blocks are in a task at once.
UNIT_SHINGLES = 150_000
# Sets of a block: the matrices of a task have a row and a column for each set of two blocks.
UNIT_SETS = 1_000


def shingle_sets(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all rows of a block, sorted within a row, and their bounds."""
    codes = block.codes()
    counts = block.counts()
    parts, sizes = [], np.zeros(len(counts), dtype=np.int64)
    grams = gram_hashes(codes, SHINGLE)
    for r, n in enumerate(counts.tolist()):
        a = int(block.first[r])
        if n >= SHINGLE:
            own = np.sort(grams[a : a + n - SHINGLE + 1])
            own = own[np.append(True, own[1:] != own[:-1])]
        elif n:
            own = gram_hashes(codes[a : a + n], n) + np.uint64(n)
        else:
            continue
        sizes[r] = len(own)
        parts.append(own)
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return flat, np.concatenate(([0], np.cumsum(sizes)))


def fingerprints(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two independent 64-bit sums over each set: equal sets have equal ones."""
    out = np.zeros((2, len(bounds) - 1), dtype=np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for i, salt in enumerate((0x51ED270B, 0x2545F491)):
            out[i, full] = np.add.reduceat(mix(flat + np.uint64(salt)), bounds[full])
    return out


def band_keys(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The band keys of all non-empty sets, one row each."""
    full = np.flatnonzero(np.diff(bounds))
    starts = bounds[full]
    draws = np.random.default_rng(SEED).integers(0, 2**64, (PERMUTATIONS, 2), dtype=np.uint64)
    values = np.empty((2 * PERMUTATIONS, len(full)), dtype=np.uint64)
    for i, (a, b) in enumerate(draws):
        turned = flat * (a | np.uint64(1)) + b
        values[2 * i] = np.minimum.reduceat(turned, starts)
        values[2 * i + 1] = np.maximum.reduceat(turned, starts)
    keys = np.empty((len(full), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(full), band + 1, dtype=np.uint64)
        for row in values[band * ROWS : (band + 1) * ROWS]:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + row)
        keys[:, band] = key
    return keys


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `n_shingles`, `f1`, `f2` (fingerprints of the set) and `bands`."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in word_blocks(batch.column(1), white_space_words(), lower_ascii()):
                flat, bounds = shingle_sets(block)
                sizes = np.diff(bounds)
                prints = fingerprints(flat, bounds).view(np.int64)
                keys = band_keys(flat, bounds) if len(flat) else np.empty((0, BANDS), np.uint64)
                ends = np.concatenate(([0], np.cumsum(sizes > 0))) * BANDS
                rows = block.rows
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(rows.start, rows.stop - rows.start),
                        pa.array(sizes), pa.array(prints[0]), pa.array(prints[1]),
                        ragged(keys.view(np.int64).ravel(), ends, pa.int64()),
                    ],
                    ["doc_id", "n_shingles", "f1", "f2", "bands"],
                )

    picked = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`"))
    schema = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>"
    return picked.mapInArrow(run, schema)


def linked(sets: list[np.ndarray], blocks: np.ndarray, cross: bool) -> np.ndarray:
    """For each set the first one (by place) it is connected with through links.

    With `cross`, only pairs of different blocks are looked at.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    # Only shingles of two sets at least add to an intersection.
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    opens = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    counts = np.diff(np.append(opens, len(flat)))
    column = np.repeat(np.cumsum(counts > 1) - 1, counts)
    shared = np.repeat(counts > 1, counts)
    owner, column = owner[shared], column[shared]
    common = np.zeros((n, n), dtype=np.float32)
    width = max(256, min(4096, (1 << 24) // max(n, 1)))
    total = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, total, width):
        a, b = np.searchsorted(column, (low, low + width))
        part = np.zeros((n, min(width, total - low)), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        common += part @ part.T
    both = common.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    link = 100 * both >= SIMILARITY_PERCENT * union
    if cross:
        link &= blocks[:, None] != blocks[None, :]
    np.fill_diagonal(link, True)
    root = np.full(n, -1, dtype=np.int64)
    for i in range(n):
        if root[i] >= 0:
            continue
        front = np.array([i])
        root[i] = i
        while len(front):
            reached = np.flatnonzero(link[front].any(axis=0) & (root < 0))
            root[reached] = i
            front = reached
    return root


def _compare_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by unit; the rows of a unit follow each other."""
    unit, held = None, []

    def found(rows: list) -> pa.RecordBatch | None:
        if len(rows) < 2:
            return None
        # A class is told by its id and set: another class, or a row that is of neither, may have the id.
        sets: dict[tuple[int, int], np.ndarray] = {}
        places = []
        texts = pa.array([r[2] for r in rows], pa.string())
        for block in word_blocks(texts, white_space_words(), lower_ascii()):
            flat, bounds = shingle_sets(block)
            prints = fingerprints(flat, bounds)[0].view(np.int64)
            for r in range(len(prints)):
                rep, place, _, _, print_ = rows[block.rows.start + r]
                if (rep, print_) not in sets and prints[r] == print_:
                    sets[rep, print_] = flat[bounds[r] : bounds[r + 1]]
                    places.append(place)
        if len(sets) < 2:
            return None
        ids, blocks = np.array([rep for rep, _ in sets], dtype=np.int64), np.array(places)
        root = linked(list(sets.values()), blocks, rows[0][3])
        moved = np.flatnonzero(ids[root] != ids)
        if not len(moved):
            return None
        return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], ["a", "b"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("g", "u", "w", "rep", "block", "x", "f1")]
        for g, u, w, rep, block, x, print_ in zip(*columns, strict=True):
            if (g, u, w) != unit:
                if out := found(held):
                    yield out
                unit, held = (g, u, w), []
            held.append((rep, block, x, u != w, print_))
    if out := found(held):
        yield out


def candidate_groups(classes: DataFrame) -> DataFrame:
    """`rep`, `g` of the classes that share a band with another one."""
    keys = classes.select("rep", F.explode("bands").alias("key"))
    stars = keys.groupBy("key").agg(F.min("rep").alias("center"), F.count("*").alias("n"))
    # Hinted, here and below, so that the plan does not change with the size of the tables.
    shared = stars.filter("n > 1").drop("n").hint("merge")
    met = keys.join(shared, "key").filter("rep <> center")
    edges = met.select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
    pointed = components(edges)
    roots = pointed.select(F.col("root").alias("rep"), F.col("root").alias("g")).distinct()
    members = pointed.select(F.col("node").alias("rep"), F.col("root").alias("g"))
    return stage(members.unionByName(roots), "groups")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_shingles`, `component_id`, `kept`."""
    signed = stage(signatures(docs, key, text), "signatures")
    classes = stage(
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("f1", "f2").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    groups = candidate_groups(classes)
    sized = groups.join(classes.select(F.col("rep").alias("r"), "n", "f1", "f2"), F.col("rep") == F.col("r"))
    sized = stage(sized.drop("r"), "members")
    blocks = sized.groupBy("g").agg(
        F.ceil(F.greatest(F.sum("n") / UNIT_SHINGLES, F.count("*") / UNIT_SETS)).alias("blocks"),
        F.count("*").alias("in_group"),
    )
    placed = sized.join(blocks.filter("in_group > 1"), "g").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks"))
    )
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("d"), F.col(f"`{text}`").alias("x"))
    units = placed.hint("merge").join(texts, F.col("rep") == F.col("d")).select(
        "g", "rep", "block", "x", "f1",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        "g", F.least("block", "other").alias("u"), F.greatest("block", "other").alias("w"),
        "rep", "block", "x", "f1",
    )
    dealt = units.repartition("g", "u", "w").sortWithinPartitions("g", "u", "w", "rep")
    links = stage(dealt.mapInArrow(_compare_units, "a long, b long"), "links")
    pointed = components(links)
    by_set = classes.join(pointed, F.col("rep") == F.col("node"), "left").select(
        "f1", "f2", F.coalesce("root", "rep").alias("component")
    )
    found = signed.drop("bands").join(by_set, ["f1", "f2"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` but for those that another document of their component stands for."""
    gone = unused_name(docs, "gone")
    found = near_duplicates(docs, key, text).filter("NOT kept").select(F.col("doc_id").alias(gone))
    kept = docs.join(found.distinct(), F.col(f"`{key}`").cast("long") == F.col(gone), "left_anti")
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
