"""Line dedup by a deletion-neighbourhood join over words.

A line is the sequence of its words `[^\\x20\\x09-\\x0D]+`. A line goes if the same sequence, or one
within `1` word edit (a word replaced, added or left out), stands earlier, by doc_id and line
number. Sequences of fewer than `LEAST_WORDS` words go by equality only: an edit would make any two
short lines alike.

Every sequence of `n` words emits fingerprints of itself and of the `n` sequences that lack one
word. Two sequences are one replacement apart if they lack the same place and agree, one insertion
apart if one agrees with the other's lack of some place. So each emitted key needs no pairs, only
the earliest sequence that has it. To emit less, sequences first tell four fingerprints of halves:
sequences one edit apart share one of them, so the neighbourhood of a sequence whose halves nobody
shares is not emitted. The edit distance to the earliest partner is then verified on the words.

Defined results: a null text has no lines; empty and blank lines stay and are not counted as
duplicates; rows that are alike in id and text are the same lines, so neither copy goes for the
other's sake; a null doc_id is the earliest. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evpipe.llm.util import ragged, small_batches, stage, unused_name
from evpipe.llm.words import Block, RunSums, white_space_words, word_blocks

LEAST_WORDS = 8


class Lines:
    """The lines of a block of rows that have words: `row` and `line` number, and the words from
    `a` to `b` of the block."""

    def __init__(self, block: Block):
        breaks = np.flatnonzero(block.data == 0x0A)
        rows = np.repeat(np.arange(len(block.first) - 1), block.counts())
        # Line breaks before a word, in the block and in its own row.
        before = np.searchsorted(breaks, block.starts)
        line = before - np.searchsorted(breaks, block.offsets[:-1])[rows]
        self.block = block
        self.a = np.flatnonzero(np.diff(line, prepend=-1) | np.diff(rows, prepend=-1))
        self.b = np.append(self.a[1:], len(rows)) if len(self.a) else self.a
        self.row, self.line = rows[self.a] + block.rows.start, line[self.a]
        self.sums = RunSums(block.codes()), RunSums(block.codes(second=True))

    def prints(self, kept: np.ndarray | slice = slice(None)) -> list[pa.Array]:
        """`p1` and `p2`, together a fingerprint of 128 bits of the words of each line."""
        return [_signed(s.run(self.a[kept], self.b[kept])) for s in self.sums]

    def halves(self) -> pa.Array:
        """Fingerprints of which two sequences that are one edit apart have one in common at least;
        none for lines of fewer than `LEAST_WORDS` words."""
        n = self.b - self.a
        long = n >= LEAST_WORDS
        a, b, n = self.a[long], self.b[long], n[long]
        found = np.empty((len(n), 4), dtype=np.uint64)
        # For the longer sequence of a pair with `m` words: its first m // 2 or last (m - 1) // 2
        # words are untouched. This one may be the longer or the shorter of a pair.
        for k, m in enumerate((n, n + 1)):
            found[:, 2 * k] = self.sums[0].run(a, a + m // 2, 2 * m)
            found[:, 2 * k + 1] = self.sums[0].run(b - (m - 1) // 2, b, 2 * m + 1)
        offsets = np.concatenate(([0], np.cumsum(4 * long)))
        return ragged(found.ravel().view(np.int64), offsets, pa.int64())

    def words(self, kept: np.ndarray) -> pa.Array:
        """The words of the lines marked in `kept`, joined by one space."""
        a, b = self.a[kept], self.b[kept]
        if not len(a):
            return pa.array([], pa.binary())
        n = b - a
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(a - (ends - n), n)
        size = self.block.ends[at] - self.block.starts[at] + 1
        # No space behind the last word of a line.
        size[ends - 1] -= 1
        opens = np.cumsum(size) - size
        source = np.arange(opens[-1] + size[-1]) + np.repeat(self.block.starts[at] - opens, size)
        out = self.block.data[np.minimum(source, len(self.block.data) - 1)]
        spaces = (opens + size - 1).astype(np.int64)
        out[np.delete(spaces, ends - 1)] = 0x20
        bounds = np.concatenate(([0], (opens + size)[ends - 1])).astype(np.int32)
        return pa.Array.from_buffers(
            pa.binary(), len(a), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(out.tobytes())]
        )


def _signed(prints: np.ndarray) -> pa.Array:
    return pa.array(prints.view(np.int64))


def _lines(column: pa.Array) -> Iterator[Lines]:
    return map(Lines, word_blocks(column, white_space_words()))


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """`doc_id`, `line`, `p1`, `p2` (fingerprint of the words) and `halves` of every line that has
    words."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines in _lines(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(lines.row, pa.int64())),
                        pa.array(lines.line, pa.int64()), *lines.prints(), lines.halves(),
                    ],
                    ["doc_id", "line", "p1", "p2", "halves"],
                )

    picked = docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`"))
    return picked.mapInArrow(run, "doc_id long, line long, p1 long, p2 long, halves array<long>")


def _words_of(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """`p1`, `p2`, `words` of the lines that `wanted` (`doc_id`, `line`) lists."""
    listed = wanted.groupBy(F.col("doc_id").alias("d")).agg(F.collect_set("line").alias("numbers"))
    picked = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").alias("x"))
    # Hinted, so that the plan does not change with the size of the tables.
    texts = picked.join(listed.hint("merge"), F.col("k").eqNullSafe(F.col("d")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(1)
            asked = numbers.flatten().to_numpy(zero_copy_only=False)
            rows = np.repeat(
                np.arange(len(numbers)), numbers.value_lengths().to_numpy(zero_copy_only=False)
            )
            # A row has fewer than 2^31 bytes, and a batch at most some thousand rows.
            asked = (rows << 32) + asked
            for lines in _lines(batch.column(0)):
                kept = np.isin((lines.row << 32) + lines.line, asked)
                yield pa.RecordBatch.from_arrays(
                    [*lines.prints(kept), lines.words(kept)], ["p1", "p2", "words"]
                )

    return texts.select("x", "numbers").mapInArrow(run, "p1 long, p2 long, words binary")


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of each sequence: of the whole (`place` -1) and of what is left without a word."""
    for batch in batches:
        for block in word_blocks(batch.column("words"), white_space_words()):
            a, b = block.first[:-1], block.first[1:]
            row = np.repeat(np.arange(len(a)), b - a)
            word = np.arange(len(row))
            keys = []
            for sums in (RunSums(block.codes()), RunSums(block.codes(second=True))):
                lacking = sums.without(a[row], word, b[row])
                keys.append(_signed(np.concatenate((sums.run(a, b), lacking))))
            own = pa.array(np.concatenate((np.arange(len(a)), row)) + block.rows.start)
            place = np.concatenate((np.full(len(a), -1), word - a[row]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(own) for c in ("p1", "p2", "first")), *keys, pa.array(place)],
                ["p1", "p2", "first", "k1", "k2", "place"],
            )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(c).to_pylist() for c in ("words", "theirs"))
        keep = [within_one_edit(x.split(b" "), y.split(b" ")) for x, y in zip(a, b, strict=True)]
        yield batch.select(["p1", "p2"]).filter(pa.array(keep, pa.bool_()))


def earlier_neighbours(docs: DataFrame, lines: DataFrame, first: DataFrame, key: str,
                       text: str) -> DataFrame:
    """`p1`, `p2` of the sequences that an earlier one is within one edit of.

    `first` has a row for each sequence: `p1`, `p2` and `first`, where it first stands.
    """
    half = lines.select("p1", "p2", F.explode("halves").alias("half"))
    # Halves of one sequence only bring nothing together.
    shared = half.groupBy("half").agg(F.min("p1").alias("low"), F.max("p1").alias("high"))
    shared = shared.filter("low <> high").select("half").hint("merge")
    open_ = stage(half.join(shared, "half").select("p1", "p2").distinct(), "open-lines")
    candidates = stage(open_.hint("merge").join(first, ["p1", "p2"]), "candidates")
    wanted = candidates.select("first.doc_id", "first.line")
    fetched = _words_of(docs, key, text, wanted).dropDuplicates(["p1", "p2"])
    words = stage(fetched.join(candidates.hint("merge"), ["p1", "p2"]), "candidate-words")
    place = "struct<doc_id: bigint, line: bigint>"
    emitted = words.mapInArrow(
        _neighbours, f"p1 long, p2 long, first {place}, k1 long, k2 long, place long"
    )
    # Nearly all keys belong to one sequence. Emitting twice is cheaper than storing them.
    keys = emitted.groupBy("k1", "k2").agg(F.min("p1").alias("low"), F.max("p1").alias("high"))
    keys = keys.filter("low <> high").select("k1", "k2")
    keyed = stage(emitted.join(keys.hint("merge"), ["k1", "k2"]), "neighbours")
    # The earliest of those that lack the same place, and of whole and lacking ones of one key.
    lacking, whole = keyed.filter("place >= 0"), keyed.filter("place < 0")
    own = F.struct("first", "p1", "p2")
    replaced = lacking.groupBy("k1", "k2", "place").agg(F.min(own).alias("e"))
    shorter = whole.select("k1", "k2", own.alias("e"))
    longer = lacking.groupBy("k1", "k2").agg(F.min(own).alias("e"))
    columns = ["p1", "p2", "first", "e"]
    met = lacking.join(replaced, ["k1", "k2", "place"]).select(*columns)
    met = met.unionByName(lacking.join(shorter, ["k1", "k2"]).select(*columns))
    met = met.unionByName(whole.join(longer, ["k1", "k2"]).select(*columns))
    earliest = met.filter("e.first < first").groupBy("p1", "p2").agg(F.min("e").alias("e"))
    pairs = earliest.select("p1", "p2", F.col("e.p1").alias("q1"), F.col("e.p2").alias("q2"))
    theirs = words.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("words").alias("theirs"))
    pairs = pairs.join(words, ["p1", "p2"]).join(theirs, ["q1", "q2"])
    return pairs.select("p1", "p2", "words", "theirs").mapInArrow(_verify, "p1 long, p2 long")


def duplicate_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `line`, `gone` of every line that has words."""
    lines = stage(lines_of(docs, key, text), "lines")
    place = F.struct("doc_id", "line")
    first = stage(lines.groupBy("p1", "p2").agg(F.min(place).alias("first")), "first-lines")
    near = earlier_neighbours(docs, lines, first, key, text).withColumn("near", F.lit(True))
    facts = first.join(near, ["p1", "p2"], "left")
    found = lines.select("doc_id", "line", "p1", "p2").join(facts, ["p1", "p2"])
    again = ~(F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.line") == F.col("line")))
    return found.select("doc_id", "line", (F.col("near").isNotNull() | again).alias("gone"))


def digest(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_lines` (with words), `n_removed`, and the sha256 of the removed line numbers."""
    gone = duplicate_lines(docs).groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.count_if("gone").alias("n_removed"),
        F.sort_array(F.collect_set(F.when(F.col("gone"), F.col("line")))).alias("lines"),
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("d")).distinct()
    rows = ids.join(gone, F.col("d").eqNullSafe(F.col("doc_id")), "left")
    listed = F.array_join(F.coalesce("lines", F.array().cast("array<long>")).cast("array<string>"), ",")
    return rows.select(
        F.col("d").alias("doc_id"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.sha2(listed.cast("binary"), 256).alias("removed_sha256"),
    )


def drop_duplicate_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the duplicate lines cut out of the texts."""
    own, gone = unused_name(docs, "d"), unused_name(docs, "gone_lines")
    numbers = duplicate_lines(docs, key, text).filter("gone").groupBy(F.col("doc_id").alias(own)).agg(
        F.collect_set("line").alias(gone)
    )
    joined = docs.join(numbers, F.col(f"`{key}`").cast("long").eqNullSafe(F.col(own)), "left")
    numbered = F.transform(
        F.split(F.col(f"`{text}`"), "\n", -1),
        lambda x, i: F.when(
            F.array_contains(F.coalesce(gone, F.array().cast("array<long>")), i.cast("long")),
            F.lit(None).cast("string"),
        ).otherwise(x),
    )
    kept = F.array_join(F.filter(numbered, lambda x: x.isNotNull()), "\n")
    return joined.select(*(
        F.when(F.col(f"`{text}`").isNotNull(), kept).alias(c) if c == text else F.col(f"`{c}`")
        for c in docs.columns
    ))
