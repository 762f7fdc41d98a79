"""Spelling variants: words of a vocabulary that one edit turns into a much more frequent word.

Pairs of words one insertion, deletion or replacement apart are the accepted pairs of a composed
automaton: the minimal acceptor of the vocabulary, a transducer that makes one edit, and the
acceptor again. The composition is enumerated in partitions. Two words one edit apart share the
first half of the shorter word, or its last half, so each word goes to the partitions of its halves;
a partition is the composed automaton behind the state that reading the shared half leads to, and
holds an acceptor of only the other parts, the windows, of its words. A pair is accepted in exactly
one partition. Partitions of more than `GROUP_WORDS` words, and windows longer than
`WINDOW_LETTERS`, are halved again, as often as it takes: windows of two letters at most have no more
than some 8,000 words, so no task holds an unbounded group and nothing as large as a vocabulary is
broadcast.

Defined results: null and empty texts have no words, an empty table has none; a null doc_id counts
as an empty id where occurrences are told apart; repeated rows count as often as they occur; ties go
to the word that comes first in code-point order; other columns of the documents are not read. Words
of any length are taken.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evpipe.llm.util import small_batches, stage
from evpipe.llm.words import Block, lower_ascii, row_slices, text_bytes

LEAST_LETTERS = 6
LEAST_COUNT = 5
# A form is at least so many times as frequent as its variant.
FORM_RATIO = 5
# One occurrence in so many loses a letter.
SLIP_EVERY = 199
BLOCK_BYTES = 4 << 20
GROUP_WORDS = 20_000
WINDOW_LETTERS = 128
# Bytes of a run up to which checksums are worked out for all runs at once.
_SHORT_RUN = 64


def letter_runs(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Maximal runs `[A-Za-z\\u00C0-\\u00FF]+`, A-Z lower-cased, some rows at a time.

    In UTF-8 the letters beyond ASCII are the byte C3 and the one behind it.
    """
    letters = np.zeros(256, bool)
    letters[0x41:0x5B] = letters[0x61:0x7B] = True
    raw, all_offsets = text_bytes(column)
    for rows in row_slices(all_offsets, most):
        offsets = all_offsets[rows.start : rows.stop + 1]
        data = lower_ascii()[raw[offsets[0] : offsets[-1]]]
        offsets = offsets - offsets[0]
        inside = letters[data]
        lead = np.flatnonzero(data == 0xC3)
        inside[lead] = inside[lead + 1] = True
        edges = np.zeros(len(data) + 1, bool)  # where a row begins
        edges[offsets[:-1]] = True
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | edges[1:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | edges[1:-1]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        yield Block(rows, data, offsets, starts, ends, np.searchsorted(starts, offsets))


def crc_table() -> np.ndarray:
    """The steps of the checksum by one byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


def checksums(block: Block, before: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """crc32 of each run of a block behind bytes whose crc32 is `before` of the run's row."""
    table, size = crc_table(), block.ends - block.starts
    order = np.argsort(-size, kind="stable")
    order = order[size[order] <= _SHORT_RUN]
    state = before[rows] ^ np.uint32(0xFFFFFFFF)
    lengths, starts = size[order], block.starts[order]
    some = state[order]
    for k in range(int(lengths.max(initial=0))):
        n = int(np.searchsorted(-lengths, -k, side="left"))  # runs longer than k
        byte = block.data[starts[:n] + k]
        some[:n] = table[(some[:n] ^ byte) & np.uint32(0xFF)] ^ (some[:n] >> np.uint32(8))
    state[order] = some
    state ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > _SHORT_RUN).tolist():
        run = block.data[block.starts[i] : block.ends[i]]
        state[i] = zlib.crc32(run.tobytes(), int(before[rows[i]]))
    return state


def _block_counts(block: Block, keys: list, least: int, every: int) -> Counter:
    """How often each word occurs in a block. Equal runs are found by a 64-bit fingerprint."""
    points = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))
    letters = points[block.ends] - points[block.starts]
    rows = np.repeat(np.arange(len(block.first) - 1), block.counts())
    long = np.flatnonzero(letters >= least)
    some = Block(block.rows, block.data, block.offsets, block.starts[long], block.ends[long],
                 block.first)
    letters, rows = letters[long], rows[long]
    before = np.array(
        [zlib.crc32(f"{'' if k is None else k}:".encode()) for k in keys], dtype=np.uint32
    )
    sums = checksums(some, before, rows)
    slips = sums % np.uint32(every) == 0
    raw, found = some.data.tobytes(), Counter()
    whole = np.flatnonzero(~slips)
    _, where, counts = np.unique(some.codes()[whole], return_index=True, return_counts=True)
    for i, n in zip(whole[where].tolist(), counts.tolist(), strict=True):
        found[raw[some.starts[i] : some.ends[i]].decode()] += n
    for i in np.flatnonzero(slips & (letters > least)).tolist():
        word, gone = raw[some.starts[i] : some.ends[i]].decode(), int(sums[i]) % int(letters[i])
        found[word[:gone] + word[gone + 1 :]] += 1
    return found


def vocabulary(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT, every: int = SLIP_EVERY,
) -> DataFrame:
    """`word`, `n`: the words of at least so many letters that occur so often. An occurrence whose
    crc32 (of `<key>:<word>`) `every` divides loses the letter at that crc32 modulo its length."""
    small_batches(docs.sparkSession)
    picked = docs.select(docs[key].cast("string").alias("k"), docs[text].alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in letter_runs(batch.column(1)):
                keys = batch.column(0).slice(block.rows.start, len(block.first) - 1).to_pylist()
                found = _block_counts(block, keys, least_letters, every)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                    ["word", "n"],
                )

    counts = picked.mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


class Acceptor:
    """The minimal automaton of strings given in ascending order, each once. State `s` has the
    arcs `arcs[s]` and is final or not by `final[s]`."""

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict = {}
        path: list[list] = [[False, []]]  # states that may still get arcs: final, arcs
        letters = ""

        def close(depth: int) -> None:
            while len(path) > depth:
                end, arcs = path.pop()
                key = end, tuple(arcs)
                state = known.get(key)
                if state is None:
                    state = known[key] = len(self.arcs)
                    self.arcs.append(dict(arcs))
                    self.final.append(end)
                if path:
                    path[-1][1].append((letters[len(path) - 1], state))
                else:
                    self.start = state

        for string in strings:
            same, most = 0, min(len(string), len(letters))
            while same < most and string[same] == letters[same]:
                same += 1
            close(same + 1)
            letters = string
            path.extend([False, []] for _ in range(len(string) - same))
            path[-1][0] = True
        close(0)


class OneEdit:
    """The pairs that acceptor, one-edit transducer and acceptor accept in composition.

    Before the edit both sides are in the same state, as they have read the same; behind it they
    read the same again. States in composition are looked at once each.
    """

    def __init__(self, acceptor: Acceptor):
        self.arcs, self.final = acceptor.arcs, acceptor.final
        self.start = acceptor.start
        self.same: dict[tuple[int, int], list[str]] = {}
        self.edited: dict[int, set[tuple[str, str]]] = {}

    def common(self, p: int, q: int) -> list[str]:
        """What is accepted from both states."""
        key = (p, q) if p < q else (q, p)
        found = self.same.get(key)
        if found is None:
            found = [""] if self.final[p] and self.final[q] else []
            other = self.arcs[q]
            for letter, state in self.arcs[p].items():
                if letter in other:
                    found += [letter + rest for rest in self.common(state, other[letter])]
            self.same[key] = found
        return found

    def pairs(self, p: int | None = None) -> set[tuple[str, str]]:
        """Each pair once, the smaller string first, with what is read from state `p` on."""
        p = self.start if p is None else p
        found = self.edited.get(p)
        if found is not None:
            return found
        found, arcs = set(), list(self.arcs[p].items())
        for i, (letter, state) in enumerate(arcs):
            found.update((letter + x, letter + y) for x, y in self.pairs(state))
            for other, second in arcs[i + 1 :]:
                found.update((letter + x, other + x) for x in self.common(state, second))
            for x in self.common(state, p):
                longer = letter + x
                found.add((longer, x) if longer < x else (x, longer))
        self.edited[p] = found
        return found


def _halves(rows: DataFrame) -> DataFrame:
    """Each word in the partitions of its halves. A row has `path`, the halves taken so far, and the
    letters of the word outside the window, `front` and `back`."""
    size = F.length("window")
    halves = F.array_distinct(F.array(F.floor(size / 2), F.floor((size - 1) / 2))).cast("array<int>")
    sides = F.when(F.col("m") > 0, F.array(F.lit("f"), F.lit("b"))).otherwise(F.array(F.lit("f")))
    cut = rows.withColumn("m", F.explode(halves)).withColumn("side", F.explode(sides))
    m, rest = F.col("m"), F.length("window") - F.col("m")
    first, last = F.substring("window", F.lit(1), m), F.substring("window", rest + 1, m)

    def either(in_front, behind):
        return F.when(F.col("side") == "f", in_front).otherwise(behind)

    return cut.select(
        F.concat("path", "side", m.cast("string"), F.lit(".")).alias("path"),
        either(F.concat("front", first), F.col("front")).alias("front"),
        either(F.col("back"), F.concat(last, "back")).alias("back"),
        either(
            F.substring("window", m + 1, rest), F.substring("window", F.lit(1), rest)
        ).alias("window"),
        "n",
    )


def accepts(path: str, first: str, second: str) -> bool:
    """Whether this is the one partition for the pair: at each step the half of the shorter window
    was taken, and it was the first one unless the windows differ there."""
    for step in path.split(".")[:-1]:
        side, m = step[0], int(step[1:])
        if m != min(len(first), len(second)) // 2:
            return False
        if (side == "f") != (first[:m] == second[:m]):
            return False
        if side == "f":
            first, second = first[m:], second[m:]
        else:
            first, second = first[: len(first) - m], second[: len(second) - m]
    return True


def _window_pairs(path: str, front: str, back: str, words: list[tuple[str, int]]) -> Iterator[tuple]:
    """The pairs of a partition, both ways round."""
    n = dict(words)
    for x, y in OneEdit(Acceptor([w for w, _ in words])).pairs():
        first, second = front + x + back, front + y + back
        if accepts(path, first, second):
            yield first, n[x], second, n[y]
            yield second, n[y], first, n[x]


def near_pairs(
    words: DataFrame, group_words: int = GROUP_WORDS, window_letters: int = WINDOW_LETTERS
) -> DataFrame:
    """`word`, `n`, `near`, `near_n` for all pairs of distinct `word` with one edit between them,
    each pair both ways round. `words` has each word once, with its `n`."""
    key = ["path", "front", "back"]
    found = None
    rows = words.select(
        F.lit("").alias("path"), F.lit("").alias("front"), F.lit("").alias("back"),
        F.col("word").alias("window"), "n",
    )
    while True:
        rows = stage(_halves(rows), "halves")
        size = F.max(F.length("window"))
        groups = rows.groupBy(*key).agg(F.count("*").alias("words"), size.alias("letters"))
        # At most one in `group_words` of the rows, and keys with very long words.
        large = stage(
            groups.filter(
                f"letters > 2 and words > 1 and (words > {group_words} or letters > {window_letters})"
            ).select(*key), "large",
        )
        some = large.isEmpty()
        left = rows if some else rows.join(large, key, "left_anti")
        pairs = _enumerated(left, key)
        found = pairs if found is None else found.unionByName(pairs)
        if some:
            return found
        rows = rows.join(large, key, "left_semi")


def _enumerated(rows: DataFrame, key: list[str]) -> DataFrame:
    ordered = rows.repartition(*key).sortWithinPartitions(*key, "window")
    columns = ordered.select(*key, "window", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def out(made: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*made, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                ["word", "n", "near", "near_n"],
            )

        made: list[tuple] = []
        for (path, front, back), group in groupby(each(), key=lambda r: r[:3]):
            words = [(r[3], r[4]) for r in group]
            if len(words) > 1:
                made.extend(_window_pairs(path, front, back, words))
            if len(made) > 20_000:
                yield out(made)
                made = []
        if made:
            yield out(made)

    return columns.mapInArrow(run, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """`word`, `root` for the `word`, `form` given: the last word that the forms lead to.

    Each step leads to a word several times as frequent, so no chain is longer than the logarithm
    of the largest count, and each round doubles how far a word looks.
    """
    known = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = known.join(ahead, "root", "left")
        known = stage(joined.select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if known.filter("next is not null").isEmpty():
            return known.select("word", "root")
        known = known.select("word", "root")


def variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near`, `form_n` for each row of `word`, `n`.

    The form is the near word of largest n, if that is at least `ratio` times the word's own.
    """
    words = stage(words.select("word", "n"), "vocabulary")
    often = F.col("near_n") >= F.lit(ratio) * F.col("n")
    best = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))
    near = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.when(often, best)).alias("best")
    )
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"),
    )
    found = stage(joined, "forms")
    ends = roots(found.filter("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
