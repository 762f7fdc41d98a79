"""Repeated passages found with suffix automata of reference shards.

A passage is repeated if some window of `window` consecutive words of one document starts anywhere
else too, in the same or another document. All words that such windows cover are removed.

Every window names an anchor, the `GRAM` words in it whose fingerprint is the smallest (the first of
equal ones), so equal windows name equal anchors. The stretch of the windows that one anchor
occurrence answers for is a piece. Anchors that occur once are done with; the pieces of each other
anchor make up one reference shard. A task builds the suffix automaton of a shard's distinct pieces,
with the number of occurrences at each state, and streams the pieces through it for matching
statistics: a window is repeated if the state of its last `window` words counts two or more. A window
can match only inside the shard of its own anchor, so a shard goes to the one task that needs it
rather than to all. Equal pieces are counted before they are shuffled, and each counts as often as
it occurs. An anchor with more than `SHARD_PIECES` distinct pieces is cut finer: its windows become
pieces of their own, each with its own shard.

Defined results: a null or word-free text has no words; texts shorter than a window are kept;
repeated rows are repeated passages; overlapping occurrences in one document count. Rows with equal
ids are judged by their own texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evpipe.llm.util import small_batches, stage
from evpipe.llm.words import Block, gram_hashes, mix, white_space_words, word_blocks

WINDOW = 35
GRAM = 12
SHARD_PIECES = 4096
_PLACE_BITS = 28


class SuffixAutomaton:
    """The suffix automaton of several sequences, with occurrence counts."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _state(self, length: int, after: dict, link: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A copy of state `q` for the sequences that reach it from `p` and shorter ones."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list, times: int) -> None:
        last = 0
        for word in words:
            p, q = last, self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            else:
                last = self._state(self.length[p] + 1, {}, 0)
                while p != -1 and word not in self.next[p]:
                    self.next[p][word] = last
                    p = self.link[p]
                if p != -1:
                    q = self.next[p][word]
                    self.link[last] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            self.count[last] += times

    def settle(self) -> None:
        """Every state counts the ends of all sequences that it is a suffix of."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def occurrences(self, words: list, window: int) -> list[int]:
        """For each window of a sequence of the automaton, how often it occurs."""
        state, found = 0, []
        follow, link, length, count = self.next, self.link, self.length, self.count
        for i, word in enumerate(words):
            state = follow[state][word]
            if i >= window - 1:
                # The shortest suffixes of the state that are still a window long.
                while length[link[state]] >= window:
                    state = link[state]
                found.append(count[state])
        return found


def pieces_of(block: Block, window: int) -> tuple[np.ndarray, ...]:
    """For each piece of a block: its anchor, its row, its first word (within the block) and its
    number of windows."""
    reach = window - GRAM + 1
    grams = gram_hashes(block.codes(), GRAM)
    n = len(grams) - reach + 1
    if n <= 0:
        return tuple(np.empty(0, k) for k in (np.uint64, np.int64, np.int64, np.int64))
    places = np.uint64((1 << _PLACE_BITS) - 1)
    keys = (grams & ~places) | np.arange(len(grams), dtype=np.uint64)
    # The least key of every run of `reach` keys, by runs of powers of two.
    least, width = keys, 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
    anchors = (least & places).astype(np.int64)
    rows = np.repeat(np.arange(len(block.first) - 1), block.counts())
    inside = rows[:n] == rows[window - 1 : window - 1 + n]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return pieces_of(Block(block.rows, block.data[:0], block.offsets, block.starts[:0],
                               block.ends[:0], block.first * 0), window)
    named, row = anchors[starts], rows[starts]
    opens = np.flatnonzero(np.append(True, (named[1:] != named[:-1]) | (row[1:] != row[:-1])))
    sizes = np.diff(np.append(opens, len(starts)))
    return mix(grams[named[opens]]), row[opens], starts[opens], sizes


def _row_keys(docs: DataFrame, text: str) -> DataFrame:
    """Rows by two fingerprints of id and text, which stand for the row from here on."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("doc_id", text, F.lit(1)).alias("k1"),
        F.xxhash64(F.lit(2), text, "doc_id").alias("k2"),
        F.col(text).alias("x"),
    )


def _anchors(docs: DataFrame, text: str, window: int, places: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in word_blocks(batch.column("x"), white_space_words()):
                anchor, row, start, _ = pieces_of(block, window)
                columns = [pa.array(anchor.view(np.int64))]
                if places:
                    own = pa.array(row + block.rows.start)
                    columns += [batch.column("k1").take(own), batch.column("k2").take(own)]
                    columns += [pa.array(start - block.first[row])]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["anchor", "k1", "k2", "at"] if places else ["anchor"]
    keyed = _row_keys(docs, text)
    source = keyed if places else keyed.select("x")
    return source.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _pieces(texts: DataFrame, window: int) -> DataFrame:
    """The pieces of the anchors that are listed in `ats`, with their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in word_blocks(batch.column("x"), white_space_words()):
                anchor, row, start, size = pieces_of(block, window)
                within = start - block.first[row]
                wanted = np.zeros(len(row), dtype=bool)
                lows = np.searchsorted(row, np.arange(len(block.first)))
                for r in range(len(block.first) - 1):
                    a, b = lows[r], lows[r + 1]
                    ats = batch.column("ats")[block.rows.start + r].values.to_numpy()
                    wanted[a:b] = np.isin(within[a:b], ats)
                took = np.flatnonzero(wanted)
                data = block.data.tobytes()
                words, prints = [], []
                for i in took.tolist():
                    a, b = start[i], start[i] + size[i] + window - 1
                    spans = zip(block.starts[a:b].tolist(), block.ends[a:b].tolist(), strict=True)
                    words.append(b" ".join([data[p:q] for p, q in spans]))
                    prints.append(hashlib.blake2b(words[-1], digest_size=16).digest())
                own = pa.array(row[took] + block.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[took].view(np.int64)), pa.array(prints, pa.binary()),
                        batch.column("k1").take(own), batch.column("k2").take(own),
                        pa.array(within[took]), pa.array(words, pa.binary()),
                    ],
                    names,
                )

    schema = "anchor long, print binary, k1 long, k2 long, at long, words binary"
    names = [x.split()[0] for x in schema.split(", ")]
    return texts.mapInArrow(run, schema)


def _match_shards(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by anchor; the distinct pieces of an anchor follow each other."""
        anchor, held = None, []
        out: list[tuple] = []

        def decide() -> None:
            if not held:
                return
            if len(held) == 1 and held[0][1] == 1:
                # One piece met once: only a window that recurs inside it can be repeated.
                words = held[0][2].split(b" ")
                if len(set(words)) == len(words):
                    return
            if len(held) == 1 and held[0][1] > 1:
                n = held[0][2].count(b" ") + 2 - window
                out.append((anchor, held[0][0], (1 << n) - 1))
                return
            shard = SuffixAutomaton()
            texts = [words.split(b" ") for _, _, words in held]
            for (_, times, _), words in zip(held, texts, strict=True):
                shard.add(words, times)
            shard.settle()
            for (name, _, _), words in zip(held, texts, strict=True):
                counts = shard.occurrences(words, window)
                mask = sum(1 << i for i, n in enumerate(counts) if n > 1)
                if mask:
                    out.append((anchor, name, mask))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[], [], []]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()),
                 pa.array(columns[2], pa.int64())],
                ["anchor", "print", "mask"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "print", "times", "words")]
            for key, name, times, words in zip(*columns, strict=True):
                if key != anchor:
                    decide()
                    anchor, held = key, []
                    if len(out) >= 10_000:
                        yield flush()
                held.append((name, times, words))
        decide()
        yield flush()

    return run


def _by_window(pieces: DataFrame, window: int) -> DataFrame:
    """Masks of pieces whose anchor has too many of them: each window is looked up by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("anchor", "print", "times", "words")),
                       strict=True)
            for key, name, times, words in rows:
                split = words.split(b" ")
                for i in range(len(split) - window + 1):
                    one = b" ".join(split[i : i + window])
                    out.append((hashlib.blake2b(one, digest_size=16).digest(), times, key, name, 1 << i))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["w", "times", "anchor", "print", "bit"],
            )

    windows = pieces.mapInArrow(run, "w binary, times long, anchor long, print binary, bit long")
    repeated = windows.groupBy("w").agg(F.sum("times").alias("n")).filter("n > 1").select("w")
    found = windows.join(repeated, "w")
    return found.groupBy("anchor", "print").agg(F.sum("bit").alias("mask"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """`k1`, `k2` of the rows with repeated windows, and `hits`: (first word, mask of windows).

    A window has at least as many words as an anchor, and at most 62 more, as the windows of a piece
    are the bits of a long; others are refused.
    """
    if not GRAM <= window <= GRAM + 62:
        raise ValueError(f"a window has {GRAM} to {GRAM + 62} words, got {window}")
    spark = docs.sparkSession
    small_batches(spark)
    counts = _anchors(docs, text, window, False).groupBy("anchor").agg(F.count("*").alias("n"))
    repeated = stage(counts.filter("n > 1").select("anchor"), "anchors")
    places = _anchors(docs, text, window, True).join(repeated, "anchor")
    listed = places.groupBy("k1", "k2").agg(F.collect_set("at").alias("ats"))
    texts = _row_keys(docs, text).join(listed, ["k1", "k2"])
    pieces = stage(_pieces(texts, window), "pieces")
    distinct = stage(
        pieces.groupBy("anchor", "print").agg(
            F.count("*").alias("times"), F.first("words").alias("words")
        ),
        "distinct",
    )
    hot = distinct.groupBy("anchor").agg(F.count("*").alias("n")).filter(f"n > {SHARD_PIECES}")
    hot = stage(hot.select("anchor"), "hot")
    shards = distinct.join(hot, "anchor", "left_anti")
    shards = shards.repartition("anchor").sortWithinPartitions("anchor", "print")
    masks = shards.mapInArrow(_match_shards(window), "anchor long, print binary, mask long")
    masks = masks.unionByName(_by_window(distinct.join(hot, "anchor", "left_semi"), window))
    masks = stage(masks, "masks")
    met = pieces.select("anchor", "print", "k1", "k2", "at").join(masks, ["anchor", "print"])
    return met.groupBy("k1", "k2").agg(F.collect_set(F.struct("at", "mask")).alias("hits"))


def remove_repeated(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_words`, `n_removed` and `kept`, the words that stay
    joined by single spaces."""
    hits = stage(repeated_windows(docs, window, text), "hits")
    keyed = _row_keys(docs, text)
    joined = keyed.join(hits, ["k1", "k2"], "left").select("doc_id", "x", "hits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("hits")
            for block in word_blocks(batch.column("x"), white_space_words()):
                edges = np.zeros(len(block.starts) + 1, dtype=np.int64)
                for r in range(len(block.first) - 1):
                    for hit in lists[block.rows.start + r].as_py() or ():
                        mask = hit["mask"]
                        for i in range(mask.bit_length()):
                            if mask >> i & 1:
                                at = block.first[r] + hit["at"] + i
                                edges[at] += 1
                                edges[at + window] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                data = block.data.tobytes()
                ahead = np.concatenate(([0], np.cumsum(gone)))
                kept = []
                for a, b in zip(block.first, block.first[1:], strict=False):
                    stay = np.flatnonzero(~gone[a:b]) + a
                    spans = zip(block.starts[stay].tolist(), block.ends[stay].tolist(), strict=True)
                    kept.append(b" ".join([data[p:q] for p, q in spans]).decode("utf-8"))
                size = block.rows.stop - block.rows.start
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.rows.start, size),
                        pa.array(block.counts(), pa.int64()),
                        pa.array(ahead[block.first[1:]] - ahead[block.first[:-1]], pa.int64()),
                        pa.array(kept, pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def digest(docs: DataFrame) -> DataFrame:
    found = remove_repeated(docs.select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
