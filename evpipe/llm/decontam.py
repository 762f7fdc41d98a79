"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document. One row of it covers a block of documents and keeps, for
each word of the block, the sorted positions at which it stands (its postings). `build_index` can
be stored and asked any number of times. A phrase is looked up in a block by starting from the
rarest of its words there, moving that word's postings back by its offset in the phrase, and
intersecting with the equally moved postings of the next rarest word, until all words are used or no
start is left. Blocks are independent, so neither building nor asking needs a shuffle of texts; the
phrases travel to the blocks in portions of at most `PORTION_WORDS` words, each a broadcast of
bounded size.

`search_near` asks the same index a looser question: where do all words of an item stand within a
given number of words, in any order. There the items do not pass the driver: each goes, by its word
that is rarest in all documents, to the blocks that hold this word.

Defined results: null and word-free texts have no words and are never hit; an item without words
takes no part; equal items are all listed; rows with equal ids are judged one by one; an item with a
null id hits words but is left out of the list. Further input columns do not matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evpipe.llm.util import ragged, small_batches, stage
from evpipe.llm.words import letter_words, lower_ascii, word_blocks

WINDOW = 10
PORTION_WORDS = 2_000_000
# Words of the items that one task asks a block about in `search_near`; more are dealt over tasks.
ASKED_WORDS = 1_000_000

Portion = list[tuple[bytes, list[str]]]


class Postings:
    """The postings of one block of rows: `places[bounds[i]:bounds[i + 1]]` belong to word `i`."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, places: np.ndarray, first: np.ndarray):
        self.words, self.places, self.first = words, places, first
        self.bounds = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        self.row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))

    @classmethod
    def of(cls, codes: np.ndarray, first: np.ndarray) -> Postings:
        order = np.argsort(codes, kind="stable")
        words, counts = np.unique(codes, return_counts=True)
        return cls(words, counts, order, first)

    def lists(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and length of the postings of each word, length 0 where it does not occur."""
        if not len(self.words):
            return np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        there = self.words[at] == words
        return self.bounds[at], np.where(there, self.bounds[at + 1] - self.bounds[at], 0)

    def phrase(self, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Starts of the exact occurrences, within one row, of the phrase with these postings."""
        if not len(count) or not count.all():
            return np.empty(0, dtype=np.int64)
        order = np.argsort(count, kind="stable")
        rare = int(order[0])
        starts = self.places[begin[rare] : begin[rare] + count[rare]] - rare
        starts = starts[(starts >= 0) & (starts + len(count) <= len(self.row_of))]
        for i in order[1:]:
            listed = self.places[begin[i] : begin[i] + count[i]]
            at = np.minimum(np.searchsorted(listed, starts + i), count[i] - 1)
            starts = starts[listed[at] == starts + i]
            if not len(starts):
                return starts
        return starts[self.row_of[starts] == self.row_of[starts + len(count) - 1]]

    def proximity(self, words: np.ndarray, within: int) -> list[tuple[int, int, int]]:
        """(row, first, last) of stretches of at most `within` words of one row that hold every
        distinct word, the shortest one for each place at which such a stretch can end."""
        wanted = np.unique(words)
        begin, count = self.lists(wanted)
        if not len(wanted) or not count.all():
            return []
        lists = [self.places[b : b + c] for b, c in zip(begin, count, strict=True)]
        merged = heapq.merge(*([(int(p), k) for p in x] for k, x in enumerate(lists)))
        latest: dict[int, int] = {}
        found = []
        for place, k in merged:
            latest[k] = place
            low = min(latest.values())
            row = int(self.row_of[place])
            if len(latest) == len(lists) and place - low < within and self.row_of[low] == row:
                base = int(self.first[row])
                found.append((row, low - base, place - base))
        return found


class PhraseSet:
    """A portion of phrases, ready to be looked up in blocks."""

    def __init__(self, part: Portion):
        self.names = [[x for x in names if x is not None] for _, names in part]
        codes = [np.frombuffer(words, np.uint64) for words, _ in part]
        self.lengths = np.array([len(c) for c in codes], dtype=np.int64)
        flat = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        self.vocabulary, self.ids = np.unique(flat, return_inverse=True)
        self.begin = np.concatenate(([0], np.cumsum(self.lengths)))

    def find(self, index: Postings) -> tuple[np.ndarray, dict[int, set[str]]]:
        """The hit words of a block, and by row the items with phrases that occur in it."""
        n = len(index.row_of)
        edges = np.zeros(n + 1, dtype=np.int64)
        named: dict[int, set[str]] = {}
        begin, count = index.lists(self.vocabulary)
        if len(self.lengths):
            # A phrase whose rarest word is absent ends here, all of them in one step.
            rarest = np.minimum.reduceat(count[self.ids], self.begin[:-1])
            for k in np.flatnonzero(rarest):
                ids = self.ids[self.begin[k] : self.begin[k + 1]]
                starts = index.phrase(begin[ids], count[ids])
                if len(starts):
                    np.add.at(edges, starts, 1)
                    np.add.at(edges, starts + len(ids), -1)
                    for row in np.unique(index.row_of[starts]).tolist():
                        named.setdefault(row, set()).update(self.names[k])
        return np.cumsum(edges[:-1]) > 0, named


def phrases_of(items: DataFrame, window: int, item: str, text: str) -> DataFrame:
    """Distinct windows of the items: `item` and `words`, the fingerprints as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words = [], []
            for block in word_blocks(batch.column(1), letter_words(), lower_ascii()):
                codes = block.codes()
                for row, (a, b) in enumerate(zip(block.first, block.first[1:], strict=False)):
                    name = batch.column(0)[block.rows.start + row].as_py()
                    for i in range(a, max(a, b - window) + 1 if b > a else a):
                        ids.append(name)
                        words.append(codes[i : min(i + window, b)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(words, pa.binary())], ["item", "words"]
            )

    picked = items.select(F.col(f"`{item}`").cast("string"), F.col(f"`{text}`"))
    return picked.mapInArrow(run, "item string, words binary").distinct()


def portions(phrases: DataFrame) -> Iterator[Portion]:
    """The windows with their items, in portions of a bounded number of words."""
    words = phrases.agg(F.sum(F.length("words") / 8 + 1)).first()[0] or 0
    if words <= PORTION_WORDS:
        # One portion: fetched at once instead of task by task.
        rows = sorted(phrases.collect(), key=lambda r: (bytes(r["words"]), r["item"] or ""))
    else:
        rows = phrases.orderBy("words", "item").toLocalIterator()
    held, size = [], 0
    for row in rows:
        words = bytes(row["words"])
        if held and held[-1][0] == words:
            held[-1][1].append(row["item"])
        else:
            if size >= PORTION_WORDS:
                yield held
                held, size = [], 0
            held.append((words, [row["item"]]))
        size += 1 + len(words) // 8
    yield held


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index, one row for each block of about a MB of text.

    `ids`: the documents; `first`: the first word of each, and the number of words; `words`,
    `counts`: the distinct words and how often each stands in the block; `places`: their postings,
    each list as differences.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in word_blocks(batch.column(1), letter_words(), lower_ascii()):
                index = Postings.of(block.codes(), block.first)
                steps = np.diff(index.places, prepend=0)
                opens = index.bounds[:-1]
                steps[opens] = index.places[opens]
                ids = batch.column(0).slice(block.rows.start, block.rows.stop - block.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        ragged(ids, [0, len(ids)]),
                        ragged(block.first, [0, len(block.first)], pa.int64()),
                        pa.array([index.words.tobytes()], pa.binary()),
                        pa.array([np.diff(index.bounds).astype(np.int32).tobytes()], pa.binary()),
                        pa.array([steps.astype(np.int32).tobytes()], pa.binary()),
                    ],
                    ["ids", "first", "words", "counts", "places"],
                )

    picked = docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`"))
    schema = "ids array<long>, first array<long>, words binary, counts binary, places binary"
    return picked.mapInArrow(run, schema)


def open_index(first: list, words: bytes, counts: bytes, places: bytes) -> Postings:
    steps = np.frombuffer(places, np.int32).astype(np.int64)
    counts = np.frombuffer(counts, np.int32)
    opens = np.concatenate(([0], np.cumsum(counts)))[:-1].astype(np.int64)
    total = np.cumsum(steps)
    before = np.where(opens > 0, total[opens - 1], 0) if len(opens) else opens
    listed = total - np.repeat(before, counts)
    return Postings(np.frombuffer(words, np.uint64), counts, listed, np.asarray(first))


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, item: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """One row per indexed document: `doc_id`, `n_words`, `n_hit`, `hit_items`, `hit_mask`."""
    # Each portion of phrases is a pass over the blocks that adds what it finds to the block's row.
    found = index.withColumns({"hits": F.lit(None).cast("binary"), "items": F.lit(None).cast(_ITEMS)})
    names = found.columns
    for part in portions(phrases_of(items, window, item, item_text)):
        shared = index.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked = PhraseSet(shared.value)
            for batch in batches:
                for r in range(batch.num_rows):
                    row = batch.slice(r, 1)
                    _, first, words, counts, places, bits, listed = (c[0] for c in row.columns)
                    opened = open_index(
                        first.values.to_numpy(), words.as_py(), counts.as_py(), places.as_py()
                    )
                    hit, named = asked.find(opened)
                    if bits.is_valid:
                        hit |= np.unpackbits(np.frombuffer(bits.as_py(), np.uint8), count=len(hit)) > 0
                        for k, old in enumerate(listed.as_py()):
                            named.setdefault(k, set()).update(old)
                    rows = [sorted(named.get(k, ())) for k in range(len(opened.first) - 1)]
                    yield pa.RecordBatch.from_arrays(
                        [*row.columns[:5], pa.array([np.packbits(hit).tobytes()], pa.binary()),
                         pa.array([rows], pa.list_(pa.list_(pa.string())))],
                        names,
                    )

        found = found.mapInArrow(run, found.schema)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, first, *_, bits, listed = (c[r] for c in batch.columns)
                bounds = first.values.to_numpy()
                hit = np.unpackbits(np.frombuffer(bits.as_py(), np.uint8), count=bounds[-1]) > 0
                yield pa.RecordBatch.from_arrays(
                    [ids.values, *_rows(hit, listed.as_py(), bounds)],
                    ["doc_id", "n_words", "n_hit", "hit_items", "hit_mask"],
                )

    schema = "doc_id long, n_words long, n_hit long, hit_items array<string>, hit_mask binary"
    return found.select("ids", "first", "hits", "items").mapInArrow(unpack, schema)


def _distinct_words(items: DataFrame, item: str, text: str) -> DataFrame:
    """`item` and `words`, its distinct words in order; items without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in word_blocks(batch.column(1), letter_words(), lower_ascii()):
                codes = block.codes().view(np.int64)
                sets = [
                    np.unique(codes[a:b]) for a, b in zip(block.first, block.first[1:], strict=False)
                ]
                names = batch.column(0).slice(block.rows.start, len(sets))
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
                flat = np.concatenate(sets)
                yield pa.RecordBatch.from_arrays(
                    [names, ragged(flat, offsets, pa.int64())], ["item", "words"]
                )

    picked = items.select(F.col(f"`{item}`").cast("string"), F.col(f"`{text}`"))
    found = picked.mapInArrow(run, "item string, words array<long>")
    return found.filter(F.size("words") > 0).distinct()


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            block, words, counts = (c[r].as_py() for c in batch.columns)
            words, counts = np.frombuffer(words, np.int64), np.frombuffer(counts, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(words), block)), pa.array(words), pa.array(counts, pa.int64())],
                ["block", "word", "n"],
            )


def search_near(index: DataFrame, items: DataFrame, within: int, item: str = "item_id",
                item_text: str = "text") -> DataFrame:
    """`doc_id`, `item`, `first`, `last`: stretches of at most `within` words of one document that
    hold every distinct word of an item, in any order; positions count words from 0.

    For each place at which such a stretch can end there is one row, with the shortest stretch.
    `index` is a stored `build_index`. Items without words, and those with more distinct words than
    `within`, match nothing; an item with a null id is reported with a null `item`; items of equal id
    and words count once, those of equal ids and different words are all reported. Documents that are
    repeated are reported one by one.
    """
    # Equal blocks share an id, and with it what they are asked about, which is the same.
    blocks = index.withColumn("block", F.xxhash64(*index.columns))
    asked = stage(
        _distinct_words(items, item, item_text).filter(F.size("words") <= within), "asked-items"
    )
    terms = asked.select(F.explode("words").alias("word")).distinct()
    held = blocks.select("block", "words", "counts").mapInArrow(
        _block_words, "block long, word long, n long"
    )
    held = stage(held.join(terms, "word"), "asked-words")
    frequency = held.groupBy("word").agg(F.sum("n").alias("n"))
    # An item with a word that stands nowhere matches nothing.
    word_of = asked.select("item", "words", F.explode("words").alias("word"))
    rarest = word_of.join(frequency, "word", "left").groupBy("item", "words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")).alias("rare")
    ).filter("rare.n > 0")
    rarest = rarest.select("item", "words", F.col("rare.word").alias("word"))
    met = stage(rarest.join(held.select("word", "block").distinct(), "word").drop("word"), "met-items")
    # A block that very many items meet is asked in several tasks.
    parts = met.groupBy("block").agg(F.ceil(F.sum(F.size("words")) / ASKED_WORDS).alias("parts"))
    part = F.pmod(F.xxhash64("item", "words"), F.col("parts")).cast("int").alias("part")
    dealt = met.join(parts, "block").select("block", part, "item", "words")
    copies = blocks.select("block", "ids", "first", F.col("words").alias("vocabulary"), "counts", "places")
    copies = copies.join(parts, "block").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("part")
    ).drop("parts")
    schema = "doc_id long, item string, first long, last long"

    def near(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        return _near_in_blocks(blocks, asked, within)

    both = copies.groupBy("block", "part").cogroup(dealt.groupBy("block", "part"))
    return both.applyInArrow(near, schema)


def _near_in_blocks(blocks: pa.Table, asked: pa.Table, within: int) -> pa.Table:
    ids, names, firsts, lasts = [], [], [], []
    for row in blocks.to_pylist():
        opened = open_index(row["first"], row["vocabulary"], row["counts"], row["places"])
        for name, words in zip(asked["item"], asked["words"], strict=True):
            codes = words.values.to_numpy().view(np.uint64)
            for r, low, high in opened.proximity(codes, within):
                ids.append(row["ids"][r])
                names.append(name.as_py())
                firsts.append(low)
                lasts.append(high)
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "item": pa.array(names, pa.string()),
        "first": pa.array(firsts, pa.int64()), "last": pa.array(lasts, pa.int64()),
    })


_ITEMS = "array<array<string>>"


def _rows(hit: np.ndarray, listed: list[list[str]], first: np.ndarray) -> list[pa.Array]:
    ahead = np.concatenate(([0], np.cumsum(hit)))
    n_hit = ahead[first[1:]] - ahead[first[:-1]]
    masks = [
        np.packbits(hit[a:b]).tobytes() if n else b""
        for a, b, n in zip(first[:-1], first[1:], n_hit, strict=True)
    ]
    return [
        pa.array(np.diff(first), pa.int64()), pa.array(n_hit, pa.int64()),
        pa.array(listed, pa.list_(pa.string())), pa.array(masks, pa.binary()),
    ]


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest of a stored index searched for all items, one row per document."""
    found = search(stage(build_index(docs), "postings"), items)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text",
                      item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no window of any item, with their columns unchanged.

    The index of a block lives in the task only: each row is asked about once.
    """
    small_batches(docs.sparkSession)
    for part in portions(phrases_of(items, window, item, item_text)):
        shared = docs.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked = PhraseSet(shared.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for block in word_blocks(batch.column(text), letter_words(), lower_ascii()):
                    hit, _ = asked.find(Postings.of(block.codes(), block.first))
                    ahead = np.concatenate(([0], np.cumsum(hit)))
                    keep[block.rows] = ahead[block.first[1:]] == ahead[block.first[:-1]]
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
