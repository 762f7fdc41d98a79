"""Token ids in a compressed binary format.

`write_tokens` encodes every text with a tokenizer, ends each document with one more id and writes
a folder with two tables:

* `table`: `bits`, `symbols`, `freqs`, the one frequency table that all blocks share, made from the
  counts of all ids (8-byte and 4-byte little-endian integers);
* `blocks`: one row per block of whole documents: `start` (ids before the block), `doc_ids`,
  `doc_tokens`, and the block's ids as coded by `evpipe.llm.rans` (`n`, `lanes`, `words`, `states`,
  `check_states`, `check_places`, `crcs`) with `words_crc`, the crc32 of the coded words.

Blocks follow each other by `start`, in ascending order of doc_id. Any block, and any stretch
between two checkpoints of a block, can be decoded without the rest. The blocks are Parquet rows
because Spark reaches every store that way.

Texts are cut into the pre-tokens of byte-level tokenizers, and a worker encodes each distinct one
once, with the tokenizer's model alone; what it keeps is bounded in number and bytes. Texts with
characters beyond ASCII and the letters of Latin-1, or with an added token, are encoded as a whole, and
so is every text with a tokenizer of another kind.

Defined results: a null text is empty and yields the end id alone; a null doc_id comes first; rows
with equal doc_id follow each other by text; a document is never split, so a block holds at least
one document however long. An empty table gives empty tables.
"""

from __future__ import annotations

import gc
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evpipe.llm import rans
from evpipe.llm.byte_bpe import Codec
from evpipe.llm.util import ragged, small_batches, stage
from evpipe.llm.words import byte_letters, row_slices, text_bytes, worker_cache
from evpipe.plans.staging import new_path

END_ID = 2
BLOCK_TOKENS = 1 << 18
TEXT_BYTES = 2 << 20
# Leads a text that the tokenizer gets as a whole; no byte of UTF-8.
_WHOLE = b"\xff"


class PieceEncoder(Codec):
    """Ids of texts by a tokenizer, with the pre-tokens met so far in memory."""

    def __init__(self, tokenizer_json: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        spec = json.loads(tokenizer_json)
        # Found in a text before it is cut, so a text that holds one goes through as a whole.
        self.added = [t["content"].encode() for t in spec.get("added_tokens") or ()]
        before = spec.get("pre_tokenizer") or {}
        self.by_bytes = (
            spec.get("normalizer") is None and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before.get("add_prefix_space")
        )
        self.letters = dict(enumerate(byte_letters()))
        self.end_id = end_id
        self.forget()

    def pieces_of(self, text: str) -> list[bytes]:
        return [_WHOLE + text.encode()]

    def ids_of(self, pieces: list[bytes]) -> list:
        if pieces and pieces[0][:1] == _WHOLE:
            texts = [piece[1:].decode() for piece in pieces]
            return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        tokenize, letters = self.model.tokenize, self.letters
        return [[t.id for t in tokenize(x.decode("latin-1").translate(letters))] for x in pieces]

    def with_added(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """The rows that hold an added token."""
        raw, found = data.tobytes(), set()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, side="right")) - 1
                found.add(row)
                at = raw.find(token, int(offsets[row + 1]))
        return sorted(found)

    def encode_rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some rows, end ids included, and how many belong to each row."""
        # Hundreds of thousands of short lists and no cycle: nothing for the collector to find.
        gc.disable()
        try:
            parts, low, by_bytes = [], 0, self.by_bytes
            for row in [*self.with_added(data, offsets), len(offsets) - 1]:
                for a, b, cut in ((low, row, by_bytes), (row, row + 1, False)):
                    if a < b < len(offsets):
                        self.by_bytes = cut
                        some = offsets[a : b + 1]
                        parts.append(self.encode_block(data[some[0] : some[-1]], some - some[0]))
                low = row + 1
            self.by_bytes = by_bytes
        finally:
            gc.enable()
        flat = np.concatenate([ids for ids, _ in parts])
        counts = np.concatenate([n for _, n in parts])
        return np.insert(flat, np.cumsum(counts), self.end_id), counts + 1


def worker_encoder(tokenizer_json: str, end_id: int) -> PieceEncoder:
    kept, key = worker_cache(), ("encoder", zlib.crc32(tokenizer_json.encode()), end_id)
    if key not in kept:
        kept[key] = PieceEncoder(tokenizer_json, end_id)
    return kept[key]


def token_blocks(
    docs: DataFrame, tokenizer_json: str, end_id: int = END_ID, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Blocks of ids in order: `part`, `at` (ids of the part before the block), the documents with
    their numbers of ids, and the ids as 4-byte integers."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(tokenizer_json)  # one vocabulary file
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").alias("x"))
    # Documents of one id meet in one task: ids are keys, or few copies of one by a mixture.
    ordered = picked.repartitionByRange(parts, "k").sortWithinPartitions("k", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value, end_id)
        part, at = TaskContext.get().partitionId(), 0
        keys, sizes, ids, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part]), pa.array([at]), pa.array([len(flat)]),
                    ragged(pa.concat_arrays(keys), [0, sum(map(len, keys))]),
                    ragged(np.concatenate(sizes), [0, sum(map(len, sizes))], pa.int64()),
                    pa.array([flat.astype("<u4").tobytes()], pa.binary()),
                ],
                ["part", "at", "n", "doc_ids", "doc_tokens", "ids"],
            )

        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for rows in row_slices(offsets, TEXT_BYTES):
                some = offsets[rows.start : rows.stop + 1]
                found, counts = encoder.encode_rows(raw[some[0] : some[-1]], some - some[0])
                ids.append(found)
                sizes.append(counts)
                keys.append(batch.column(0).slice(rows.start, rows.stop - rows.start))
                held += len(found)
                if held >= BLOCK_TOKENS:
                    yield block()
                    at += held
                    keys, sizes, ids, held = [], [], [], 0
        if held:
            yield block()

    schema = "part long, at long, n long, doc_ids array<long>, doc_tokens array<long>, ids binary"
    return ordered.mapInArrow(run, schema)


def id_counts(blocks: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur and how often: at most one row for each id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                found = np.bincount(np.frombuffer(ids.as_py(), "<u4"))
                if len(found) > len(total):
                    total = np.concatenate((total, np.zeros(len(found) - len(total), np.int64)))
                total[: len(found)] += found
        where = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(total[where])], ["id", "n"])

    counts = blocks.select("ids").mapInArrow(run, "id long, n long")
    rows = sorted(counts.groupBy("id").agg(F.sum("n").alias("n")).collect())
    return np.array([r["id"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)


def write_tokens(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = END_ID,
                 key: str = "doc_id", text: str = "text") -> None:
    """Encode `docs` and write them to the folder `path`."""
    spark = docs.sparkSession
    blocks = stage(token_blocks(docs, tokenizer_json, end_id, key, text), "token-ids")
    # One figure for each task of the stage before.
    totals = blocks.groupBy("part").agg(F.sum("n").alias("n")).collect()
    starts, ahead = {}, 0
    for row in sorted(totals):
        starts[row["part"]] = ahead
        ahead += row["n"]
    table = rans.quantise(*id_counts(blocks))
    spark.createDataFrame(
        [(table.bits, bytearray(table.symbols.astype("<i8").tobytes()),
          bytearray(table.freq.astype("<u4").tobytes()))],
        "bits int, symbols binary, freqs binary",
    ).coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast((table.bits, table.symbols, table.freq, starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, symbols, freq, begin = shared.value
        known = rans.Table(bits, symbols, freq)
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                ids = np.frombuffer(row.column(5)[0].as_py(), "<u4").astype(np.int64)
                coded = rans.encode(ids, known)
                words = coded.words.astype("<u4").tobytes()
                start = begin[row.column(0)[0].as_py()] + row.column(1)[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([start]), row.column(3), row.column(4),
                        pa.array([coded.n]), pa.array([coded.lanes]),
                        pa.array([words], pa.binary()),
                        pa.array([coded.states.tobytes()], pa.binary()),
                        pa.array([coded.check_states.tobytes()], pa.binary()),
                        ragged(coded.check_places, [0, len(coded.check_places)], pa.int64()),
                        ragged(coded.crcs, [0, len(coded.crcs)], pa.int64()),
                        pa.array([zlib.crc32(words)], pa.int64()),
                    ],
                    _NAMES,
                )

    coded = blocks.select("part", "at", "n", "doc_ids", "doc_tokens", "ids")
    coded.mapInArrow(run, _SCHEMA).write.option("compression", "none").parquet(f"{path}/blocks")


_SCHEMA = (
    "start long, doc_ids array<long>, doc_tokens array<long>, n long, lanes long, words binary, "
    "states binary, check_states binary, check_places array<long>, crcs array<long>, words_crc long"
)
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]


def read_table(spark: SparkSession, path: str) -> rans.Table:
    row = spark.read.parquet(f"{path}/table").first()
    return rans.Table(
        row["bits"], np.frombuffer(row["symbols"], "<i8"),
        np.frombuffer(row["freqs"], "<u4").astype(np.int64),
    )


def read_tokens(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """One row per document of a folder that `write_tokens` wrote: `doc_id`, `start`, `n_tokens`,
    `ids_crc32`, and with `ids` the ids themselves."""
    table = read_table(spark, path)
    shared = spark.sparkContext.broadcast((table.bits, table.symbols, table.freq))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = rans.Table(*shared.value)
        slots = known.slots()
        for batch in batches:
            for r in range(batch.num_rows):
                (start, keys, sizes, n, lanes, words, states, checks, places, crcs, words_crc) = (
                    c[r] for c in batch.columns
                )
                if zlib.crc32(words.as_py()) != words_crc.as_py():
                    raise ValueError("checksum of a block's words does not match")
                lanes = lanes.as_py()
                coded = rans.Coded(
                    n.as_py(), lanes, np.frombuffer(words.as_py(), "<u4"),
                    np.frombuffer(states.as_py(), "<u8"),
                    np.frombuffer(checks.as_py(), "<u8").reshape(-1, lanes),
                    places.values.to_numpy(), crcs.values.to_numpy(),
                )
                found = rans.decode(coded, known, slots).astype("<u4")
                size = sizes.values.to_numpy()
                bounds = np.concatenate(([0], np.cumsum(size)))
                sums = [
                    zlib.crc32(found[a:b].tobytes())
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                ]
                columns = [
                    keys.values, pa.array(start.as_py() + bounds[:-1], pa.int64()),
                    pa.array(size, pa.int64()), pa.array(sums, pa.int64()),
                ]
                if ids:
                    columns.append(ragged(found.astype(np.int64), bounds, pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    schema += ", ids array<long>" if ids else ""
    names = [x.split()[0] for x in schema.split(", ")]
    blocks = spark.read.schema(_SCHEMA).parquet(f"{path}/blocks")
    return blocks.mapInArrow(run, schema)


def tokenizer_json(path: str | None = None) -> str:
    """The content of a tokenizer file; by default the public byte-level one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def round_trip(docs: DataFrame) -> DataFrame:
    """Write `docs` in the format and read the digest of each document back from the files."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_json())
    return read_tokens(spark, path)
