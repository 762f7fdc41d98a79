"""Words and their fingerprints for whole Arrow batches, without a Python loop over words.

Words are found on the UTF-8 bytes. Every class used here is closed under UTF-8: a byte of 0x80 and
more always belongs to a word, so byte classes and character classes cut a text alike.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa

# Bytes worked on at once: bounds the 8-byte temporaries of a task to a few tens of MB. A single
# longer text is still taken as a whole.
BLOCK_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_MULTIPLIER = 0xD6E8FEB86659FD93
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_GRAM = 0xA0761D6478BD642F
_GRAM_INVERSE = pow(_GRAM, -1, 1 << 64)
_SECOND = 0x9FB21C651E98DF25
_SECOND_INVERSE = pow(_SECOND, -1, 1 << 64)


def white_space_words() -> np.ndarray:
    """Byte class of `[^\\x20\\x09-\\x0D]+`."""
    table = np.ones(256, dtype=bool)
    table[0x20] = False
    table[0x09:0x0E] = False
    return table


def letter_words() -> np.ndarray:
    """Byte class of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`, to be used on lower-cased A-Z."""
    table = np.zeros(256, dtype=bool)
    table[0x30:0x3A] = True
    table[0x61:0x7B] = True
    table[0x80:] = True
    return table


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD & (2**64 - 1)))
_SECOND_VALUES = mix(np.arange(257, 513, dtype=np.uint64) * np.uint64(_ODD))


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, over all tasks it runs.

    Functions travel to the workers by value, so their own module variables start anew in every
    task; an entry of `sys.modules` does not.
    """
    name = "evpipe_worker_cache"
    module = sys.modules.get(name) or sys.modules.setdefault(name, ModuleType(name))
    return module.__dict__.setdefault("kept", {})


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2**64, at least `n` of them; kept, as every block needs them."""
    kept = worker_cache()
    known = kept.get(base)
    if known is None or len(known) < n:
        size = 1 << max(10, (n - 1).bit_length())
        known = np.ones(size, dtype=np.uint64)
        filled = 1
        while filled < size:
            step = np.uint64(pow(base, filled, 1 << 64))
            known[filled : 2 * filled] = known[:filled] * step
            filled *= 2
        kept[base] = known
    return known[:n]


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A fingerprint of each run of `n` consecutive codes."""
    count = len(codes) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    if n <= 8:
        total = codes[:count].copy()
        for i in range(1, n):
            total *= np.uint64(_GRAM)
            total += codes[i : i + count]
        return mix(total)
    ahead = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * powers(_GRAM, len(codes)), out=ahead[1:])
    return mix((ahead[n:] - ahead[:-n]) * powers(_GRAM_INVERSE, count))


class RunSums:
    """Fingerprints of any runs of codes, each from two prefix sums.

    Equal runs have equal fingerprints wherever they stand, also in other blocks. `a`, `i`, `b` are
    arrays of positions with `a <= i < b`.
    """

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.ahead = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes * powers(_GRAM, n), out=self.ahead[1:])
        self.back = powers(_GRAM_INVERSE, n + 2)

    def _sum(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.ahead[b] - self.ahead[a]) * self.back[a]

    def run(self, a: np.ndarray, b: np.ndarray, tag: np.ndarray | int = 0) -> np.ndarray:
        """Of the codes from `a` to `b`, told apart by `tag`."""
        return _closed(self._sum(a, b), b - a, tag)

    def without(self, a: np.ndarray, i: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the codes from `a` to `b` that lack the one at `i`: `run` of that shorter sequence."""
        rest = self.ahead[b] - self.ahead[i + 1]
        return _closed(self._sum(a, i) + rest * self.back[a + 1], b - a - 1, 0)


def _closed(total: np.ndarray, n: np.ndarray, tag: np.ndarray | int) -> np.ndarray:
    kind = np.asarray(tag).astype(np.uint64) * np.uint64(_SECOND)
    return mix(mix(total + n.astype(np.uint64) * np.uint64(_ODD)) + kind)


@dataclass
class Block:
    """Some whole rows of a batch. Word `i` is `data[starts[i]:ends[i]]`; row `r` has the words
    from `first[r]` to `first[r + 1]`."""

    rows: slice
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def codes(self, second: bool = False) -> np.ndarray:
        """64-bit fingerprints of the words; `second` gives others, independent of the first."""
        if not len(self.starts):
            return np.empty(0, dtype=np.uint64)
        n = len(self.data)
        values, base, inverse = _BYTE_VALUES, _MULTIPLIER, _INVERSE
        if second:
            values, base, inverse = _SECOND_VALUES, _SECOND, _SECOND_INVERSE
        ahead = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[self.data] * powers(base, n), out=ahead[1:])
        total = (ahead[self.ends] - ahead[self.starts]) * powers(inverse, n)[self.starts]
        return mix(total + (self.ends - self.starts).astype(np.uint64) * np.uint64(_ODD))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else pa.scalar("", column.type))
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, ends.astype(np.int64)


def row_slices(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[slice]:
    """Consecutive rows of about `most` bytes, at least one row each."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield slice(low, high)
        low = high


def word_blocks(
    column: pa.Array, table: np.ndarray, fold: np.ndarray | None = None, most: int = BLOCK_BYTES
) -> Iterator[Block]:
    """The words of a string column, some rows at a time."""
    raw, all_offsets = text_bytes(column)
    for rows in row_slices(all_offsets, most):
        offsets = all_offsets[rows.start : rows.stop + 1]
        data = raw[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        if fold is not None:
            data = fold[data]
        inside = table[data]
        # A word also ends where its row ends.
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        opens[edges] = inside[edges]
        starts = np.flatnonzero(opens)
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        closes[edges - 1] = inside[edges - 1]
        ends = np.flatnonzero(closes) + 1
        first = np.searchsorted(starts, offsets)
        yield Block(rows, data, offsets, starts, ends, first)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


def spans_within(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of `n` words that stay in one row, and the row of each start."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    ahead = np.concatenate(([0], np.cumsum(counts)))
    return first[rows] + np.arange(len(rows)) - ahead[rows], rows
