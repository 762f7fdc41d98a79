"""Static range asymmetric numeral system over token ids, with interleaved lanes.

A block is coded by `lanes` states side by side: id `i` belongs to lane `i % lanes`, and step `t`
codes one id in every lane. A state is a 64-bit number of at least 2**31; what is shifted out goes
in 32-bit words to one stream, step by step and within a step by lane, in the order in which the
decoder asks for it. All blocks share one frequency table. A checkpoint keeps the states and the
place in the stream before some step, so that a block can be decoded from several places at once;
each stretch between checkpoints has a crc32 of its ids.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

LOWEST = np.uint64(1 << 31)
WORD = np.uint64(32)
MOST_LANES = 1024
CHECKPOINT_STEPS = 128


@dataclass
class Table:
    """Frequencies that sum to 2**bits; `symbols` are the ids that have one."""

    bits: int
    symbols: np.ndarray
    freq: np.ndarray

    def __post_init__(self):
        self.cum = np.concatenate(([0], np.cumsum(self.freq)))[:-1].astype(np.uint64)
        self.freq = self.freq.astype(np.uint64)
        # The place of each id in `symbols`, -1 where it has none.
        self.number = np.full(int(self.symbols.max(initial=-1)) + 1, -1, dtype=np.int32)
        self.number[self.symbols] = np.arange(len(self.symbols))

    def slots(self) -> np.ndarray:
        """The number of the symbol that owns each slot."""
        return np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq.astype(np.int64))


def quantise(symbols: np.ndarray, counts: np.ndarray) -> Table:
    """Counts scaled to a power of two, at least 1 for each symbol that occurs."""
    bits = max(16, int(np.ceil(np.log2(max(4 * len(symbols), 1)))))
    spare = (1 << bits) - len(symbols)
    total = int(counts.sum())
    freq = 1 + np.array([int(c) * spare // total for c in counts.tolist()], dtype=np.int64)
    if len(freq):
        freq[int(freq.argmax())] += (1 << bits) - int(freq.sum())
    return Table(bits, symbols.astype(np.int64), freq)


@dataclass
class Coded:
    n: int
    lanes: int
    words: np.ndarray
    states: np.ndarray
    # Before step k * CHECKPOINT_STEPS, k = 1, 2, ...: a row of states and the place in `words`.
    check_states: np.ndarray
    check_places: np.ndarray
    crcs: np.ndarray


def encode(ids: np.ndarray, table: Table) -> Coded:
    """Code the ids of one block. Every id must be in the table."""
    n = len(ids)
    lanes = int(min(max(n // 256, 1), MOST_LANES))
    if n and int(ids.max()) >= len(table.number):
        raise ValueError("an id has no frequency")
    at = table.number[ids]
    if n and int(at.min()) < 0:
        raise ValueError("an id has no frequency")
    freq, cum = table.freq[at], table.cum[at]
    bits, full = np.uint64(table.bits), np.uint64(63 - table.bits)
    x = np.full(lanes, LOWEST, dtype=np.uint64)
    steps = -(-n // lanes)
    out: list[np.ndarray] = [None] * steps
    checks = {}
    for t in range(steps - 1, -1, -1):
        f, c = freq[t * lanes : (t + 1) * lanes], cum[t * lanes : (t + 1) * lanes]
        y = x[: len(f)]
        over = (y >> full) >= f
        out[t] = y[over].astype(np.uint32)
        y = np.where(over, y >> WORD, y)
        q = y // f
        x[: len(f)] = (q << bits) + (y - q * f) + c
        if t and t % CHECKPOINT_STEPS == 0:
            checks[t] = x.copy()
    sizes = np.array([len(w) for w in out], dtype=np.int64)
    ahead = np.concatenate(([0], np.cumsum(sizes)))
    marks = sorted(checks)
    stretch = CHECKPOINT_STEPS * lanes
    return Coded(
        n, lanes, np.concatenate(out) if out else np.empty(0, np.uint32), x,
        np.array([checks[t] for t in marks], dtype=np.uint64).reshape(len(marks), lanes),
        ahead[marks].astype(np.int64) if marks else np.empty(0, np.int64),
        np.array([crc(ids[i : i + stretch]) for i in range(0, n, stretch)], dtype=np.int64),
    )


def crc(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def decode_stretch(coded: Coded, k: int, table: Table, slots: np.ndarray) -> np.ndarray:
    """The ids between checkpoint `k` (0 is the beginning) and the next one."""
    x = (coded.states if k == 0 else coded.check_states[k - 1]).copy()
    place = 0 if k == 0 else int(coded.check_places[k - 1])
    low = k * CHECKPOINT_STEPS * coded.lanes
    high = min(coded.n, low + CHECKPOINT_STEPS * coded.lanes)
    found = np.empty(high - low, dtype=np.int32)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    for i in range(0, high - low, coded.lanes):
        m = min(coded.lanes, high - low - i)
        y = x[:m]
        slot = y & mask
        s = slots[slot]
        found[i : i + m] = s
        y = table.freq[s] * (y >> bits) + slot - table.cum[s]
        short = np.flatnonzero(y < LOWEST)
        if len(short):
            y[short] = (y[short] << WORD) | coded.words[place : place + len(short)]
            place += len(short)
        x[:m] = y
    ids = table.symbols[found]
    if crc(ids) != int(coded.crcs[k]):
        raise ValueError("checksum of a stretch of ids does not match")
    return ids


def decode(coded: Coded, table: Table, slots: np.ndarray) -> np.ndarray:
    parts = [decode_stretch(coded, k, table, slots) for k in range(len(coded.crcs))]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)
