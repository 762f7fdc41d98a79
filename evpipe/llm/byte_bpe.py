"""Byte-level BPE encoding and decoding through sentencepiece.

A vocabulary of ranks (one base64 token and its rank a line) is written as a sentencepiece BPE model
without any training: every token is a piece in which a letter stands for each byte, its score is
the negative rank, and normalisation is the identity. The library then merges the neighbours of the
best score, the leftmost of equals, which are those of the lowest rank.

Texts are cut into pre-tokens by a pattern, and each pre-token is encoded by itself. One that is a
token of its own gets that id at once, whether or not the merges lead there; all others go through
the model. A worker keeps the ids of the pre-tokens it has met, up to a bound.

Defined results: a null or empty text has no ids, and no ids decode to no bytes; null ids decode to
no bytes. An id outside the vocabulary is refused when decoding. Rows are independent of each other,
so repeated rows and ids give repeated results, an empty table gives an empty one, and columns that
have the names of results are replaced. A long text is cut at the ends of words before it is
matched, so memory follows the block of text and the ids of the longest text, not its pre-tokens.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import sys
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from evpipe.llm.util import add_columns, ragged
from evpipe.llm.words import Block, byte_letters, row_slices, text_bytes, worker_cache

BLOCK_BYTES = 2 << 20
# What a worker keeps: about 40 bytes a pre-token and 4 bytes an id.
PIECES_KEPT = 1_000_000
IDS_KEPT = 8_000_000
# Numbers of fields and kinds in the public format of sentencepiece models.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2
_UNKNOWN_PIECE = "⁇"


def read_ranks(path: str | None = None) -> list[bytes]:
    """The tokens of a rank file in order of rank; by default the public one of many languages.

    Ranks must be 0, 1, 2 and so on, and all single bytes must be tokens.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        found = [line.split() for line in file if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in found}
    tokens = [ranks.get(i) for i in range(len(ranks))]
    if None in tokens or not {bytes([b]) for b in range(256)}.issubset(tokens):
        raise ValueError("ranks must be consecutive and hold every single byte")
    return tokens


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    scored = _varint(2 << 3 | 5) + struct.pack("<f", score)
    return _bytes(_PIECES, _bytes(1, text.encode()) + scored + _number(3, kind))


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model in which piece `i` is `tokens[i]`; the unknown piece comes last.

    Scores are 32-bit floats, so ranks are exact up to 2 ** 24.
    """
    letters = dict(enumerate(byte_letters()))
    pieces = [
        _piece(token.decode("latin-1").translate(letters), -float(rank), _NORMAL)
        for rank, token in enumerate(tokens)
    ]
    pieces.append(_piece(_UNKNOWN_PIECE, 0.0, _UNKNOWN))
    trainer = b"".join(
        [
            _number(3, _BPE), _number(4, len(pieces)), _number(40, len(tokens)),
            _number(41, -1), _number(42, -1), _number(43, -1),
            _bytes(45, _UNKNOWN_PIECE.encode()),
        ]
    )
    # No character map, no space put in front, none removed, none replaced.
    normalizer = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join([*pieces, _bytes(_TRAINER, trainer), _bytes(_NORMALIZER, normalizer)])


def _ranges(codes: list[int]) -> str:
    """The inside of a character class that holds these code points."""
    out, at = [], 0
    while at < len(codes):
        end = at
        while end + 1 < len(codes) and codes[end + 1] == codes[end] + 1:
            end += 1
        out.append(f"\\U{codes[at]:08x}-\\U{codes[end]:08x}")
        at = end + 1
    return "".join(out)


def class_differences() -> dict[str, tuple[str, str]]:
    """Letters and numbers by one library and not by the other: the two follow different versions
    of Unicode. For each class, what only `regex` has and what only `tiktoken` has."""
    import tiktoken

    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    out = {}
    for name in (r"\p{L}", r"\p{N}"):
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs = set(bytes(probe.encode_ordinary(every)).decode())
        ours = set(regex.findall(name, every))
        out[name] = (_ranges(sorted(map(ord, ours - theirs))), _ranges(sorted(map(ord, theirs - ours))))
    return out


def exact_pattern(pattern: str, differences: dict[str, tuple[str, str]]) -> str:
    """`pattern` with its classes of letters and numbers as the other library has them. The
    pattern's own classes may hold them, which version 1 of the syntax allows."""
    for name, (less, more) in differences.items():
        held = f"[{name}{more}]" if more else name
        pattern = pattern.replace(name, f"[{held}--[{less}]]" if less else held)
    return pattern


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _classes() -> np.ndarray:
    """The class of each byte where it tells that of its character: letter, number, white space or
    any other sign; 0 where it doesn't."""
    table = np.zeros(256, np.uint8)
    table[:0x80] = _SIGN
    table[0x30:0x3A] = _DIGIT
    table[0x41:0x5B] = table[0x61:0x7B] = _LETTER
    table[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = _SPACE
    # The regular expressions don't agree on these with the byte classes of other libraries.
    table[0x1C:0x20] = 0
    return table


_LETTER, _DIGIT, _SPACE, _SIGN = 1, 2, 3, 4
# What may follow an apostrophe in a pre-token of its own.
_SHORT, _LONG = [b"s", b"t", b"m", b"d"], [b"re", b"ve", b"ll"]


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts of all pre-tokens by the public pattern, for rows of ASCII and Latin-1 letters,
    and which rows have other characters and must be matched by the pattern itself.

    Pre-tokens leave no gaps: a run of one class, with the space before it. Of white space before
    something else the last character stands alone, or goes with what follows if it is a space.
    """
    kind = _classes()[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    second = data[lead + 1]
    lead = lead[(second != 0x97) & (second != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    odd = np.zeros(len(offsets) - 1, bool)
    odd[np.searchsorted(offsets, np.flatnonzero(kind == 0), side="right") - 1] = True

    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens = np.ones(len(data), bool)
    opens[1:] = kind[1:] != kind[:-1]
    inside = np.ones(len(data), bool)  # not the first byte of a row
    inside[begins] = False
    space = kind == _SPACE
    after = np.flatnonzero(~space[1:] & space[:-1] & inside[1:]) + 1
    opens[begins] = True
    opens[after - 1] = True
    opens[after] = data[after - 1] != 0x20

    quotes = np.flatnonzero((data == 0x27) & opens)
    padded = np.concatenate((data, np.zeros(3, np.uint8)))
    # The byte behind must belong to the row.
    ends = offsets[np.searchsorted(offsets, quotes, side="right")]
    for words in (_SHORT, _LONG):
        n = len(words[0])
        same = np.zeros(len(quotes), bool)
        for word in words:
            same |= np.all([padded[quotes + 1 + k] == x for k, x in enumerate(word)], axis=0)
        found = quotes[same & (quotes + n < ends)]
        opens[found + 1] = False
        behind = found + n + 1
        opens[behind[behind < len(data)]] = True
    return np.flatnonzero(opens), odd


class Codec:
    """Encodes and decodes with a serialised model.

    Pre-tokens are told apart by a 64-bit fingerprint, their length and their first 8 bytes.
    """

    def __init__(self, model: bytes, pattern: str, differences: dict[str, tuple[str, str]]):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = byte_letters()
        back = {ord(letter): b for b, letter in enumerate(letters)}
        self.letters = dict(enumerate(letters))
        n = self.model.get_piece_size() - 1
        self.tokens = [self.model.id_to_piece(i).translate(back).encode("latin-1") for i in range(n)]
        self.ids = {token: i for i, token in enumerate(self.tokens)}
        # The ids as decimal numbers with a comma behind.
        self.shown = [f"{i},".encode() for i in range(n)]
        self.by_bytes = pattern == default_pattern()
        self.pattern = regex.compile(pattern)
        odd = "".join(x + y for x, y in differences.values())
        self.odd = regex.compile(f"[{odd}]") if odd else None
        self.odd_pattern = regex.compile(exact_pattern(pattern, differences), regex.V1)
        self.forget()

    def forget(self) -> None:
        self.codes = np.empty(0, np.uint64)  # ascending
        self.entry = np.empty(0, np.int64)
        self.head = np.empty(0, np.uint64)
        self.size = np.empty(0, np.int64)
        self.begin = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)

    def pieces_of(self, text: str) -> list[bytes]:
        """The pre-tokens by the pattern itself."""
        odd = self.odd is not None and not text.isascii() and self.odd.search(text)
        return [x.encode() for x in (self.odd_pattern if odd else self.pattern).findall(text)]

    def ids_of(self, pieces: list[bytes]) -> list:
        """The ids of each pre-token."""
        ids: list = [(i,) if (i := self.ids.get(x)) is not None else None for x in pieces]
        others = [k for k, found in enumerate(ids) if found is None]
        texts = [pieces[k].decode("latin-1").translate(self.letters) for k in others]
        if texts:
            for k, found in zip(others, self.model.encode(texts, num_threads=1), strict=True):
                ids[k] = found
        return ids

    def add(self, pieces: list[bytes]) -> np.ndarray:
        """Entries of more pre-tokens."""
        ids = self.ids_of(pieces)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        first = len(self.begin)
        self.begin = np.concatenate((self.begin, len(self.flat) + np.cumsum(lengths) - lengths))
        self.length = np.concatenate((self.length, lengths))
        self.size = np.concatenate((self.size, np.fromiter(map(len, pieces), np.int64, len(ids))))
        heads = b"".join(piece[:8].ljust(8, b"\0") for piece in pieces)
        self.head = np.concatenate((self.head, np.frombuffer(heads, "<u8")))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
        self.flat = np.concatenate((self.flat, flat))
        return np.arange(first, len(self.begin))

    def entries(self, block: Block) -> np.ndarray:
        """The entry of each pre-token of a block."""
        codes = block.codes()
        met, where, back = np.unique(codes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.codes, met)
        known = np.zeros(len(met), bool)
        known[at < len(self.codes)] = self.codes[at[at < len(self.codes)]] == met[at < len(self.codes)]
        new = np.flatnonzero(~known)
        if len(new):
            raw = block.data.tobytes()
            low, high = block.starts[where[new]].tolist(), block.ends[where[new]].tolist()
            added = self.add([raw[a:b] for a, b in zip(low, high, strict=True)])
            self.codes = np.insert(self.codes, at[new], met[new])
            self.entry = np.insert(self.entry, at[new], added)
            at = np.searchsorted(self.codes, met)
        entry = self.entry[at][back]
        # Equal fingerprints of different pre-tokens: those go their own way.
        sizes = block.ends - block.starts
        padded = np.concatenate((block.data, np.zeros(8, np.uint8)))
        heads = np.lib.stride_tricks.as_strided(padded, (len(block.data) + 1, 8), (1, 1))
        head = heads[block.starts].view("<u8")[:, 0]
        cut = np.maximum(8 - sizes, 0).astype(np.uint64) * np.uint64(8)
        head = np.where(sizes >= 8, head, (head << cut) >> cut)
        wrong = np.flatnonzero((head != self.head[entry]) | (sizes != self.size[entry]))
        if len(wrong):
            pieces = [block.data[block.starts[i] : block.ends[i]].tobytes() for i in wrong]
            entry[wrong] = self.add(pieces)
        return entry

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some rows, and how many each row has."""
        if len(self.codes) > PIECES_KEPT or len(self.flat) > IDS_KEPT:
            self.forget()
        n = len(offsets) - 1
        starts, odd = np.empty(0, np.int64), np.ones(n, bool)
        if self.by_bytes and len(data):
            starts, odd = split(data, offsets)
        rows = np.searchsorted(offsets, starts, side="right") - 1
        ends = np.append(starts[1:], len(data))[: len(starts)]
        plain = ~odd[rows]
        starts, ends, rows = starts[plain], ends[plain], rows[plain]
        empty = np.empty(0, np.int64)
        found = [self.entries(Block(slice(0, n), data, offsets, starts, ends, empty))]
        places = [rows]
        for row in np.flatnonzero(odd).tolist():
            pieces = self.pieces_of(data[offsets[row] : offsets[row + 1]].tobytes().decode())
            if pieces:
                met = {piece: k for k, piece in enumerate(dict.fromkeys(pieces))}
                added = self.add(list(met))
                found.append(added[np.fromiter(map(met.get, pieces), np.int64, len(pieces))])
                places.append(np.full(len(pieces), row))
        entry, place = found[0], rows
        if len(found) > 1:
            entry, place = np.concatenate(found), np.concatenate(places)
            order = np.argsort(place, kind="stable")
            entry, place = entry[order], place[order]
        lengths = self.length[entry]
        ahead = np.cumsum(lengths)
        shift = np.repeat(self.begin[entry] - ahead + lengths, lengths)
        bounds = np.concatenate(([0], ahead))[np.searchsorted(place, np.arange(n + 1))]
        return self.flat[shift + np.arange(len(shift))], np.diff(bounds)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and the n + 1 offsets of the texts in them."""
        raw, ends = text_bytes(texts)
        cuts = cut_long(raw, ends)
        out, counts = [], []
        for rows in row_slices(cuts, BLOCK_BYTES):
            some = cuts[rows.start : rows.stop + 1]
            ids, sizes = self.encode_block(raw[some[0] : some[-1]], some - some[0])
            out.append(ids)
            counts.append(sizes)
        flat = np.concatenate(out) if out else np.empty(0, np.int32)
        ahead = np.concatenate(([0], np.cumsum(np.concatenate(counts)))) if counts else np.zeros(1)
        # Cuts of a long row count for that row; of rows at one place all but the last are empty.
        return flat, ahead.astype(np.int64)[np.searchsorted(cuts, ends, side="left")]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that a row of ids stands for."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.tokens):
            raise ValueError("an id is not in the vocabulary")
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids of a row as decimal numbers joined by commas."""
        return b"".join(map(self.shown.__getitem__, ids.tolist()))[:-1]


def cut_long(raw: np.ndarray, ends: np.ndarray, most: int | None = None) -> np.ndarray:
    """The offsets of rows, with more of them inside rows beyond `most` bytes. No pre-token
    goes on behind an ASCII letter with an ASCII space or sign, so rows may be cut there."""
    most = most or BLOCK_BYTES
    if not len(ends) or np.diff(ends).max(initial=0) <= 2 * most:
        return ends
    kind = _classes()
    out = [ends[:1]]
    for low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        at = low
        while high - at > 2 * most:
            at = step = at + most
            while True:
                near = raw[step : min(step + 4096, high)]
                ascii_letter = (kind[near[:-1]] == _LETTER)
                safe = np.flatnonzero(ascii_letter & (kind[near[1:]] >= _SPACE))
                if len(safe) or step + 4096 >= high:
                    break
                step += 4095
            if not len(safe):
                break
            at = step + int(safe[0]) + 1
            out.append(np.array([at]))
        out.append(np.array([high]))
    return np.concatenate(out)


def worker_codec(model: bytes, pattern: str, differences: dict) -> Codec:
    kept = worker_cache()
    key = ("byte_bpe", zlib.crc32(model), pattern)
    if key not in kept:
        kept[key] = Codec(model, pattern, differences)
    return kept[key]


def _shared(df: DataFrame, ranks: str | None, pattern: str | None):
    """The model and its pattern for all tasks: the size of the vocabulary file."""
    spec = serialise(read_ranks(ranks)), pattern or default_pattern(), class_differences()
    return df.sparkSession.sparkContext.broadcast(spec)


def encode(
    docs: DataFrame, text: str = "text", ids: str = "ids", ranks: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """`docs` with a column of the ids of `text` (array of int)."""
    shared = _shared(docs, ranks, pattern)

    def make(column: pa.Array) -> list[pa.Array]:
        flat, offsets = worker_codec(*shared.value).encode(column)
        return [ragged(flat, offsets, pa.int32())]

    return add_columns(docs, text, [(ids, "array<int>")], make)


def decode(
    encoded: DataFrame, ids: str = "ids", data: str = "bytes", ranks: str | None = None
) -> DataFrame:
    """`encoded` with a column of the bytes that its ids stand for (binary). The bytes of a cut
    list of ids need not be whole characters."""
    shared = _shared(encoded, ranks, None)

    def make(column: pa.Array) -> list[pa.Array]:
        codec, empty = worker_codec(*shared.value), np.empty(0, np.int32)
        lists = (x.values.to_numpy(zero_copy_only=False) if x.is_valid else empty for x in column)
        return [pa.array([codec.decode(ids) for ids in lists], pa.binary())]

    return add_columns(encoded, ids, [(data, "binary")], make)


def digest(
    docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """`doc_id`, `n_tokens`, `ids_sha256` of the decimal ids joined by commas, and
    `decoded_sha256` of the bytes that the ids decode to."""
    shared = _shared(docs, ranks, pattern)

    def make(column: pa.Array) -> list[pa.Array]:
        codec = worker_codec(*shared.value)
        flat, offsets = codec.encode(column)
        rows = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return [
            pa.array(np.diff(offsets)),
            pa.array([hashlib.sha256(codec.decimals(ids)).hexdigest() for ids in rows], pa.string()),
            pa.array([hashlib.sha256(codec.decode(ids)).hexdigest() for ids in rows], pa.string()),
        ]

    picked = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"))
    fields = [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    return add_columns(picked, "text", fields, make).drop("text")
