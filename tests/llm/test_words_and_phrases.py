"""Spelling variants, byte-level BPE and collocations."""

import base64
import hashlib
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import SCHEMA, edge_rows, ordered, tuples

from evpipe.llm import byte_bpe, collocations, spelling, words

WORDS = ["word", "form", "root", "n", "n_near", "form_n"]
BPE = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
PHRASES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    rows = edge_rows()
    more = [*rows, (None, rows[9][1], None, "a", 1, None, None, None, None), (3, "Other ÀÉÿ×÷ ½x", "en", *rows[0][3:])]
    return spark.createDataFrame([*more, *more], SCHEMA)


# 11


def typos(seed, n):
    """Texts of words that are often one or two edits apart."""
    rng = random.Random(seed)
    roots = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(6, 11))) for _ in range(12)]
    out = []
    for i in range(n):
        found = []
        for _ in range(60):
            w = rng.choice(roots[: rng.randrange(1, 12)])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "x", w[k] + "y", "ab"]) + w[k + 1 :]
            found.append(rng.choice([w, w.upper(), w.title()]))
        out.append((i, rng.choice([" ", "1", "×"]).join(found)))
    return out


def test_one_edit_automaton_equals_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        strings = sorted({"".join(rng.choices("abc", k=rng.randrange(6))) for _ in range(rng.randrange(1, 40))})
        acceptor = spelling.Acceptor(strings)
        expected = {(a, b) for a in strings for b in strings if a < b and brute.one_edit(a, b)}
        assert spelling.OneEdit(acceptor).pairs() == expected
        # Minimal: no two states accept the same.
        told = {(e, tuple(a.items())) for e, a in zip(acceptor.final, acceptor.arcs, strict=True)}
        assert len(told) == len(acceptor.arcs)


def test_checksums_equal_zlib():
    import zlib

    texts = pa.array(["abc éÿ " + "x" * 100, None, "", "zz"])
    for block in spelling.letter_runs(texts):
        rows = np.repeat(np.arange(4), block.counts())
        before = np.array([zlib.crc32(f"{i}:".encode()) for i in range(4)], np.uint32)
        found = spelling.checksums(block, before, rows)
        runs = [block.data[a:b].tobytes() for a, b in zip(block.starts, block.ends, strict=True)]
        assert found.tolist() == [zlib.crc32(f"{r}:".encode() + x) for r, x in zip(rows, runs, strict=True)]


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling_equals_brute_force(spark, seed):
    docs = typos(seed, 60)
    table = spark.createDataFrame([(*d, "n") for d in docs], "doc_id long, text string, n string")
    found = spelling.variants(spelling.vocabulary(table, every=7))
    assert tuples(found, *WORDS) == ordered(brute.variants(brute.occurrences(docs, every=7)))


def test_large_groups_and_long_words_are_split(spark):
    docs = typos(5, 80)
    words_ = [(w, n) for w, n in brute.occurrences(docs, 2, 1).items()]
    long = "ab" * 300
    words_ += [(long, 9), (long + "c", 2), (long[:200] + "x" + long[200:], 3), ("x" + long, 1), (long[:-1], 4)]
    table = spark.createDataFrame(words_, "word string, n long")
    for most, letters in ((2, 128), (3, 5), (20_000, 128)):
        pairs = tuples(spelling.near_pairs(table, most, letters), "word", "near")
        assert pairs == ordered((a, b) for a, _ in words_ for b, _ in words_ if a != b and brute.one_edit(a, b))


def test_roots_follow_long_chains(spark):
    rows = [(f"w{i}", f"w{i + 1}") for i in range(20)] + [("x", "w5"), ("y", "z")]
    found = dict(tuples(spelling.roots(spark.createDataFrame(rows, "word string, form string")), "word", "root"))
    assert found == {**{f"w{i}": "w20" for i in range(20)}, "x": "w20", "y": "z"}


def test_spelling_on_edges(spark, edge, empty, odd):
    for table in (edge, odd):
        docs = [tuple(r) for r in table.select("doc_id", "text").collect()]
        found = spelling.variants(spelling.vocabulary(table, least_count=2))
        assert tuples(found, *WORDS) == ordered(brute.variants(brute.occurrences(docs, least_count=2)))
    assert spelling.variants(spelling.vocabulary(empty)).count() == 0


# 12


@pytest.fixture(scope="module")
def reference_encoding():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    model = byte_bpe.serialise(byte_bpe.read_ranks())
    return byte_bpe.Codec(model, byte_bpe.default_pattern(), byte_bpe.class_differences())


def strange_texts():
    rng = random.Random(4)
    letters = "  \n\t\r'''stmdrevlLa1.é×ß÷-A\x1c\x0b\x85\xa0ʼ。𝔘՘\U00011de0"
    out = ["".join(rng.choices(letters, k=rng.randrange(1, 40))) for _ in range(3000)]
    out += ["".join(chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(30)) for _ in range(300)]
    return [*out, None, "", "x" * 30_000, "ab " * 20_000, "don't we'll they're 's 'S", "<|endoftext|>", *(r[1] for r in edge_rows())]


def test_codec_equals_the_other_library(codec, reference_encoding, monkeypatch):
    texts = strange_texts()
    expected = [reference_encoding.encode_ordinary(x or "") for x in texts]

    def check():
        flat, offsets = codec.encode(pa.array(texts))
        rows = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        assert [r.tolist() for r in rows] == expected
        assert [codec.decode(r) for r in rows] == [(x or "").encode() for x in texts]

    check()
    check()  # all known
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 500)
    monkeypatch.setattr(byte_bpe, "PIECES_KEPT", 100)
    check()  # long texts cut, pre-tokens forgotten
    codec.forget()
    plain = words.Block.codes
    monkeypatch.setattr(words.Block, "codes", lambda self: plain(self) & np.uint64(255))
    check()  # equal fingerprints
    codec.forget()


def test_byte_bpe_on_tables(spark, edge, empty, odd, reference_encoding):
    def digest(doc, text):
        ids = reference_encoding.encode_ordinary(text or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        return doc, len(ids), listed, hashlib.sha256((text or "").encode()).hexdigest()

    for table in (edge, odd):
        rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
        assert tuples(byte_bpe.digest(table), *BPE) == ordered(digest(*r) for r in rows)
        both = byte_bpe.decode(byte_bpe.encode(table))
        assert both.columns == [*table.columns, "ids", "bytes"]
        for r in both.collect():
            assert r["ids"] == reference_encoding.encode_ordinary(r["text"] or "")
            assert bytes(r["bytes"]) == (r["text"] or "").encode()
    assert byte_bpe.digest(empty).count() == 0
    lists = spark.createDataFrame([(None,), ([],), ([5, 6],)], "ids array<int>")
    assert {len(r["bytes"]) > 0 for r in byte_bpe.decode(lists).collect()} == {True, False}
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([([-1],)], "ids array<int>")).collect()


# 13


def repeated_phrases(seed, n):
    rng = random.Random(seed)
    names = [" ".join(rng.choices("abcdefgh", k=rng.randrange(2, 6))) for _ in range(10)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(20):
            parts.append(rng.choice(names) if rng.random() < 0.5 else " ".join(rng.choices("abcdefghijklmnopq", k=3)))
            parts.append(rng.choice([" ", ". ", "\n", "\t", "  ", " É "]))
        rows.append((i, "".join(parts).title() if i % 3 else "".join(parts), rng.choice(["x", "y", None])))
    return rows


@pytest.mark.parametrize(("top", "least", "bits"), [(3, 2, 1 << 16), (12, 5, 1 << 15), (2000, 3, 1 << 16), (40, 2, 1 << 26)])
def test_collocations_equal_brute_force(spark, top, least, bits, monkeypatch):
    rows = repeated_phrases(top, 60)
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = collocations.collocations(table, top=top, least=least, bits=bits)
    assert tuples(found, *PHRASES) == ordered(brute.collocations([(r[2], r[1]) for r in rows], top, least))


def test_expansion_stops_early(spark, monkeypatch):
    """The frontier's portions leave out what cannot be among the first."""
    rows = repeated_phrases(9, 200)
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").cache()
    counted = []
    plain = collocations._counted
    monkeypatch.setattr(
        collocations, "_counted", lambda *a: counted.append(plain(*a)) or counted[-1]
    )
    sizes = []
    for top in (2, 2000):
        counted.clear()
        collocations.collocations(table, top=top, least=2, bits=1 << 20).count()
        sizes.append(sum(t.filter(F.length("phrase") >= 5).count() for t in counted))
    assert sizes[0] < sizes[1]


def test_collocations_on_edges(spark, edge, empty, odd):
    for table in (edge, odd):
        rows = [tuple(r) for r in table.select("lang", "text").collect()]
        found = collocations.collocations(table, least=2, bits=1 << 18)
        assert tuples(found, *PHRASES) == ordered(brute.collocations(rows, least=2))
    assert collocations.collocations(empty, bits=1 << 15).count() == 0


def test_scores_beyond_64_bits(spark):
    rows = spark.createDataFrame([(3 * 10**18, 4 * 10**18, 5 * 10**18)], "f long, l long, r long")
    assert rows.select(collocations._ratio("f", F.col("l"), F.col("r"))).first()[0] == 2_000_000 * 3 // 9
