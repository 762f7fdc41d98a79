import re

import numpy as np
import pyarrow as pa
from brute import LETTER, LOWER, SPACE
from hypothesis import given, settings
from hypothesis import strategies as st

from evpipe.llm import rans
from evpipe.llm.words import (
    gram_hashes,
    letter_words,
    lower_ascii,
    spans_within,
    white_space_words,
    word_blocks,
)

TEXTS = st.lists(st.one_of(st.none(), st.text("aB1 \n\té \x1f-", max_size=20)), max_size=12)


def words(texts, table, fold=None, most=1 << 20):
    out = []
    for block in word_blocks(pa.array(texts, pa.string()), table, fold, most):
        data = block.data.tobytes()
        for a, b in zip(block.first, block.first[1:], strict=False):
            out.append([data[block.starts[i] : block.ends[i]].decode() for i in range(a, b)])
    return out


@settings(deadline=None, max_examples=200)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_words_equal_the_patterns(texts, most):
    assert words(texts, white_space_words(), None, most) == [SPACE.findall(t or "") for t in texts]
    expected = [LETTER.findall((t or "").translate(LOWER)) for t in texts]
    assert words(texts, letter_words(), lower_ascii(), most) == expected


def test_words_of_a_sliced_column():
    column = pa.array(["a b", None, "c", "d e f"]).slice(1, 3)
    blocks = list(word_blocks(column, white_space_words()))
    assert [int(n) for b in blocks for n in b.counts()] == [0, 1, 3]


def test_codes_tell_words_apart_and_do_not_depend_on_place():
    texts = [" ".join(f"w{i}" for i in range(5000)), "x w17 w18", "w18w w1 8"]
    codes = [b.codes() for b in word_blocks(pa.array(texts), white_space_words(), None, 1)]
    assert len(np.unique(codes[0])) == 5000
    assert codes[1][1] == codes[0][17] and codes[1][2] == codes[0][18]
    assert codes[2][0] not in codes[0]


def test_gram_hashes_are_those_of_the_content():
    codes = np.random.default_rng(1).integers(0, 50, 3000).astype(np.uint64)
    for n in (1, 2, 5, 12, 35):
        hashes = gram_hashes(codes, n)
        grams = [tuple(codes[i : i + n]) for i in range(len(codes) - n + 1)]
        assert len(hashes) == len(grams)
        assert len(dict(zip(hashes.tolist(), grams, strict=True))) == len(set(grams))


def test_spans_stay_in_their_rows():
    starts, rows = spans_within(np.array([0, 3, 3, 8]), 3)
    assert starts.tolist() == [0, 3, 4, 5] and rows.tolist() == [0, 2, 2, 2]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 60_000), max_size=400), st.integers(1, 300))
def test_rans_round_trip(ids, repeats):
    ids = np.array(ids * repeats, dtype=np.int64)
    symbols, counts = np.unique(ids, return_counts=True)
    if not len(ids):
        return
    table = rans.quantise(symbols, counts)
    assert table.freq.sum() == 1 << table.bits
    coded = rans.encode(ids, table)
    slots = table.slots()
    assert np.array_equal(rans.decode(coded, table, slots), ids)
    # Any stretch decodes without those before it.
    last = len(coded.crcs) - 1
    stretch = rans.CHECKPOINT_STEPS * coded.lanes
    assert np.array_equal(rans.decode_stretch(coded, last, table, slots), ids[last * stretch :])


def test_rans_size_is_near_the_entropy_and_damage_is_found():
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.geometric(0.05, 300_000), 900)
    symbols, counts = np.unique(ids, return_counts=True)
    table = rans.quantise(symbols, counts)
    coded = rans.encode(ids, table)
    p = counts / counts.sum()
    entropy = -(p * np.log2(p)).sum() * len(ids) / 32
    assert len(coded.words) < entropy * 1.01 + coded.lanes
    coded.words = coded.words.copy()
    coded.words[100] ^= 1
    try:
        rans.decode(coded, table, table.slots())
    except (ValueError, IndexError):
        return
    raise AssertionError("damage was not found")


def test_patterns_are_those_of_the_contract():
    assert re.fullmatch(LETTER, "é9z") and not re.search(LETTER, "A-_ \x7f")
