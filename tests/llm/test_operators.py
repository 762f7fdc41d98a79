import itertools
import os
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evpipe.llm import (
    decontam,
    lang_id,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    substring_dedup,
    token_output,
    topk,
    toxicity,
)
from evpipe.llm.components import components
from evpipe.llm.words import lower_ascii, white_space_words, word_blocks
from evpipe.plans.staging import folder_names, staging_root

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names the operators use themselves.
        T.StructField("score", T.StringType()), T.StructField("size", T.StringType()),
        T.StructField("licenses", T.StringType()), T.StructField("hits", T.LongType()),
    ]
)


def edge_rows():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)] + ["The", "é", "übel", "123"]

    def prose(n):
        return " ".join(rng.choice(words, n))

    base, passage = prose(120), prose(60)
    near = base.split(" ")
    near[60] = "other"
    line = "one two three four five six seven eight nine"
    texts = [
        None, "", "   \n\t ", "...!?", "a", "The", "the", "word " * 40, "Word " * 40, base, base,
        base.upper(), " ".join(near), prose(30) + " " + passage + " " + prose(20),
        prose(10) + "\n" + passage, passage, prose(5000), "x" * 60_000, "ab " * 30_000,
        "  ", "tab\tand  two spaces\r\n end ", "<|endoftext|> x <|endoftext|>",
        f"{line}\n{line}\nshort\nshort\n{line} ten", f"short\n{line.replace('five', '5')}",
        "Released under the MIT License.\nrest", "Licensed under the apache license version 2.0",
        "日本語 テキスト", "é \U0001f600 ok", passage.replace(" ", "\n"), prose(9), prose(4),
    ]
    rows = []
    for i, t in enumerate(texts):
        lang = [None, "en", "de"][i % 3]
        source = [None, "b", "a", "a", "a"][i % 5]
        rows.append((i * 3, t, lang, source, None, "x", "y", "z", 7))
    return rows


@pytest.fixture(scope="module")
def rows():
    return edge_rows()


@pytest.fixture(scope="module")
def edge(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark, rows):
    """The edge rows with a null id, and twice."""
    more = [*rows, (None, rows[9][1], "en", "a", 1, None, None, None, None)]
    return spark.createDataFrame([*more, *more], SCHEMA)


def tuples(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def ordered(rows):
    return sorted(rows, key=repr)


ITEMS = [
    (1, "w1 w2"), (2, None), (3, "..."), (4, "the"), (5, "The"), (None, "a"), (70, "WORD " * 12),
]


# 1


def test_language_id_on_edges(spark, edge, empty, odd, rows):
    model = lang_id.train(edge)
    got = {r["doc_id"]: r for r in lang_id.predict(edge, model).collect()}
    assert len(got) == len(rows)
    for doc, text, *_ in rows:
        r = got[doc]
        assert 0 <= r["score"] <= 1
        if text is None or not any(map(str.isalpha, text)):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "de")
    assert lang_id.train(empty) is None
    assert {r["lang_pred"] for r in lang_id.predict(edge, None).collect()} == {"und"}
    assert lang_id.predict(empty, model).count() == 0
    assert lang_id.predict(odd, lang_id.train(odd)).count() == odd.count()


def test_language_id_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = lang_id.train(docs.filter(~lang_id.held_out()))
    found = lang_id.predict(docs.filter(lang_id.held_out()), model)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    assert (model.weights == 0).mean() > 0.5


# 2


def test_decontamination_equals_brute_force(spark, edge, rows, sf_dir):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = tuples(decontam.contamination(edge, items), "doc_id", "n_words", "n_hit", "n_items",
                 "items_sha256", "contaminated")
    assert got == ordered(brute.contamination([r[:2] for r in rows], ITEMS))
    kept = {r["doc_id"] for r in decontam.drop_contaminated(edge, items).collect()}
    assert kept == {r[0] for r in got if not r[5]}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    plain = brute.contamination(
        [(r["doc_id"], r["text"]) for r in docs.collect()],
        [(r["item_id"], r["text"]) for r in bench.collect()],
    )
    assert any(r[5] for r in plain)
    assert tuples(decontam.contamination(docs, bench), "doc_id", "n_words", "n_hit", "n_items",
                  "items_sha256", "contaminated") == ordered(plain)


def test_decontamination_in_portions_and_without_rows(spark, edge, empty, odd, rows, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = tuples(decontam.contamination(edge, items), "doc_id", "n_hit", "items_sha256")
    monkeypatch.setattr(decontam, "PORTION_WORDS", 1)
    assert tuples(decontam.contamination(edge, items), "doc_id", "n_hit", "items_sha256") == whole
    nothing = items.filter("false")
    assert decontam.contamination(edge, nothing).filter("contaminated").count() == 0
    assert decontam.drop_contaminated(edge, nothing).count() == len(rows)
    assert decontam.contamination(empty, items).count() == 0
    assert decontam.contamination(odd, items).count() == odd.count()
    assert decontam.drop_contaminated(edge, items).columns == edge.columns


def test_proximity():
    words = np.array([7, 1, 9, 2, 9, 9, 3, 1, 2], dtype=np.uint64)
    index = decontam.Postings.of(words, np.array([0, 6, 9]))
    assert index.proximity(np.array([1, 2], np.uint64), 3) == [(0, 1, 3), (1, 1, 2)]
    assert index.proximity(np.array([1, 2], np.uint64), 2) == [(1, 1, 2)]
    assert index.proximity(np.array([7, 3], np.uint64), 99) == []
    begin, count = index.lists(np.array([9, 9], np.uint64))
    assert index.phrase(begin, count).tolist() == [4]


@pytest.mark.parametrize("most", [1, 1_000_000])
def test_near_search_equals_brute_force(spark, edge, empty, odd, rows, monkeypatch, most):
    monkeypatch.setattr(decontam, "ASKED_WORDS", most)
    texts = [*ITEMS, (90, "short nine"), (90, "NINE five"), (91, None), (92, "..."),
             (None, "five six"), (93, "word"), (93, "word"), (94, "nowhere five"), (95, "six FIVE")]
    items = spark.createDataFrame(texts, "item_id long, text string").withColumn("doc_id", F.lit(1))
    index = decontam.stage(decontam.build_index(edge), "test-postings")
    for within in (2, 12):
        got = tuples(decontam.search_near(index, items, within), "doc_id", "item", "first", "last")
        want = ordered(brute.proximity([r[:2] for r in rows], texts, within))
        assert got == want and {r[1] for r in got} >= {None, "93", "95"}
    assert decontam.search_near(index, items.filter("false"), 9).count() == 0
    assert decontam.search_near(decontam.build_index(empty), items, 9).count() == 0
    twice = decontam.build_index(edge.unionByName(edge))
    assert decontam.search_near(twice, items, 12).count() == 2 * len(want)
    assert decontam.search_near(decontam.build_index(odd), items, 12).count() >= len(want)


# 3


def expected_tokens(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(token_output.tokenizer_json())
    start, out = 0, []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_hold_the_tokenizers_ids(spark, edge, rows, empty, odd, sf_dir):
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    assert tuples(token_output.round_trip(edge), *names) == ordered(
        expected_tokens([r[:2] for r in rows])
    )
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = expected_tokens([(r[0], r[1]) for r in docs.orderBy("doc_id").collect()])
    assert tuples(token_output.round_trip(docs), *names) == ordered(plain)
    assert token_output.round_trip(empty).count() == 0
    twice = sorted(token_output.round_trip(odd).collect(), key=lambda r: r["start"])
    assert len(twice) == odd.count()
    ends = [r["start"] + r["n_tokens"] for r in twice]
    assert [r["start"] for r in twice] == [0, *ends[:-1]]
    ids = [r["doc_id"] for r in twice]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])


def test_pieces_give_the_tokenizers_ids():
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    from evpipe.llm.words import row_slices, text_bytes

    json = token_output.tokenizer_json()
    tokenizer = Tokenizer.from_str(json)
    bits = [
        "a", "the", "Th", "\u00e9", "\u00df", "\u2019s", "'s", "'ll", "don't", "\n", "\n\n", " ", "  ",
        "\t", ".", ",", "!?", "42", "3.5", "x9", "\u65e5\u672c", "\xa0", "\u2009", "\u3000", "\x1f", "\x85",
        "<|endoftext|>", "%&", "_", "--", "~", "\U0001f600", "\ufb01", "\xd7", "\xf7", "\xb5", "\u0130",
        "\r\n", "\u1680", "\u2028", "\u200b",
    ]
    rnd = random.Random(1)
    rows = ["", None, " ", "\n", "a\n", "a \n b"]
    for _ in range(3000):
        rows.append("".join(
            rnd.choice(bits) + rnd.choice(["", " ", "", " "]) for _ in range(rnd.randint(0, 14))
        ))
    encoder = token_output.PieceEncoder(json, 2)
    got = []
    raw, offsets = text_bytes(pa.array(rows))
    for some in row_slices(offsets, 20_000):
        own = offsets[some.start : some.stop + 1]
        ids, counts = encoder.encode_rows(raw[own[0] : own[-1]], own - own[0])
        bounds = np.concatenate(([0], np.cumsum(counts)))
        got += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    assert got == [
        [*tokenizer.encode(x or "", add_special_tokens=False).ids, 2] for x in rows
    ]


def test_small_blocks_and_ids(spark, edge, rows, monkeypatch, tmp_path):
    monkeypatch.setattr(token_output, "BLOCK_TOKENS", 50)
    json = token_output.tokenizer_json()
    token_output.write_tokens(edge, str(tmp_path / "t"), json)
    found = token_output.read_tokens(spark, str(tmp_path / "t"), ids=True).collect()
    assert len(found) == len(rows)
    for r in found:
        assert len(r["ids"]) == r["n_tokens"] and r["ids"][-1] == 2


# 4


def test_toxicity_on_edges(spark, edge, rows, empty, odd):
    labels = spark.createDataFrame(
        [(r[0], i % 2) for i, r in enumerate(rows)] + [(None, 1), (0, None), (999, 1), (27, 1)],
        "doc_id long, toxic int",
    )
    model = toxicity.train(edge, labels)
    found = toxicity.score(edge, model).collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    nothing = labels.filter("false")
    for some in (toxicity.train(edge, nothing), toxicity.train(empty, labels)):
        assert {r["predicted"] for r in toxicity.score(edge, some).collect()} == {0}
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.score(odd, toxicity.train(odd, labels)).count() == odd.count()


def test_toxicity_held_out(spark):
    path = "/root/testdata/sf0.1"
    if not os.path.exists(path):
        pytest.skip("no larger table")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    model = toxicity.train(docs.filter(~toxicity.held_out()), labels.filter(~toxicity.held_out()))
    found = toxicity.score(docs.select("doc_id", "text"), model).join(labels, "doc_id")
    seen = found.filter(toxicity.held_out()).select("toxic", "predicted").toPandas()
    caught = seen[seen.toxic == 1].predicted.mean()
    false = seen[seen.toxic == 0].predicted.mean()
    assert caught > 0.8 and false < 0.02


def test_segments_are_the_maximal_ones():
    # One strong word, a far one, and two near ones that join.
    gains = np.array([5.0, 4.0, 3.0, 3.0])
    places = np.array([2, 40, 80, 82])
    found = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(places, gains)]
    assert found == [(2, 2, 4.5), (40, 40, 3.5), (80, 82, 4.5)]
    assert toxicity.segments(np.array([1]), np.array([0.2])) == []


def test_segments_equal_all_pairs():
    """By definition: the best of all stretches, then the same to its left and to its right."""

    def maximal(scores, low, high):
        ahead = np.concatenate(([0.0], np.cumsum(scores[low:high])))
        pairs = [(ahead[b] - ahead[a], a, b) for a in range(high - low) for b in range(a + 1, high - low + 1)]
        best, a, b = max(pairs, default=(0.0, 0, 0))
        if best <= 0:
            return []
        return [
            *maximal(scores, low, low + a), (low + a, low + b - 1, round(float(best), 6)),
            *maximal(scores, low + b, high),
        ]

    rng = np.random.default_rng(8)
    lengths = []
    for _ in range(150):
        places = np.sort(rng.choice(24, rng.integers(0, 14), replace=False))
        gains = rng.random(len(places)) * rng.choice([0.8, 2.0, 5.0])
        scores = np.full(24, -toxicity.DRIFT)
        scores[places] += gains
        found = [(a, b, round(float(s), 6)) for a, b, s in toxicity.segments(places, gains)]
        assert found == maximal(scores, 0, 24)
        lengths += [b - a for a, b, _ in found]
    assert max(lengths) > 4


@pytest.mark.parametrize("window", [0, 11, 75])
def test_windows_that_are_refused(empty, window):
    with pytest.raises(ValueError):
        substring_dedup.remove_repeated(empty, window)


# 5


def test_license_scan_equals_brute_force(spark, edge, rows, empty, odd):
    def grams(text):
        words = brute.LETTER.findall((text or "").translate(brute.LOWER))
        return set(zip(words, words[1:], strict=False)) if len(words) > 1 else set(words)

    sets = {k: grams(v) for k, v in licenses.TEMPLATES.items()}

    def best(text):
        own = grams(text)
        found = [
            (-2 * len(own & s) / (len(own) + len(s)), k) for k, s in sets.items() if own
        ]
        found = [x for x in found if -x[0] >= licenses.THRESHOLD]
        return min(found) if found else None

    plain = []
    for doc, text, *_ in rows:
        lines = [x for x in map(best, (text or "").split("\n")) if x]
        every = lines + [x for x in [best(text)] if x]
        top = min(every) if every else (None, None)
        dice = None if top[0] is None else round(-top[0], 9)
        plain.append((doc, top[1], dice, len(lines)))
    templates = licenses.template_frame(spark)
    got = tuples(licenses.best_licenses(edge, templates), "doc_id", "license_id", "dice", "n_lines")
    assert got == ordered(plain)
    assert sum(r[3] for r in plain) == 2
    none = templates.filter("false")
    assert licenses.best_licenses(edge, none).filter("license_id IS NOT NULL").count() == 0
    assert licenses.best_licenses(empty, templates).count() == 0
    assert licenses.best_licenses(odd, templates).count() == odd.count()


def test_notices_equal_brute_force(spark, edge, empty, odd):
    bodies = {p.stem: p.read_text() for p in licenses.TEXTS.glob("*.txt")}
    header = next(t for n, t in licenses.HEADERS if n == "GPL-2.0")
    wrapped = "# " + "\n# ".join(header[i : i + 70] for i in range(0, len(header), 70) if header[i:i + 70])
    texts = [
        "Some prose.\nCopyright (c) 2020 Foo\n\n" + bodies["MIT"] + "\nand code follows",
        "Some prose first. This is released under the MIT license, as told. More prose.",
        "Licensed under the MIT License.", "Copyright (c) 2020 Foo. All rights reserved.",
        "code()\n" + wrapped + "\ncode()", bodies["BSD-2-Clause"], bodies["BSD-3-Clause"],
        (bodies["MIT"] + "\n") * 2, "all rights of the MIT people", None, "", "MIT", "of the " * 500,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    templates = licenses.notice_frame(spark)
    short = templates.filter(F.length("text") < 2000)

    def grams(words):
        return list(zip(words, words[1:], strict=False))

    def split(text):
        return grams(brute.LETTER.findall((text or "").translate(brute.LOWER)))

    expected = []
    for doc, text in enumerate(texts):
        own = split(text)
        for name, template in ((r["license_id"], split(r["text"])) for r in short.collect()):
            held, runs = set(template), []
            for a in range(len(own)):
                if own[a] not in held:
                    continue
                best, seen = (0.0, a), set()
                for b in range(a, min(len(own), a + int(1.5 * len(template) + 1e-9))):
                    seen.add(own[b])
                    dice = 2 * len(seen & held) / (len(seen) + len(held)) if own[b] in held else 0
                    best = min(best, (-dice, b))
                if -best[0] >= licenses.THRESHOLD:
                    runs.append((best[0], a, best[1] + 1))
            taken = set()
            for dice, a, b in sorted(runs):
                if not taken & set(range(a, b + 1)):
                    taken |= set(range(a, b + 1))
                    expected.append((doc, a, b, name, round(-dice, 9)))
    found = licenses.notices(docs, short).select("doc_id", F.explode("notices").alias("x"))
    got = [(r[0], *r[1][:3], round(r[1][3], 9)) for r in found.collect()]
    assert ordered(got) == ordered(expected)
    best = {r["doc_id"]: r["license_id"] for r in licenses.best_notices(docs, templates).collect()}
    assert [best[i] for i in range(len(texts))] == [
        "MIT", "MIT", "MIT", "all-rights-reserved", "GPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "MIT",
        *[None] * 5,
    ]
    assert sum(1 for r in got if r[0] == 7) == 2
    whole = spark.createDataFrame([(n, "x y\n" + t + "\nz") for n, t in bodies.items()], "doc_id string, text string")
    assert all(r["license_id"] == r["doc_id"] for r in licenses.best_notices(whole, templates).collect())
    assert licenses.best_notices(edge, templates.filter("false")).filter("n_notices > 0").count() == 0
    assert licenses.best_notices(empty, templates).count() == 0
    assert licenses.best_notices(odd, templates).count() == odd.count()


# 6


def test_near_duplicates_equal_brute_force(spark, edge, rows, empty, odd, sf_dir, monkeypatch):
    names = ("doc_id", "n_shingles", "component_id", "kept")
    plain = ordered(brute.near([r[:2] for r in rows]))
    assert tuples(near_dedup.near_duplicates(edge), *names) == plain
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = brute.near([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert tuples(near_dedup.near_duplicates(docs), *names) == ordered(expected)
    # Groups cut into blocks give the same.
    monkeypatch.setattr(near_dedup, "UNIT_SHINGLES", 500)
    assert tuples(near_dedup.near_duplicates(docs), *names) == ordered(expected)
    assert near_dedup.near_duplicates(empty).count() == 0
    found = near_dedup.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    assert all(r["kept"] for r in found if r["doc_id"] is None)
    assert {tuple(r) for r in found if r["doc_id"] is not None} == set(plain)
    assert near_dedup.drop_near_duplicates(edge).columns == edge.columns


def test_one_group_of_many_variants(spark):
    rng = np.random.default_rng(8)
    base = [f"v{i}" for i in range(60)]
    rows = []
    for i in range(300):
        words = list(base)
        for j in rng.choice(60, rng.integers(0, 4), replace=False):
            words[j] = f"u{rng.integers(0, 40)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = tuples(near_dedup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept")
    assert got == ordered(brute.near(rows))


def test_ids_with_several_texts_lose_no_link(spark):
    """Whichever text of an id comes first, each is compared."""
    a, b = ([f"{c}{i}" for i in range(60)] for c in "ab")
    texts = [a, b, [*b[:-1], "x"], [*a[:-1], "y"], [*b[:-1], "z"]]
    rows = [(i, " ".join(t)) for i, t in zip((1, 1, 2, 3, 4), texts, strict=True)]
    for order in itertools.permutations(rows[:3]):
        parts = []
        for rep, text in order:
            block = next(word_blocks(pa.array([text]), white_space_words(), lower_ascii()))
            print_ = int(near_dedup.fingerprints(*near_dedup.shingle_sets(block))[0].view(np.int64)[0])
            parts.append({"g": 1, "u": 0, "w": 0, "rep": rep, "block": 0, "x": text, "f1": print_})
        found = near_dedup._compare_units(iter([pa.RecordBatch.from_pylist(parts)]))
        assert [sorted(p.values()) for f in found for p in f.to_pylist()] == [[1, 2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == 5 and {r["component_id"] for r in got} == {1}


def test_units_of_many_short_variants_are_bounded(spark, monkeypatch):
    """One notice whose last word differs: few shingles, many sets, all linked (14 of 16)."""
    notice = " ".join(f"n{i}" for i in range(18))
    texts = [f"{notice} {i}" for i in range(4500)] + [f"other {i} text of a few words" for i in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    compare = near_dedup._compare_units

    def counted(batches):
        held = {}

        def look():
            for batch in batches:
                for unit in zip(*(batch.column(c).to_pylist() for c in "guw"), strict=True):
                    held[unit] = held.get(unit, 0) + 1
                    assert held[unit] <= 2500, "sets in a unit"
                yield batch

        yield from compare(look())

    monkeypatch.setattr(near_dedup, "_compare_units", counted)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: 0 if i < 4500 else i for i in range(len(texts))}


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(40)]
    root = {x: x for e in edges for x in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    before = set(folder_names(spark, staging_root(spark)))
    got = {
        r["node"]: r["root"]
        for r in components(spark.createDataFrame(edges, "a long, b long")).collect()
    }
    assert got == {k: v for k, v in root.items() if k != v}
    # Only the last round is left.
    assert len(set(folder_names(spark, staging_root(spark))) - before) == 1


# 7


def test_mixing(spark, edge, rows, empty, odd, sf_dir):
    got = mixing.mix_digest(edge).collect()
    sizes = {r[0]: len(brute.SPACE.findall(r[1] or "")) for r in rows}
    assert {r["doc_id"]: r["size"] for r in got} == sizes
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    again = mixing.mix_digest(edge.repartition(5))
    names = ("doc_id", "size", "source_size", "target", "taken")
    assert tuples(again, *names) == ordered([tuple(r[n] for n in names) for r in got])
    assert mixing.mix_digest(empty).count() == 0
    assert mixing.mix_digest(odd).count() == odd.count()
    out = mixing.mixed(edge)
    assert out.columns == edge.columns
    copies = {r["doc_id"]: r["copies"] for r in got}
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {k: v for k, v in copies.items() if v}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sums = mixing.mix_digest(docs).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"),
        F.sum("copies").alias("copies"), F.sum(F.col("target") / F.col("source_size")).alias("due"),
        F.max("size").alias("largest"),
    )
    for r in sums.collect():
        # The pivotal method keeps the number of copies, so only sizes can be off.
        assert abs(r["copies"] - r["due"]) < 1
        assert abs(r["taken"] - r["target"]) <= 2 * r["largest"]


def test_targets_equal_brute_force(spark):
    def due(sizes, weights=None):
        frame = spark.createDataFrame(sizes, "source string, size long").repartition(3)
        return {r["source"]: r["target"] for r in mixing.source_targets(frame, weights).collect()}

    assert due([("a", 4), ("b", 10), (None, 10), ("a", 6)]) == {"a": 5.0, "b": 10.0, None: 15.0}
    assert due([("a", 1), (None, 100)], {"a": 9, None: 1}) == {"a": 3.0, None: 98.0}
    assert due([("a", 0), ("b", 0)]) == {"a": 0.0, "b": 0.0}
    assert due([("a", 5), ("b", 7)], {"c": 1.0}) == {"a": 0.0, "b": 0.0} and due([]) == {}
    rng = np.random.default_rng(6)
    names = sorted((f"s{i}" if i % 2 else f"\u00fc{i}" for i in range(500)), key=str.encode)
    for spread in (0.5, 2.0, 4.0):
        sizes = np.floor(np.exp(rng.normal(0, spread, 501)) * 10).astype(int).tolist()
        rows = list(zip([*names, None], sizes, strict=True))
        turns = brute.targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(501)])
        assert due(rows) == dict(zip([*names, None], turns, strict=True))
        given = rng.integers(0, 9, 501).tolist()
        own = dict(zip([*names, None], given, strict=True))
        assert due(rows, own) == dict(zip(own, brute.targets(sizes, given), strict=True))


def test_levels_of_the_reduction_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 8)
    rows = [(i, "a" if i % 3 else "b", 10) for i in range(900)]
    frame = spark.createDataFrame(rows, "id long, source string, size long")
    out = mixing.copies(frame).groupBy("source").agg(F.sum("copies").alias("n")).collect()
    # b is last and weighs 2: 9000 words are shared 3000 to 6000.
    assert {r["source"]: r["n"] for r in out} == {"a": 300, "b": 600}


def test_pivot_keeps_sums_and_probabilities():
    rng = np.random.default_rng(4)
    p = np.array([0.3, 0.9, 0.25, 0.5, 1.0, 0.0, 0.75])
    total = np.zeros(len(p))
    for _ in range(4000):
        out, held = mixing.pivot(p, rng.random(len(p)))
        assert abs(out.sum() - p.sum()) < 1e-9
        assert ((out < 1e-9) | (out > 1 - 1e-9) | (np.arange(len(p)) == held)).all()
        total += out
    assert np.abs(total / 4000 - p).max() < 0.04


# 8


def test_line_dedup_equals_brute_force(spark, edge, rows, empty, odd, sf_dir):
    names = ("doc_id", "n_lines", "n_removed", "removed_sha256")
    assert tuples(line_dedup.digest(edge), *names) == ordered(
        brute.lines([r[:2] for r in rows])
    )
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    plain = brute.lines([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert tuples(line_dedup.digest(docs), *names) == ordered(plain)
    assert line_dedup.digest(empty).count() == 0
    found = {r["doc_id"]: r for r in line_dedup.digest(odd).collect()}
    assert len(found) == len(rows) + 1 and found[None]["n_removed"] == 0
    out = line_dedup.drop_duplicate_lines(edge)
    assert out.columns == edge.columns and out.count() == len(rows)
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[66] == "one two three four five six seven eight nine\nshort"


@pytest.mark.parametrize("a, b, near", [
    ("a b c", "a b c", True), ("a b c", "a x c", True), ("a b c", "a c", True),
    ("a b", "a b c", True), ("a b c", "c b a", False), ("a b c", "b c a", False),
    ("a", "b c", False), ("", "a", True),
])
def test_one_edit(a, b, near):
    assert line_dedup.within_one_edit(a.split(), b.split()) is near
    assert (brute.edit(a.split(), b.split()) < 2) is near


# 9


def brute_top(rows, k=5):
    def usable(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)

    whole = [
        (i, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        for i, v in rows if i is not None and usable(v)
    ]
    out = []
    for q, v in {i: v for i, v in whole if i % 50 == 0}.items():
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w, strict=True)), i)
            for i, w in whole if i != q and len(w) == len(v)
        )
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return ordered(out)


def test_top_k_equals_brute_force(spark, sf_dir, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).astype("float32").tolist()) for i in range(160)]
    rows += [(200, None), (250, []), (300, [nan] * 6), (350, [1.0, None] * 3), (400, [inf] * 6)]
    rows += [(450, [0.0] * 6), (500, [1.0, 2.0]), (501, [1.0, 2.0]), (502, [1.0, 2.0]),
             (None, [1.0] * 6), (161, rows[3][1]), (162, rows[3][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    for numbers in (1 << 22, 90):
        monkeypatch.setattr(topk, "BLOCK_NUMBERS", numbers)
        got = topk.top_k(frame, frame.filter("vec_id % 50 = 0"), 5)
        assert tuples(got, "query_id", "rank", "vec_id", "score") == brute_top(rows)
    monkeypatch.setattr(topk, "PORTION_NUMBERS", 10)
    got = topk.top_k(frame, frame.filter("vec_id % 50 = 0"), 5)
    assert tuples(got, "query_id", "rank", "vec_id", "score") == brute_top(rows)
    none = frame.filter("false")
    assert topk.top_k(none, none, 5).count() == 0
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = topk.top_k(table, table.filter("vec_id % 50 = 0"), 5)
    plain = brute_top([(r["vec_id"], r["embedding"]) for r in table.collect()])
    assert tuples(got, "query_id", "rank", "vec_id", "score") == plain


# 10


def test_substrings_equal_brute_force(spark, edge, rows, empty, odd, sf_dir, monkeypatch):
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    plain = ordered(brute.substrings([r[:2] for r in rows]))
    assert sum(r[2] for r in plain) > 0
    assert tuples(substring_dedup.digest(edge), *names) == plain
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = ordered(brute.substrings([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert tuples(substring_dedup.digest(docs), *names) == expected
    # Anchors with many pieces are looked up by window.
    monkeypatch.setattr(substring_dedup, "SHARD_PIECES", 1)
    assert tuples(substring_dedup.digest(docs), *names) == expected
    assert tuples(substring_dedup.digest(edge), *names) == plain
    assert substring_dedup.digest(empty).count() == 0
    doubled = [r[:2] for r in rows] + [(None, rows[9][1])]
    assert tuples(substring_dedup.digest(odd), *names) == ordered(
        brute.substrings([*doubled, *doubled])
    )


def test_automaton_counts_occurrences():
    shard = substring_dedup.SuffixAutomaton()
    texts = [(list("abcabcab"), 1), (list("bcab"), 3), (list("xabcx"), 2)]
    for words, times in texts:
        shard.add(words, times)
    shard.settle()
    for words, _ in texts:
        for n in (1, 2, 3, 4):
            expected = [
                sum(
                    times for other, times in texts for j in range(len(other) - n + 1)
                    if other[j : j + n] == words[i : i + n]
                )
                for i in range(len(words) - n + 1)
            ]
            assert shard.occurrences(words, n) == expected


def test_columns_named_like_helpers(spark):
    """The tables' own columns may have any name, and stay as they are."""
    text = "one two three four five six seven eight nine ten eleven"
    rows = [(1, text, 5, "a", [1], 3), (2, text, 6, "b", [2], 4), (3, text + "\nother words", 7, "c", None, 1)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, gone long, d string, gone_lines array<long>, rep long"
    )
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    # The third shares 7 of 9 shingles with the first: not near enough.
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]
    cut = line_dedup.drop_duplicate_lines(docs)
    assert cut.columns == docs.columns
    found = {r["doc_id"]: r for r in cut.collect()}
    assert found[1]["text"] == text and found[2]["text"] == "" and found[3]["text"] == "other words"
    assert [found[i]["gone"] for i in (1, 2, 3)] == [5, 6, 7] and found[2]["d"] == "b"
