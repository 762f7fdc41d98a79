"""Phrase collocations: the phrases of each language that hold together best.

A phrase of 2 to 4 words that occurs `a` times and is cut in two parts of `l` and `r` occurrences has
the score floor(2000000 * a / (l + r)); its lowest-scoring cut counts. Phrases grow word by word from
their prefixes, best first. All that grows from a prefix of `f` occurrences occurs at most `f` times,
and so does its remainder at least as often as itself; cut behind the first `k` words of the prefix,
which occur `l` times, it scores floor(2000000 * f / (l + f)) at most. That bound needs the counts of
prefixes only. Prefixes are expanded in portions of falling bound: one cut value for each language,
from a histogram of the scores of its pairs of words, down to which everything is expanded. When the
survivors at or above the cut number as many as are wanted, whatever isn't expanded scores less than
the last of them, ties included, and the language is settled; the others go on with a lower cut.

The counts come from passes over the texts. What a pass counts is told by filters: bitmaps of fixed
size over fingerprints of phrases, which let through all that is wanted and some others, whose counts
are as exact as any. Counts are by language and the phrase's text. With very many distinct phrases the
filters let more through, so that passes count more, never less.

Defined results: null and empty texts have no words; a null language is `und`; an empty table has no
rows; repeated rows count as often as they occur; ties go by count, then by the phrase's UTF-8 bytes;
other columns are not read. A phrase does not reach over the end of a text or of a piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evpipe.llm.util import small_batches, stage
from evpipe.llm.words import Block, gram_hashes, lower_ascii, mix, word_blocks

TOP = 2000
LEAST_COUNT = 30
# A phrase goes when a longer one has so many percent of its occurrences.
SHARE = 80
SCALE = 2_000_000
UNDETERMINED = "und"
BLOCK_BYTES = 4 << 20
FILTER_BITS = 1 << 26
# Scores are looked at in steps of this size to find a cut.
SCORE_STEP = 500
# How many more pairs of words the next portion of the frontier takes in.
WIDER = 8
_CHUNK = 1 << 15  # bits of the arrays that bitmap_construct_agg makes


def phrase_bytes() -> np.ndarray:
    """Byte class of `[^\\x20\\x09]+` within pieces."""
    table = np.ones(256, bool)
    table[[0x20, 0x09]] = False
    table[piece_ends()] = False
    return table


def piece_ends() -> list[int]:
    """`[.,;:!?\\x0A-\\x0D]`."""
    return [*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]


@dataclass
class Pass:
    """What a pass over the texts counts: phrases of `size` words, all of whose `inner`-word parts are
    in the filter `every` and that have, at one of the places of `some` (place, words, filter), a part
    in that filter. Without filters, all phrases."""

    size: int
    inner: int = 0
    every: object = None
    some: list[tuple[int, int, object]] = field(default_factory=list)


def _held(fingerprints: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    shift = np.uint64(64 - (len(bitmap) * 8).bit_length() + 1)
    place = fingerprints >> shift
    return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _phrases(block: Block, langs: np.ndarray, wanted: Pass) -> tuple[np.ndarray, ...]:
    """The starts of the phrases that a pass counts, their fingerprints, and those of all their words
    but the first."""
    codes, n = block.codes(), wanted.size
    rows = np.repeat(np.arange(len(block.first) - 1), block.counts())
    ends = np.zeros(256, bool)
    ends[piece_ends()] = True
    ahead = np.concatenate(([0], np.cumsum(ends[block.data], dtype=np.int32)))
    apart = (ahead[block.starts[1:]] != ahead[block.ends[:-1]]) | (rows[1:] != rows[:-1])
    piece = np.concatenate(([0], np.cumsum(apart)))[: len(codes)]
    count = len(codes) - n + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    keep = piece[n - 1 :] == piece[:count]
    spread = langs[rows]

    def prints(size: int) -> np.ndarray:
        found = gram_hashes(codes, size)
        return mix(found + spread[: len(found)])

    if wanted.inner:
        within = _held(prints(wanted.inner), wanted.every.value)
        for k in range(n - wanted.inner + 1):
            keep &= within[k : k + count]
    if wanted.some:
        anywhere = np.zeros(count, bool)
        for place, size, bitmap in wanted.some:
            anywhere |= _held(prints(size), bitmap.value)[place : place + count]
        keep &= anywhere
    starts = np.flatnonzero(keep)
    tails = prints(n - 1)[starts + 1] if n > 1 else np.zeros(len(starts), np.uint64)
    return starts, prints(n)[starts], tails


def _scan(docs: DataFrame, wanted: Pass, spelled: bool) -> DataFrame:
    """Counts of each block: `lang`, `phrase`, `fp`, `end_fp` (of all words but the first) and `f`, or
    only `fp` and `f`. With single words and `spelled`, also a row of a null phrase for the words of a
    language."""
    small_batches(docs.sparkSession)
    schema = "fp long, f long"
    if spelled:
        schema = "lang string, phrase string, fp long, end_fp long, f long"
    names = [x.split()[0] for x in schema.split(", ")]

    def spell(block: Block, first: np.ndarray) -> list[str]:
        raw, n = block.data.tobytes(), wanted.size
        parts = [
            [raw[a:b] for a, b in zip(block.starts[first + k].tolist(), block.ends[first + k].tolist(),
                                      strict=True)]
            for k in range(n)
        ]
        return [b" ".join(words).decode() for words in zip(*parts, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for block in word_blocks(batch.column(1), phrase_bytes(), lower_ascii(), BLOCK_BYTES):
                row_langs = batch.column(0).slice(block.rows.start, len(block.first) - 1).to_pylist()
                for lang in set(row_langs) - known.keys():
                    known[lang] = int.from_bytes(
                        hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"
                    )
                spread = np.array([known[x] for x in row_langs], np.uint64)
                starts, prints, tails = _phrases(block, spread, wanted)
                met, where, counts = np.unique(prints, return_index=True, return_counts=True)
                columns = [pa.array(met.view(np.int64)), pa.array(counts)]
                if spelled:
                    first = starts[where]
                    row = np.searchsorted(block.first, first, side="right") - 1
                    columns = [
                        pa.array([row_langs[r] for r in row.tolist()], pa.string()),
                        pa.array(spell(block, first), pa.string()),
                        columns[0], pa.array(tails[where].view(np.int64)), columns[1],
                    ]
                yield pa.RecordBatch.from_arrays(columns, names)
                if spelled and wanted.size == 1:
                    words: dict[str, int] = {}
                    for lang, n in zip(row_langs, block.counts().tolist(), strict=True):
                        words[lang] = words.get(lang, 0) + n
                    none = [0] * len(words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(words), pa.nulls(len(words), pa.string()), pa.array(none),
                         pa.array(none), pa.array(words.values())], names,
                    )

    return docs.mapInArrow(run, schema)


def _counted(docs: DataFrame, wanted: Pass, least: int) -> DataFrame:
    """`lang`, `phrase`, `fp`, `f` of all phrases of a pass with at least so many occurrences."""
    found = _scan(docs, wanted, True).groupBy("lang", "phrase").agg(
        F.min("fp").alias("fp"), F.min("end_fp").alias("end_fp"), F.sum("f").alias("f")
    )
    often = F.col("phrase").isNull() | (F.col("f") >= least)
    return stage(found.filter(often), f"phrases{wanted.size}")


def bitmap(rows: DataFrame, bits: int = FILTER_BITS):
    """A broadcast filter of `fp`: `bits` bits whatever the number of rows. The driver gets it in
    chunks of 4 KB, which tasks have put together."""
    spark = rows.sparkSession
    place = F.shiftrightunsigned("fp", 64 - bits.bit_length() + 1)
    picked = rows.select(
        F.floor(place / _CHUNK).alias("chunk"), (place % _CHUNK).alias("bit")
    )
    out = np.zeros(bits // 8, np.uint8)
    for row in picked.groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("b")).collect():
        at = row["chunk"] * (_CHUNK // 8)
        out[at : at + len(row["b"])] = np.frombuffer(row["b"], np.uint8)
    return spark.sparkContext.broadcast(out)


def _ratio(a: str, left: Column, right: Column) -> Column:
    """floor(2000000 * a / (left + right)), with products beyond 64 bits."""
    wide = [x.cast("decimal(20,0)") for x in (F.col(a), left, right)]
    return F.call_function("div", wide[0] * F.lit(SCALE), wide[1] + wide[2])


def _at_least_share(longer: Column, a: Column) -> Column:
    whole, share = longer.cast("decimal(20,0)") * 100, a.cast("decimal(20,0)") * SHARE
    return whole >= share


def _look_up(rows: DataFrame, counts: DataFrame, key: Column, name: str) -> DataFrame:
    """`rows` with the count of the phrase `key` as `name`, null where `counts` has none."""
    other = counts.select(
        F.col("lang").alias("lang_"), F.col("phrase").alias("phrase_"), F.col("f").alias(name)
    )
    keyed = rows.withColumn("key_", key)
    same = (keyed["lang"] == other["lang_"]) & (keyed["key_"] == other["phrase_"])
    return keyed.join(other, same, "left").drop("key_", "lang_", "phrase_")


def _first(words: int) -> Column:
    return F.substring_index("phrase", " ", words)


def _last(words: int) -> Column:
    return F.substring_index("phrase", " ", -words)


def _worst_cut(cuts: list[tuple[Column, Column]]) -> Column:
    """The cut of the lowest score, of equals the shortest first part."""
    return F.array_min(
        F.array(
            *(
                F.struct(_ratio("f", left, right).alias("score"), F.lit(k).alias("k"),
                         left.alias("l"), right.alias("r"))
                for k, (left, right) in enumerate(cuts, 1)
            )
        )
    )


def _bound(prefixes: list[Column]) -> Column:
    """What no phrase that grows from this one can surpass, by the counts of its own prefixes."""
    bounds = [_ratio("f", left, F.col("f")) for left in prefixes]
    return bounds[0] if len(bounds) == 1 else F.least(*bounds)


def _at_or_above(rows: DataFrame, cuts: DataFrame, value: Column) -> DataFrame:
    """Rows of the languages of `cuts` whose `value` reaches their cut."""
    joined = rows.withColumn("value_", value).join(cuts, "lang")
    return joined.filter("value_ >= cut").drop("value_", "cut")


def _kept(candidates: DataFrame, longer: DataFrame, size: int) -> DataFrame:
    """Candidates of `size` words that no phrase of one word more makes superfluous. A still longer
    one needs no look: what it holds in between occurs at least as often."""
    parts = longer.select("lang", F.explode(F.array(_first(size), _last(size))).alias("phrase"), "f")
    most = parts.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    told = _look_up(candidates, most, F.col("phrase"), "longer")
    return told.filter(F.col("longer").isNull() | ~_at_least_share(F.col("longer"), F.col("f"))).drop("longer")


def _cuts(pairs: DataFrame, langs: DataFrame, wanted: int) -> DataFrame:
    """`lang`, `cut`: a score that so many pairs of words of the language reach, else 0."""
    steps = pairs.join(langs, "lang", "left_semi").groupBy(
        "lang", F.floor(F.col("cut_.score") / SCORE_STEP).alias("step")
    ).agg(F.count("*").alias("n"))
    # A language has SCALE / 2 / SCORE_STEP steps and one more at most.
    down = Window.partitionBy("lang").orderBy(F.desc("step"))
    reached = steps.withColumn("n", F.sum("n").over(down)).filter(F.col("n") >= wanted)
    best = reached.groupBy("lang").agg(F.max("step").alias("step"))
    return langs.join(best, "lang", "left").select(
        "lang", (F.coalesce("step", F.lit(0)) * SCORE_STEP).cast("long").alias("cut")
    )


def _expand(
    docs: DataFrame, ones: DataFrame, twos: DataFrame, pairs: object, cuts: DataFrame, least: int,
    bits: int,
) -> DataFrame:
    """`lang`, `phrase`, `f` and the lowest-scoring cut of all phrases that reach the cut of their
    language and survive."""

    def parts_of(rows: DataFrame, size: int, label: str) -> tuple[list, DataFrame]:
        """The prefixes to expand, and the phrases whose survival is asked, as filters."""
        lead = [F.col(f"l{k}") for k in range(1, size)]
        grown = _at_or_above(rows, cuts, _bound(lead))
        best = stage(_at_or_above(rows, cuts, F.col("cut_.score")), label)
        return [(0, size, bitmap(grown, bits)), (1, size, bitmap(best, bits))], best

    some, best2 = parts_of(twos, 2, "best2")
    three = _counted(docs, Pass(3, 2, pairs, some), least)
    rows = _look_up(three, ones, _first(1), "l1")
    rows = _look_up(rows, twos, _first(2), "l2")
    rows = _look_up(rows, twos, _last(2), "r1")
    rows = _look_up(rows, ones, _last(1), "r2")
    cut = _worst_cut([(F.col("l1"), F.col("r1")), (F.col("l2"), F.col("r2"))])
    threes = stage(rows.withColumn("cut_", cut), "threes")

    some, best3 = parts_of(threes, 3, "best3")
    four = _counted(docs, Pass(4, 2, pairs, some), least)
    rows = _look_up(four, ones, _first(1), "l1")
    rows = _look_up(rows, twos, _first(2), "l2")
    # A phrase whose prefix is not among the expanded ones is below the cut.
    rows = _look_up(rows, three, _first(3), "l3").filter("l3 is not null")
    rows = _look_up(rows, twos, _last(2), "r2")
    rows = _look_up(rows, ones, _last(1), "r3")
    upper = F.least(
        _ratio("f", F.col("l1"), F.col("f")), _ratio("f", F.col("l2"), F.col("r2")),
        _ratio("f", F.col("l3"), F.col("r3")),
    )
    hopeful = stage(_at_or_above(rows, cuts, upper), "hopeful")
    # Remainders that no expanded prefix led to are counted on demand.
    ends = hopeful.select("lang", _last(3).alias("phrase"), F.col("end_fp").alias("fp"))
    missing = stage(ends.join(three, ["lang", "phrase"], "left_anti"), "missing")
    ends = three
    if not missing.isEmpty():
        more = _counted(docs, Pass(3, 0, None, [(0, 3, bitmap(missing, bits))]), least)
        ends = three.unionByName(more.join(three, ["lang", "phrase"], "left_anti"))
    rows = _look_up(hopeful, ends, _last(3), "r1")
    cut = _worst_cut([(F.col(f"l{k}"), F.col(f"r{k}")) for k in (1, 2, 3)])
    best4 = _at_or_above(rows.withColumn("cut_", cut), cuts, F.col("cut_.score"))

    columns = ["lang", "phrase", "f", "cut_"]
    out = _kept(best2, three, 2).select(columns)
    out = out.unionByName(_kept(best3, four, 3).select(columns))
    return out.unionByName(best4.select(columns))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP,
    least: int = LEAST_COUNT, bits: int = FILTER_BITS,
) -> DataFrame:
    """`lang`, `rank` (from 1), `phrase`, `a`, `l`, `r`, `n` (words of the language), `score`: the
    first `top` of each language by score, then by count, then by phrase."""
    texts = docs.select(
        F.coalesce(docs[lang].cast("string"), F.lit(UNDETERMINED)).alias("lang"), docs[text].alias("x")
    )
    words = _counted(texts, Pass(1), least)
    totals = words.filter("phrase is null").select("lang", F.col("f").alias("n"))
    ones = words.filter("phrase is not null")
    frequent = bitmap(ones, bits)
    # Pairs are many and few are frequent: by fingerprint first, which can only count too much.
    pairs = _scan(texts, Pass(2, 1, frequent), False).groupBy("fp").agg(F.sum("f").alias("f"))
    likely = bitmap(pairs.filter(F.col("f") >= least), bits)
    two = _counted(texts, Pass(2, 1, frequent, [(0, 2, likely)]), least)
    rows = _look_up(_look_up(two, ones, _first(1), "l1"), ones, _last(1), "r1")
    twos = stage(rows.withColumn("cut_", _worst_cut([(F.col("l1"), F.col("r1"))])), "twos")
    held = bitmap(twos, bits)

    best = Window.partitionBy("lang").orderBy(
        F.desc("score"), F.desc("a"), F.asc("phrase")
    )
    open_langs, wanted, settled = totals.select("lang"), top, []
    while True:
        cuts = stage(_cuts(twos, open_langs, wanted), "cuts")
        found = _expand(texts, ones, twos, held, cuts, least, bits).select(
            "lang", "phrase", F.col("f").alias("a"), F.col("cut_.l").alias("l"),
            F.col("cut_.r").alias("r"), F.col("cut_.score").alias("score"),
        )
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
        ranked = stage(ranked, "ranked")
        enough = ranked.groupBy("lang").count().filter(F.col("count") >= top)
        more = cuts.filter("cut > 0").join(enough, "lang", "left_anti").select("lang")
        open_langs = stage(more, "open")
        if open_langs.isEmpty():
            settled.append(ranked)
            break
        settled.append(ranked.join(open_langs, "lang", "left_anti"))
        wanted *= WIDER
    out = settled[0]
    for rows in settled[1:]:
        out = out.unionByName(rows)
    return out.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
        F.col("score").cast("long").alias("score"),
    )
