"""Toxic passages by maximum-scoring segment search.

Words are runs of letters, digits and non-ASCII characters of the A-Z-lower-cased text. A word's
score is the log-odds of occurring in toxic and in clean training rows under Dirichlet priors: the
prior of a word is the rate of its stem (its first `LONG_STEM` bytes), whose own prior is the pooled
rate. Words and stems enter the lexicon if their surplus in toxic rows is significant; any other
word scores what its longest known stem does, or 0. Every word costs `DRIFT`, so that a stretch of
ordinary words falls. A linear scan (Ruzzo and Tompa) finds all
maximal segments of positive score; those with an expected number of chance occurrences under
`PASSAGE_E` are the toxic passages of a row.

Chance follows extreme-value statistics: in `n` words of clean text a segment of score `S` or more
is expected `n * exp(-lambda * S)` times, where lambda solves sum(p * exp(lambda * score)) = 1 over
the clean word scores. The evidence of a segment is minus the log of that number; a logistic curve
over the log of one plus the evidence of all segments that beat chance, fitted on the training rows,
is the score of a row.

The model is fitted on at most about `SAMPLE_ROWS` labelled rows (all of them if there are fewer)
and keeps the `LEXICON` most significant words and stems.

Defined results: null and word-free texts have no passage and get the score of an empty text; rows
without a label are not learnt from; of several labels of one document the highest counts; without
both labels to learn from, the score is the share of label 1, or 0. Input columns named like
results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evpipe.llm.util import add_columns, small_batches
from evpipe.llm.words import (
    Block,
    letter_words,
    lower_ascii,
    mix,
    word_blocks,
)

SAMPLE_ROWS = 60_000
LEXICON = 200_000
LONG_STEM, SHORT_STEM = 5, 4
PRIOR_WORDS = 1.0
STEM_WORDS = 5.0
LEAST_Z = 5.5
DRIFT = 0.5
PASSAGE_E = 0.01


def stems(block: Block, n: int) -> np.ndarray:
    """Fingerprints of the first `n` bytes of the words, apart from those of whole words."""
    short = np.minimum(block.ends, block.starts + n)
    cut = Block(block.rows, block.data, block.offsets, block.starts, short, block.first)
    return mix(cut.codes() + np.uint64(n))


def word_counts(labelled: DataFrame) -> DataFrame:
    """For each word of labelled rows its stems, in how many `toxic` and `clean` rows it occurs, and
    how often it stands in clean rows, `used`."""
    small_batches(labelled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = np.array(batch.column(1).to_pylist(), dtype=np.int64)
            for block in word_blocks(batch.column(0), letter_words(), lower_ascii(), 8 << 20):
                toxic = np.repeat(flags[block.rows], block.counts())
                row = np.repeat(np.arange(len(block.first) - 1), block.counts())
                codes = block.codes()
                code, where, back = np.unique(codes, return_index=True, return_inverse=True)
                used = np.bincount(back, weights=1 - toxic, minlength=len(code))
                _, once = np.unique(row * len(code) + back, return_index=True)
                rows = np.bincount(back[once], minlength=len(code))
                hits = np.bincount(back[once], weights=toxic[once], minlength=len(code))
                columns = (
                    code.view(np.int64), stems(block, LONG_STEM)[where].view(np.int64),
                    stems(block, SHORT_STEM)[where].view(np.int64), hits, rows - hits, used,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.astype(np.int64)) for x in columns], names
                )

    names = ["code", "stem", "short", *_SUMS]
    schema = ", ".join(f"{n} long" for n in names)
    return labelled.mapInArrow(run, schema).groupBy(*names[:3]).agg(*_sums())


_SUMS = ["toxic", "clean", "used"]


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in _SUMS]


@dataclass
class ToxicityModel:
    codes: np.ndarray
    scores: np.ndarray
    rate: float
    intercept: float
    slope: float

    def evidence(self, n_words: int, gain: float) -> float:
        """Minus the log of the expected number of chance segments of that gain or more."""
        return self.rate * gain - float(np.log(max(n_words, 1)))

    def total(self, n_words: int, found: list[tuple[int, int, float]]) -> float:
        """The evidence of all segments of a row that are better than chance."""
        return sum(max(self.evidence(n_words, s), 0.0) for _, _, s in found)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.intercept + self.slope * evidence, -500, 500)))

    def words(self, block: Block) -> np.ndarray:
        """The log-odds of every word of a block: its own, else its longest known stem's, or 0."""
        found = self._of(stems(block, SHORT_STEM))
        for codes in (stems(block, LONG_STEM), block.codes()):
            found = np.where(self._has(codes), self._of(codes), found)
        return found

    def _at(self, codes: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))

    def _has(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(codes), dtype=bool)
        return self.codes[self._at(codes)] == codes

    def _of(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(codes))
        return np.where(self._has(codes), self.scores[self._at(codes)], 0.0)


def segments(places: np.ndarray, gains: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of a row in which the words at `places`
    gain `gains` and every word costs DRIFT."""
    kept: list[list[float]] = []
    total, last = 0.0, -1
    for place, gain in zip(places.tolist(), gains.tolist(), strict=True):
        before = total - DRIFT * (place - last - 1)
        total, last = before + gain - DRIFT, place
        if gain <= DRIFT:
            continue
        piece = [place, place, before, total]
        # `kept` holds candidates with their sums before and after; join to the left while the
        # nearest one that begins lower also ends lower.
        while True:
            k = len(kept) - 1
            while k >= 0 and kept[k][2] >= piece[2]:
                k -= 1
            if k < 0 or kept[k][3] >= piece[3]:
                break
            piece = [kept[k][0], piece[1], kept[k][2], piece[3]]
            del kept[k:]
        kept.append(piece)
    return [(int(a), int(b), r - l) for a, b, l, r in kept]


def scan(column: pa.Array, model: ToxicityModel) -> Iterator[tuple[int, list]]:
    """For each row the number of words and its maximal segments."""
    for block in word_blocks(column, letter_words(), lower_ascii()):
        gains = model.words(block)
        hot = np.flatnonzero(gains > 0)
        low = np.searchsorted(hot, block.first)
        for r, n in enumerate(block.counts().tolist()):
            at = hot[low[r] : low[r + 1]]
            yield n, segments(at - block.first[r], gains[at]) if len(at) else []


def fit_rate(scores: np.ndarray, weights: np.ndarray) -> float:
    """lambda of clean text; `scores` fall on average, one at least can rise."""
    p = weights / weights.sum()
    if not (scores > 0).any() or p @ scores >= 0:
        return 1.0
    low, high = 0.0, 1.0
    with np.errstate(over="ignore"):
        while p @ np.exp(high * scores) < 1 and high < 1e3:
            high *= 2
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if p @ np.exp(middle * scores) < 1 else (low, middle)
    return (low + high) / 2


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by damped Newton steps with a slight ridge."""
    center, spread = x.mean(), x.std() or 1.0
    design = np.column_stack((np.ones(len(x)), (x - center) / spread))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + 0.1 * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] - w[1] * center / spread), float(w[1] / spread)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic") -> ToxicityModel:
    """Fit on the rows of `docs` that have a label."""
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("k")).agg((F.max(label) > 0).cast("int").alias("y"))
    n = known.count()
    draw = F.pmod(F.xxhash64("k"), F.lit(1 << 32))
    sample = known.filter(draw < F.lit(int(min(1.0, SAMPLE_ROWS / max(n, 1)) * 2**32)))
    # About SAMPLE_ROWS rows of two numbers.
    joined = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("x")).join(
        F.broadcast(sample), "k"
    )
    rows = joined.select("x", "y")
    n_rows = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    counts = word_counts(rows)
    codes, scores, used, all_used = _lexicon(counts, n_rows.get(1, 0), n_rows.get(0, 0))
    order = np.argsort(codes)
    model = ToxicityModel(codes[order], scores[order], 1.0, 0.0, 1.0)
    rest = max(all_used - used.sum(), 1.0)
    model.rate = fit_rate(np.append(scores - DRIFT, -DRIFT), np.append(used + 0.1, rest))
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ToxicityModel(*shared.value)
        for batch in batches:
            found = [
                m.total(n, found)
                for n, found in scan(batch.column(0), m)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.log1p(found), pa.float64()), batch.column(1)], ["e", "y"]
            )

    pairs = rows.mapInArrow(run, "e double, y int").orderBy("e", "y").toPandas()
    x, y = pairs["e"].to_numpy(), pairs["y"].to_numpy(dtype=float)
    if len(y) and 0 < y.sum() < len(y):
        model.intercept, model.slope = fit_logistic(x, y)
    else:
        share = float(y.mean()) if len(y) else 0.0
        model.intercept, model.slope = (500.0 if share else -500.0), 0.0
    return model


def _lexicon(counts: DataFrame, t: int, c: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Significant words and stems of `t` toxic and `c` clean rows: codes, log-odds and uses in
    clean rows; and the number of all words of clean rows."""
    none = np.empty(0)
    if not t or not c:
        return none.astype(np.uint64), none, none, 0.0
    by_stem = counts.groupBy("stem").agg(*_sums())
    share = t / (t + c)

    def significant(frame: DataFrame, code: str, prior: Column, weight: float) -> DataFrame:
        """Rows whose toxic share is above the pooled one beyond chance, with their log-odds."""
        toxic, clean = F.col("toxic").cast("double"), F.col("clean").cast("double")
        n = toxic + clean
        odds = F.log((toxic + weight * prior) / (clean + weight * (1 - prior)))

        def surplus(found: Column, part: float) -> Column:
            return F.when(found > 0, found * F.log(found / (n * part))).otherwise(0.0)

        z = F.sqrt(F.greatest(2 * (surplus(toxic, share) + surplus(clean, 1 - share)), F.lit(0.0)))
        z = F.when(toxic > share * n, z).otherwise(0.0)
        out = frame.select(
            F.col(code).alias("code"), (odds - float(np.log(t / c))).alias("s"), z.alias("z"),
            F.col("used").cast("double").alias("used"),
        )
        return out.filter((F.col("z") >= LEAST_Z) & (F.col("s") > DRIFT))

    family = by_stem.select("stem", F.col("toxic").alias("st"), F.col("clean").alias("sc"))
    rate = (F.col("st") + STEM_WORDS * share) / (F.col("st") + F.col("sc") + STEM_WORDS)
    found = significant(counts.join(family, "stem"), "code", rate, STEM_WORDS)
    short = counts.groupBy("short").agg(*_sums())
    for frame, code in ((by_stem, "stem"), (short, "short")):
        found = found.unionByName(significant(frame, code, F.lit(share), PRIOR_WORDS))
    top = found.orderBy(F.desc("z"), "code").limit(LEXICON).toPandas()
    codes = top["code"].to_numpy(np.int64).view(np.uint64)
    all_used = counts.agg(F.sum("used")).first()[0]
    return codes, top["s"].to_numpy(), top["used"].to_numpy(), float(all_used or 0)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """`docs` with `score`, `predicted` and `passages`, the significant segments as (first word,
    last word, log-odds)."""
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("gain", pa.float64())]))

    def make(column: pa.Array) -> list[pa.Array]:
        m = ToxicityModel(*shared.value)
        evidence, passages = [], []
        for n, found in scan(column, m):
            evidence.append(m.total(n, found))
            passages.append([
                {"first": a, "last": b, "gain": s} for a, b, s in found
                if m.evidence(n, s) > -np.log(PASSAGE_E)
            ])
        p = m.probability(np.log1p(evidence))
        return [
            pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32()),
            pa.array(passages, kind),
        ]

    fields = [
        ("score", "double"), ("predicted", "int"),
        ("passages", "array<struct<first:long,last:long,gain:double>>"),
    ]
    return add_columns(docs, text, fields, make)


def held_out(key: str = "doc_id") -> Column:
    """Rows the training may not see: crc32 of the id as text is divisible by 5."""
    remainder = F.crc32(F.col(key).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))
