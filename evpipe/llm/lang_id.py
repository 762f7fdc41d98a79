"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters are lower-cased; n-grams of one to three characters are hashed to `BUCKETS` features. A
row's features are (1 + log tf) * idf, scaled to length 1. Document frequencies come from every
training row. The weights are fitted by follow-the-regularised-leader with elastic-net penalties on
a bounded sample (`SAMPLE_ROWS` of the labelled rows, spread over the languages by their share, but
at least `ROWS_PER_LANG` of each), four fifths of it for the weights and one fifth for the
temperature that calibrates the probabilities.

Defined results: a text that is null or holds no letter is `und` with score 0, and so is every text
when there is nothing to learn from. Rows without a language or text are not learnt from. Repeated
rows are predicted alike. Input columns called `lang_pred` or `score` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evpipe.llm.util import add_columns, small_batches

BUCKETS = 1 << 16
SAMPLE_ROWS = 6000
ROWS_PER_LANG = 300
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
UNDETERMINED = "und"


def grams(text: str) -> np.ndarray:
    """The bucket of every n-gram of a text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = codes.astype(np.uint64)
    parts, rolled = [], np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, min(3, len(codes)) + 1):
        rolled = rolled[: len(codes) - n + 1] * np.uint64(0x1000193) + codes[n - 1 :] + np.uint64(n)
        parts.append(((rolled * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64))
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero features of a text: their buckets and values."""
    counts = np.bincount(grams(text), minlength=BUCKETS)
    where = np.flatnonzero(counts)
    values = (1.0 + np.log(counts[where])) * idf[where]
    length = np.sqrt(values @ values)
    return where, values / length if length > 0 else values


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, text: str) -> np.ndarray:
        where, values = features(text, self.idf)
        return softmax((values @ self.weights[where] + self.bias) / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], n_langs: int, epochs: int = EPOCHS
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal, one row at a time in the given order."""
    z = np.zeros((BUCKETS + 1, n_langs))
    n = np.zeros((BUCKETS + 1, n_langs))

    def solved(where: np.ndarray) -> np.ndarray:
        held = z[where]
        shrunk = np.sign(held) * np.maximum(np.abs(held) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n[where])) / ALPHA + L2)

    for _ in range(epochs):
        for where, values, lang in rows:
            # The last feature is the bias.
            at = np.append(where, BUCKETS)
            x = np.append(values, 1.0)
            w = solved(at)
            error = softmax(x @ w)
            error[lang] -= 1.0
            g = np.outer(x, error)
            seen = n[at]
            grown = seen + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(seen)) / ALPHA * w
            n[at] = grown
    w = solved(np.arange(BUCKETS + 1))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, langs: np.ndarray) -> float:
    """The temperature of least log loss, by a search that narrows around the best of a grid."""
    if not len(logits):
        return 1.0
    low, high = np.log(0.25), np.log(20.0)

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(len(langs)), langs]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    for _ in range(4):
        grid = np.linspace(low, high, 17)
        best = int(np.argmin([loss(t) for t in grid]))
        low, high = grid[max(best - 1, 0)], grid[min(best + 1, 16)]
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """In how many texts each bucket occurs, and behind the buckets the number of texts."""
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BUCKETS + 1, dtype=np.int64)
        mark = np.zeros(BUCKETS, dtype=bool)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                at = grams(text)
                mark[at] = True
                found[:-1] += mark
                mark[at] = False
                found[-1] += 1
        where = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(found[where])], ["b", "n"])

    counts = texts.mapInArrow(run, "b long, n long").groupBy("b").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS + 1, dtype=np.int64)
    found = counts.toArrow()  # one row a bucket at most
    out[found["b"].to_numpy()] = found["n"].to_numpy()
    return out


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> (
    LanguageModel | None
):
    """Fit on the rows of `docs` that have a language; None when no row has."""
    rows = docs.select(
        F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"),
        F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(1 << 32)).alias("draw"),
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.filter(F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    frequencies = document_frequencies(rows.select("text"))
    idf = np.log((1.0 + frequencies[-1]) / (1.0 + frequencies[:-1])) + 1.0
    share = SAMPLE_ROWS / sum(sizes.values())
    wanted = [max(share, ROWS_PER_LANG / sizes[x]) for x in langs]
    limits = F.create_map(
        *(F.lit(v) for x, s in zip(langs, wanted, strict=True) for v in (x, min(s, 1.0) * 2.0**32))
    )
    sample = rows.filter(F.col("draw") < limits[F.col("lang")])
    numbers = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, values = [], []
            for x in batch.column("text").to_pylist():
                w, v = features(x, idf)
                where.append(w.astype(np.uint16).tobytes())
                values.append(v.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("draw"), batch.column("lang"), pa.array(where), pa.array(values)],
                ["draw", "lang", "w", "v"],
            )

    drawn = sample.mapInArrow(run, "draw long, lang string, w binary, v binary").collect()
    drawn.sort(key=lambda r: (r["draw"], r["lang"], bytes(r["w"])))
    examples = [
        # Views of what was fetched; the arithmetic on them is in 64 bits.
        (np.frombuffer(r["w"], np.uint16), np.frombuffer(r["v"], np.float32), numbers[r["lang"]])
        for r in drawn
    ]
    held = [e for i, e in enumerate(examples) if i % 5 == 4]
    weights, bias = fit_ftrl([e for i, e in enumerate(examples) if i % 5 != 4], len(langs))
    logits = np.array([v @ weights[w] + bias for w, v, _ in held]).reshape(len(held), len(langs))
    temperature = fit_temperature(logits, np.array([e[2] for e in held], dtype=np.int64))
    return LanguageModel(langs, idf, weights, bias, temperature)


def predict(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, the calibrated probability of that language."""
    # BUCKETS weights a language.
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else astuple(model))

    def make(column: pa.Array) -> list[pa.Array]:
        known = None if shared.value is None else LanguageModel(*shared.value)
        langs, scores = [], []
        for x in column.to_pylist():
            if known is None or not has_letter(x):
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            p = known.probabilities(x)
            best = int(p.argmax())
            langs.append(known.langs[best])
            scores.append(float(min(p[best], 1.0)))
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return add_columns(docs, text, [("lang_pred", "string"), ("score", "double")], make)


def held_out(key: str = "doc_id") -> Column:
    """Rows the training may not see: crc32 of the id as text leaves 2 when divided by 4."""
    remainder = F.crc32(F.col(key).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))
