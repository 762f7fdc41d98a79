"""Licence scans: notices in texts found by the Dice coefficient over word bigrams.

A line of a text and the whole text are compared with every licence template. Both are normalised
(A-Z lower-cased, words are runs of letters, digits and non-ASCII characters) and taken as sets of
word bigrams; a single word is its own bigram. The coefficient of sets A and B, 2 |A n B| / (|A| +
|B|), can reach a threshold t only if |B| lies between t / (2 - t) |A| and (2 - t) / t |A|: templates
are kept in order of size and only those within the bounds are compared, and among them only those
that share a bigram, found by a look-up of the line's bigrams.

`notices` looks for licences in any run of consecutive words, over line ends and inside of lines, and
with whole licence texts and file headers among its templates. A run holds at most (2 - t) / t times
the bigrams of the template. It can reach t only with t / (2 - t) |A| of the template's distinct
bigrams, so only texts that hold as many, and runs from places with as many ahead, are compared; a run
begins and ends at a shared bigram, as without that it would not be the best. From each such place the
best run (then the shortest) is taken; those of one template don't overlap, better ones first, then
earlier ones. Runs of different templates may. Templates of one word are left to `scan`.

Defined results: null, empty and word-free texts and lines match nothing; of several templates for
one line the best counts, then the smaller name; templates without words match nothing; an empty
template table matches nothing. Rows with equal ids are scanned one by one. Input columns named like
the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evpipe.llm.util import add_columns
from evpipe.llm.words import gram_hashes, letter_words, lower_ascii, mix, word_blocks

THRESHOLD = 0.8
# A template set is small by nature; it is refused beyond this many words.
MOST_TEMPLATE_WORDS = 5_000_000

# Short notices by which works name their licence.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License."
    ),
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
    "all-rights-reserved": "Copyright. All rights reserved.",
}

# Whole licence texts, by the name of the file.
TEXTS = Path(__file__).parent / "license_texts"

# File headers and other wordings, which `notices` reads besides.
HEADERS = [
    ("Apache-2.0", (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    )),
    *(
        (f"{short}-{number}.0", (
            f"{opening} is free software; you can redistribute it and/or modify it under the terms of "
            f"the GNU {kind} as published by the Free Software Foundation; either version {number} of "
            f"the License, or (at your option) any later version. {opening} is distributed in the hope "
            "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
            f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details."
        ))
        for short, number, kind, opening in (
            ("GPL", 2, "General Public License", "This program"),
            ("GPL", 3, "General Public License", "This program"),
            ("LGPL", 3, "Lesser General Public License", "This library"),
        )
    ),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MPL-2.0", (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    )),
    ("all-rights-reserved", "All rights reserved."),
]


def bigrams(codes: np.ndarray) -> np.ndarray:
    """The distinct bigrams of a sequence of words, sorted."""
    return np.unique(gram_hashes(codes, 2) if len(codes) > 1 else mix(codes))




class TemplateSet:
    """Templates in order of size, with the templates of each bigram."""

    def __init__(self, names: list[str], sets: list[np.ndarray], threshold: float):
        order = sorted((i for i, s in enumerate(sets) if len(s)), key=lambda i: (len(sets[i]), names[i]))
        self.names = [names[i] for i in order]
        self.sizes = np.array([len(sets[i]) for i in order], dtype=np.int64)
        self.threshold = threshold
        owners = np.repeat(np.arange(len(order)), self.sizes)
        flat = np.concatenate([sets[i] for i in order]) if order else np.empty(0, np.uint64)
        by = np.argsort(flat, kind="stable")
        self.grams, self.owners = flat[by], owners[by]

    def best(self, grams: np.ndarray) -> tuple[str, float] | None:
        """The best template of a set of bigrams that reaches the threshold."""
        n, t = len(grams), self.threshold
        low = np.searchsorted(self.sizes, np.ceil(t / (2 - t) * n - 1e-9))
        high = np.searchsorted(self.sizes, np.floor((2 - t) / t * n + 1e-9), side="right")
        if not n or low >= high:
            return None
        begin = np.searchsorted(self.grams, grams)
        end = np.searchsorted(self.grams, grams, side="right")
        there = np.flatnonzero(end > begin)
        if not len(there):
            return None
        owners = np.concatenate([self.owners[begin[i] : end[i]] for i in there])
        shared = np.bincount(owners[(owners >= low) & (owners < high)], minlength=len(self.sizes))
        dice = 2.0 * shared / (self.sizes + n)
        found = [(-dice[k], self.names[k]) for k in np.flatnonzero(dice >= t)]
        return (min(found)[1], -min(found)[0]) if found else None


def template_frame(spark: SparkSession) -> DataFrame:
    """The built-in templates as a table of `license_id` and `text`."""
    return spark.createDataFrame(sorted(TEMPLATES.items()), "license_id string, text string")


def notice_frame(spark: SparkSession) -> DataFrame:
    """Short notices, headers and whole licence texts as a table of `license_id` and `text`."""
    whole = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt"))]
    return spark.createDataFrame(
        [*sorted(TEMPLATES.items()), *HEADERS, *whole], "license_id string, text string"
    )


def _template_sets(templates: DataFrame) -> list[tuple[str, bytes, int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, counts = [], []
            for block in word_blocks(batch.column(1), letter_words(), lower_ascii()):
                codes = block.codes()
                counts += block.counts().tolist()
                sets += [
                    bigrams(codes[a:b]).tobytes() for a, b in zip(block.first, block.first[1:], strict=False)
                ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary()), pa.array(counts, pa.int64())], ["n", "s", "w"]
            )

    picked = templates.filter("license_id IS NOT NULL").select("license_id", "text").distinct()
    sets = picked.mapInArrow(run, "n string, s binary, w long")
    words = sets.agg(F.sum(F.length("s"))).first()[0] or 0
    if words > 8 * MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates hold more than {MOST_TEMPLATE_WORDS} words")
    return sorted((r["n"], bytes(r["s"]), r["w"]) for r in sets.collect())


def scan(docs: DataFrame, templates: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> (
    DataFrame
):
    """`docs` with `licenses`: for each matching line (and the whole text, line null) the line's
    number from 0, the template and the coefficient."""
    shared = docs.sparkSession.sparkContext.broadcast(_template_sets(templates))
    kind = pa.list_(
        pa.struct([("line", pa.int32()), ("license_id", pa.string()), ("dice", pa.float64())])
    )

    def make(column: pa.Array) -> list[pa.Array]:
        names = [n for n, _, _ in shared.value]
        known = TemplateSet(names, [np.frombuffer(s, np.uint64) for _, s, _ in shared.value], threshold)
        # Longer lines can't match any template: the largest template bounds the words looked at.
        most = (2 - threshold) / threshold * int(known.sizes.max(initial=0)) + 1
        out = []
        for block in word_blocks(column, letter_words(), lower_ascii()):
            codes = block.codes()
            breaks = np.flatnonzero(block.data == 0x0A)
            for r in range(len(block.first) - 1):
                a, b = int(block.first[r]), int(block.first[r + 1])
                low, high = np.searchsorted(breaks, block.offsets[r : r + 2])
                cuts = np.searchsorted(block.starts[a:b], breaks[low:high]) + a
                edges = np.concatenate(([a], cuts, [b]))
                found = []
                for line in np.flatnonzero(np.diff(edges)).tolist():
                    best = _match(known, codes[edges[line] : edges[line + 1]], most)
                    if best:
                        found.append({"line": line, "license_id": best[0], "dice": best[1]})
                best = _match(known, codes[a:b], most)
                if best:
                    found.append({"line": None, "license_id": best[0], "dice": best[1]})
                out.append(found)
        return [pa.array(out, kind)]

    return add_columns(
        docs, text, [("licenses", "array<struct<line:int,license_id:string,dice:double>>")], make
    )


def _match(known: TemplateSet, codes: np.ndarray, most: float) -> tuple[str, float] | None:
    # Distinct bigrams can be far fewer than words, so only sets of sure size are skipped unseen.
    if not len(codes):
        return None
    grams = bigrams(codes)
    return known.best(grams) if len(grams) <= most else None


def best_licenses(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """One row per document: the best match (ties to the smaller name), and the matching lines."""
    found = scan(docs.select("doc_id", "text"), templates)
    order = F.array_sort(F.transform(
        "licenses", lambda x: F.struct((-x["dice"]).alias("d"), x["license_id"].alias("n"))
    ))
    best = F.try_element_at(order, F.lit(1))
    return found.select(
        "doc_id", best["n"].alias("license_id"), F.round(-best["d"], 9).alias("dice"),
        F.size(F.filter("licenses", lambda x: x["line"].isNotNull())).cast("long").alias("n_lines"),
    )


class NoticeSet:
    """Templates of two words and more, with the templates of each bigram."""

    def __init__(self, templates: list[tuple[str, bytes, int]], threshold: float):
        templates = [t for t in templates if t[2] > 1]
        sets = [np.frombuffer(s, np.uint64) for _, s, _ in templates]
        ratio = (2 - threshold) / threshold
        self.names = [n for n, _, _ in templates]
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.least = np.maximum(np.ceil(self.sizes / ratio - 1e-9).astype(np.int64), 1)
        self.most = [int(ratio * (w - 1) + 1e-9) for _, _, w in templates]
        self.threshold = threshold
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        by = np.argsort(flat, kind="stable")
        self.grams, opens = np.unique(flat[by], return_index=True)
        self.owners, self.bounds = owners[by], np.append(opens, len(flat))

    def places(self, grams: np.ndarray) -> np.ndarray:
        """For each bigram its place among those of the templates, or -1."""
        if not len(self.grams):
            return np.full(len(grams), -1)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, at, -1)

    def find(self, grams: np.ndarray, places: np.ndarray) -> list[tuple[int, int, str, float]]:
        """First and last word, template and coefficient of the runs in the bigrams of a text."""
        held = np.unique(places[places >= 0])
        shared = np.zeros(len(self.names), dtype=np.int64)
        for p in held.tolist():
            shared[self.owners[self.bounds[p] : self.bounds[p + 1]]] += 1
        found, before = [], None
        for k in np.flatnonzero(shared >= self.least).tolist():
            if before is None:
                # Where the same bigram was before, to count distinct ones from any place on.
                order = np.argsort(grams, kind="stable")
                before = np.full(len(grams), -1)
                same = grams[order[1:]] == grams[order[:-1]]
                before[order[1:][same]] = order[:-1][same]
            own = np.zeros(len(self.grams) + 1, dtype=bool)
            own[held] = [k in self.owners[self.bounds[p] : self.bounds[p + 1]] for p in held.tolist()]
            found += self._runs(k, before, own[places])
        return sorted(found)

    def _runs(self, k: int, before: np.ndarray, hit: np.ndarray) -> list[tuple[int, int, str, float]]:
        most, size = self.most[k], int(self.sizes[k])
        ahead = np.concatenate(([0], np.cumsum(hit)))
        starts = np.flatnonzero(hit)
        ends = np.minimum(starts + most, len(hit))
        starts = starts[ahead[ends] - ahead[starts] >= self.least[k]]
        runs = []
        for s in starts.tolist():
            new = before[s : s + most] < s
            n = np.cumsum(new)
            dice = 2.0 * np.cumsum(new & hit[s : s + most]) / (size + n)
            end = int(np.argmax(dice))
            if dice[end] >= self.threshold:
                runs.append((-float(dice[end]), s, s + end + 1))
        taken = np.zeros(len(hit) + 1, dtype=bool)
        kept = []
        for dice, first, last in sorted(runs):
            if not taken[first] and not taken[last] and not taken[first : last + 1].any():
                taken[first : last + 1] = True
                kept.append((first, last, self.names[k], -dice))
        return kept


def notices(docs: DataFrame, templates: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> (
    DataFrame
):
    """`docs` with `notices`: for each run of words that matches a template its first and last word
    (from 0), the template and the coefficient, in this order."""
    shared = docs.sparkSession.sparkContext.broadcast(_template_sets(templates))
    kind = pa.list_(pa.struct([
        ("first", pa.int32()), ("last", pa.int32()), ("license_id", pa.string()), ("dice", pa.float64()),
    ]))
    names = ("first", "last", "license_id", "dice")

    def make(column: pa.Array) -> list[pa.Array]:
        known = NoticeSet(shared.value, threshold)
        out = []
        for block in word_blocks(column, letter_words(), lower_ascii()):
            grams = gram_hashes(block.codes(), 2)
            places = known.places(grams)
            for a, b in zip(block.first.tolist(), block.first[1:].tolist(), strict=False):
                own = places[a : max(b - 1, a)]
                found = known.find(grams[a : max(b - 1, a)], own) if (own >= 0).any() else []
                out.append([dict(zip(names, x, strict=True)) for x in found])
        return [pa.array(out, kind)]

    fields = "array<struct<first:int,last:int,license_id:string,dice:double>>"
    return add_columns(docs, text, [("notices", fields)], make)


def best_notices(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """One row per document: the longest run that matches (ties to the better, then to the smaller
    name, then to the earlier one) and the number of all."""
    found = notices(docs.select("doc_id", "text"), templates)
    order = F.array_sort(F.transform("notices", lambda x: F.struct(
        (x["first"] - x["last"]).alias("l"), (-x["dice"]).alias("d"), x["license_id"].alias("n"),
        x["first"].alias("f"), x["last"].alias("e"),
    )))
    best = F.try_element_at(order, F.lit(1))
    return found.select(
        "doc_id", best["n"].alias("license_id"), F.round(-best["d"], 9).alias("dice"),
        best["f"].alias("first_word"), best["e"].alias("last_word"),
        F.size("notices").cast("long").alias("n_notices"),
    )
