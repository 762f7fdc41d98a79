"""Exact top-k search by the threshold algorithm over sorted per-dimension lists.

Vectors are turned to whole numbers, floor(256 * x). Candidates are dealt into blocks of a bounded
size; a block sorts its vectors once in every dimension. A query walks all lists of a block at once,
each from the end at which its own component multiplies to the most, scores vectors in full as they
come up, and stops as soon as the sum of the products at the walk's front, the most that any vector
not met yet can score, is below the k-th best score. A block passes on its k best rows for each
query, and the k best of those are the answer. Queries travel in portions of bounded size, one pass over the blocks for each.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do
empty ones; a query is compared with vectors of its own length only; ties go to the smaller id;
repeated ids are repeated candidates (a query leaves out every row that has its id, and is asked
once); rows without an id take no part. Scores are 64-bit whole numbers and wrap beyond that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evpipe.plans.staging import new_path

SCALE = 256
BLOCK_NUMBERS = 1 << 22
PORTION_NUMBERS = 1 << 20
WALK = 64
_EXACT = 2.0**53


def whole_vectors(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """`id`, `v`: the vectors that take part, as whole numbers."""
    x = F.col(f"`{column}`")
    fit = (F.size(x) > 0) & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))
    )
    numbers = F.transform(x, lambda e: F.floor(F.lit(SCALE) * e.cast("double")))
    picked = vectors.filter(F.col(f"`{key}`").isNotNull() & x.isNotNull()).filter(fit)
    return picked.select(F.col(f"`{key}`").cast("long").alias("id"), numbers.alias("v"))


class SortedLists:
    """One block of vectors of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.orders = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.orders, axis=0)
        self.largest = float(np.abs(vectors.astype(np.float64)).max(initial=0.0))
        self.floats = vectors.astype(np.float64)

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        most = self.largest * float(np.abs(query.astype(np.float64)).sum())
        if most < _EXACT:
            return (self.floats[rows] @ query.astype(np.float64)).astype(np.int64)
        with np.errstate(over="ignore"):
            return (self.vectors[rows] * query).sum(axis=1, dtype=np.int64)

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, best first, smaller ids first among equals."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        rising = query[used] < 0
        seen = np.zeros(n, dtype=bool)
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, WALK
        while depth < n:
            high = min(n, depth + step)
            down = self.orders[n - high : n - depth, used[~rising]]
            up = self.orders[depth:high, used[rising]]
            met = np.zeros(n, dtype=bool)
            met[down.ravel()] = True
            met[up.ravel()] = True
            if not len(used):
                met[:] = True
            fresh = np.flatnonzero(met & ~seen)
            seen |= met
            own = fresh[self.ids[fresh] != query_id]
            ids = np.concatenate((ids, self.ids[own]))
            scores = np.concatenate((scores, self.scores(own, query)))
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if not len(used):
                break
            front = np.where(rising, self.sorted[high - 1, used], self.sorted[n - high, used])
            # Rounded up, so that it stays a bound for numbers beyond 2 ** 53.
            bound = float(front.astype(np.float64) @ query[used].astype(np.float64))
            bound += abs(bound) * 1e-9
            if len(ids) == k and scores[-1] > bound:
                break
            depth, step = high, step * 2
        return ids, scores


def top_k(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id",
          column: str = "embedding") -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score` of the k best rows of `vectors` for each query."""
    spark = vectors.sparkSession
    candidates = whole_vectors(vectors, key, column)
    asked = whole_vectors(queries, key, column).dropDuplicates(["id"])
    schema = "query_id long, vec_id long, score long"
    path, portions = new_path(spark, "best-of-blocks"), 0
    for ids, rows in _portions(asked):
        shared = spark.sparkContext.broadcast((ids, rows))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            query_ids, wanted = shared.value
            for held_ids, held in _blocks(batches):
                found: list[list[np.ndarray]] = []
                block = SortedLists(held_ids, held)
                for query_id, query in zip(query_ids, wanted, strict=True):
                    if len(query) == held.shape[1]:
                        ids, scores = block.top(query_id, query, k)
                        found.append([np.full(len(ids), query_id), ids, scores])
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)],
                        ["query_id", "vec_id", "score"],
                    )

        # Written portion by portion, so neither the plan nor what is broadcast grows with their number.
        candidates.mapInArrow(run, schema).write.mode("append").parquet(path)
        shared.destroy()
        portions += 1
    best = spark.read.schema(schema).parquet(path) if portions else spark.createDataFrame([], schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors of equal length in blocks of about BLOCK_NUMBERS numbers."""
    held: dict[int, tuple[list, list]] = {}
    for batch in batches:
        lists = batch.column(1)
        ids = batch.column(0).to_numpy()
        bounds = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.to_numpy()
        lengths = np.diff(bounds)
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            vectors = flat[bounds[rows][:, None] + np.arange(length)]
            names, parts = held.setdefault(length, ([], []))
            names.append(ids[rows])
            parts.append(vectors)
            if sum(p.size for p in parts) >= BLOCK_NUMBERS:
                yield np.concatenate(names), np.concatenate(parts)
                del held[length]
    for names, parts in held.values():
        yield np.concatenate(names), np.concatenate(parts)


def _portions(asked: DataFrame) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    numbers = asked.agg(F.sum(F.size("v"))).first()[0] or 0
    if numbers <= PORTION_NUMBERS:
        # One portion: fetched at once instead of task by task.
        found = sorted(asked.collect(), key=lambda r: r["id"])
    else:
        found = asked.orderBy("id").toLocalIterator()
    ids, rows, size = [], [], 0
    for row in found:
        ids.append(row["id"])
        rows.append(np.array(row["v"], dtype=np.int64))
        size += len(row["v"])
        if size >= PORTION_NUMBERS:
            yield ids, rows
            ids, rows, size = [], [], 0
    if ids:
        yield ids, rows
