"""Nearest neighbours by collision counting over query-centred windows.

Each block of vectors keeps one sorted array per random projection. A query opens a window
around its own projection in every array and widens all windows step by step (virtual
rehashing); a vector that falls into enough windows is verified by its true distance. The
search of a block ends once the windows are so wide that a vector as near as the k-th found
would, but for a small chance, have been counted often enough.
"""

from __future__ import annotations

from math import ceil, comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from packtrace.session import durable

K = 10
PROJECTIONS = 32
SHARE = 0.75  # of the windows a vector must fall into
MISS = 0.05  # chance to miss a vector as near as the k-th
GROWTH = 1.2  # of the windows from step to step
BLOCK_ROWS = 8192  # expected vectors per block
QUERY_ROWS = 2048  # expected queries per block
SEED = 11


def reach(m: int, threshold: int, miss: float) -> float:
    """Half-width, in units of a distance, at which a vector that far off is counted with chance 1 - miss."""
    low, high = 0.0, 10.0
    for _ in range(60):
        z = (low + high) / 2
        p = erf(z / sqrt(2))
        hit = sum(comb(m, i) * p**i * (1 - p) ** (m - i) for i in range(threshold, m + 1))
        low, high = (z, high) if hit < 1 - miss else (low, z)
    return high


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, m: int = PROJECTIONS, seed: int = SEED):
        self.ids, self.vectors = ids, vectors
        self.lines = np.random.default_rng(seed).normal(size=(vectors.shape[1], m))
        place = vectors @ self.lines
        self.order = np.argsort(place, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(place, self.order.T, 0).T.copy()
        self.threshold = ceil(SHARE * m)
        self.reach = reach(m, self.threshold, MISS)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the ids and distances of its k nearest found in this block, nearest first."""
        n, m = len(self.ids), len(self.sorted)
        centre = queries @ self.lines
        span = float(self.sorted.max() - self.sorted.min()) or 1.0
        spread = float(self.sorted.std()) or span
        # window borders per step, projection and query; the last step holds everything
        widths = [spread / 2]
        while widths[-1] < span + float(np.abs(centre).max()) + float(np.abs(self.sorted).max()):
            widths.append(widths[-1] * GROWTH)
        borders = {}
        out = []

        def window(step: int) -> tuple[np.ndarray, np.ndarray]:
            if step not in borders:
                borders[step] = tuple(
                    np.stack([np.searchsorted(self.sorted[j], centre[:, j] + sign * widths[step], side) for j in range(m)], 1)
                    for sign, side in ((-1, "left"), (1, "right")))
            return borders[step]

        for q in range(len(query_ids)):
            count = np.zeros(n, np.int16)
            seen = np.zeros(n, bool)
            found, far = np.zeros(0, np.int64), np.zeros(0)
            low, high = None, None
            for step, width in enumerate(widths):
                new_low, new_high = (x[q] for x in window(step))
                for j in range(m):
                    order = self.order[j]
                    if low is None:
                        count[order[new_low[j] : new_high[j]]] += 1
                    else:
                        count[order[new_low[j] : low[j]]] += 1
                        count[order[high[j] : new_high[j]]] += 1
                low, high = new_low, new_high
                fresh = np.flatnonzero((count >= self.threshold) & ~seen)
                if len(fresh):
                    seen[fresh] = True
                    fresh = fresh[self.ids[fresh] != query_ids[q]]
                    gap = self.vectors[fresh] - queries[q]
                    found = np.concatenate([found, fresh])
                    far = np.concatenate([far, np.sqrt((gap * gap).sum(1))])
                    if len(found) > k:  # all that tie with the k-th stay
                        kth = np.partition(far, k - 1)[k - 1]
                        found, far = found[far <= kth], far[far <= kth]
                if len(found) >= k and width >= self.reach * far.max():
                    break
            best = np.lexsort((self.ids[found], far))[:k]
            out.append((self.ids[found[best]], far[best]))
        return out


def usable(vector: Column) -> Column:
    """Vectors that are not null, not zero, and hold neither null nor non-finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By dimension: ids, vectors, and the places of their rows."""
    ids = table.column("id").to_numpy()
    lists = table.column("v").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    start = np.cumsum(size) - size
    out = {}
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        out[d] = ids[at], flat[start[at][:, None] + np.arange(d)], at
    return out


def _match(k: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        asked, row, ids, far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        number = queries.column("q").to_numpy() if len(queries) else None
        have = _rows(vectors) if len(vectors) else {}
        for d, (query_ids, points, at) in (_rows(queries) if len(queries) else {}).items():
            if d not in have:  # vectors of another length have no distance
                continue
            answers = Block(*have[d][:2]).search(query_ids, points, k)
            for q, n, (i, s) in zip(query_ids.tolist(), number[at].tolist(), answers, strict=True):
                asked.append(np.full(len(i), q))
                row.append(np.full(len(i), n))
                ids.append(i)
                far.append(s)
        return pa.table({"query_id": np.concatenate(asked), "q": np.concatenate(row), "vec_id": np.concatenate(ids), "score": np.concatenate(far)})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, id: str = "vec_id", vector: str = "embedding",
            block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k nearest vectors found for each query: query_id, rank (from 1), vec_id, score.

    score is the Euclidean distance in double precision; ties go to the smaller id. A vector
    with the query's own id is no candidate. Rows with a null id and vectors that are not
    ``usable`` take no part, neither as queries nor as candidates; vectors are compared with
    those of their own length only. A query without candidates has no row. Repeated rows are
    candidates each; a query row repeated in id and vector counts once, and an id with several
    vectors has ranks for each of them. Queries meet all vectors block by block; nothing is sampled or cut.
    """
    def ready(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        return df.filter(F.col("id").isNotNull() & usable(F.col("v")))

    points = ready(vectors)
    asked = durable(ready(queries).distinct().withColumn("q", F.monotonically_increasing_id()))
    n, q = vectors.count(), asked.count()
    blocks, parts = max(1, ceil(n / block_rows)), max(1, ceil(q / query_rows))
    points = points.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
    points = points.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(parts)).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = points.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(
        _match(k), "query_id long, q long, vec_id long, score double")
    order = Window.partitionBy("query_id", "q").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

