"""Ordered per-key scans that hold up when one key owns a large share of the rows.

A key whose rows fit in one task is scanned with ordinary window functions over
``partitionBy(key)``. A larger ("hot") key is cut into chunks that are contiguous
in the scan order, windows run per (key, chunk), and what has to cross a chunk
border - the last reading, a running total - is computed as one aggregate row per
chunk and joined back. Those rows number at most table_rows / rows_per_task plus
one per hot key, which is why they may be broadcast.

Where the chunk borders fall has no influence on results, only on task sizes: any
function that grows with the scan order gives the same answers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from packtrace.operators import quantiles
from packtrace.session import durable
from packtrace.spec import Skew

HOT = "_hot"
MAX_CHUNKS = 500_000  # borders that the driver holds and every task gets: above it, raise rows_per_task


def _position(borders: list[np.ndarray], values: list[np.ndarray]) -> np.ndarray:
    """For each row, how many borders are <= it, comparing column after column."""
    left = np.searchsorted(borders[0], values[0], side="left")
    right = np.searchsorted(borders[0], values[0], side="right")
    if len(borders) == 1:
        return right
    out = left.copy()
    tied = np.flatnonzero(left < right)
    if len(tied):
        spans = pd.Series(tied).groupby([left[tied], right[tied]])
        for (lo, hi), rows in spans:
            idx = rows.to_numpy()
            out[idx] = lo + _position([b[lo:hi] for b in borders[1:]], [v[idx] for v in values[1:]])
    return out


def _chunk_column(borders: dict[int, list[np.ndarray]], order: Sequence[str]) -> Column:
    @F.pandas_udf("int")
    def chunk(hot: pd.Series, *cols: pd.Series) -> pd.Series:
        out = np.zeros(len(hot), dtype=np.int32)
        values = [c.to_numpy() for c in cols]
        for key, rows in hot.groupby(hot).indices.items():
            if key in borders:
                out[rows] = _position(borders[key], [v[rows] for v in values])
        return pd.Series(out)

    return chunk(HOT, *order)


class Scan:
    """One scan order over rows grouped by ``keys``; cut by ``chunk`` for hot keys.

    Hot rows are read twice by every step, once for the chunk summaries and once for
    the rows. A step that follows a windowed one therefore starts from a table
    written to the shared folder, so steps add up instead of multiplying.
    """

    def __init__(self, keys: Sequence[str], order: Sequence[str], skew: Skew, chunk: str | None = None, state=None):
        self.keys, self.order, self.skew, self.chunk = list(keys), list(order), skew, chunk
        self.group = Window.partitionBy(*self.keys)
        parts = self.keys + ([chunk] if chunk else [])
        self.window = Window.partitionBy(*parts).orderBy(*self.order)
        self._chunks = Window.partitionBy(*self.keys).orderBy(chunk) if chunk else None
        self._state = {"windowed": False} if state is None else state

    def _settled(self, df: DataFrame) -> DataFrame:
        out = durable(df) if self._state["windowed"] else df
        self._state["windowed"] = False
        return out

    def look(
        self,
        df: DataFrame,
        previous: dict[str, Column] | None = None,
        following: dict[str, Column] | None = None,
        known_before: dict[str, Column] | None = None,
        known_until: dict[str, Column] | None = None,
        sums: dict[str, Column] | None = None,
    ) -> DataFrame:
        """Attach values from around each row, all in one pass.

        ``previous`` and ``following`` take the adjacent row's value whatever it is,
        ``known_before`` and ``known_until`` the latest non-NULL one before or up to the
        row, ``sums`` the running total including the row.
        """
        past, upto = Window.unboundedPreceding, self.window.rowsBetween(Window.unboundedPreceding, 0)
        before = self.window.rowsBetween(past, -1)
        makers = [
            (previous, lambda c: F.lag(c).over(self.window)),
            (following, lambda c: F.lead(c).over(self.window)),
            (known_before, lambda c: F.last(c, ignorenulls=True).over(before)),
            (known_until, lambda c: F.last(c, ignorenulls=True).over(upto)),
            (sums, lambda c: F.sum(c).over(upto)),
        ]
        makers = [(cols or {}, make) for cols, make in makers]
        if not self.chunk:
            return df.withColumns({n: make(c) for cols, make in makers for n, c in cols.items()})
        names = [n for cols, _ in makers for n in cols]
        df = self._settled(df).withColumns({f"_v_{n}": c for cols, _ in makers for n, c in cols.items()})
        out = self._carry(df, previous or {}, following or {}, {**(known_before or {}), **(known_until or {})}, sums or {})
        local = {n: make(F.col(f"_v_{n}")) for cols, make in makers for n in cols}
        first = F.lag(F.lit(True)).over(self.window).isNull().alias("_first")
        last = F.lead(F.lit(True)).over(self.window).isNull().alias("_last")
        out = out.select("*", first, last, *[c.alias(n) for n, c in local.items()])
        merged = {n: F.when(F.col("_first"), F.col(f"_c_{n}")).otherwise(F.col(n)) for n in previous or {}}
        merged |= {n: F.when(F.col("_last"), F.col(f"_c_{n}")).otherwise(F.col(n)) for n in following or {}}
        merged |= {n: F.coalesce(n, f"_c_{n}") for n in [*(known_before or {}), *(known_until or {})]}
        merged |= {
            n: F.when(F.col(n).isNull(), F.col(f"_c_{n}")).otherwise(F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.lit(0)))
            for n in sums or {}
        }
        self._state["windowed"] = True
        return out.withColumns(merged).drop("_first", "_last", *[f"_{p}_{n}" for p in "vc" for n in names])

    def _carry(self, df: DataFrame, previous, following, known, sums) -> DataFrame:
        """Summarise each chunk, carry the summaries across the key's chunks, attach them.

        One row per chunk: proven small, hence broadcast.
        """
        at = F.struct(*self.order)
        edge = [F.max_by(F.struct(*[F.col(f"_v_{n}") for n in previous]), at).alias("_end")] if previous else []
        edge += [F.min_by(F.struct(*[F.col(f"_v_{n}") for n in following]), at).alias("_start")] if following else []
        latest = [F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_c_{n}") for n in known]
        totals = [F.sum(f"_v_{n}").alias(f"_c_{n}") for n in sums]
        chunks = df.groupBy(*self.keys, self.chunk).agg(*edge, *latest, *totals)
        earlier = self._chunks.rowsBetween(Window.unboundedPreceding, -1)
        carried = [F.lag(F.col("_end")[f"_v_{n}"]).over(self._chunks).alias(f"_c_{n}") for n in previous]
        carried += [F.lead(F.col("_start")[f"_v_{n}"]).over(self._chunks).alias(f"_c_{n}") for n in following]
        carried += [F.last(f"_c_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in known]
        carried += [F.sum(f"_c_{n}").over(earlier).alias(f"_c_{n}") for n in sums]
        return _join_keys(df, chunks.select(*self.keys, self.chunk, *carried), [*self.keys, self.chunk])

    def total(self, df: DataFrame, **aggs: Column) -> DataFrame:
        """Attach per-key aggregates to every row of the key."""
        if not self.chunk:
            return df.withColumns({n: a.over(self.group) for n, a in aggs.items()})
        df = self._settled(df)
        rows = df.groupBy(*self.keys).agg(*[a.alias(n) for n, a in aggs.items()])
        return _join_keys(df, rows, self.keys)

    def quantile(self, df: DataFrame, **wanted: tuple[Column, float]) -> DataFrame:
        """Attach exact interpolated per-key quantiles to every row of the key."""
        if not self.chunk:
            return df.withColumns({n: F.percentile(c, F.lit(p)).over(self.group) for n, (c, p) in wanted.items()})
        df = out = self._settled(df)
        for name, (col, p) in wanted.items():
            found = quantiles.select_exact(df, self.keys, col, [p], self.skew, settled=True)
            out = _join_keys(out, found.select(*self.keys, F.col("quantiles")[0].alias(name)), self.keys)
        return out


def _join_keys(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Attach a table of at most a few rows per hot key; keys may be NULL."""
    if not keys:  # one row at most, beside every row
        return df.join(F.broadcast(small), on=F.lit(True), how="left")
    renamed = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    out = df.join(F.broadcast(renamed), on=match, how=how)
    return out.drop(*[f"_k_{k}" for k in keys])


class Groups:
    """Which keys of a table are hot, and where their chunks begin."""

    def __init__(self, keys, orders, skew, hot=None, borders=None, types=None):
        self.keys, self.orders, self.skew = list(keys), orders, skew
        self.hot, self.borders, self.types = hot or [], borders or {}, types

    @classmethod
    def measure(cls, df: DataFrame, keys: Sequence[str], orders: dict[str, Sequence[str]], skew: Skew = Skew()) -> Groups:
        """Sample the table once; runs a Spark job, collects one row per future chunk."""
        keys = list(keys)
        cols = list(dict.fromkeys([*keys, *[c for o in orders.values() for c in o]]))
        picked = df.select(*cols)
        if skew.rate < 1.0:
            picked = picked.sample(fraction=skew.rate, seed=skew.seed)
        whole = Window.partitionBy(*keys)
        marks = {
            f"_rank_{name}": F.row_number().over(whole.orderBy(*order)) % skew.per_chunk == 0
            for name, order in orders.items()
        }
        marked = picked.withColumns({"_n": F.count(F.lit(1)).over(whole), **marks})
        border = F.lit(False)
        for name in marks:
            border = border | F.col(name)
        rows = marked.filter((F.col("_n") >= 2 * skew.per_chunk) & border).drop("_n").limit(MAX_CHUNKS + 1).collect()
        if len(rows) > MAX_CHUNKS:
            raise ValueError(f"more than {MAX_CHUNKS} chunks: raise rows_per_task")
        hot: dict[tuple, int] = {}
        found: dict[str, dict[int, list]] = {name: {} for name in orders}
        for row in rows:
            index = hot.setdefault(tuple(row[k] for k in keys), len(hot))
            for name, order in orders.items():
                if row[f"_rank_{name}"]:
                    found[name].setdefault(index, []).append(tuple(row[c] for c in order))
        borders = {
            name: {i: [np.array(c) for c in zip(*sorted(set(points)))] for i, points in per_key.items()}
            for name, per_key in found.items()
        }
        types = T.StructType([df.schema[k] for k in keys] + [T.StructField(HOT, T.IntegerType())])
        return cls(keys, orders, skew, [(*k, i) for k, i in hot.items()], borders, types)

    def apply(self, df: DataFrame, body: Callable[[DataFrame, dict[str, Scan]], DataFrame]) -> DataFrame:
        """Run ``body`` on the ordinary keys and, apart from them, on the hot ones."""
        plain = {name: Scan(self.keys, order, self.skew) for name, order in self.orders.items()}
        if not self.hot:
            return body(df, plain)
        state = {"windowed": False}
        cut = {n: Scan(self.keys, o, self.skew, f"_chunk_{n}", state) for n, o in self.orders.items()}
        hot = self.hot_rows(df)
        hot = hot.withColumns(
            {f"_chunk_{name}": _chunk_column(self.borders[name], order) for name, order in self.orders.items()}
        ).drop(HOT)
        done = body(hot, cut).drop(*[f"_chunk_{name}" for name in self.orders])
        if not self.keys:
            return done
        rest = _join_keys(df, self._hot_table(df).drop(HOT), self.keys, how="left_anti")
        return body(rest, plain).unionByName(done)

    def _hot_table(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.createDataFrame(self.hot, self.types)

    def hot_rows(self, df: DataFrame) -> DataFrame:
        """Rows of the hot keys, with the key's number in ``HOT``."""
        if not self.keys:
            return df.withColumn(HOT, F.lit(0))
        return _join_keys(df, self._hot_table(df), self.keys, how="inner")


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """1-based position of every row in the table's order.

    Rows are dealt out by ranges of the order, sorted and written once; a range's rows then count
    on from the rows of all ranges before it. Those counts, a number per range, are all that the
    driver sees; no row passes through one task or through Python.
    """
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = durable(cut.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).cast("int")
    sizes = sorted((r.part, r["count"]) for r in cut.groupBy(part.alias("part")).count().collect())  # a row per range
    shifts, before = [], 0
    for at, n in sizes:
        shifts.append((at, before - (at << 33)))
        before += n
    table = df.sparkSession.createDataFrame(shifts, "_part int, _shift bigint")
    out = cut.withColumn("_part", part).join(F.broadcast(table), "_part")  # as many rows as ranges
    return out.withColumn(name, F.col("_at") + F.col("_shift") + 1).drop("_part", "_at", "_shift")


def position(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, skew: Skew = Skew()) -> DataFrame:
    """1-based position of every row within its key, or in the table without keys."""
    if not keys:
        return numbered(df, order, name)
    groups = Groups.measure(df, keys, {"o": order}, skew)
    return groups.apply(df, lambda part, scans: scans["o"].look(part, sums={name: F.lit(1).cast("bigint")}))
