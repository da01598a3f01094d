"""Best-fit packing of documents into bins, with conflicts.

Documents are dealt to shards by a hash; a shard is packed in one task, longest piece first.
Its open bins stand in the order of their residual room, each with bitmaps of the sources and
duplicate clusters it holds. A piece goes to the successor of its length in that order, and on
to the next until the tightest compatible bin is found; without one it opens a bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from packtrace.llm.common import without_white
from packtrace.session import durable

CAPACITY = 4096  # words per bin
PER_SOURCE = 4  # pieces of one source per bin
SHARD_ROWS = 8192  # expected rows per shard


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int = 1) -> list[int]:
    """Bin of each piece, in the given order. Negative sources or clusters conflict with nothing.

    A source has ``per_source`` places in a bin's bitmap, a cluster one. Bins of equal room are
    tried in the order in which they were opened.
    """
    rooms: list[tuple[int, int]] = []  # (residual, bin), in order
    held: list[tuple[int, int]] = []  # per bin its source and cluster bitmaps
    out = []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        s = (1 << per_source) - 1 << per_source * source if source >= 0 else 0
        c = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(rooms, (length, -1))
        while at < len(rooms):
            have = held[rooms[at][1]]
            if not have[1] & c and (not s or have[0] & s != s):
                break
            at += 1
        if at < len(rooms):
            room, bin_ = rooms.pop(at)
        else:
            room, bin_ = capacity, len(held)
            held.append((0, 0))
        free = s & ~held[bin_][0]
        held[bin_] = (held[bin_][0] | free & -free, held[bin_][1] | c)
        if room > length:
            insort(rooms, (room - length, bin_))
        out.append(bin_)
    return out


def _numbered(values: list, shared_only: bool) -> list[int]:
    """Small numbers for bitmap places; -1 for null and, if asked, for values that occur once."""
    count: dict = {}
    for v in values:
        count[v] = count.get(v, 0) + 1
    number: dict = {}
    return [
        -1 if v is None or (shared_only and count[v] == 1) else number.setdefault(v, len(number)) for v in values
    ]


def _pack(capacity: int, per_source: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("length", "doc", "piece", "source", "cluster", "row", "start", "shard")),
                          strict=True), key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2], r[5]))
        bins = best_fit([r[0] for r in rows], _numbered([r[3] for r in rows], False), _numbered([r[4] for r in rows], True), capacity, per_source)
        used: dict[int, int] = {}
        offset = []
        for b, r in zip(bins, rows, strict=True):
            offset.append(used.get(b, 0))
            used[b] = offset[-1] + r[0]
        return pa.table({
            "row": pa.array([r[5] for r in rows], pa.int64()), "doc_id": pa.array([r[1] for r in rows], pa.int64()),
            "piece": pa.array([r[2] for r in rows], pa.int32()), "start": pa.array([r[6] for r in rows], pa.int64()),
            "length": pa.array([r[0] for r in rows], pa.int64()), "shard": pa.array([r[7] for r in rows], pa.int32()),
            "bin": pa.array(bins, pa.int32()), "offset": pa.array(offset, pa.int64()),
        })

    return run


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def pack(docs: DataFrame, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text", source: str = "source",
         cluster: Column | None = None, per_source: int = PER_SOURCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pieces of documents in bins: row, doc_id, piece, start, length, shard, bin, offset, bin_id.

    Lengths are words. A document longer than ``capacity`` gives full pieces, each a bin of its
    own, and a rest that is packed; a document without words gives one piece of length 0. No bin
    holds more than ``per_source`` pieces of one source or two of one duplicate cluster (by
    default: texts equal after deleting white space); a null source or cluster conflicts with nothing. Bins are told
    apart by ``bin_id``, unique over all shards; full pieces have bin_id -1 - (row, piece) order.
    Every row is packed, repeated ones too; an empty table gives an empty result.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    bare = without_white(whole)
    cluster = F.when(bare != "", F.xxhash64(bare)) if cluster is None else cluster
    rows = docs.select(
        F.col(id).cast("long").alias("doc"), F.col(source).cast("string").alias("source"), cluster.alias("cluster"),
        word_count(whole).alias("n"),
    ).withColumn("row", F.monotonically_increasing_id())
    rows = durable(rows)
    total = rows.count()
    shards = max(1, -(-total // shard_rows))
    full = F.floor(F.col("n") / capacity).cast("int")
    rest = F.col("n") % capacity
    rows = rows.withColumn("full", full).withColumn("rest", rest)
    packed = rows.filter("rest > 0 or full = 0").select(
        F.pmod(F.xxhash64("row", "doc"), F.lit(shards)).cast("int").alias("shard"), "row", "doc", "source", "cluster",
        F.col("full").alias("piece"), (F.col("full").cast("long") * capacity).alias("start"), F.col("rest").alias("length"))
    packed = packed.groupBy("shard").applyInArrow(
        _pack(capacity, per_source), "row long, doc_id long, piece int, start long, length long, shard int, bin int, offset long")
    packed = packed.withColumn("bin_id", F.col("shard").cast("long") * (1 << 32) + F.col("bin"))
    alone = rows.filter("full > 0").select(
        "row", F.col("doc").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("piece")).select(
        "row", "doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
        F.lit(-1).alias("shard"), F.lit(0).alias("bin"), F.lit(0).cast("long").alias("offset"),
        (-1 - F.monotonically_increasing_id()).alias("bin_id"))
    return packed.unionByName(alone)


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per bin its pieces, words and share of the capacity."""
    return packed.groupBy("bin_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("length").alias("words")).withColumn(
        "share", F.col("words") / capacity)

