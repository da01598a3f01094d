"""SimHash near-duplicates, compared by bit planes.

Fingerprints that differ in at most ``radius`` bits agree in all but ``radius`` of their pieces,
so every pair to be linked meets in a bucket. A bucket's fingerprints are stored vertically, one
64-lane word per bit; a query's differences are added up plane by plane in carry-save counters
whose overflow marks the lanes beyond the radius, and words are abandoned once all lanes are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from packtrace.llm.common import free, words
from packtrace.llm.links import components
from packtrace.session import durable

SHINGLE, RADIUS, SEED = 3, 2, 42
PIECES = 4  # of 16 bits each
BUCKET_ROWS = 4096  # larger buckets are cut by further bits
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is 1 if set in more than half of the shingle hashes; no words give zero."""
    w = words(text)
    if not w:
        return 0
    if len(w) <= shingle:
        parts = [b" ".join(w)]
    else:
        parts = map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, seed) for p in parts), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[i : i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp, mark) for every row; fp is the fingerprint as a signed long, mark a digest of the text.

    Null texts have no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), batch.column(2)], ["doc_id", "fp", "mark"])

    whole = F.col(text).cast("string")
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), whole.alias("text"), _mark(whole).alias("mark"))
    return rows.mapInArrow(run, "doc_id long, fp long, mark string")


def _mark(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def planes(values: np.ndarray, word: np.ndarray, lane: np.ndarray, n_words: int) -> np.ndarray:
    """Bit planes: element [b, w] holds bit b of the 64 fingerprints of word w, one per lane."""
    out = np.zeros((64, n_words), np.uint64)
    one = np.uint64(1)
    for b in range(64):
        bit = (values >> np.uint64(b)) & one
        np.bitwise_or.at(out[b], word, bit << lane)
    return out


def within(query: np.ndarray, word: np.ndarray, stored: np.ndarray, radius: int) -> np.ndarray:
    """For each (query fingerprint, word) item a mask of the lanes within ``radius`` bits."""
    width = max(1, radius.bit_length())
    start = (1 << width) - 1 - radius  # so that the counter overflows at radius + 1
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.zeros(len(query), np.uint64)
    at = np.arange(len(query))
    count = [np.full(len(query), full if start >> k & 1 else 0, np.uint64) for k in range(width)]
    over = np.zeros(len(query), np.uint64)
    for b in range(64):
        carry = stored[b][word] ^ (np.uint64(0) - ((query >> np.uint64(b)) & np.uint64(1)))
        for k in range(width):
            count[k], carry = count[k] ^ carry, count[k] & carry
        over |= carry
        if b % 8 == 7 and b < 63:
            live = over != full
            if live.sum() < 0.7 * len(live):  # abandon words whose lanes are all out
                at, query, word, over = at[live], query[live], word[live], over[live]
                count = [c[live] for c in count]
    out[at] = ~over
    return out


def _join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        la, lb = labels[a], labels[b]
        if (la == lb).all():
            return labels
        low = np.minimum(la, lb)
        np.minimum.at(labels, la, low)
        np.minimum.at(labels, lb, low)
        while (labels[labels] != labels).any():
            labels = labels[labels]


def bucket_links(key: np.ndarray, value: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within buckets, each fingerprint to the smallest it reaches in its bucket.

    ``key`` is sorted. Returns (fingerprint, smaller fingerprint) for those that reach one.
    """
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    order = np.lexsort((value, np.repeat(np.arange(len(first)), size)))
    value = value[order]
    place = np.arange(len(key)) - np.repeat(first, size)
    n_words = -(-size // 64)
    word0 = np.cumsum(n_words) - n_words
    word = np.repeat(word0, size) + place // 64
    stored = planes(value, word, (place % 64).astype(np.uint64), int(n_words.sum()))
    row_of = np.zeros(int(n_words.sum()), np.int64)  # row in a word's lane 0
    row_of[word[place % 64 == 0]] = np.flatnonzero(place % 64 == 0)
    lanes = np.minimum(64, np.repeat(size, n_words) - (np.arange(len(row_of)) - np.repeat(word0, n_words)) * 64)
    valid = np.where(lanes == 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (lanes % 64).astype(np.uint64)) - np.uint64(1))
    # a query looks at its own word and those after it: each pair is compared once or twice
    ahead = np.repeat(word0 + n_words, size) - word
    ends = np.cumsum(ahead)
    labels = np.arange(len(key))
    for begin in range(0, int(ends[-1]) if len(ends) else 0, _CHUNK):
        item = np.arange(begin, min(begin + _CHUNK, int(ends[-1])))
        row = np.searchsorted(ends, item, side="right")
        at = word[row] + item - (ends[row] - ahead[row])
        hit = within(value[row], at, stored, radius) & valid[at]
        some = np.flatnonzero(hit)
        bits = np.unpackbits(hit[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, lane = np.nonzero(bits)
        labels = _join_labels(labels, row[some][which], row_of[at[some]][which] + lane)
    far = np.flatnonzero(labels != np.arange(len(key)))
    return value[far], value[labels[far]]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, value):
            a, b = bucket_links(key, value, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"])

        key, value = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            key = np.r_[key, batch.column(0).to_numpy()]
            value = np.r_[value, batch.column(1).to_numpy().view(np.uint64)]
            done = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last bucket may go on in the next batch
            if done:
                yield out(key[:done], value[:done])
                key, value = key[done:], value[done:]
        if len(key):
            yield out(key, value)

    return run


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (u, v) that connect exactly the distinct fingerprints ``fp`` within ``radius`` bits of each other."""
    kept = PIECES - radius
    if kept < 1:
        raise ValueError(f"radius must be below {PIECES}")
    piece = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(PIECES)]
    keys = []
    for n, chosen in enumerate(combinations(range(PIECES), kept)):
        rest = [i for i in range(PIECES) if i not in chosen]
        left = sum((F.shiftleft(piece[i], 16 * k) for k, i in enumerate(rest)), F.lit(0).cast("long"))
        keys.append(F.struct(F.xxhash64(F.lit(n), *[piece[i] for i in chosen]).alias("key"), left.alias("rest")))
    placed = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.key", "k.rest")
    sizes = durable(placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    placed = placed.join(sizes, "key")
    # of a large bucket's remaining bits, one of radius + 1 parts must agree as well
    bits, parts = 16 * radius, radius + 1
    edges = [bits * i // parts for i in range(parts + 1)]
    further = [
        F.xxhash64("key", F.lit(i), F.shiftright("rest", edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1)))
        for i in range(parts)
    ]
    bucket = F.explode(F.when(F.col("n") > bucket_rows, F.array(*further)).otherwise(F.array("key")))
    placed = placed.select(bucket.alias("bucket"), "fp")
    return placed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_compare(radius), "u long, v long")


def _rooted(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, low, root) per distinct fingerprint: its smallest id, and the fingerprint that names its component."""
    distinct = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(fingerprint_links(distinct.select("fp"), radius))
    return durable(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id that links reach, its own included. Copies of a fingerprint
    count once, so a large group of copies costs no comparisons. Null and empty texts share the
    fingerprint zero. An empty table gives an empty result; other columns are not read.
    """
    marked = durable(fingerprints(docs, id, text, shingle).drop("mark"))
    rooted = _rooted(marked, radius)
    lowest = durable(rooted.groupBy("root").agg(F.min("low").alias("component_id")))
    of_fp = durable(rooted.join(lowest, "root").select("fp", "component_id"))
    out = marked.join(of_fp, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component of ``docs``, with all its columns, whatever those are called.

    The row with the smallest id stays (rows without an id last), among rows with that id the one
    whose text has the smallest digest, and of rows repeated in id and text the first.
    """
    marked = durable(fingerprints(docs, id, text, shingle))
    same = durable(marked.groupBy("fp", "doc_id", "mark").agg(F.count(F.lit(1)).alias("n")))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    rooted = _rooted(marked, radius).select("fp", "root")
    of_fp = same.groupBy("fp").agg(F.min(first).alias("first"))  # combined before copies of a component meet
    best = of_fp.join(rooted, "fp").groupBy("root").agg(F.min("first").alias("best"))
    best = durable(rooted.join(best, "root").select("fp", "best"))
    id_, mark = free(docs, "_id", "_mark")
    judged = same.join(best, "fp").withColumn("stays", F.col("best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("best.mark") == F.col("mark")))
    judged = durable(judged.filter("n > 1 or not stays").select(F.col("doc_id").alias(id_), F.col("mark").alias(mark), "stays"))
    whole = F.col(text).cast("string")
    match = [F.col(id).cast("long").eqNullSafe(F.col(id_)), _mark(whole) == F.col(mark)]
    # what goes is usually little, so that few texts travel
    once = docs.join(judged.drop("stays"), match, "left_anti")
    again = docs.join(judged.filter("stays").drop("stays"), match, "left_semi")
    again = again.withColumns({id_: F.col(id).cast("long"), mark: _mark(whole)}).dropDuplicates([id_, mark])
    return once.unionByName(again.drop(id_, mark))
