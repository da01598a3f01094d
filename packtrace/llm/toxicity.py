"""Toxicity scores from a bag of subwords.

Every character n-gram of a word, its edges marked by a space, has an embedding in a hashed
table; a text is the average of its n-grams' embeddings, read by a linear softmax. Embeddings
and softmax are trained jointly, so a misspelling never seen is judged by the n-grams it shares
with words that were. Scoring folds both into one weight per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from packtrace.llm.common import piece, remainder, slices

NGRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 18
DIM = 4
TRAIN_ROWS = {1: 2000, 0: 4000}  # labelled rows per class, the documented bound of the fit
TRAIN_DOC_CHARS = 12_000  # of a text in the fit: longer texts serve, by a piece, only a class without shorter ones
STEPS, BATCH, RATE, DECAY = 800, 64, 1.0, 1e-4
LEAST_TEXTS = 3  # texts of the sample that hold a bucket, else it keeps weight zero
_SLICE = 1 << 19  # bytes of text scored together; their n-grams take about a hundred times as much
_SPACE = 32


def _table() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


_KNOWN: dict[str, np.ndarray] = {}


def _codes(text: str | None) -> np.ndarray:
    return np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass") if text else b"", np.uint32)


def units(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, and for each the place of its text.

    Letters and digits are kept, lower-cased; each run of other characters is one word edge.
    """
    if "alnum" not in _KNOWN:
        _KNOWN["alnum"] = _table()
    parts = [_codes(t) for t in texts]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    codes = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    doc = np.repeat(np.arange(len(parts), dtype=np.int32), size)
    inside = _KNOWN["alnum"][codes]
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # one edge after each word; the one before is its left neighbour
    keep[:-1] |= inside[1:] & ~inside[:-1]
    codes = np.where(inside, codes, _SPACE)[keep]
    inside, doc = inside[keep], doc[keep]
    edge = np.concatenate([[0], np.cumsum(~inside, dtype=np.int32)]).astype(np.int32)
    found, owner = [], []
    h = codes.astype(np.uint32)
    for n in range(2, NGRAMS[-1] + 1):
        if len(codes) < n:
            break
        h = h[: len(codes) - n + 1] * np.uint32(16777619) + codes[n - 1 :]
        if n < NGRAMS[0]:
            continue
        last = len(codes) - n + 1
        whole = edge[n - 1 : n - 1 + last] == edge[1 : 1 + last]  # no edge strictly inside
        at = np.flatnonzero(whole)
        mixed = (h[at] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(2654435761)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(2246822519)
        found.append(mixed >> np.uint32(32 - BUCKETS.bit_length() + 1))
        owner.append(doc[at])
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    return np.concatenate(found), np.concatenate(owner)


def fit(texts: list[str], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Train embeddings and softmax jointly; returns one weight per bucket and the bias of class 1."""
    rng = np.random.default_rng(seed)
    rows, share = [], []
    held = np.zeros(BUCKETS, np.int32)
    for t in texts:
        bucket, n = np.unique(units([t])[0], return_counts=True)
        held[bucket] += 1
        rows.append(bucket)
        share.append((n / max(1, n.sum())).astype(np.float32))
    known = np.flatnonzero(held >= LEAST_TEXTS)
    place = np.full(BUCKETS, -1, np.int64)
    place[known] = np.arange(len(known))
    for i, bucket in enumerate(rows):
        at = place[bucket]
        rows[i], share[i] = at[at >= 0], share[i][at >= 0]
    embed = rng.uniform(-1 / DIM, 1 / DIM, (len(known), DIM)).astype(np.float32)
    soft = rng.normal(0, 1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full(p.shape, 1e-8, np.float32) for p in (embed, soft, bias)]
    target = np.eye(2, dtype=np.float32)[labels.astype(int)]
    order = np.zeros(0, np.int64)
    for step in range(STEPS if len(texts) and len(known) else 0):
        rate = RATE * (1 - step / STEPS)
        while len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(texts))])
        batch, order = order[:BATCH], order[BATCH:]
        flat = np.concatenate([rows[i] for i in batch])
        part = np.concatenate([share[i] for i in batch])
        which = np.repeat(np.arange(len(batch)), [len(rows[i]) for i in batch])
        taken = embed[flat] * part[:, None]
        hidden = np.stack([np.bincount(which, taken[:, d], len(batch)) for d in range(DIM)], 1).astype(np.float32)
        logit = hidden @ soft + bias
        logit -= logit.max(1, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(1, keepdims=True)
        wrong = p - target[batch]
        back = (wrong @ soft.T)[which] * part[:, None]
        grads = [
            np.stack([np.bincount(flat, back[:, d], len(known)) for d in range(DIM)], 1).astype(np.float32),
            hidden.T @ wrong,
            wrong.sum(0),
        ]
        for value, grad, sum2 in zip((embed, soft, bias), grads, seen, strict=True):
            sum2 += grad * grad
            value *= 1 - rate * DECAY
            value -= rate * grad / np.sqrt(sum2)
    weight = np.zeros(BUCKETS, np.float32)
    weight[known] = embed @ (soft[:, 1] - soft[:, 0])
    return weight, float(bias[1] - bias[0])


def _sample(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str) -> tuple[DataFrame, dict[int, int]]:
    marks = labels.select(F.col(id).cast("long").alias("key"), F.col(label).cast("int").alias("y"))
    marks = marks.filter("key is not null and y in (0, 1)").groupBy("key").agg(F.max("y").alias("y"))
    marks = marks.filter(remainder("key", 5) != 0)
    counts = {r[0]: r[1] for r in marks.groupBy("y").count().collect()}
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 40))
    top = F.when(F.col("y") == 1, F.lit(_cut(counts, 1))).otherwise(F.lit(_cut(counts, 0)))
    picked = marks.filter(place < top)
    rows = docs.select(F.col(id).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.filter("text is not null").select(
        "key", piece(F.col("text"), F.col("key"), TRAIN_DOC_CHARS).alias("text"), (F.char_length("text") > TRAIN_DOC_CHARS).alias("long"))
    return rows.join(F.broadcast(picked), "key").select("key", "text", "y", "long"), counts  # picked is bounded by TRAIN_ROWS


def _cut(counts: dict[int, int], y: int) -> int:
    return int((1 << 40) * min(1.0, TRAIN_ROWS[y] / max(1, counts.get(y, 0))))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple[np.ndarray, float]:
    """Fit on a bounded sample of labelled rows whose id is not held out; runs in one task.

    The sample is drawn by a hash of the id, per class. The bias is set back to the share of
    the classes among all rows that may be learnt from. With one class or no labels all
    weights are zero and the score is that share (a half without labels).
    """
    picked, counts = _sample(docs, labels, id, text, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        rows = sorted(set(zip(*(table.column(c).to_pylist() for c in ("key", "text", "y", "long")), strict=True))) if len(table) else []
        shorter = {y for _, _, y, long in rows if not long}
        rows = [r for r in rows if not r[3] or r[2] not in shorter]
        y = np.array([r[2] for r in rows], np.int64)
        if len(set(y.tolist())) < 2:
            return
        weight, bias = fit([r[1] for r in rows], y)
        bias -= float(np.log(y.sum() / (len(y) - y.sum())))  # to even odds
        yield pa.RecordBatch.from_arrays([pa.array([weight.tobytes()]), pa.array([bias])], ["weight", "bias"])

    found = picked.repartition(1).mapInArrow(run, "weight binary, bias double").collect()
    odds = float(np.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)))
    if not found:
        return np.zeros(BUCKETS, np.float32), odds
    return np.frombuffer(bytes(found[0].weight), np.float32), found[0].bias + odds


def scores(texts: list[str | None], weight: np.ndarray, bias: float) -> np.ndarray:
    bucket, doc = units(texts)
    total = np.bincount(doc, weight[bucket], len(texts))
    mean = total / np.maximum(1, np.bincount(doc, minlength=len(texts)))
    return 1 / (1 + np.exp(-np.clip(mean + bias, -60, 60)))


def score(docs: DataFrame, model: tuple[np.ndarray, float], id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1), predicted (1 from 0.5 on).

    Null and empty texts, and texts without letters or digits, have the score of the bias alone.
    Whole texts are read, however long; columns beside id and text are not.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one weight per bucket: 1 MB
    out = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = shared.value
        for batch in slices(batches, "text", _SLICE):
            found = scores(batch.column("text").to_pylist(), weight, bias)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], schema=out)

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``least``, with all their columns; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, _SLICE):
            yield batch.filter(pa.array(scores(batch.column(text).to_pylist(), *shared.value) < least))

    return docs.mapInArrow(run, docs.schema)
