"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions, each with its own context tree over the bytes before it.
A node's counts give a Krichevsky-Trofimov estimate; weighting mixes the estimates of all
depths. Counts come from the whole training text: tasks count n-grams and ship sorted arrays by
the three nearest bytes of context, one task per bucket of those builds and weighs its subtrees,
and depths 0 to 2 are weighed from the sums of all buckets, at most 2**24 nodes. The weighed tree then predicts each bit from the
deepest context it holds. It stays as the written table: scoring holds the code lengths of the
n-grams seen most and asks the buckets for those of all others, so every node counts.

The text of a document is its token sequence: A to Z lower-cased, words joined by one space,
and an end byte. The unigram base score uses the same tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from packtrace.llm.common import remainder, slices
from packtrace.session import durable

DEPTH = 6  # bytes of context
GRAMS = 3_000_000  # n-grams whose code lengths scoring holds in memory; the others' are asked for
FREQUENT = 1 << 19  # words whose counts scoring holds in memory; the others' counts are joined
_SLICE = 1 << 20
_SCORED = 2 << 20  # bytes of text scored together, beside the model
_PARTIAL = 1_000_000  # distinct n-grams a task gathers before it ships them
_PART = 60_000  # n-grams weighed together
_ASKED = 2_000_000  # n-grams asked of a bucket in one task; more of them are spread over copies of its tree
_LOOK = 200_000  # n-grams looked up together
BUCKETS = 512  # of contexts, at least; each is a row of the written tree
_MOST = 1 << 30  # of a count that is shipped
_END = b"\0"
_U = np.uint64


# --- texts as bytes -----------------------------------------------------------------


def _words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another as UTF-8, with A to Z lower-cased, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    flat, ends = lists.flatten(), np.r_[0, np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64)]
    full = pc.greater(pc.binary_length(flat), 0)  # white space at either end leaves an empty word
    before = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)]
    return flat.filter(full).cast(pa.binary()), np.diff(before[ends])


def _hashes(word: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, word.to_pylist()), _U, len(word))


def _stream(word: pa.Array, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of DEPTH context bytes and the byte they precede, for all bytes; and bytes per text."""
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(tokens)].astype(np.int32)), word)
    texts = pc.binary_join_element_wise(b"\0" * DEPTH, pc.binary_join(lists, b" "), _END, b"")
    size = pc.binary_length(texts).to_numpy().astype(np.int64)
    a = np.frombuffer(texts.buffers()[2], np.uint8, int(size.sum()))
    two = a[:-1].astype(np.uint32) << np.uint32(8) | a[1:]
    four = two[:-2] << np.uint32(16) | two[2:]
    key = four[:-3].astype(_U) << _U(24) | (four[3:] & np.uint32(0xFFFFFF)).astype(_U)
    start = np.cumsum(size) - size
    real = np.ones(len(key), bool)
    for k in range(1, DEPTH + 1):  # keys that end in a later text's padding
        real[start[1:] - k] = False
    return key[real], size - DEPTH


def _counted(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed counts."""
    order = np.argsort(key)
    key, count = key[order], count[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.sort(key)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.diff(np.r_[first, len(key)])


def _pack(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: sorted keys then compress well in a shuffle."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unpack(blob: bytes, kind) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    return np.frombuffer(blob, np.uint8).reshape(wide, -1).T.copy().reshape(-1).view(kind)


def _mix(x: np.ndarray) -> np.ndarray:
    return (x * _U(0x9E3779B97F4A7C15)) >> _U(40)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of n-grams, by the three nearest context bytes."""
    return _mix((key >> _U(8)) & _U(0xFFFFFF)) % _U(buckets)


def _by_bucket(where: np.ndarray, buckets: int) -> np.ndarray:
    """Stable order of bucket numbers; numpy sorts short integers by radix."""
    return np.argsort(where.astype(np.uint16) if buckets <= 1 << 16 else where, kind="stable")


# --- gathering ------------------------------------------------------------------------


def _gather(buckets: int):
    """Per task: n-gram counts (kind 0, by the nearest context bytes) and word counts (kind 1, by word)."""
    out = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("key", pa.binary()), ("n", pa.binary())])

    def ship(kind: int, key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        where = _bucket(key, buckets) if kind == 0 else (key >> _U(40)) % _U(buckets)
        order = _by_bucket(where, buckets)
        key, n = key[order], n[order].astype(np.int32)
        cuts = np.searchsorted(where[order], np.arange(buckets + 1, dtype=_U))
        full = np.flatnonzero(np.diff(cuts))
        parts = [slice(cuts[b], cuts[b + 1]) for b in full.tolist()]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(full), kind, np.int32)), pa.array(full.astype(np.int32)),
            pa.array([_pack(key[p]) for p in parts], pa.binary()), pa.array([_pack(n[p]) for p in parts], pa.binary())], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n = np.zeros(0, _U), np.zeros(0, np.int64)
        word, times = np.zeros(0, _U), np.zeros(0, np.int64)
        texts = total = 0
        for batch in slices(batches, "text", _SLICE):
            flat, tokens = _words(batch.column("text"))
            texts += len(tokens)
            fresh, m = _distinct(_stream(flat, tokens)[0])
            key, n = _counted(np.r_[key, fresh], np.r_[n, m])
            total += int(m.sum())
            if len(key) > _PARTIAL or total > _MOST:
                yield from ship(0, key, n)
                key, n = np.zeros(0, _U), np.zeros(0, np.int64)
            found = flat.value_counts()
            word, times = _counted(np.r_[word, _hashes(found.field("values"))], np.r_[times, found.field("counts").to_numpy()])
            if len(word) > _PARTIAL // 8 or total > _MOST:
                yield from ship(1, word, times)
                word, times = np.zeros(0, _U), np.zeros(0, np.int64)
            total = 0 if total > _MOST else total
        yield from ship(0, key, n)
        if texts:  # the end token
            word, times = _counted(np.r_[word, _U(xxhash.xxh64_intdigest(b""))], np.r_[times, texts])
        yield from ship(1, word, times)

    return run


# --- weighting ------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after moving the argument up by six."""
    low = np.ones_like(x)
    y = x.copy()
    for _ in range(6):
        low *= y
        y += 1
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) - np.log(low)


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1) - np.log(np.pi)


def _bits(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes (context << 8 | bits so far, led by a 1) of sorted n-grams, with counts of zeros and ones."""
    context, byte = key >> _U(8) << _U(8), key & _U(255) | _U(256)
    keys, zeros, ones = [], [], []
    for s in range(8):
        node = context | byte >> _U(s + 1)
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        bit = (byte >> _U(s) & _U(1)).astype(bool)
        keys.append(node[first])
        zeros.append(np.add.reduceat(np.where(bit, 0, n), first))
        ones.append(np.add.reduceat(np.where(bit, n, 0), first))
    keys, zeros, ones = map(np.concatenate, (keys, zeros, ones))
    order = np.argsort(keys)
    return keys[order], zeros[order].astype(float), ones[order].astype(float)


def _up(key: np.ndarray, depth: int, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Parents of nodes of ``depth``: their keys, each child's parent, and the children's sums."""
    parent, of = np.unique(key & _U((1 << 8 * depth) - 1), return_inverse=True)
    return parent, of, [np.bincount(of, v, len(parent)) for v in values]


def _share(own: np.ndarray, weighed: np.ndarray) -> np.ndarray:
    """Weight of a node's own estimate against its children's."""
    return np.exp(np.log(0.5) + own - weighed)


def _both(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    return np.logaddexp(np.log(0.5) + own, np.log(0.5) + children)


def subtrees(key: np.ndarray, n: np.ndarray, root: int) -> tuple[tuple, tuple]:
    """Weigh the nodes of depths ``root`` to DEPTH above sorted n-grams.

    Returns per node its key led by its depth, the settled part of its prediction and the
    weight left to deeper nodes, both relative to what the root gets; then, for the parents of
    the roots, key, zeros, ones and summed log weights.
    """
    levels = {}
    key, zeros, ones = _bits(key, n)
    own = weighed = _log_kt(zeros, ones)
    parents: dict[int, np.ndarray] = {}
    levels[DEPTH] = (key, zeros, ones, own, weighed)
    for depth in range(DEPTH - 1, root - 1, -1):
        key, parents[depth + 1], (zeros, ones, children) = _up(key, depth + 1, zeros, ones, weighed)
        own = _log_kt(zeros, ones)
        weighed = _both(own, children)
        levels[depth] = (key, zeros, ones, own, weighed)
    above, _, sums = _up(key, root, zeros, ones, weighed)
    out = []
    done, rest = np.zeros(len(key)), np.ones(len(key))
    for depth in range(root, DEPTH + 1):
        key, zeros, ones, own, weighed = levels[depth]
        if depth > root:
            done, rest = done[parents[depth]], rest[parents[depth]]
        estimate = (ones + 0.5) / (zeros + ones + 1)
        share = _share(own, weighed) if depth < DEPTH else np.ones(len(key))
        done, rest = done + rest * share * estimate, rest * (1 - share)
        out.append((key | _U(depth << 56), done.astype(np.float32), rest.astype(np.float32)))
    return tuple(map(np.concatenate, zip(*out, strict=True))), (above, *sums)


class Crown:
    """Depths 0 and 1 as dense tables over (context byte, bits so far), depth 2 as sorted keys.

    ``done`` is the settled part of a prediction and ``rest`` the weight left to deeper nodes;
    ``alone`` is the prediction where depth 2 was never seen.
    """

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray):
        by = np.argsort(key)
        key, zeros, ones, children = key[by], zeros[by], ones[by], children[by]
        own2 = _log_kt(zeros, ones)
        weighed2 = _both(own2, children)
        share2 = _share(own2, weighed2)
        self.key2, self.done2, self.rest2 = key, (share2 * (ones + 0.5) / (zeros + ones + 1)).astype(np.float32), (1 - share2).astype(np.float32)
        self.done, self.rest, self.alone = np.zeros(1 << 16), np.zeros(1 << 16), np.full(1 << 16, 0.5)
        if not len(key):
            return
        key1, _, (zeros, ones, children) = _up(key, 2, zeros, ones, weighed2)
        own1 = _log_kt(zeros, ones)
        weighed1 = _both(own1, children)
        key0, up, (z0, o0, c0) = _up(key1, 1, zeros, ones, weighed1)
        own0 = _log_kt(z0, o0)
        share0 = _share(own0, _both(own0, c0))
        est0 = (o0 + 0.5) / (z0 + o0 + 1)
        share1, est1 = _share(own1, weighed1), (ones + 0.5) / (zeros + ones + 1)
        for node, p in zip(key0.tolist(), (share0 * est0 + (1 - share0) / 2).tolist(), strict=True):
            self.alone[node::256] = p  # contexts never seen
        at = key1.astype(np.int64)
        self.done[at] = (share0 * est0)[up] + (1 - share0)[up] * share1 * est1
        self.rest[at] = (1 - share0)[up] * (1 - share1)
        self.alone[at] = self.done[at] + self.rest[at] / 2


_CLASSES = 4096


def _class(n: np.ndarray) -> np.ndarray:
    """Counts in steps: exact to 1024, then 64 steps per doubling."""
    return np.where(n <= 1024, n, 1024 + np.floor(64 * np.log2(np.maximum(n, 1024) / 1024))).astype(np.int64).clip(0, _CLASSES - 1)


def _weigh(table: pa.Table) -> pa.Table:
    """Weigh a bucket. Contexts of three bytes are independent below depth 3, so they go through in small parts."""
    key, n = _counted(
        np.concatenate([_unpack(b, _U) for b in table.column("key").to_pylist()]),
        np.concatenate([_unpack(b, np.int32) for b in table.column("n").to_pylist()]).astype(np.int64))
    near = key >> _U(8) & _U(0xFFFFFF)
    order = np.argsort(near, kind="stable")
    key, n, near = key[order], n[order], near[order]
    often = _class(n).astype(np.int16)
    ends = np.flatnonzero(np.r_[near[1:] != near[:-1], True]) + 1
    parts, tops, begin = [], [], 0
    while begin < len(key):
        last = min(int(np.searchsorted(ends, begin + _PART)), len(ends) - 1)
        stop = int(ends[last])
        at = begin + np.argsort(key[begin:stop])
        part, top = subtrees(key[at], n[at], 3)
        parts.append(part)
        tops.append(top)
        begin = stop
    nodes, done, rest = map(np.concatenate, zip(*parts, strict=True))
    del parts
    key2, _, sums = _up(np.concatenate([t[0] for t in tops]), 3, *(np.concatenate([t[i] for t in tops]) for i in (1, 2, 3)))
    at = np.argsort(nodes)
    value = (done + rest / 2)[at].astype(np.float32)  # deeper contexts that were never seen would add a half of the rest
    return pa.table({
        "bucket": table.column("bucket")[:1], "gram": [key.tobytes()], "often": [often.tobytes()],
        "grams": [np.bincount(often, minlength=_CLASSES).astype(np.int64).tobytes()],
        "key": [nodes[at].tobytes()], "value": [value.tobytes()],
        "top": [b"".join(np.ascontiguousarray(x).tobytes() for x in (key2, *sums))],
    })


_MADE = "bucket int, gram binary, often binary, grams binary, key binary, value binary, top binary, word long, n long"


def _settle(table: pa.Table) -> pa.Table:
    """The weighed subtrees of a bucket of n-grams, or the counts of a bucket of words."""
    if table.column("kind")[0].as_py() == 0:
        out = _weigh(table)
    else:
        h, n = _counted(
            np.concatenate([_unpack(b, _U) for b in table.column("key").to_pylist()]),
            np.concatenate([_unpack(b, np.int32) for b in table.column("n").to_pylist()]).astype(np.int64))
        out = pa.table({"word": h.view(np.int64), "n": n})
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in _MADE.split(", ")]
    return pa.table({name: out.column(name).cast(kinds[kind]) if name in out.column_names else pa.nulls(len(out), kinds[kind]) for name, kind in fields})


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums that buckets hand to depth 2, a row per node and bucket."""
    for batch in batches:
        for blob in batch.column("top").to_pylist():
            n = len(blob) // 32
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(blob, kind, n, 8 * i * n)) for i, kind in enumerate((np.int64, float, float, float))],
                ["key", "zeros", "ones", "children"])


class Nodes:
    """Node keys of depth 3 and more in order, with predictions relative to what depth 3 gets; and the crown."""

    def __init__(self, key, value, crown):
        self.key, self.value, self.crown = key, value, crown

    @staticmethod
    def of(key: bytes | None, value: bytes | None, crown) -> Nodes:
        """The whole tree of a bucket, from its row of the written table."""
        return Nodes(np.frombuffer(key or b"", _U), np.frombuffer(value or b"", np.float32), crown)

    def find(self, node: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.key):
            return np.zeros(len(node), np.int64), np.zeros(len(node), bool)
        wanted = node & _U((1 << 8 * (depth + 1)) - 1) | _U(depth << 56)
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return at, self.key[at] == wanted

    def code_length(self, gram: np.ndarray) -> np.ndarray:
        """Bits for the last byte of each distinct n-gram; grams are sorted."""
        c = self.crown
        byte = gram & _U(255) | _U(256)
        bits = np.zeros(len(gram))
        for s in range(8):
            node = gram >> _U(8) << _U(8) | byte >> _U(s + 1)
            new = np.r_[True, node[1:] != node[:-1]]
            which = np.cumsum(new) - 1
            node = node[new]
            low = (node & _U(0xFFFF)).astype(np.int64)
            one = c.alone[low]
            two = (node & _U(0xFFFFFF)).astype(_U)
            at2 = np.minimum(np.searchsorted(c.key2, two), max(0, len(c.key2) - 1))
            todo = np.flatnonzero(c.key2[at2] == two) if len(c.key2) else np.zeros(0, np.int64)
            one[todo] = c.done[low[todo]] + c.rest[low[todo]] * (c.done2[at2[todo]] + c.rest2[at2[todo]] / 2)
            for depth in range(DEPTH, 2, -1):
                if not len(todo):
                    break
                at, hit = self.find(node[todo], depth)
                got = todo[hit]
                one[got] = c.done[low[got]] + c.rest[low[got]] * (c.done2[at2[got]] + c.rest2[at2[got]] * self.value[at[hit]])
                todo = todo[~hit]
            one = one[which]
            bits -= np.log2(np.where(byte >> _U(s) & _U(1), one, 1 - one))
        return bits


class Model:
    """What scoring holds: the code lengths of the frequent n-grams and the counts of the frequent words."""

    def __init__(self, word, word_count, n_tokens, n_words, gram, cost, buckets):
        self.word, self.word_count, self.n_tokens, self.n_words = word, word_count, n_tokens, n_words
        self.gram, self.cost, self.buckets = gram, cost, buckets

    def known(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code lengths of distinct n-grams in order, and which of them must be asked for."""
        if not len(self.gram):
            return np.zeros(len(gram)), np.ones(len(gram), bool)
        at = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        hit = self.gram[at] == gram
        return np.where(hit, self.cost[at], 0.0), ~hit


def _costs(tree: Nodes, gram: np.ndarray) -> np.ndarray:
    """Code lengths of distinct n-grams in order, a part at a time."""
    parts = [tree.code_length(gram[i : i + _LOOK]) for i in range(0, len(gram), _LOOK)]
    return np.concatenate([np.zeros(0), *parts]).astype(np.float32)


def _per_position(key: np.ndarray, distinct: np.ndarray, value: np.ndarray) -> np.ndarray:
    """value[i] where key equals distinct[i], by a hash table: much cheaper than a search per byte."""
    size = max(8, (2 * len(distinct)).bit_length())
    shift, last = _U(64 - size), _U((1 << size) - 1)
    table = np.zeros(1 << size, np.int32)
    slot = distinct * _U(0x9E3779B97F4A7C15) >> shift
    todo = np.arange(1, len(distinct) + 1, dtype=np.int32)
    while len(todo):
        free = table[slot] == 0
        table[slot[free]] = todo[free]
        wait = table[slot] != todo
        todo, slot = todo[wait], (slot[wait] + _U(1)) & last
    slot = key * _U(0x9E3779B97F4A7C15) >> shift
    found = table[slot] - 1
    miss = np.flatnonzero(distinct[found] != key)
    while len(miss):
        slot[miss] = (slot[miss] + _U(1)) & last
        found[miss] = table[slot[miss]] - 1
        miss = miss[distinct[found[miss]] != key[miss]]
    return value[found]


class Tree:
    """The weighed tree: a written table with a row per bucket, and the crown."""

    def __init__(self, rows: DataFrame, crown: Crown):
        self.rows, self.crown = rows, crown


def train(docs: DataFrame, text: str = "text") -> tuple[Model, DataFrame, Tree]:
    """Learn from all rows of ``docs``; returns the model, the rarer words' counts (word, n) and the written tree.

    All nodes stay, however much text there is: ``score`` holds GRAMS n-grams and FREQUENT words,
    and gets what it does not hold from the returned tables. Neither bound changes a score.
    Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    buckets = max(BUCKETS, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(text).cast("string").alias("text"))
    parts = rows.mapInArrow(_gather(buckets), "kind int, bucket int, key binary, n binary")
    made = durable(parts.groupBy("kind", "bucket").applyInArrow(_settle, _MADE))
    trees, counts = made.filter("bucket is not null").drop("word", "n"), made.filter("word is not null").select("word", "n")
    sums = trees.select("top").mapInArrow(_unfold, "key long, zeros double, ones double, children double").groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("zeros", "ones", "children")]).toArrow()  # 2**24 rows at most
    crown = Crown(*(sums.column(i).to_numpy().view(kind) for i, kind in enumerate((_U, float, float, float))))
    steps = np.zeros(_CLASSES, np.int64)
    for r in trees.select("grams").toLocalIterator():
        steps += np.frombuffer(bytes(r.grams), np.int64)
    most = np.cumsum(steps[::-1])[::-1]  # n-grams of at least each step
    least = int(np.flatnonzero(most <= GRAMS)[0]) if (most <= GRAMS).any() else _CLASSES
    upper = spark.sparkContext.broadcast(crown)  # 2**24 nodes at most

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                k, v, g, o = (batch.column(c)[i].as_py() for c in ("key", "value", "gram", "often"))
                of = np.sort(np.frombuffer(g, _U)[np.frombuffer(o, np.int16) >= least])
                cost = _costs(Nodes.of(k, v, upper.value), of)
                yield pa.RecordBatch.from_arrays([pa.array([of.tobytes()]), pa.array([cost.tobytes()])], ["key", "value"])

    held = int(most[least]) if least < _CLASSES else 0
    key, value, filled = np.empty(held, _U), np.empty(held, np.float32), 0
    for r in trees.select("key", "value", "gram", "often").mapInArrow(kept, "key binary, value binary").toLocalIterator():
        part = np.frombuffer(r.key, _U)
        key[filled : filled + len(part)] = part
        value[filled : filled + len(part)] = np.frombuffer(r.value, np.float32)
        filled += len(part)
    order = np.argsort(key)
    key, value = key[order], value[order]
    del order
    spread = counts.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).collect()
    n_tokens, n_words = sum(r.tokens for r in spread), sum(r.words for r in spread)
    limit, words_held = 100_001, 0
    for r in sorted(spread, key=lambda r: -r.n):
        if words_held + r.words > FREQUENT:
            break
        limit, words_held = r.n, words_held + r.words
    frequent = counts.filter(F.col("n") >= limit).toArrow()
    word = frequent.column("word").to_numpy().view(_U)
    by = np.argsort(word)
    model = Model(word[by], frequent.column("n").to_numpy()[by], n_tokens, n_words, key, value, buckets)
    return model, counts.filter(F.col("n") < limit), Tree(trees, crown)


def _answers(asked: DataFrame, tree: Tree) -> DataFrame:
    """Code lengths of the n-grams that slices ask for, by slice and bucket, from the whole trees of the buckets."""
    spark = asked.sparkSession
    upper = spark.sparkContext.broadcast(tree.crown)  # 2**24 nodes at most
    sizes = asked.groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") > _ASKED).collect()  # a row per bucket at most
    copies = F.lit(1)
    for r in sizes:
        copies = F.when(F.col("bucket") == r.bucket, F.lit(-(-r.n // _ASKED))).otherwise(copies)
    asked = asked.withColumn("copy", F.pmod(F.xxhash64("slice"), copies).cast("int"))
    trees = tree.rows.select("bucket", "key", "value").withColumn("copy", F.explode(F.sequence(F.lit(0), (copies - 1).cast("int"))))

    def look(tree: pa.Table, wanted: pa.Table) -> pa.Table:
        parts = [_unpack(b, _U) for b in wanted.column("gram").to_pylist()]
        gram, at = np.unique(np.concatenate([np.zeros(0, _U), *parts]), return_inverse=True)
        row = {c: tree.column(c)[0].as_py() if len(tree) else None for c in ("key", "value")}
        cost = _costs(Nodes.of(row["key"], row["value"], upper.value), gram)[at] if parts else []
        cuts = np.cumsum([0, *map(len, parts)])
        return pa.table({
            "slice": wanted.column("slice"), "bucket": wanted.column("bucket"),
            "cost": pa.array([cost[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    return trees.groupBy("bucket", "copy").cogroup(asked.groupBy("bucket", "copy")).applyInArrow(look, "slice long, bucket int, cost binary")


def _add_up(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Bits that a slice's documents need for the n-grams it asked for."""
    order = np.argsort(answers.column("bucket").to_numpy())
    blobs = answers.column("cost").to_pylist()
    cost = np.frombuffer(b"".join(blobs[i] for i in order), np.float32).astype(float)
    lists = zip(docs.column("which").to_pylist(), docs.column("often").to_pylist(), strict=True)
    more = [float(cost[_unpack(w, np.int32)] @ _unpack(o, np.int32)) for w, o in lists]
    return pa.table({"row": docs.column("row"), "more_bits": pa.array(more, pa.float64())})


def score(docs: DataFrame, model: Model, rare: DataFrame, tree: Tree, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    base_score sums log10((c + 1) / (N + V + 1)) over tokens, the end among them; score is the
    tree's log10 probability of the token sequence, bits_per_byte its code length. Null texts
    count as empty: one end token. Without training text every bit costs one bit. A slice of
    documents sends its distinct n-grams that the model does not hold to their buckets of
    ``tree`` and gets their code lengths back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by GRAMS and FREQUENT
    out = pa.schema([
        ("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64()),
        ("bits", pa.float64()), ("n_bytes", pa.int64()), ("rare", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
        ("slice", pa.int64()), ("which", pa.binary()), ("often", pa.binary()), ("bucket", pa.int32()), ("gram", pa.binary()), ("n", pa.int64())])

    def questions(slice_: int, gram: np.ndarray, where: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows with a bucket: the n-grams a slice asks of it."""
        if not len(gram):
            return
        cuts = np.r_[0, np.flatnonzero(np.diff(where)) + 1, len(gram)]
        first, size = cuts[:-1], np.diff(cuts)
        values = {
            "slice": np.full(len(first), slice_), "bucket": where[first].astype(np.int32), "n": size,
            "gram": [_pack(gram[a:b]) for a, b in zip(first.tolist(), cuts[1:].tolist(), strict=True)]}
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[f.name], f.type) if f.name in values else pa.nulls(len(first), f.type) for f in out], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        row = TaskContext.get().partitionId() << 33
        end = np.searchsorted(m.word, _U(xxhash.xxh64_intdigest(b"")))
        ends = int(m.word_count[end]) if len(m.word) and end < len(m.word) and m.word[end] == xxhash.xxh64_intdigest(b"") else 0
        for batch in slices(batches, "text", _SCORED):
            word, tokens = _words(batch.column("text"))
            key, size = _stream(word, tokens)
            gram, _ = _distinct(key)
            cost, ask = m.known(gram)
            at = _per_position(key, gram, np.arange(len(gram), dtype=np.int32))
            del key
            bits = np.add.reduceat(cost[at], np.cumsum(size) - size)  # no text is without an end byte
            wanted = gram[ask]
            where = _bucket(wanted, m.buckets)
            order = _by_bucket(where, m.buckets)
            place = np.zeros(len(gram), np.int64)  # of the n-grams asked for, by bucket
            place[np.flatnonzero(ask)[order]] = np.arange(len(order))
            some = np.flatnonzero(ask[at])
            doc = np.searchsorted(np.cumsum(size), some, side="right")
            pair, often = _distinct(doc.astype(_U) << _U(32) | place[at[some]].astype(_U))
            ends_of = np.searchsorted(pair >> _U(32), np.arange(len(tokens) + 1, dtype=_U))
            which, often = (pair & _U(0xFFFFFFFF)).astype(np.int32), often.astype(np.int32)
            each = list(zip(ends_of[:-1].tolist(), ends_of[1:].tolist(), strict=True))
            wanted, where = wanted[order], where[order]
            yield from questions(row, wanted, where)
            del gram, at, some, doc, pair, place
            coded = word.dictionary_encode()
            number, h = coded.indices.to_numpy(), _hashes(coded.dictionary)
            count = np.zeros(len(h), np.int64)
            if len(m.word) and len(h):
                at = np.minimum(np.searchsorted(m.word, h), len(m.word) - 1)
                count = np.where(m.word[at] == h, m.word_count[at], 0)
            doc = np.repeat(np.arange(len(tokens)), tokens)
            logs = np.bincount(doc, np.log10(count + 1)[number], len(tokens)) + np.log10(ends + 1)
            known = np.bincount(doc, (count > 0)[number], len(tokens)).astype(np.int64) + (ends > 0)
            other = count[number] == 0
            pair, times = _distinct(doc[other].astype(_U) << _U(32) | number[other].astype(_U))
            cuts = np.searchsorted(pair >> _U(32), np.arange(len(tokens) + 1, dtype=_U)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + len(tokens))), batch.column("doc_id"), pa.array(tokens + 1), pa.array(known), pa.array(logs),
                pa.array(bits), pa.array(size),
                pa.ListArray.from_arrays(pa.array(cuts), pa.array(h[(pair & _U(0xFFFFFFFF)).astype(np.int64)].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(cuts), pa.array(times)), pa.array(np.full(len(tokens), row)),
                pa.array([_pack(which[a:b]) if a < b else None for a, b in each], pa.binary()),
                pa.array([_pack(often[a:b]) if a < b else None for a, b in each], pa.binary()),
                *(pa.nulls(len(tokens), f.type) for f in list(out)[-3:])], schema=out)
            row += len(tokens)

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    kinds = "row long, doc_id long, n_tokens long, n_known long, logs double, bits double, n_bytes long, rare array<long>, times array<long>, \
slice long, which binary, often binary, bucket int, gram binary, n long"
    found = durable(rows.mapInArrow(run, kinds))
    scored = found.filter("bucket is null")
    pairs = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("p")).select("row", F.col("p.rare").alias("word"), "p.times")
    more = pairs.join(rare, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs"), F.sum("times").alias("more_known"))
    out_rows = scored.select("row", "doc_id", "n_tokens", "n_known", "logs", "bits", "n_bytes").join(more, "row", "left")
    answers = _answers(found.filter("bucket is not null").select("slice", "bucket", "gram", "n"), tree)
    asking = scored.filter("which is not null").select("slice", "row", "which", "often")
    deep = asking.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_add_up, "row long, more_bits double")
    out_rows = out_rows.join(deep, "row", "left").withColumn("bits", F.col("bits") + F.coalesce("more_bits", F.lit(0.0)))
    unit = float(np.log10(model.n_tokens + model.n_words + 1))
    return out_rows.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (-F.col("bits") * F.lit(float(np.log10(2)))).alias("score"),
        (F.col("bits") / F.col("n_bytes")).alias("bits_per_byte"),
    )


def learnable(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """The rows from which the language model may learn."""
    return docs.filter(remainder(id, 7) != 2)
