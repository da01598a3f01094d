"""Byte-pair encoding and decoding by a pair occurrence index.

All new words of a slice of texts are laid out as one chain of symbols. The index maps every
pair that has a merge to all its positions; ranks are applied in ascending order to all their
positions at once, and the pairs that appear or vanish beside a merge update their own lists.
The vocabulary is a public tokenizer file whose path the caller gives.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from packtrace.llm.common import slices

_SLICE = 8 << 20
_CACHE = 300_000  # words whose ids a worker remembers

# Fixed values of the file format: the bytes that stand for themselves; the others move to 256 and up.
_PLAIN_BYTES = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]

# Below U+0250 every letter, number and space is known, so the plain engine may cut words.
_SIMPLE = re.compile("[\x00-ɏ]*")
_L, _N, _S = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_SIMPLE_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")


def _byte_letters() -> list[str]:
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in _PLAIN_BYTES:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


class Vocabulary:
    """Merges and symbols of a word-level BPE file with word ends."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        if model["type"] != "BPE" or not suffix or spec.get("decoder") is not None:
            raise ValueError("not a word-level BPE file with word ends")
        split = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"][0]
        self.word = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = self.left << 32 | self.right
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where there is no merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], -1)

    def words(self, text: str) -> list[str | int]:
        """Words of a text in order; special tokens, which are cut out first, as their ids."""
        out: list[str | int] = []
        parts = self.special_cut.split(text) if self.special_cut else [text]
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self.special[part])
            elif _SIMPLE.fullmatch(part):
                out += _SIMPLE_WORD.findall(part.lower())
            else:
                # sigma is lower-cased alike in every place
                out += self.word.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return out


def merge(symbol: np.ndarray, word: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Apply all merges to chained symbols; ``word`` tells each symbol's word. Returns what is left of both."""
    n = len(symbol)
    symbol = symbol.copy()
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    if n:
        ends = np.r_[word[1:] != word[:-1], True]
        after[ends] = -1
        before[np.r_[True, ends[:-1]]] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def enter(at: np.ndarray) -> None:
        rank = vocab.ranks(symbol[at], symbol[after[at]])
        at, rank = at[rank >= 0], rank[rank >= 0]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, group in zip(rank[np.r_[0, cuts]].tolist(), np.split(at, cuts), strict=True):
            if r not in index:
                index[r] = []
                heapq.heappush(active, r)
            index[r].append(group)

    enter(np.flatnonzero(after >= 0))
    while active:
        r = heapq.heappop(active)
        groups = index.pop(r)
        at = groups[0] if len(groups) == 1 else np.unique(np.concatenate(groups))
        a, b = vocab.left[r], vocab.right[r]
        nxt = after[at]
        live = (symbol[at] == a) & (nxt >= 0) & (symbol[nxt] == b)  # entries that other merges left stale go
        at, nxt = at[live], nxt[live]
        if a == b and len(at) > 1:  # in a run of one symbol every second pair merges, from the left
            joined = np.r_[False, nxt[:-1] == at[1:]]
            start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
            even = (np.arange(len(at)) - start) % 2 == 0
            at, nxt = at[even], nxt[even]
        if not len(at):
            continue
        symbol[at] = vocab.merged[r]
        symbol[nxt] = -1
        beyond = after[nxt]
        after[at] = beyond
        inside = beyond >= 0
        before[beyond[inside]] = at[inside]
        ahead = before[at]
        enter(np.unique(np.concatenate([ahead[ahead >= 0], at[inside]])))
    left = symbol >= 0
    return symbol[left], word[left]


def encode_words(words: list[str], vocab: Vocabulary) -> list[np.ndarray]:
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    flat = np.frombuffer(b"".join(raw), np.uint8)
    symbol = vocab.inner[flat]
    ends = np.cumsum(size) - 1
    symbol[ends] = vocab.final[flat[ends]]
    ids, word = merge(symbol, np.repeat(np.arange(len(raw)), size), vocab)
    return np.split(ids, np.searchsorted(word, np.arange(1, len(raw))))


class Encoder:
    """Encodes texts slice by slice; remembers the ids of words it has met, up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.ids: dict[str | int, bytes] = {}
        self.pieces: dict[str | int, bytes] = {}

    def slice(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Per text its ids as little-endian 32-bit integers, and the decoded text in UTF-8."""
        lists = [self.vocab.words(t) if t else [] for t in texts]
        if len(self.ids) > _CACHE:
            self.ids, self.pieces = {}, {}
        new = set().union(*lists) - self.ids.keys() if lists else set()
        token = self.vocab.token
        for special in [w for w in new if isinstance(w, int)]:
            new.discard(special)
            self.ids[special] = special.to_bytes(4, "little")
            self.pieces[special] = token[special].encode()
        fresh = sorted(new)
        for w, ids in zip(fresh, encode_words(fresh, self.vocab) if fresh else [], strict=True):
            self.ids[w] = ids.astype("<u4").tobytes()
            self.pieces[w] = " ".join([token[i] for i in ids.tolist()]).encode()
        ids_of, piece_of = self.ids.__getitem__, self.pieces.__getitem__
        return [(b"".join(map(ids_of, ws)), b" ".join(map(piece_of, ws))) for ws in lists]


_LOADED: dict[str, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    if spec not in _LOADED:
        _LOADED.clear()
        _LOADED[spec] = Encoder(Vocabulary(spec))
    return _LOADED[spec]


def _spread(docs: DataFrame, spec: str, id: str, text: str, finish, columns: list[tuple[str, pa.DataType, str]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # the vocabulary file: a few MB, whatever the input
    out = pa.schema([("doc_id", pa.int64()), *[(n, t) for n, t, _ in columns]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in slices(batches, "text", _SLICE):
            rows = [finish(*x) for x in encoder.slice(batch.column("text").to_pylist())]
            found = [pa.array([r[i] for r in rows], columns[i][1]) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found], schema=out)

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, ", ".join(["doc_id long", *[f"{n} {s}" for n, _, s in columns]]))


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) per row of ``docs``, with the vocabulary file at ``path`` on the driver.

    Null and empty texts have no ids and decode to empty text. Repeated rows are encoded each on
    their own; other columns are not read.
    """
    return _spread(docs, _read(path), id, text, lambda ids, back: (np.frombuffer(ids, "<u4").astype(np.int32), back.decode()),
                   [("ids", pa.list_(pa.int32()), "array<int>"), ("decoded", pa.string(), "string")])


def digests(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what ``encode`` gives, without sending the ids on."""
    return _spread(
        docs, _read(path), id, text,
        lambda ids, back: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()),
        [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string")])


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
