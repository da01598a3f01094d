"""Exact and SimHash deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from packtrace.llm import exact, links, simhash

WHITE = re.compile("[\x20\x09-\x0d]")


def rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab \n") for _ in range(rng.choice((0, 1, 7, 40, 300)))) for _ in range(25)]
    texts = [None, "", " \t\n\x0b\x0c\r", " ", "é" * 33, "😀 😀", *base]
    out = []
    for i in range(160):
        t = rng.choice(texts)
        if t and rng.random() < 0.3:
            t = t.replace("a", "a ") + " "
        out.append((i * 7 % 160, t, "x", "y", 1))
    out += [(None, "ab", "x", "y", 1), (None, "ab", "x", "y", 1), out[5], out[5]]
    return out


SCHEMA = "doc_id long, text string, row string, name string, hash int"


def bare(text):
    return WHITE.sub("", text or "")


@pytest.mark.parametrize("clash", [False, True])
def test_exact_groups(spark, monkeypatch, clash):
    if clash:  # a hash that always collides: contents must still be told apart
        monkeypatch.setattr(exact, "_hash", lambda block: F.pmod(F.xxhash64(block), F.lit(2)))
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA)
    found = exact.exact_duplicates(docs, block_chars=8).collect()
    groups: dict[str, list] = {}
    for d, t, *_ in data:
        groups.setdefault(bare(t), []).append((d, len(t or "")))
    best = {k: min(v, key=lambda x: (-x[1], x[0] is None, x[0] or 0)) for k, v in groups.items()}
    want = sorted((str(d), str(best[bare(t)][0]), len(groups[bare(t)]), hashlib.sha256(bare(t).encode()).hexdigest()) for d, t, *_ in data)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in found) == want
    kept = [r for r in found if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(hashlib.sha256(k.encode()).hexdigest() for k in groups)
    assert all(r.doc_id == r.keep_id for r in kept)
    stay = exact.drop_exact(docs, block_chars=8)
    assert stay.columns == docs.columns
    assert sorted((str(r.doc_id), bare(r.text)) for r in stay.collect()) == sorted((str(b[0]), k) for k, b in best.items())


def test_exact_of_empty_table(spark):
    assert exact.exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert exact.drop_exact(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(w)] if 0 < len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@pytest.mark.parametrize("text", [None, "", " \n", "A", "a B", "a b c", "É a É a É a É a", "x " * 500 + "y z", "the cat sat on the mat " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_hash_is_the_engines(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_carry_save_counters(radius):
    rng = np.random.default_rng(radius)
    stored = rng.integers(0, 1 << 63, 64, dtype=np.uint64)
    query = stored[:8].copy()
    for i in range(8):
        for b in rng.choice(64, i, replace=False):
            query[i] ^= np.uint64(1) << np.uint64(b)
    p = simhash.planes(stored, np.zeros(64, np.int64), np.arange(64, dtype=np.uint64), 1)
    hit = simhash.within(query, np.zeros(8, np.int64), p, radius)
    for q, h in zip(query.tolist(), hit.tolist(), strict=True):
        assert h == sum(1 << i for i, s in enumerate(stored.tolist()) if (q ^ s).bit_count() <= radius)


def clusters(values, linked):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in values:
        for b in values:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def near(seed: int, n: int) -> list[int]:
    rng = random.Random(seed)
    out = [0, (1 << 64) - 1]
    while len(out) < n:
        x = rng.choice(out) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.choice((rng.randrange(64), rng.randrange(8)))
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("bucket_rows", [4096, 3])
def test_links_connect_what_brute_force_connects(spark, bucket_rows):
    values = near(3, 260)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    pairs = [tuple(r) for r in simhash.fingerprint_links(df, 2, bucket_rows).collect()]
    want = clusters(values, lambda a, b: (a ^ b).bit_count() <= 2)
    linked = {(a % (1 << 64), b % (1 << 64)) for a, b in pairs}
    got = clusters(values, lambda a, b: (a, b) in linked or (b, a) in linked)
    assert got == want


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 540)] + [(7, 7)]
    found = {r.node: r.root for r in links.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    have = set(pairs)
    want = clusters(sorted({x for p in pairs for x in p}), lambda a, b: (a, b) in have or (b, a) in have)
    assert {k: found.get(k, k) for k in want} == want


def test_near_duplicates(spark):
    data = rows(2) + [(1000, "one two three four five six seven eight nine ten " * 30, "", "", 0),
                      (1001, "one two three four five six seven eight nine ten " * 30 + "Eleven", "", "", 0)]
    docs = spark.createDataFrame(data, SCHEMA)
    found = simhash.near_duplicates(docs).collect()
    prints = {}
    for d, t, *_ in data:
        prints.setdefault(plain_fingerprint(t), []).append(d)
    root = clusters(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 2)
    low: dict = {}
    for f, ids in prints.items():
        known = [i for i in ids if i is not None]
        if known:
            low[root[f]] = min([low.get(root[f], known[0]), *known])
    assert len(found) == len(data)
    assert all(r.component_id == low.get(root[int(r.fingerprint, 16)]) for r in found)
    assert {(r.doc_id, r.fingerprint) for r in found} == {(d, f"{plain_fingerprint(t):016x}") for d, t, *_ in data}
    stay = simhash.drop_near(docs)
    assert stay.columns == docs.columns
    kept = [plain_fingerprint(r.text) for r in stay.collect()]
    assert sorted(root[f] for f in kept) == sorted(set(root.values()))  # one of each component
    assert {r.doc_id for r in stay.collect()} == {low.get(r) for r in set(root.values())}


def test_near_duplicates_of_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_ids_lose_and_double_nothing(spark):
    other = "quite another text that shares no words with it at all"
    near = spark.createDataFrame([(1, "a b c d", 0), (2, "a b c d", 0), (2, other, 0), (3, None, 1), (3, None, 2)], "doc_id long, text string, _id int")
    assert sorted((r.doc_id, r.text or "") for r in simhash.drop_near(near).collect()) == [(1, "a b c d"), (2, other), (3, "")]
    same = spark.createDataFrame([(1, "a bc", 0), (1, "ab c", 0), (2, "abc", 0)], "doc_id long, text string, _sha int")
    stay = exact.drop_exact(same).collect()
    assert [(r.doc_id, len(r.text)) for r in stay] == [(1, 4)]


@pytest.mark.parametrize("drop", [exact.drop_exact, simhash.drop_near])
def test_columns_of_any_name_pass(spark, drop):
    names = ["__id", "__chars", "__sha", "n_same", "_id", "_ID_", "_chars", "_sha", "_n_same", "_mark", "_n", "fp", "hash", "row"]
    docs = spark.createDataFrame([(1, "a b", *range(len(names))), (2, "a b", *range(len(names)))], ["doc_id", "text", *names])
    stay = drop(docs)
    assert stay.columns == docs.columns and [tuple(r)[0] for r in stay.collect()] == [1]
