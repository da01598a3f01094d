"""Personal data: patterns against the plain expressions, the field against enumeration and held-out sentences."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

from packtrace.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checked(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        twice = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if checked(kind, m[0])]
    return sorted(found)


ODD = [
    "", "a@b.c", "a@b.c@d.e", "@a.b@c.d", "a@b.c_x@d.e", "a@b.c.@d.e", "a.b@c..d", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.255 1.2.3.04",
    "+1 (743) 555-3824", "+1 (743) 555-3824 170.106.4.2", "4111 1111 1111 1111", "4111-1111 1111-1112", "7536784127813050 4845168114407329",
    "é😀+49-30-1234567😀x@y.zz", "+1+1+12345678901", "1" * 50, "1." * 40, "a%b+c-d@e-f.g", "x@y", "+12(((((((34567890", "tel +1..............2345678901",
]


@pytest.mark.parametrize("text", ODD)
def test_patterns_equal_the_plain_expressions(text):
    assert pii.base_spans(text) == plain(text)


def test_patterns_on_random_texts():
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice(("1", "22", "333", "4444", ".", ".", " ", "-", "@", "a", "b.c", "+", "(", ")", "_", "é", "+1 234 567 8901", "4111111111111111")) for _ in range(rng.randint(1, 24)))
        assert pii.base_spans(text) == plain(text), text


def labellings(n, spans):
    """All ways to place candidates that do not overlap, as lists in order."""
    for size in range(len(spans) + 1):
        for chosen in itertools.combinations(sorted(range(len(spans)), key=lambda c: (spans[c][0], spans[c][2])), size):
            if all(spans[a][2] <= spans[b][0] for a, b in itertools.pairwise(chosen)):
                yield list(chosen)


def test_field_equals_enumeration():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(2, 6)
        spans = sorted({(i, rng.randrange(4), j) for i, j in (sorted(rng.sample(range(n), 2)) for _ in range(rng.randint(1, 6)))})
        score = [rng.uniform(-2, 2) for _ in spans]
        turn = np.array([[rng.uniform(-1, 1) for _ in range(5)] for _ in range(5)])
        ways = list(labellings(n, spans))
        worth = [sum(score[c] for c in w) + float((pii._changes(n, spans, w) * turn).sum()) for w in ways]
        total, chance, change = pii.marginals(n, spans, score, turn.tolist())
        share = [math.exp(x - total) for x in worth]
        assert sum(share) == pytest.approx(1)
        for c in range(len(spans)):
            assert chance[c] == pytest.approx(sum(p for p, w in zip(share, ways, strict=True) if c in w))
        assert np.allclose(change, sum(p * pii._changes(n, spans, w) for p, w in zip(share, ways, strict=True)))
        assert sorted(pii.best(n, spans, score, turn.tolist())) == sorted(ways[int(np.argmax(worth))])


def test_pruning_changes_no_labelling():
    field = pii.train()
    for text, _ in pii.composed(60, 17):
        whole = []
        for group in pii.clusters(pii.candidates(text)):
            whole += [group[c] for c in pii.best(*pii.lattice(group), [field.score(text, c) for c in group], field.turn)]
        assert field.spans(text) == whole


def test_field_on_sentences_not_learnt_from():
    field = pii.train()
    right = found = there = 0
    for text, gold in pii.composed(400, 1234):
        got = set(field.spans(text))
        right, found, there = right + len(got & set(gold)), found + len(got), there + len(gold)
    assert right >= 0.97 * found and right >= 0.97 * there


def test_clean_texts_have_no_spans():
    field = pii.train()
    clean = ["On 2024-05-17 at 12:30 we paid 1,299.00 for version 1.2.3.", "ISBN 978-3-16-148410-0, pages 123-145", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"",
             "in 1999-2004, 30 % of 5000 people", "meet me at noon. or dot the i", "the order 20394857 of 17.05.2024"]
    for text in clean:
        assert field.spans(text) == [] and pii.base_spans(text) == []


def test_added_spans_stay_off_the_base():
    field = pii.train()
    text = "call (743) 555-3824 or ruben [at] mail1 [dot] com, 4845168114407329 and x@y.org"
    base = pii.base_spans(text)
    added = field.added(text, base)
    assert [text[s:e] for s, _, e in added] == ["(743) 555-3824", "ruben [at] mail1 [dot] com"] and len(base) == 2
    assert field.added(text, [(0, 2, len(text))]) == []


def test_long_texts_take_linear_time():
    field = pii.train()
    for text in ("1 " * 40_000, "1." * 30_000, "a@" * 100_000, "[at] " * 50_000, "x" * 300_000 + "@", "+1" * 50_000):
        assert field.added(text, pii.base_spans(text)) is not None


def test_find(spark):
    rows = [(1, None, 0, 0), (2, "", 0, 0), (None, "a@b.cc", 0, 0), (3, ODD[11], 0, 0), (3, ODD[11], 0, 0), (4, "é😀 a@b.cc, ruben (at) mail.com", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base int, spans int")
    found = pii.find(docs).collect()
    assert len(found) == len(rows)
    for r, (_, text, *_) in zip(found, rows, strict=True):
        assert [tuple(s) for s in r.base] == plain(text or "")
    assert [tuple(s) for s in found[5].added] == [(11, 0, 30)]
    assert pii.find(docs.limit(0)).count() == 0


def test_query_equals_plain_version(spark, sf_dir):
    found = {r.doc_id: r for r in queries.op13_personal_data(spark, sf_dir).collect()}
    field = pii.train()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        base = plain(r.text or "")
        text = lambda spans: ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        own = found[r.doc_id]
        assert own.base_sha256 == hashlib.sha256(text(base).encode()).hexdigest()
        assert [own.n_email, own.n_ip, own.n_card, own.n_phone] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        assert own.spans == text(sorted(base + field.added(r.text or "", base)))
