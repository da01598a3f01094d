"""The conversation trie against a plain version."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from packtrace.llm import trie

TURNS = "conv_id long, turn long, role string, text string, conv string, pos int"


def plain(rows: list[tuple]) -> list[tuple]:
    """(conv_id, depth, parent, members, children, leaves, saved, ends) per node, by walking every prefix."""
    own: dict[int, list] = {}
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        built[c] = own.get(donor, [])[:h] + turns[h:]
    members: dict[tuple, list[int]] = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members.setdefault(tuple(built[c][:d]), []).append(c)
    children: dict[tuple, int] = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(cs) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, cs in members.items():
        ended = ",".join(str(c) for c in cs if len(built[c]) == len(node))
        out.append((cs[0], len(node), members[node[:-1]][0] if node else None, len(cs), children.get(node, 0), leaves[node], saved[node],
                    hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def found(spark, rows, band=trie.BAND):
    turns = trie.numbered(spark.createDataFrame(rows, TURNS).repartition(3))
    return sorted((tuple(r) for r in trie.prefix_trie(*trie.shared_openings(turns), band=band).collect()), key=lambda r: (r[1], r[0]))


def conversations(seed: int, most: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in [*range(40), *range(100, 112), 205, -3, -100, 10**15]:
        for t in range(rng.choice((1, 2, 3, most))):
            rows.append((c, t, rng.choice(("user", "a", None)), rng.choice(("", "é 😀", "x" * 9, None)), "z", 0))
    rows += [(7, None, "user", "first", "", 0), (8, 1, "b", "tie", "", 0), (8, 1, "b", "tie", "", 0), (8, 1, "c", "tie", "", 0), (None, 1, "u", "t", "", 0)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most, band, run", [(5, 16, 1024), (40, 2, 3), (17, 4, 5)])
def test_trie_equals_plain_version(spark, monkeypatch, most, band, run):
    monkeypatch.setattr(trie, "RUN", run)  # short windows and low bands: several rounds
    monkeypatch.setattr(trie, "_CHUNK_BITS", 2)
    rows = conversations(most, most)
    assert found(spark, rows, band) == plain(rows)


def test_a_long_conversation_and_many_copies(spark):
    rows = [(1, t, "u", str(t % 7), "", 0) for t in range(700)] + [(c, t, "u", str(t), "", 0) for c in range(200, 330) for t in range(2)]
    assert found(spark, rows) == plain(rows)


def test_trie_of_nothing(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "u", "t", "", 0)]) == []
    turnless = [(101, 1, "u", "t", "", 0), (104, 1, "u", "t", "", 0)]  # both lose their only turn to an absent opening
    assert [r[:2] for r in found(spark, turnless)] == [r[:2] for r in plain(turnless)]
    assert found(spark, turnless) == plain(turnless)
