"""Personal data: fixed patterns, and a semi-Markov conditional random field for what they miss.

The field labels whole spans. Candidates are runs of at most GROUPS groups of digits, groups of hex
digits, and words around an at sign, also one told in brackets; features look at the whole span (its shape, digits,
groups, check digit, parts) and at the words around it. Forward sums over all ways to place typed
spans train it; a dynamic program over candidate borders picks boundaries and kinds jointly. It
learns from composed, labelled sentences, as no table marks personal data.
"""

from __future__ import annotations

import functools
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from heapq import merge

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from packtrace.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
GROUPS = 6  # of digits in a candidate
SENTENCES = 400  # composed for training
STEPS = 50
RATE = 0.3
DECAY = 2e-3
SEED = 5
_SLICE = 4 << 20
_OUT = len(KINDS)  # the label of what lies between spans

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]+")


# --- fixed patterns -----------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if place % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all pattern matches that pass their checks, by start and then kind.

    Matches are the leftmost ones that do not overlap, per kind. Addresses are found from their
    @, so that a long run of letters is looked at once.
    """
    out, last = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            last = m.end()
            out.append((start, 0, last))
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for kind, pattern, low, high in ((2, _CARD, 14, 19), (3, _PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = "".join(_DIGITS.findall(m[0]))
            if low <= len(digits) <= high and (kind == 3 or luhn(digits)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


# --- candidates and features ----------------------------------------------------------------

_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
_NUMBERS = re.compile(r"(?<![0-9A-Za-z])[+(]?[0-9](?:[0-9\x20().\[\]/-]*[0-9])?(?![0-9A-Za-z])")
_COLONS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Za-z:])")
_AT = re.compile(r"[^\s@<>()\[\]{},;:!?\"']{1,64}\x20?(?:@|[\[({]\x20?at\x20?[\])}])\x20?[\w-]{1,63}(?:\x20?(?:\.|[\[({]\x20?dot\x20?[\])}])\x20?[\w-]{1,63}){1,6}", re.IGNORECASE)
_SIGN = re.compile(r"@|[\[({]\x20?at\x20?[\])}]", re.IGNORECASE)
_HINT = re.compile(r"[0-9]|@|[\[({]\x20?at\x20?[\])}]", re.IGNORECASE)
# words that tell what follows
_CUES = {
    "email": 0, "mail": 0, "contact": 0, "write": 0, "ip": 1, "server": 1, "host": 1, "address": 1, "card": 2, "visa": 2, "credit": 2, "payment": 2,
    "tel": 3, "phone": 3, "call": 3, "fax": 3, "mobile": 3, "isbn": 4, "page": 4, "pages": 4, "order": 4, "version": 4, "date": 4, "invoice": 4, "id": 4,
}
_WORD = re.compile(r"([^\W\d_]+)\W{0,3}\Z")


def _number_candidates(text: str, start: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of runs of digit groups with what stands between them, by start."""
    groups: list[tuple[int, int]] = []

    def of(first: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
        a, digits, found = first[0][0], 0, []
        begins = [a - len(lead) for lead in ("", "+", "(", "+(") if text[max(0, a - len(lead)) : a] == lead]
        for n, (x, b) in enumerate(first, 1):
            digits += b - x
            if digits > 19:
                break
            if 7 <= digits <= 15:
                found += [(s, 3, b) for s in begins]
            if 12 <= digits <= 19 and n <= 5:
                found.append((a, 2, b))
            if n == 4 and digits <= 12:
                found.append((a, 1, b))
        yield from sorted(found)

    for m in _DIGITS.finditer(text, start, end):
        groups.append((m.start(), m.end()))
        if len(groups) == GROUPS:
            yield from of(groups)
            groups.pop(0)
    while groups:
        yield from of(groups)
        groups.pop(0)


def _address_candidates(text: str) -> Iterator[tuple[int, int, int]]:
    for m in _AT.finditer(text) if _SIGN.search(text) else ():
        at = _SIGN.search(m[0])
        ends = [t.end() for t in _TOKEN.finditer(m[0], at.end()) if t[0][0].isalnum()]
        stops = [e for e in ends if re.search(r"[.\])}]", m[0][at.end() : e])]
        if m[0][0].isalnum():
            yield from ((m.start(), 0, m.start() + e) for e in stops[-6:])


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """All (start, kind, end) that the field may choose, by start; numbers stand next to no letter or digit."""
    if not _HINT.search(text):
        return iter(())
    numbers = (c for m in _NUMBERS.finditer(text) if m.end() - m.start() >= 7 for c in _number_candidates(text, m.start(), m.end()))
    colons = ((m.start(), 1, m.end()) for m in _COLONS.finditer(text))
    return merge(numbers, colons, _address_candidates(text))


def _shape(span: str) -> str:
    """Digit runs as their lengths, letter runs as a, other characters as they are."""
    return re.sub(r"[0-9]+|[^\W\d_]+", lambda m: str(len(m[0])) if m[0][0].isdigit() else "a", span)


def features(text: str, start: int, kind: int, end: int) -> list[str]:
    """Names of what holds of a whole span and of its surroundings."""
    span = text[start:end]
    found = _WORD.search(text, max(0, start - 24), start)
    cue = _CUES.get(found[1].lower()) if found else None
    before, after = text[start - 1 : start], text[end : end + 1]
    out = ["any", f"cue={cue}" if cue is None or cue > 3 else f"cue={'same' if cue == kind else 'other'}", f"before={_side(before)}", f"after={_side(after)}"]
    if kind == 0:
        domain = _SIGN.split(span)[-1]
        last = re.findall(r"[^\W_]+", domain)[-1]
        out += [f"at={'plain' if '@' in span else 'told'}", f"spaces={min(4, span.count(' '))}", f"last={'letters' if last.isalpha() else 'other'}{min(len(last), 7)}"]
        out.append(f"dots={'.' in domain}{'dot' in domain.lower()}")
        return [f"{kind} {f}" for f in out]
    groups = _DIGITS.findall(span)
    digits = "".join(groups)
    between = set(re.findall(r"[^0-9]+", span.lstrip("+(")))
    out += [f"shape={_shape(span)}", f"digits={len(digits)}", f"groups={len(groups)}", f"between={'|'.join(sorted(between))}", f"plus={span[0] == '+'}"]
    out += [f"longest={max(map(len, groups))}", f"balanced={span.count('(') == span.count(')')}", f"lead={'0' if digits[0] == '0' else '9' if digits[:2] == '97' else 'd'}"]
    if kind == 2:
        out += [f"luhn={luhn(digits)}", f"luhn={luhn(digits)} digits={len(digits)}", f"even={len({len(g) for g in groups}) == 1}"]
    if kind == 1 and ":" not in span:
        out += [f"bytes={all(map(_byte, groups))}", f"zeros={any(g[0] == '0' and len(g) > 1 for g in groups)}"]
    if kind == 1 and ":" in span:
        out += [f"colons={span.count(':')}", f"hex={any(c.isalpha() for c in span)}"]
    if kind == 3:
        out.append(f"date={bool(re.fullmatch(r'(?:19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-(?:19|20)[0-9]{2}', span))}")
    return [f"{kind} {f}" for f in out]


def _side(c: str) -> str:
    return "none" if not c else "space" if c.isspace() else "alnum" if c.isalnum() else c if c in "#$%@+-_/=:.,()\"'" else "mark"


# --- the field --------------------------------------------------------------------------------


def clusters(found: Iterable[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """Candidates in groups that neither overlap nor touch: between groups nothing but the outside label is possible."""
    group, reach = [], -1
    for c in found:
        if group and c[0] > reach:
            yield group
            group = []
        group.append(c)
        reach = max(reach, c[2])
    if group:
        yield group


def lattice(group: list[tuple[int, int, int]]) -> tuple[int, list[tuple[int, int, int]]]:
    """Borders, numbered, and the candidates as (from border, kind, to border) by where they end."""
    borders = sorted({x for s, _, e in group for x in (s, e)})
    number = {b: i for i, b in enumerate(borders)}
    return len(borders), [(number[s], k, number[e]) for s, k, e in group]


def _sum(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


def forward(n: int, spans: list[tuple[int, int, int]], score: list[float], turn: np.ndarray, join=_sum) -> list[list[float]]:
    """Per border and label of what ends there, the joined weight of all ways to get there."""
    at: dict[int, list[int]] = {}
    for c, (_, _, j) in enumerate(spans):
        at.setdefault(j, []).append(c)
    none = -math.inf
    out = [[none] * _OUT + [0.0]]
    for p in range(1, n):
        row = [[] for _ in range(_OUT + 1)]
        row[_OUT].append(join([out[p - 1][a] + turn[a][_OUT] for a in range(_OUT + 1)]))
        for c in at.get(p, ()):
            i, k, _ = spans[c]
            row[k].append(score[c] + join([out[i][a] + turn[a][k] for a in range(_OUT + 1)]))
        out.append([join(r) if r else none for r in row])
    return out


def marginals(n: int, spans: list[tuple[int, int, int]], score: list[float], turn: np.ndarray) -> tuple[float, list[float], np.ndarray]:
    """Log of the sum over all labellings, each candidate's probability, and expected label changes."""
    ahead = forward(n, spans, score, turn)
    total = _sum(ahead[-1])
    back = [[0.0] * (_OUT + 1)]  # from the last border
    by: dict[int, list[int]] = {}
    for c, (i, _, _) in enumerate(spans):
        by.setdefault(i, []).append(c)
    chance = [0.0] * len(spans)
    change = np.zeros((_OUT + 1, _OUT + 1))
    behind = {n - 1: back[0]}
    for p in range(n - 2, -1, -1):
        row = []
        for a in range(_OUT + 1):
            ways = [turn[a][_OUT] + behind[p + 1][_OUT]]
            change[a, _OUT] += math.exp(ahead[p][a] + ways[0] - total)
            for c in by.get(p, ()):
                _, k, j = spans[c]
                way = turn[a][k] + score[c] + behind[j][k]
                part = math.exp(ahead[p][a] + way - total)
                chance[c] += part
                change[a, k] += part
                ways.append(way)
            row.append(_sum(ways))
        behind[p] = row
    return total, chance, change


def best(n: int, spans: list[tuple[int, int, int]], score: list[float], turn: np.ndarray) -> list[int]:
    """The candidates of the likeliest labelling; ties go to the outside label, then to the smaller candidate."""
    top = forward(n, spans, score, turn, max)
    ending: dict[tuple[int, int], list[int]] = {}
    for c, (_, k, j) in enumerate(spans):
        ending.setdefault((j, k), []).append(c)
    out, p, label = [], n - 1, max(range(_OUT, -1, -1), key=lambda a: top[n - 1][a])
    while p > 0:
        if label == _OUT:
            source = p - 1
        else:
            way = lambda c: score[c] + max(top[spans[c][0]][a] + turn[a][label] for a in range(_OUT + 1))  # noqa: E731, B023
            c = max(ending[p, label], key=lambda c: (way(c), -c))
            out.append(c)
            source = spans[c][0]
        label = max(range(_OUT, -1, -1), key=lambda a: top[source][a] + turn[a][label])
        p = source
    return out[::-1]


class Field:
    """Weights by feature name, and of label changes; staying outside has none."""

    def __init__(self, weights: dict[str, float], turn: np.ndarray):
        self.weights, self.turn = weights, turn.tolist()
        # a candidate below this score is never worth its place: the outside label does better whatever stands beside it
        out, t = turn[:, _OUT, None], turn
        self.least = [float(min((out + t[None, _OUT] - t[:, k, None] - t[None, k]).min(), (t[:, _OUT] - t[:, k]).min())) for k in range(_OUT)]

    def score(self, text: str, candidate: tuple[int, int, int]) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(text, *candidate))

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """The likeliest labelling of a whole text. What it holds at once are the candidates that may win."""
        out, score = [], {}

        def worthy() -> Iterator[tuple[int, int, int]]:
            for c in candidates(text):
                value = self.score(text, c)
                if value >= self.least[c[1]]:
                    score[c] = value
                    yield c

        for group in clusters(worthy()):
            out += [group[c] for c in best(*lattice(group), [score.pop(c) for c in group], self.turn)]
        return out

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The field's spans that overlap none of the fixed patterns' spans."""
        starts, ends = [], []  # of what the base covers
        for s, _, e in base:
            if ends and s < ends[-1]:
                ends[-1] = max(ends[-1], e)
            else:
                starts.append(s)
                ends.append(e)
        return [c for c in self.spans(text) if bisect_left(starts, c[2]) == bisect_right(ends, c[0])]


# --- composed sentences -------------------------------------------------------------------------


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _valid(rng: random.Random, n: int) -> str:
    body = rng.choice("3456") + _digits(rng, n - 2)
    return next(body + d for d in "0123456789" if luhn(body + d))


def _word(rng: random.Random) -> str:
    return "".join(rng.choice("bcdfghlmnprstv") + rng.choice("aeiouéä") for _ in range(rng.randint(1, 4)))


def _entity(rng: random.Random) -> tuple[int, str]:
    kind = rng.randrange(4)
    d = functools.partial(_digits, rng)
    if kind == 0:
        user = rng.choice((_word(rng), f"{_word(rng)}.{_word(rng)}", f"{_word(rng)}{d(2)}", f"{_word(rng)}_{d(1)}"))
        host, end = rng.choice((_word(rng), f"mail{d(1)}.{_word(rng)}")), rng.choice(("com", "org", "de", "net", "info"))
        plain = rng.random() < 0.4
        at = "@" if plain else rng.choice((" @ ", "@", " [at] ", "[at]", " (at) ", "(at)", "{at}"))
        dot = "." if plain or "@" in at else rng.choice((".", " [dot] ", "[dot]", "(dot)", " (dot) "))
        return 0, user + at + dot.join([*host.split("."), end])
    if kind == 1:
        if rng.random() < 0.25:
            return 1, ":".join(f"{rng.randrange(1 << 16):x}" for _ in range(rng.choice((6, 8)))).replace(":0:", "::", 1)
        dot = rng.choice((".", "[.]", " . ", "(.)"))
        return 1, dot.join(str(rng.randrange(256)) for _ in range(4))
    if kind == 2:
        n = rng.choice((13, 14, 15, 16, 16, 16, 19))
        digits, sep = _valid(rng, n), rng.choice(("", " ", "-", ".", "/"))
        parts = [digits[:4], digits[4:10], digits[10:]] if n in (14, 15) else [digits[i : i + 4] for i in range(0, n, 4)]
        return 2, sep.join(parts)
    area, mid, end = rng.choice("23456789") + d(2), d(3), d(4)
    return 3, rng.choice((
        f"+1 ({area}) {mid}-{end}", f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"1-{area}-{mid}-{end}", f"+49 {area} {d(7)}",
        f"0{area} {d(7)}", f"0{area}/{d(6)}", f"00{rng.choice(('49', '33', '1'))} {area} {mid} {end}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}"))


def _other(rng: random.Random) -> str:
    """What looks like personal data and is not."""
    d = functools.partial(_digits, rng)
    year, month, day = rng.randint(1900, 2030), rng.randint(1, 12), rng.randint(1, 28)
    wrong = next(x for x in iter(lambda: d(rng.choice((13, 14, 15, 16, 16, 18))), None) if not luhn(x))
    sep = rng.choice(("", "", " ", "-", "."))
    return rng.choice((
        f"{year}-{month:02}-{day:02}", f"{day}.{month}.{year}", f"{day:02}/{month:02}/{year}", f"{year}-{year + 5}", f"{d(2)}:{d(2)}:{d(2)}", f"{year}-{month:02}-{day:02} {d(2)}:{d(2)}",
        f"{d(1)},{d(3)}.{d(2)}", f"{d(2)}.{d(2)}", f"{rng.randint(1, 9)}.{rng.randint(0, 30)}.{rng.randint(0, 9)}", f"v{rng.randint(1, 9)}.{rng.randint(0, 30)}.{rng.randint(0, 9)}.{rng.randint(300, 9999)}",
        f"{rng.randint(10, 300)}-{rng.randint(301, 900)}", f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"978{d(10)}", sep.join(wrong[i : i + 4] for i in range(0, len(wrong), 4)),
        f"#{d(8)}", d(rng.choice((7, 8, 9, 10, 11, 12))), f"token = \"{rng.getrandbits(128):032x}\"", f"{rng.getrandbits(64):x}", f"{rng.randint(256, 999)}.{d(3)}.{d(3)}.{d(3)}",
        f"{d(2)} + {d(2)} = {d(3)}", f"{d(2)}.{d(4)}, {d(1)}.{d(4)}", f"{d(2)} %", f"@{_word(rng)}", f"{d(1)} @ {d(1)}.{d(2)}", f"{_word(rng)}@localhost", f"({d(4)})", f"[{d(2)}] {d(4)}",
        f"{d(3)} {d(3)} {d(3)}", f"{d(1)} {d(1)} {d(1)} {d(1)} {d(1)} {d(1)} {d(1)} {d(1)}", f"{d(3)}, {d(3)}, {d(4)}", f"{d(4)} {d(4)}", f"1.{d(1)}.{d(1)}.{d(1)}.{d(1)}.{d(2)}"))


def composed(n: int, seed: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Sentences with the (start, kind, end) of what they hold."""
    rng = random.Random(seed)
    cues = {k: [w for w, c in _CUES.items() if c == k] for k in range(5)}
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randint(1, 4)):
            text += " ".join(_word(rng) for _ in range(rng.randint(1, 6))) + rng.choice((" ", ", ", ". ", "\n"))
            if rng.random() < 0.5:
                kind, span = _entity(rng)
                if rng.random() < 0.3:
                    text += rng.choice(cues[kind]) + rng.choice((" ", ": ", ". "))
                text += rng.choice(("", "", "", "(", "\""))
                spans.append((len(text), kind, len(text) + len(span)))
                text += span
            else:
                if rng.random() < 0.15:
                    text += rng.choice(cues[rng.randrange(5)]) + rng.choice((" ", ": "))
                text += _other(rng)
            text += rng.choice((" ", " ", ", ", ". ", ")", "\n", "!! ", "### "))
        out.append((text, spans))
    return out


@functools.lru_cache(maxsize=2)
def train(sentences: int = SENTENCES, seed: int = SEED) -> Field:
    """Fit the field to composed sentences by the likelihood of their labels, with weight decay; repeatable."""
    number: dict[str, int] = {}
    rows, columns, gold, groups = [], [], [], []
    for text, spans in composed(sentences, seed):
        for group in clusters(candidates(text)):
            right = [c in spans for c in group]
            groups.append((len(gold), *lattice(group), [c for c, r in enumerate(right) if r]))
            for c, r in zip(group, right, strict=True):
                for f in features(text, *c):
                    rows.append(len(gold))
                    columns.append(number.setdefault(f, len(number)))
                gold.append(float(r))
    rows, columns, gold = np.array(rows), np.array(columns), np.array(gold)
    weight, turn = np.zeros(len(number)), np.zeros((_OUT + 1, _OUT + 1))
    sure = [_changes(n, spans, own) for _, n, spans, own in groups]
    moves = np.ones_like(turn)
    moves[_OUT, _OUT] = 0
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weight, turn)]
    for step in range(1, STEPS + 1):
        score = np.bincount(rows, weight[columns], len(gold))
        chance, change = np.zeros(len(gold)), np.zeros_like(turn)
        now = turn.tolist()
        for (first, n, spans, _), known in zip(groups, sure, strict=True):
            _, found, expected = marginals(n, spans, score[first : first + len(spans)].tolist(), now)
            chance[first : first + len(spans)] = found
            change += known - expected
        slopes = np.bincount(columns, (gold - chance)[rows], len(number)) / len(groups) - DECAY * weight, (change / len(groups) - DECAY * turn) * moves
        for x, slope, m in zip((weight, turn), slopes, moments, strict=True):
            m[0] = 0.9 * m[0] + 0.1 * slope
            m[1] = 0.99 * m[1] + 0.01 * slope**2
            x += RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return Field(dict(zip(number, weight.tolist(), strict=True)), turn)


def _changes(n: int, spans: list[tuple[int, int, int]], chosen: list[int]) -> np.ndarray:
    """Label changes of a known labelling."""
    out = np.zeros((_OUT + 1, _OUT + 1))
    at, label = 0, _OUT
    for c in chosen:
        i, k, j = spans[c]
        for _ in range(at, i):
            out[label, _OUT] += 1
            label = _OUT
        out[label, k] += 1
        at, label = j, k
    for _ in range(at, n - 1):
        out[label, _OUT] += 1
        label = _OUT
    return out


# --- documents -------------------------------------------------------------------------------------


def find(docs: DataFrame, model: Field | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base and added, arrays of (start, kind, end) by start, then kind.

    ``base`` are the spans of the fixed patterns, which may overlap across kinds; ``added`` those
    that the field finds beside them. Places are code points, the end exclusive; kinds are
    numbered as in KINDS. Null and empty texts have no spans. Repeated rows each have theirs, an
    empty table gives an empty result, other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train())  # some thousand weights
    spans = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    out = pa.schema([("doc_id", pa.int64()), ("base", spans), ("added", spans)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in slices(batches, "text", _SLICE):
            base, added = [], []
            for t in batch.column("text"):
                t = t.as_py() or ""
                base.append(base_spans(t))
                added.append(field.added(t, base[-1]))
            columns = [pa.array([[dict(zip(("start", "kind", "end"), s, strict=True)) for s in row] for row in found], spans) for found in (base, added)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=out)

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    kinds = "array<struct<start: int, kind: int, end: int>>"
    return rows.mapInArrow(run, f"doc_id long, base {kinds}, added {kinds}")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas, in the order of their start and kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", parts)
