"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page becomes the sequence of its leaf blocks: runs of text between block-level tags. Features
are the tags, classes and ids of a block's ancestors and the shape of its text. Weights are
trained on labelled pages; Viterbi decoding picks the blocks that are main text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from packtrace.llm import html_pages
from packtrace.llm.common import slices

TRAIN_PAGES, EPOCHS, RATE, DECAY = 600, 25, 0.1, 1e-4
_SLICE = 8 << 20

# Fixed values of HTML: elements that are never text, that hold nothing, and that are inline.
_SILENT = frozenset("head script style template noscript svg iframe object textarea select option title math audio video canvas".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split())
# An element that ends when one of these begins.
_ENDS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
_HEAD = frozenset("base basefont bgsound head link meta noscript script style template title".split())  # what may stand in a head
_SCOPE = frozenset("table ul ol dl body html article section div".split())
_NAME = re.compile(r"[a-z]+")


class _Leaves(HTMLParser):
    """Collects (text, ancestors' features, own tag, share of linked letters, label) per leaf block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, frozenset[str], bool]] = []  # tag, features of the chain, main (training only)
        self.silent = self.links = 0
        self.buffer: list[str] = []
        self.linked = 0
        self.out: list[tuple[str, frozenset[str], str, float, bool]] = []
        self.hold: tuple[str, frozenset[str], bool] = ("", frozenset(), False)

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                tag, chain, main = self.hold
                self.out.append((text, chain, tag, min(1.0, self.linked / len(text)), main))
            self.buffer, self.linked = [], 0

    def _pop(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.stack.pop()[0]
            if tag in _SILENT:
                self.silent -= 1
            elif tag == "a":
                self.links -= 1
            elif tag not in _INLINE:
                self.flush()

    def _end_head(self, tag: str) -> None:
        """Close a head whose end tag was left out: a body, or what cannot stand in a head, begins."""
        depth = len(self.stack) - 1
        if tag == "body":
            depth = next((i for i, x in enumerate(self.stack) if x[0] == "head"), -1)
        if depth >= 0 and self.stack[depth][0] == "head" and tag not in _HEAD:
            self._pop(depth)

    def handle_starttag(self, tag, attrs):
        self._end_head(tag)
        if tag not in _INLINE:
            self.flush()
            if tag not in _VOID:
                self._imply(tag)
        elif tag == "br":
            self.buffer.append(" ") if self.buffer else None
        if tag in _VOID:
            return
        chain, main = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (frozenset(), False)
        if tag not in _INLINE:
            new = {"in:" + tag}
            for name, value in attrs:
                if value and name in ("class", "id", "role"):
                    new.update("name:" + x for x in _NAME.findall(value.lower()))
                elif name == "data-main":
                    main = True
                elif name == "data-other":
                    main = False
            chain = chain | new
        self.stack.append((tag, chain, main))
        if tag in _SILENT:
            self.silent += 1
        elif tag == "a":
            self.links += 1

    def _imply(self, tag: str) -> None:
        """Close what cannot stay open when this block begins."""
        for depth in range(len(self.stack) - 1, -1, -1):
            open_ = self.stack[depth][0]
            if open_ == "p" or tag in _ENDS.get(open_, ()):
                self._pop(depth)
                return
            if open_ in _SCOPE:
                return

    def handle_endtag(self, tag):
        if tag not in _INLINE:
            self.flush()
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                self._pop(depth)
                return
            if tag in _INLINE and self.stack[depth][0] not in _INLINE:
                return

    def handle_data(self, data):
        if self.silent and data.strip():
            self._end_head("")
        if self.silent:
            return
        if not self.buffer:
            self.hold = self._place()
        self.buffer.append(data)
        if self.links:
            self.linked += len(data)

    def _place(self) -> tuple[str, frozenset[str], bool]:
        for tag, chain, main in reversed(self.stack):
            if tag not in _INLINE:
                return tag, chain, main
        return "", frozenset(), False


_ODD = re.compile(r"<!\[[^>]*>|<\?[^>]*>")


def leaves(html: str) -> list[tuple[str, frozenset[str], str, float, bool]]:
    """Leaf blocks of a page in order. Markup that is no declaration at all is left out."""
    for text in (html, _ODD.sub(" ", html)):
        parser = _Leaves()
        try:
            parser.feed(text)
            parser.close()
        except AssertionError:  # an unknown <![...] section
            continue
        parser.flush()
        return parser.out
    return []


def features(blocks: list[tuple[str, frozenset[str], str, float, bool]]) -> list[list[str]]:
    out = []
    last = max(1, len(blocks) - 1)
    for i, (text, chain, tag, linked, _) in enumerate(blocks):
        n = text.count(" ") + 1
        f = list(chain)
        f += [
            "tag:" + tag, "words:" + str(min(6, n.bit_length())), "linked:" + str(int(linked * 3.999)),
            "end:" + (text[-1] if text[-1] in ".!?…:" else "none"), "place:" + ("few" if last < 4 else "first" if i == 0 else "last" if i == last else str(3 * i // (last + 1))),
        ]
        if "©" in text or "opyright" in text:
            f.append("rights")
        if n < 12:
            f += [f"says:{w}" for w in _NAME.findall(text.lower()) if len(w) > 5]
        out.append(f)
    return out


class Field:
    """Weights of the random field: per feature for both labels, and per pair of neighbouring labels."""

    def __init__(self, weights: dict[str, tuple[float, float]], steps: np.ndarray, bias: np.ndarray):
        self.weights, self.steps, self.bias = weights, steps, bias

    def emissions(self, rows: list[list[str]]) -> np.ndarray:
        get, zero = self.weights.get, (0.0, 0.0)
        out = np.empty((len(rows), 2))
        for i, row in enumerate(rows):
            a, b = self.bias[0], self.bias[1]
            for f in row:
                w = get(f, zero)
                a += w[0]
                b += w[1]
            out[i] = a, b
        return out

    def decode(self, rows: list[list[str]]) -> list[int]:
        """Viterbi: the likeliest labels; a tie goes to 0."""
        if not rows:
            return []
        e = self.emissions(rows).tolist()
        (s00, s01), (s10, s11) = self.steps.tolist()
        a, b = e[0]
        back = []
        for x, y in e[1:]:
            pa_, pb = (1 if b + s10 > a + s00 else 0), (1 if b + s11 > a + s01 else 0)
            back.append((pa_, pb))
            a, b = max(a + s00, b + s10) + x, max(a + s01, b + s11) + y
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def train(pages: list[str] | None = None, epochs: int = EPOCHS, seed: int = 3) -> Field:
    """Fit by gradient ascent on the conditional likelihood. ``pages`` mark main text by data-main."""
    pages = [html_pages.page(i) for i in range(TRAIN_PAGES)] if pages is None else pages
    data = [(features(b), np.array([x[4] for x in b], int)) for b in map(leaves, pages) if b]
    count: dict[str, int] = {}
    for rows, _ in data:
        for f in {f for row in rows for f in row}:
            count[f] = count.get(f, 0) + 1
    number = {f: i for i, f in enumerate(sorted(f for f, n in count.items() if n >= 2))}
    coded = [([np.array([number[f] for f in row if f in number], int) for row in rows], y) for rows, y in data]
    weight, steps, bias = np.zeros((len(number), 2)), np.zeros((2, 2)), np.zeros(2)
    seen = [np.full(x.shape, 1e-8) for x in (weight, steps, bias)]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(coded)):
            rows, y = coded[k]
            flat = np.concatenate(rows)
            of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            e = np.stack([np.bincount(of, weight[flat, c], len(rows)) for c in (0, 1)], 1) + bias
            one, two = _marginals(e, steps)
            wrong = np.eye(2)[y] - one
            g_weight = np.stack([np.bincount(flat, wrong[of, c], len(number)) for c in (0, 1)], 1) - DECAY * weight
            g_steps = -two
            np.add.at(g_steps, (y[:-1], y[1:]), 1.0)
            for value, grad, sum2 in zip((weight, steps, bias), (g_weight, g_steps, wrong.sum(0)), seen, strict=True):
                sum2 += grad * grad
                value += RATE * grad / np.sqrt(sum2)
    return Field({f: (float(weight[i, 0]), float(weight[i, 1])) for f, i in number.items()}, steps, bias)


def _marginals(e: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: label marginals per block, and summed marginals of neighbouring labels."""
    n = len(e)
    forward, backward = np.empty((n, 2)), np.zeros((n, 2))
    forward[0] = e[0]
    for i in range(1, n):
        forward[i] = e[i] + np.logaddexp(forward[i - 1, 0] + steps[0], forward[i - 1, 1] + steps[1])
    for i in range(n - 2, -1, -1):
        ahead = e[i + 1] + backward[i + 1]
        backward[i] = np.logaddexp(steps[:, 0] + ahead[0], steps[:, 1] + ahead[1])
    total = np.logaddexp(*forward[-1])
    two = np.zeros((2, 2))
    if n > 1:
        two = np.exp(forward[:-1, :, None] + steps[None] + (e[1:] + backward[1:])[:, None, :] - total).sum(0)
    return np.exp(forward + backward - total), two


def main_text(html: str | None, field: Field) -> str:
    blocks = leaves(html) if html else []
    labels = field.decode(features(blocks))
    return " ".join([b[0] for b, y in zip(blocks, labels, strict=True) if y])


def extract(pages: DataFrame, field: Field | None = None, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined by one space in page order. A null or empty page, and one without main text, gives
    empty text. Whole pages are read, however long; other columns are not.
    """
    shared = pages.sparkSession.sparkContext.broadcast(train() if field is None else field)  # a few thousand weights
    out = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", _SLICE):
            text = [main_text(h, shared.value) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                schema=out)

    rows = pages.select(
        F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
