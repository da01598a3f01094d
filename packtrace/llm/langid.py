"""Language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text is built. A text is parsed greedily into the
longest phrases that occur in that labelled text; the language that needs fewest phrases per
character wins. Texts are lower-cased, runs of characters that are not letters count as one
space, and a phrase ends at each ``BLOCK`` characters, so that long texts run in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from packtrace.llm.common import piece, remainder, slices

BLOCK = 1024  # characters parsed in a row
TRAIN_CHARS = 48_000  # labelled text per language, the documented bound of the fit
TRAIN_DOC_CHARS = 12_000  # of a text in the fit: longer texts serve, by a piece, only a language without shorter ones
TRAIN_DOCS = 120  # rows per language among which the fit chooses
MOST_RATE = 0.6  # phrases per character that a language's texts may need if none of them is left out to tell
LEFT_OUT = 5  # of so many labelled texts one is left out of the automata, to find the rates of its language
TRY_CHARS = 24_000  # left-out text per language that is parsed
SPREAD = 6  # standard deviations above the mean rate of a language that are still in it,
TIMES = 2.0  # and times its upper quartile: few left-out texts show too little of the spread, copies less
LEAST_PIECES = 16  # by which a class of lengths is judged
_CLASSES = 11  # of lengths, a power of two each; longer texts are in the last
_SLICE = 6 << 20
_LANES = 4096
_FIRST, _STATE, _TOP = np.uint32(0x80000000), np.uint32(0x7FFFFFFF), np.uint32(31)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _letters() -> np.ndarray:
    """1 for each code point that is a letter; a table, as one look-up per character is all there is time for."""
    table = np.zeros(0x110000, bool)
    for i in range(0x110000):
        if chr(i).isalpha():
            table[i] = True
    return table


_TABLES: dict = {}


def letters() -> np.ndarray:
    if "letters" not in _TABLES:
        _TABLES["letters"] = _letters()
    return _TABLES["letters"]


def squeeze(codes: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Letters as they are, each run of other characters as one space; and which places were kept.

    ``starts`` tells where texts begin; a run at the start of a text is left out.
    """
    letter = letters()[np.minimum(codes, 0x10FFFF)]
    out = np.where(letter, codes, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:1] = letter[:1]
    if starts is not None:
        keep[starts] = letter[starts]
    return out[keep], keep


class Automaton:
    """Suffix automaton of one text over a dense alphabet, as a table of complete parse steps.

    Entry [state, letter] is where the next state's row begins; the top bit says that a new phrase
    starts with this letter.
    """

    def __init__(self, codes: np.ndarray):
        alphabet = np.unique(codes)
        self.alphabet = alphabet
        symbols = (np.searchsorted(alphabet, codes) + 1).tolist()
        width = len(alphabet) + 1  # 0 stands for letters that never occur
        link, length, step = [-1], [0], [{}]
        last = 0
        for c in symbols:
            cur = len(link)
            link.append(0)
            length.append(length[last] + 1)
            step.append({})
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = cur
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    clone = len(link)
                    link.append(link[q])
                    length.append(length[p] + 1)
                    step.append(dict(step[q]))
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        root = np.full(width, _FIRST, np.uint32)
        for c, s in step[0].items():
            root[c] = _FIRST | np.uint32(s * width)
        table = np.tile(root, (len(step), 1))
        state = np.repeat(np.arange(len(step)), [len(s) for s in step])
        letter = np.fromiter((c for s in step for c in s), np.int64, len(state))
        target = np.fromiter((t for s in step for t in s.values()), np.int64, len(state))
        inner = state > 0
        table[state[inner], letter[inner]] = target[inner] * width
        self.table = table.ravel()

    def classes(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.alphabet):
            return np.zeros(len(codes), np.uint16)
        if not hasattr(self, "lookup"):
            self.lookup = np.zeros(int(self.alphabet[-1]) + 2, np.uint16)
            self.lookup[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        return self.lookup[np.minimum(codes, len(self.lookup) - 1)]

    def phrases(self, codes: np.ndarray, order: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Number of phrases of each block; all blocks advance together, a character at a time.

        ``order`` lists the blocks from long to short, so those still running are always a prefix.
        """
        classes = self.classes(codes)
        count = np.zeros(len(order), np.uint32)
        begin, left = start[order], -length[order]
        for first in range(0, len(order), _LANES):
            at, rest = begin[first : first + _LANES], left[first : first + _LANES]
            steps = -int(rest[0])
            # one row per step: the classes all lanes read at that step
            rows = classes[np.minimum(at[None, :] + np.arange(steps)[:, None], len(classes) - 1)]
            running = np.searchsorted(rest, -np.arange(steps))
            move, index = np.zeros(len(at), np.uint32), np.empty(len(at), np.intp)
            total = count[first : first + _LANES]
            for i, n in enumerate(running.tolist()):
                v, k = move[:n], index[:n]
                np.bitwise_and(v, _STATE, out=v)
                np.add(v, rows[i, :n], out=k, casting="unsafe")
                np.take(self.table, k, out=v, mode="clip")
                total[:n] += v >> _TOP
        out = np.empty(len(order), np.int64)
        out[order] = count
        return out


def _labelled(docs: DataFrame, text: str, lang: str, key: str) -> dict[str, list[str]]:
    """Labelled texts per language, in the order of a hash.

    Rows are taken in the order of a hash of the key, so the choice is the same at every run
    and follows no other column. Per language at most a few times TRAIN_DOCS rows reach the driver.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    length = F.char_length(text)
    known = known.filter(length > 0)
    short = length <= TRAIN_DOC_CHARS
    sizes = known.groupBy(lang).agg(F.count_if(short).alias("short"), F.count(F.lit(1)).alias("n")).collect()  # a row per language
    if not sizes:
        return {}
    counts = {r[0]: r.short or r.n for r in sizes}
    only_long = [r[0] for r in sizes if not r.short]
    known = known.filter(short | F.col(lang).isin(only_long)) if only_long else known.filter(short)
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 40))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(min(1.0, TRAIN_DOCS / n) * (1 << 40)))])
    picked = known.filter(place <= share[F.col(lang)]).select(F.col(lang).alias("l"), piece(F.col(text), F.col(key), TRAIN_DOC_CHARS).alias("t"), place.alias("p"))
    # letters only, and one copy of a text that repeats
    rows = picked.groupBy("l", "t").agg(F.min("p").alias("p")).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.l, r.p, r.t)):
        out.setdefault(r.l, []).append(r.t)
    return out


def _until(texts: list[str], chars: int) -> list[str]:
    """The first texts up to ``chars`` characters, and the one that reaches them."""
    ends = np.cumsum([0, *map(len, texts)])
    return texts[: int(np.searchsorted(ends, chars))]


def labelled_text(docs: DataFrame, text: str, lang: str, key: str, chars: int = TRAIN_CHARS) -> dict[str, str]:
    """Labelled text per language, at most ``chars`` characters and one text more."""
    return {k: "\n".join(_until(v, chars)) for k, v in _labelled(docs, text, lang, key).items()}


def labelled_split(docs: DataFrame, text: str, lang: str, key: str, chars: int = TRAIN_CHARS) -> tuple[dict[str, str], dict[str, list[str]]]:
    """Labelled text per language to learn from, and labelled texts left out to find its rates."""
    learn, left = {}, {}
    for k, v in _labelled(docs, text, lang, key).items():
        learn[k] = "\n".join(_until([t for i, t in enumerate(v) if i % LEFT_OUT != LEFT_OUT - 1], chars))
        left[k] = _until(v[LEFT_OUT - 1 :: LEFT_OUT], TRY_CHARS)
    return learn, left


def _class(length: np.ndarray) -> np.ndarray:
    return (np.frexp(np.maximum(length, 1).astype(float))[1] - 1).clip(0, _CLASSES - 1)


def cuts(left: dict[str, list[str]], models: list[tuple[str, Automaton]], most: float = MOST_RATE) -> np.ndarray:
    """Phrases per character that a text of a language needs at most, by language and class of length.

    The left-out texts are cut into pieces of each length, so that short texts, whose rates are
    high and spread widely, are judged by pieces as short. A class with few pieces takes the cut of
    the next shorter one, and a language without left-out text takes ``most``.
    """
    out = np.full((len(models), _CLASSES), most)
    for k, (name, _) in enumerate(models):
        whole = ["".join(map(chr, squeeze(_codes(t))[0])).strip() for t in left.get(name, [])]
        for c in range(_CLASSES):
            n = 1 << c
            rates, length = parse([t[i : i + n] for t in whole for i in range(0, len(t) - n + 1, n)], models)
            rates = rates[length > 0].min(1)
            if len(rates) >= LEAST_PIECES:
                out[k, c] = max(rates.max(), rates.mean() + SPREAD * rates.std(), TIMES * np.quantile(rates, 0.75))
            elif c:
                out[k, c] = out[k, c - 1]
    return out


def automata(texts: dict[str, str]) -> list[tuple[str, Automaton]]:
    key = hash(tuple(sorted(texts.items())))
    if key not in _TABLES:
        for k in [k for k in _TABLES if k != "letters"]:
            del _TABLES[k]
        _TABLES[key] = [(k, Automaton(squeeze(_codes(t))[0])) for k, t in sorted(texts.items())]
    return _TABLES[key]


def parse(texts: list[str | None], models: list[tuple[str, Automaton]]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases per character for each (text, language), and the characters of each text."""
    parts = [_codes(t) if t else np.zeros(0, np.uint32) for t in texts]
    bounds = np.cumsum([0, *map(len, parts)])
    starts = bounds[:-1][np.diff(bounds) > 0]
    codes, keep = squeeze(np.concatenate(parts) if parts else np.zeros(0, np.uint32), starts)
    before = np.concatenate([[0], np.cumsum(keep)])
    edge = before[bounds]
    length = np.diff(edge)
    n_blocks = -(-length // BLOCK)
    doc = np.repeat(np.arange(len(texts)), n_blocks)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    start = edge[:-1][doc] + place * BLOCK
    size = np.minimum(BLOCK, length[doc] - place * BLOCK)
    order = np.argsort(-size, kind="stable")
    rates = np.zeros((len(texts), len(models)))
    for k, (_, model) in enumerate(models):
        rates[:, k] = np.bincount(doc, model.phrases(codes, order, start, size), len(texts)) / np.maximum(length, 1)
    return rates, np.where(letters_in(codes, edge), length, 0)


def letters_in(codes: np.ndarray, edge: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(codes != 32)])
    return total[edge[1:]] > total[edge[:-1]]


def identify(docs: DataFrame, train: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
             key: str = "doc_id", chars: int = TRAIN_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, phrase_rate.

    ``train`` gives the labelled rows. score is 1 - best / second best phrase rate (1 with one
    language alone), phrase_rate the winner's phrases per character. Null texts, texts without
    a letter, and all texts if nothing is labelled, give ``und`` with score 0 and a null rate.
    Ties go to the language that sorts first. Other columns are not read.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(labelled_text(train, text, lang, key, chars))  # bounded: chars x languages
    out = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("phrase_rate", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = automata(model.value)
        names = [k for k, _ in models]
        for batch in slices(batches, "text", _SLICE):
            rates, length = parse(batch.column("text").to_pylist(), models)
            ok = (length > 0) & bool(names)
            if names:
                best = rates.argmin(1)
                low = rates[np.arange(len(best)), best]
                rest = rates.copy()
                rest[np.arange(len(best)), best] = np.inf
                second = rest.min(1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    score = np.where(np.isinf(second), 1.0, 1 - low / second)
            else:
                best, low, score = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([names[b] if o else "und" for b, o in zip(best, ok, strict=True)], pa.string()),
                    pa.array(np.where(ok, np.nan_to_num(score), 0.0)),
                    pa.array(low, mask=~ok),
                ],
                schema=out,
            )

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, phrase_rate double")


def drop_unknown(docs: DataFrame, train: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
                 most: float = MOST_RATE, chars: int = TRAIN_CHARS) -> DataFrame:
    """The rows of ``docs`` in a learnt language, with all their columns; nothing is shuffled.

    Texts without a letter go, and those for which even the best language needs more phrases per
    character than its left-out labelled texts of that length do (see ``cuts``; ``most`` where
    none is left out). If nothing is labelled every row stays.
    """
    model = docs.sparkSession.sparkContext.broadcast(labelled_split(train, text, lang, key, chars))  # bounded: chars x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learn, left = model.value
        models = automata(learn)
        if models and ("cuts", most) not in _TABLES:
            _TABLES["cuts", most] = cuts(left, models, most)
        for batch in slices(batches, text, _SLICE):
            if models:
                rates, length = parse(batch.column(text).to_pylist(), models)
                best = rates.argmin(1)
                low = rates[np.arange(len(best)), best]
                batch = batch.filter(pa.array((length > 0) & (low <= _TABLES["cuts", most][best, _class(length)])))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def learnable(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """The rows from which the language model may learn."""
    return docs.filter(remainder(id, 5) != 0)
