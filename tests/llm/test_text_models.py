"""Language identification, toxicity, tokens and language-model scores."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from packtrace.llm import bpe, langid, lm, queries, toxicity
from packtrace.llm.common import remainder, slices, words

ODD = [
    None, "", " \n\t", "ΣΑΣ ΣΟΦΟΣ Σ", "İstanbul ǅ x²³ ½ Ⅷ ٣٤", "a\x1cb\x1db\x85c\xa0d e​f", "étude É É",
    "<|startoftext|>hi<|endoftext|>!<|STARTOFTEXT|>", "aaaaaaaaaaaaaaa aaaa aa !!!!!!!!!! ''''s's", "don't we'll I'M 'S'",
    "日本語テスト 한국어 😀😀👍🏽", "ﬁ ß ẞ \x00\x01", "x" * 5000, "1234567 | a_b",
]
SCHEMA = "doc_id long, text string, lang string, score string, rank int"


def table(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t in enumerate(texts)], SCHEMA)


# --- language identification ---------------------------------------------------------


def greedy(reference: str, text: str) -> int:
    n = i = 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i : j + 1] in reference:
            j += 1
        n, i = n + 1, j
    return n


def squeezed(text):
    return "".join(map(chr, langid.squeeze(langid._codes(text))[0]))


def test_phrases_are_longest_matches():
    rng = random.Random(1)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    train = {"a": make("abcd  ", 400), "b": make("bcde  ", 300), "c": make("xyz ", 50)}
    texts = [make("abcdex !9é", rng.randrange(2600)) for _ in range(12)] + ["", None, "123 !", "zz"]
    models = langid.automata(train)
    rates, length = langid.parse(texts, models)
    for t, row, n in zip(texts, rates, length, strict=True):
        s = squeezed(t) if t else ""
        for (k, _), r in zip(models, row, strict=True):
            parts = [s[i : i + langid.BLOCK] for i in range(0, len(s), langid.BLOCK)]
            assert round(r * max(1, len(s))) == sum(greedy(squeezed(train[k]), p) for p in parts)
        assert n == (len(s) if any(c != " " for c in s) else 0)


def test_identify(spark):
    rng = random.Random(2)
    parts = {"aa": ["ko", "ra", "mi", "tu"], "bb": ["sch", "ein", "ung", "ver"]}
    make = lambda k: " ".join("".join(rng.choice(parts[k]) for _ in range(3)) for _ in range(40))
    data = [(i, make(k), k, "s", 0) for i, k in enumerate(["aa", "bb"] * 60)] + [(900, None, "aa", "", 0), (901, "12 !", None, "", 0), (None, make("bb"), None, "", 0), (3, "KORAMI", None, "", 0)]
    docs = spark.createDataFrame(data, SCHEMA)
    found = {(r.doc_id, r.lang_pred) for r in langid.identify(docs, langid.learnable(docs)).collect()}
    assert {(d, k) for d, _, k, *_ in data[:120]} <= found
    assert {(900, "und"), (901, "und"), (None, "bb"), (3, "aa")} <= found and len(found) == 124
    scores = [r.score for r in langid.identify(docs, langid.learnable(docs)).collect()]
    assert all(0 <= s <= 1 for s in scores)
    stay = langid.drop_unknown(docs, docs)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == {d for d, *_ in data} - {900, 901}


def test_identify_without_labels(spark):
    docs = table(spark, ["some text", None], None)
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, docs).collect()] == [("und", 0.0)] * 2
    assert langid.drop_unknown(docs, docs).count() == 2
    assert langid.identify(docs.limit(0), docs.limit(0)).count() == 0


def test_language_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = langid.identify(docs, langid.learnable(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter(remainder("doc_id", 5) == 0).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_unlabelled_languages_go_and_short_texts_stay(spark):
    rng = random.Random(6)
    parts = {k: ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 2))) for _ in range(30)] for k in ("aa", "bb", "cc")}
    make = lambda k, n: " ".join("".join(rng.choice(parts[k]) for _ in range(2)) for _ in range(n))
    known = [(i, make(k, 60), k, "", 0) for i, k in enumerate(["aa", "bb"] * 60)]
    short = [(1000 + i, make("aa", 20)[:n].strip(), None, "", 0) for i, n in enumerate((1, 2, 3, 5, 9, 17, 33, 70))]
    other = [(2000 + i, make("cc", 60), None, "", 0) for i in range(20)]
    docs = spark.createDataFrame(known + short + other + [(3000, "Длинный текст другого письма", None, "", 0)], SCHEMA)
    stay = {r.doc_id for r in langid.drop_unknown(docs, docs).collect()}
    assert stay == {d for d, *_ in known + short}


# --- toxicity -------------------------------------------------------------------------


def test_units_are_ngrams_of_words():
    bucket, doc = toxicity.units(["Ab, c", None, "ab c", ""])
    first, third = bucket[doc == 0], bucket[doc == 2]
    assert sorted(first) == sorted(third) and len(first) == 2 + 1 + 1  # " ab", "ab ", " ab ", " c "
    whole, _ = toxicity.units(["abcdefgh"])
    assert len(whole) == sum(10 - n + 1 for n in toxicity.NGRAMS)


def test_toxicity_generalises_to_misspellings(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 250)
    rng = random.Random(4)
    syllables = ["ta", "lo", "mi", "ren", "os", "ka", "du"]
    clean = lambda: ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 60))]

    def rude(word):
        w = clean()
        for _ in range(1 + len(w) // 8):
            w.insert(rng.randrange(len(w)), word)
        return w

    data = [(i, " ".join(rude(rng.choice(("grubbish", "zwakkle"))) if i % 4 == 0 else clean()), "x", "", 0) for i in range(480)]
    labels = [(d, 1, int(d % 4 == 0)) for d, *_ in data] + [(9999, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(data + [(700, None, "", "", 0), (701, "", "", "", 0)], SCHEMA)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [d for d, *_ in data if zlib.crc32(str(d).encode()) % 5 == 0]
    right = sum(found[d].predicted == int(d % 4 == 0) for d in held)
    assert right >= 0.95 * len(held) and len(found) == len(data) + 2
    assert found[700].score == found[701].score and found[700].predicted == 0
    near, far = toxicity.scores([" ".join(rude("grubbisch")), " ".join(clean())], *model)
    assert near > far
    stay = toxicity.drop_toxic(docs, model)
    assert {r.doc_id for r in stay.collect()} == {d for d, r in found.items() if not r.predicted} and stay.columns == docs.columns


def test_toxicity_without_labels(spark):
    docs = table(spark, ["a b", None])
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.5, 0.5]
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_scores_hold_little_at_once():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(400)) for _ in range(2000)]  # 4.8 MB
    weight = np.random.default_rng(0).normal(size=toxicity.BUCKETS).astype(np.float32)
    toxicity.scores(["warm up"], weight, 0.0)
    batch, found = pa.record_batch({"text": pa.array(texts)}), []
    tracemalloc.start()
    for part in slices(iter([batch]), "text", toxicity._SLICE):
        found.append(toxicity.scores(part.column("text").to_pylist(), weight, 0.0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20
    assert np.concatenate(found)[[0, 999, 1999]].tolist() == [toxicity.scores([texts[i]], weight, 0.0)[0] for i in (0, 999, 1999)]


# --- tokens -----------------------------------------------------------------------------


def test_bpe_equals_the_library(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    texts = {r.doc_id: r.text for r in docs.collect()} | {10_000 + i: t for i, t in enumerate(ODD)}
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in texts.items()], SCHEMA)
    for r in bpe.digests(docs, path).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    whole = {r.doc_id: r for r in bpe.encode(docs.filter("doc_id >= 10000"), path).collect()}
    for i, t in enumerate(ODD):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert list(whole[10_000 + i].ids) == ids and whole[10_000 + i].decoded == library.decode(ids, skip_special_tokens=False)


def test_runs_of_one_symbol_merge_from_the_left():
    vocab = bpe.Vocabulary(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ws = ["e" * n for n in range(1, 40)] + ["ee" + "l" * n + "ss" for n in range(9)]
    for w, ids in zip(ws, bpe.encode_words(ws, vocab), strict=True):
        assert ids.tolist() == library.encode(w, add_special_tokens=False).ids


# --- language model ----------------------------------------------------------------------


class Tree:
    """Context-tree weighting by recursion, for one decision after another."""

    def __init__(self, data: list[tuple[bytes, int]]):
        self.n: dict[tuple, list[int]] = {}
        for context, byte in data:
            for s in range(8):
                node, bit = (byte | 256) >> (s + 1), byte >> s & 1
                for d in range(lm.DEPTH + 1):
                    self.n.setdefault((context[lm.DEPTH - d :], node), [0, 0])[bit] += 1

    @staticmethod
    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighed(self, context, node):
        if (context, node) not in self.n:
            return 0.0
        own = self.kt(*self.n[context, node])
        if len(context) == lm.DEPTH:
            return own
        below = sum(self.weighed(bytes([b]) + context, node) for b in self.alphabet)
        return float(np.logaddexp(math.log(0.5) + own, math.log(0.5) + below))

    def predict(self, context, node):
        """Chance of a 1, by the weights after all training data."""
        self.alphabet = getattr(self, "alphabet", None) or sorted({b for c, _ in self.n for b in c})

        def at(d):
            c = context[lm.DEPTH - d :]
            if (c, node) not in self.n:
                return 0.5
            a, b = self.n[c, node]
            own = (b + 0.5) / (a + b + 1)
            if d == lm.DEPTH:
                return own
            share = math.exp(math.log(0.5) + self.kt(a, b) - self.weighed(c, node))
            return share * own + (1 - share) * at(d + 1)

        return at(0)


def stream(text):
    data = b"\0" * lm.DEPTH + b" ".join(words(text)) + b"\0"
    return [(data[i - lm.DEPTH : i], data[i]) for i in range(lm.DEPTH, len(data))]


def base(train, text):
    count: dict[str, int] = {}
    cut = lambda t: re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""]
    for t in train:
        for w in cut(t):
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    return len(cut(text)), sum(w in count for w in cut(text)), n, sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in cut(text))


@pytest.mark.parametrize("frequent", [1 << 20, 3])
def test_base_score(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)  # with 3 most words' counts are joined
    train = ["the cat the dog", "The  end\n", None, "a a a b", "É é"]
    test = ["the the zebra", None, "É a B dog dog\x0bdog", ""]
    found = {r.doc_id: r for r in lm.score(table(spark, test), *lm.train(table(spark, train))).collect()}
    for i, t in enumerate(test):
        tokens, known, n, score = base(train, t)
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n) and r.base_score == pytest.approx(score)


def test_model_without_training_text(spark):
    none = table(spark, ["x"]).limit(0)
    r = lm.score(table(spark, ["ab"]), *lm.train(none)).first()
    assert r.bits_per_byte == pytest.approx(8) and r.train_tokens == 0 and r.n_known == 0
    assert lm.score(none, *lm.train(none)).count() == 0


@pytest.mark.parametrize("held", [1 << 20, 7, 0])
def test_whole_tree_equals_recursion(spark, monkeypatch, held):
    monkeypatch.setattr(lm, "GRAMS", held)  # with few held the buckets are asked, by several copies of a tree
    monkeypatch.setattr(lm, "_ASKED", 3)
    monkeypatch.setattr(lm, "_LOOK", 2)
    train = ["abab aba", "Abba  b\n", None, "baab", ""]
    test = ["aba", "abc", None, "bb é", "abab aba", "abab abab abab"]
    docs = table(spark, test).repartition(3)
    found = {r.doc_id: r for r in lm.score(docs, *lm.train(table(spark, train))).collect()}
    tree = Tree([x for t in train for x in stream(t)])
    assert len(found) == len(test)
    for i, t in enumerate(test):
        bits = [(c, (b | 256) >> (s + 1), b >> s & 1) for c, b in stream(t) for s in range(8)]
        ones = [tree.predict(c, node) for c, node, _ in bits]
        assert found[i].score == pytest.approx(sum(math.log10(p if bit else 1 - p) for p, (*_, bit) in zip(ones, bits, strict=True)), rel=1e-5)


def test_scores_do_not_depend_on_what_is_held(spark, sf_dir, monkeypatch):
    score = lambda: {r.doc_id: r.score for r in queries.op6_language_model(spark, sf_dir).collect()}
    whole = score()
    monkeypatch.setattr(lm, "GRAMS", 10_000)
    less = score()
    assert less.keys() == whole.keys() and all(less[k] == pytest.approx(v, rel=1e-5) for k, v in whole.items())


def test_long_texts_serve_a_class_without_shorter_ones(spark, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_DOC_CHARS", 300)
    monkeypatch.setattr(toxicity, "TRAIN_DOC_CHARS", 300)
    monkeypatch.setattr(toxicity, "STEPS", 120)
    rng = random.Random(8)
    parts = {"aa": ["ko", "ra", "mi", "tu"], "bb": ["sch", "ein", "ung", "ver"]}
    make = lambda k, n: " ".join("".join(rng.choice(parts[k]) for _ in range(3)) for _ in range(n))
    data = [(i, make(k, 30 if k == "aa" else 200), k, "", 0) for i, k in enumerate(["aa", "bb"] * 60)]
    docs = spark.createDataFrame(data, SCHEMA)
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs, langid.learnable(docs)).collect()}
    assert all(found[d] == k for d, _, k, *_ in data)
    labels = spark.createDataFrame([(d, int(k == "bb")) for d, _, k, *_ in data], "doc_id long, toxic int")
    said = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert sum(said[d] == int(k == "bb") for d, _, k, *_ in data) >= 0.95 * len(data)


def test_toxicity_scores_equal_a_plain_sum(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    weight, bias = toxicity.train(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs, (weight, bias)).collect()}
    for r in docs.limit(40).collect():
        bucket, _ = toxicity.units([r.text])
        mean = float(sum(float(weight[b]) for b in bucket.tolist())) / max(1, len(bucket))
        want = 1 / (1 + math.exp(-(mean + bias)))
        assert found[r.doc_id].score == pytest.approx(want, abs=1e-5) and found[r.doc_id].predicted == int(found[r.doc_id].score >= 0.5)


def test_words_and_bytes_of_odd_texts():
    texts = [*ODD, " \x0b\x0ca\rB\tC \n", "\u2003x\u2003", "\x1c \x1f"]
    word, tokens = lm._words(pa.array(texts))
    lists = [words(t) for t in texts]
    assert word.to_pylist() == [w for x in lists for w in x] and tokens.tolist() == [len(x) for x in lists]
    key, size = lm._stream(word, tokens)
    pairs = [x for t in texts for x in stream(t)]
    assert key.tolist() == [int.from_bytes(c) << 8 | b for c, b in pairs] and size.tolist() == [len(stream(t)) for t in texts]


def test_gathered_counts_travel_in_one_batch_a_kind():
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(300))) for _ in range(40)] + [None, ""]
    found = list(lm._gather(512)(iter([pa.record_batch({"text": pa.array(texts)})])))
    assert len(found) == 2  # n-grams and words, each with a row per bucket
    rows = [r for b in found for r in b.to_pylist()]
    n = {k: {} for k in (0, 1)}
    for r in rows:
        n[r["kind"]] |= dict(zip(lm._unpack(r["key"], np.uint64).tolist(), lm._unpack(r["n"], np.int32).tolist(), strict=True))
    count: dict[int, int] = {}
    for c, b in (x for t in texts for x in stream(t)):
        count[int.from_bytes(c) << 8 | b] = count.get(int.from_bytes(c) << 8 | b, 0) + 1
    assert n[0] == count
    seen: dict[int, int] = {}
    for w in [w for t in texts for w in [*words(t), b""]]:
        h = lm.xxhash.xxh64_intdigest(w)
        seen[h] = seen.get(h, 0) + 1
    assert n[1] == seen
