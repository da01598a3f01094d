"""Nearest neighbours, web archives, main text, packing and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import re
import uuid
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from packtrace.llm import ann, html_pages, html_text, langid, packing, queries, simhash, toxicity, warc
from packtrace.llm.common import slices

# --- nearest neighbours ------------------------------------------------------------------


def brute(points: dict[int, list[float]], q: int, k: int) -> list[tuple[int, float]]:
    far = sorted((float(np.sqrt(((np.array(v) - points[q]) ** 2).sum())), i) for i, v in points.items() if i != q and len(v) == len(points[q]))
    return [(i, d) for d, i in far[:k]]


VECTORS = "vec_id long, embedding array<float>, label int, id int, v string"


def test_recall_against_brute_force(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    points = {r.vec_id: np.array(r.embedding, np.float64) for r in vectors.collect()}
    found: dict[int, list] = {}
    for r in ann.nearest(vectors, vectors.filter("vec_id % 50 = 0"), block_rows=128, query_rows=4).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = 0
    for q, rows in found.items():
        want = brute(points, q, 10)
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11))
        assert [(r[2], r[1]) for r in rows] == sorted((r[2], r[1]) for r in rows)
        for _, i, s in rows:
            assert s == pytest.approx(float(np.sqrt(((points[i] - points[q]) ** 2).sum())), rel=1e-12)
        hit += len({i for i, _ in want} & {r[1] for r in rows})
    assert set(found) == {i for i in points if i % 50 == 0} and hit >= 0.95 * 10 * len(found)


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    good = {i: rng.normal(size=8).astype(np.float32).tolist() for i in range(1, 120)}
    good |= {i: good[1] for i in range(200, 260)}  # many copies: ties go to the smaller id
    data = [(i, v, 0, 0, "") for i, v in good.items()]
    bad = [None, [], [0.0] * 8, [None, *[1.0] * 7], [float("nan"), *[1.0] * 7], [float("inf"), *[1.0] * 7]]
    data += [(1000 + i, v, 0, 0, "") for i, v in enumerate(bad)] + [(None, good[2], 0, 0, ""), (2000, [1.0, 2.0], 0, 0, ""), (2001, [1.0, 4.0], 0, 0, "")]
    vectors = spark.createDataFrame(data, VECTORS)
    rows = ann.nearest(vectors, vectors.filter("vec_id in (1, 2, 230, 1000, 1002, 1004, 2000) or vec_id is null"), k=5, block_rows=40).collect()
    points = good | {2000: [1.0, 2.0], 2001: [1.0, 4.0]}
    found: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert set(found) == {1, 2, 230, 2000}
    assert found[1] == [200, 201, 202, 203, 204] and found[230] == [1, 200, 201, 202, 203] and found[2000] == [2001]
    assert len(set(found[2]) & {i for i, _ in brute(points, 2, 5)}) >= 4
    assert ann.nearest(vectors.limit(0), vectors.limit(0)).count() == 0
    assert ann.nearest(vectors, vectors.limit(0)).count() == 0


def test_repeated_queries_get_one_answer_each(spark):
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "vec_id long, embedding array<double>")
    again = spark.createDataFrame([(5, [5.0, 1.0])] * 3 + [(7, [7.0, 1.0]), (7, [20.0, 1.0])], vectors.schema)
    rows = ann.nearest(vectors, again, k=4).collect()
    assert sorted((r["rank"], r.vec_id) for r in rows if r.query_id == 5) == [(1, 4), (2, 6), (3, 3), (4, 7)]
    assert sorted(r["rank"] for r in rows if r.query_id == 7) == [1, 1, 2, 2, 3, 3, 4, 4]


# --- web archives ---------------------------------------------------------------------------

PAGES = [
    (1, "http://a.example/x", "<html><head><title>T &amp; t</title><script>var a='<p>';</script></head><body><p>One  two<p>é &lt;3 <a href='/l?a=1&amp;b'>go</a><!-- no --></body>", "x"),
    (2, None, None, "x"), (3, "http://b.example/", "", "x"), (1, "http://a.example/x", "plain", "x"), (4, "u", "a" * 100_000 + "<br>b", "x"),
]


def test_derivatives_are_linked(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, date string")
    sources = {r.record_id: r for r in warc.responses(pages).collect()}
    rows = warc.derive(warc.responses(pages)).collect()
    assert len(sources) == len(PAGES) and len(rows) == 2 * len(PAGES)
    for r in rows:
        source = sources[r.refers_to]
        assert r.target_uri == source.target_uri and r.payload_digest == source.payload_digest and r.date == source.date
        assert r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(r.block).digest()).decode() and r.content_length == len(r.block)
        assert source.block.endswith(b"\r\n\r\n" + warc.split_http(source.block)[2])
        uuid.UUID(r.record_id[len("<urn:uuid:"):-1])
    first = next(k for k, s in sources.items() if b"One  two" in s.block)
    text = next(r.block.decode() for r in rows if r.refers_to == first and r.warc_type == "conversion")
    about = json.loads(next(r.block for r in rows if r.refers_to == first and r.warc_type == "metadata"))
    assert text == "T & t\nOne two\né <3 go"
    assert about["title"] == "T & t" and about["links"] == ["/l?a=1&b"] and ["Content-Type", "text/html; charset=utf-8"] in about["http_headers"]
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0
    carried = warc.derive(warc.responses(pages), carry="page_id").select("page_id", "refers_to").collect()
    assert sorted((r.page_id, r.refers_to) for r in carried) == sorted((s.page_id, k) for k, s in sources.items() for _ in (1, 2))
    assert warc.derive(warc.derive(warc.responses(pages))).count() == 0  # no responses among them


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, date string")
    derived = warc.derive(warc.responses(pages))
    warc.write(derived, f"{tmp_path}/out")
    key = lambda r: (r.warc_type, r.record_id)
    back = sorted(warc.read(spark, f"{tmp_path}/out/*.gz").collect(), key=key)
    want = sorted(derived.collect(), key=key)
    assert [(r.block, r.refers_to, r.target_uri, r.block_digest, r.payload_digest) for r in back] == [
        (r.block, r.refers_to, r.target_uri, r.block_digest, r.payload_digest) for r in want]


def test_parsing_archives():
    rows = [{"warc_type": "response", "record_id": "<urn:x>", "refers_to": None, "target_uri": "u", "date": "d", "block_digest": None,
             "payload_digest": None, "content_type": "c", "content_length": len(b), "block": b} for b in (b"", b"WARC/1.0\r\n\r\n", b"\x00\xff" * 9)]
    whole = b"".join(map(warc.to_bytes, rows))
    for data in (whole, b"".join(map(warc.gzip_record, rows))):
        assert [b for _, b in warc.parse(data)] == [r["block"] for r in rows]
    assert len(list(warc.parse(whole[:-30]))) == 2 and list(warc.parse(b"junk")) == [] and list(warc.parse(b"")) == []


def test_reading_goes_on_after_broken_records(spark, tmp_path):
    rows = [{"warc_type": "response", "record_id": f"<urn:{i}>", "refers_to": None, "target_uri": "u", "date": "d", "block_digest": None,
             "payload_digest": None, "content_type": "c", "content_length": 6, "block": b"%06d" % i} for i in range(5)]
    one = [warc.to_bytes(r) for r in rows]
    bad = one[1].replace(b"Content-Length: 6", b"Content-Length: six")
    short = one[3].replace(b"Content-Length: 6", b"Content-Length: 600000")
    blocks = lambda data, lost: [b for _, b in warc.parse(data, lost)]
    for broken, kept in ((bad, (0, 2, 4)), (b"garbage\r\nmore garbage\r\n", (0, 2, 4)), (short, (0, 2, 4))):
        lost = []
        assert blocks(one[0] + broken + one[2] + one[4], lost) == [rows[i]["block"] for i in kept]
        assert sum(lost) in (len(broken), len(broken) - 4, len(broken) - 2)
    lost = []
    members = [warc.gzip_record(r) for r in rows]
    members[2] = members[2][:12] + b"\xff" * 8 + members[2][20:]
    assert blocks(b"".join(members), lost) == [rows[i]["block"] for i in (0, 1, 3, 4)] and lost == [len(members[2])]
    (tmp_path / "a.warc").write_bytes(one[0] + bad + one[2])
    (tmp_path / "b.warc").write_bytes(one[3])
    found = warc.read(spark, f"{tmp_path}/*.warc").collect()
    assert sorted(r.warc_type for r in found) == ["response"] * 3 + ["unreadable"]
    assert next(r.content_length for r in found if r.warc_type == "unreadable") > 100


class PlainReader(HTMLParser):
    """All text of a page by another parser: a line per block, without scripts, styles and comments."""

    BLOCKS = set("p div br li ul ol tr table h1 h2 h3 h4 h5 h6 article section nav header footer aside title body head html blockquote pre form td th dd dt".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.silent, self.links, self.title, self.in_title = [], 0, [], "", False

    def handle_starttag(self, tag, attrs):
        self.out += ["\n"] * (tag in self.BLOCKS)
        self.silent += tag in ("script", "style", "template", "noscript")
        self.links += [v for k, v in attrs if tag == "a" and k == "href"]
        self.in_title |= tag == "title"

    def handle_endtag(self, tag):
        self.out += ["\n"] * (tag in self.BLOCKS)
        self.silent -= tag in ("script", "style", "template", "noscript")
        self.in_title &= tag != "title"

    def handle_data(self, data):
        self.out += [data] * (not self.silent)
        self.title += data * self.in_title


def test_derivatives_of_pages_equal_another_parser(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    records = {r.page_id: r for r in warc.responses(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()}
    found: dict = {}
    for r in queries.op3_warc_derivatives(spark, sf_dir).collect():
        found.setdefault(r.page_id, {})[r.warc_type] = r
    blocks = {(r.page_id, r.warc_type): r.block for r in warc.derive(warc.responses(spark.read.parquet(f"{sf_dir}/pages.parquet")), carry="page_id").collect()}
    sha = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert found.keys() == pages.keys()
    for i, page in pages.items():
        reader = PlainReader()
        reader.feed(page.html)
        reader.close()
        lines = [" ".join(line.split()) for line in "".join(reader.out).split("\n")]
        text = "\n".join(line for line in lines if line).encode()
        meta, conversion = found[i]["metadata"], found[i]["conversion"]
        assert blocks[i, "conversion"] == text and conversion.block_digest == sha(text) and conversion.content_length == len(text)
        about = json.loads(blocks[i, "metadata"])
        assert about["links"] == reader.links and (about["title"] or "") == " ".join(reader.title.split())
        for r in (meta, conversion):
            assert r.refers_to == records[i].record_id and r.target_uri == page.url and r.payload_digest == sha(page.html.encode())
            assert ["Content-Type", "text/html; charset=utf-8"] in json.loads(r.source_headers)


def test_other_payloads():
    r = {"record_id": "<i>", "target_uri": None, "date": None, "content_type": "application/http", "payload_digest": "sha1:GIVEN"}
    image = warc.derivatives({**r, "block": b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG"})
    assert [x["warc_type"] for x in image] == ["metadata"] and image[0]["payload_digest"] == "sha1:GIVEN"
    latin = warc.derivatives({**r, "block": "HTTP/1.1 200 OK\r\nContent-Type: text/plain; charset=latin-1\r\n\r\né<b>".encode("latin-1")})
    assert latin[1]["block"].decode() == "é<b>"
    assert warc.derivatives({**r, "block": None})[0]["content_length"] > 0


# --- main text -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def field():
    return html_text.train()


def test_field_on_pages_not_trained_on(field):
    right = blocks = 0
    for seed in range(9000, 9150):
        found = html_text.leaves(html_pages.page(seed))
        labels = field.decode(html_text.features(found))
        right += sum(int(b[4]) == y for b, y in zip(found, labels, strict=True))
        blocks += len(found)
    assert right >= 0.99 * blocks


def test_viterbi_and_marginals_by_enumeration(field):
    rng = np.random.default_rng(2)
    rows = [[rng.choice(sorted(field.weights)) for _ in range(3)] for _ in range(7)]
    e = field.emissions(rows)
    paths = [[p >> i & 1 for i in range(7)] for p in range(128)]
    value = [sum(e[i, y] for i, y in enumerate(p)) + sum(field.steps[a, b] for a, b in zip(p, p[1:], strict=False)) for p in paths]
    assert field.decode(rows) == paths[int(np.argmax(value))]
    chance = np.exp(value - np.logaddexp.reduce(value))
    one, two = html_text._marginals(e, field.steps)
    for i in range(7):
        assert one[i, 1] == pytest.approx(sum(c for c, p in zip(chance, paths, strict=True) if p[i]))
    for a in (0, 1):
        for b in (0, 1):
            assert two[a, b] == pytest.approx(sum(c * sum(x == a and y == b for x, y in zip(p, p[1:], strict=False)) for c, p in zip(chance, paths, strict=True)))


def test_main_text_of_pages(spark, field, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    import html as entities

    for r in html_text.extract(pages, field).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search("<article>(.*?)(</article>|$)", r.html, re.S)[1]
        want = " ".join(entities.unescape(re.sub("</?[a-zA-Z][^>]*>", " ", inner)).split())
        assert r.text == want and r.n_chars == len(want)


def test_odd_pages(spark, field):
    body = "<nav><a href=/>Home</a></nav><article><h1>A &lt;b&gt; &#233; &unknown; &amp</h1><p>one\n two <b>th</b>ree<p>four<br>five"
    data = [(1, "u", body, ""), (2, None, None, ""), (3, "", "", ""), (4, "u", "<![odd[ x ]]><article><p>in text here", ""), (5, "u", "<p" * 50, ""),
            (None, "u", "<article><p>" + "w " * 60_000 + "</p></article>", ""), (1, "u", body, ""), (6, "u", "</p></div><article><p>y</article></article>", "")]
    rows = html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string, text string"), field).collect()
    found = {r.page_id: r for r in rows}
    assert len(rows) == 8 and all(r.n_chars == len(r.text) for r in rows)
    assert found[1].text == "A <b> é &unknown; & one two three four five"
    assert found[2].text == found[3].text == "" and found[None].n_chars == 119_999 and found[6].text == "y"
    assert html_text.extract(spark.createDataFrame(data[:0], "page_id long, url string, html string"), field).count() == 0


@pytest.mark.parametrize("start", ["<body><article>", "<article>", "<span></span><article>", "<noscript><link rel=x></noscript><body><article>"])
def test_head_without_end_tag(start, field):
    head = "<!DOCTYPE html><html><head><meta charset=utf-8><title>Name</title><style>p{}</style>\n"
    want = html_text.main_text(head + "</head><body><article><p>one two three.</p><p>four five six.</p></article></body></html>", field)
    assert want == "one two three. four five six."
    assert html_text.main_text(head + start + "<p>one two three.</p><p>four five six.</p></article></html>", field) == want
    assert [b[0] for b in html_text.leaves(head + "bare text<p>more")] == ["bare text", "more"]
    assert "</head>" not in html_text.html_pages.page(3)


# --- packing ---------------------------------------------------------------------------------


def slow_fit(lengths, sources, clusters, capacity, per_source):
    """Look at every bin for every piece."""
    bins: list[dict] = []
    out = []
    for n, s, c in zip(lengths, sources, clusters, strict=True):
        fits = [
            (b["room"], i) for i, b in enumerate(bins)
            if b["room"] >= n and b["room"] > 0 and (s < 0 or b["s"].count(s) < per_source) and (c < 0 or c not in b["c"])]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"room": capacity, "s": [], "c": set()})
        bins[i]["room"] -= n
        bins[i]["s"].append(s)
        bins[i]["c"].add(c)
        out.append(i)
    return out


@pytest.mark.parametrize("per_source", [1, 3])
def test_best_fit_takes_the_tightest_compatible_bin(per_source):
    rng = random.Random(per_source)
    for _ in range(60):
        n = rng.randrange(60)
        lengths = sorted((rng.choice((0, 1, 5, rng.randrange(100), 100)) for _ in range(n)), reverse=True)
        sources = [rng.choice((-1, 0, 0, 0, 1, 2)) for _ in range(n)]
        clusters = [rng.choice((-1, -1, 0, 1, 2)) for _ in range(n)]
        assert packing.best_fit(lengths, sources, clusters, 100, per_source) == slow_fit(lengths, sources, clusters, 100, per_source)


def check_bins(packed, docs, capacity, per_source):
    """All words of all rows in bins, and no conflict in any."""
    words = lambda t: re.findall("[^\x20\x09-\x0d]+", t or "")
    bins: dict[int, list] = {}
    for r in packed:
        bins.setdefault(r.bin_id, []).append(r)
    for pieces in bins.values():
        assert sum(p.length for p in pieces) <= capacity
        at = 0
        for p in sorted(pieces, key=lambda p: (p.offset, p.length)):
            assert p.offset == at
            at += p.length
        of = [docs[p.doc_id] for p in pieces]
        for s in {d[1] for d in of} - {None}:
            assert sum(d[1] == s for d in of) <= per_source
        bare = [re.sub("[\x20\x09-\x0d]", "", d[0] or "") for d in of]
        assert len([b for b in bare if b]) == len({b for b in bare if b})
    for i, (text, _) in docs.items():
        mine = sorted((p for p in packed if p.doc_id == i), key=lambda p: p.piece)
        assert sum(p.length for p in mine) == len(words(text)) and [p.piece for p in mine] == list(range(len(mine)))
        assert [p.start for p in mine] == [capacity * k for k in range(len(mine))]


def test_pack(spark):
    rng = random.Random(3)
    texts = [None, "", " \n", "w " * 250, "a b c", *[" ".join(["x", "yy"] * rng.randrange(1, 40)) for _ in range(30)]]
    data = [(i, rng.choice(texts) if rng.random() < 0.8 else "same text here", rng.choice(("hot", "hot", "b", None)), "r", 1) for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, row string, n int")
    rows = packing.pack(docs, 100, per_source=2, shard_rows=90).collect()
    check_bins(rows, {d[0]: (d[1], d[2]) for d in data}, 100, 2)
    twice = packing.pack(docs.unionByName(docs), 100).collect()
    assert len(twice) == 2 * len(rows)
    assert packing.pack(docs.limit(0)).count() == 0
    full = packing.fill(packing.pack(docs, 100), 100)
    assert full.agg(F.max("words")).first()[0] <= 100


# --- pipeline -----------------------------------------------------------------------------------


def language_cuts(left, models):
    """The rate that pieces of each length of a language's left-out texts may need, in plain Python."""
    out = []
    for name, _ in models:
        row, last = [], langid.MOST_RATE
        texts = ["".join(map(chr, langid.squeeze(langid._codes(t))[0])).strip() for t in left.get(name, [])]
        for c in range(langid._CLASSES):
            n = 1 << c
            pieces = [t[i : i + n] for t in texts for i in range(0, len(t) - n + 1, n)]
            rates, length = langid.parse(pieces, models)
            own = [min(r) for r, n_ in zip(rates.tolist(), length.tolist(), strict=True) if n_ > 0]
            if len(own) >= langid.LEAST_PIECES:
                mean = sum(own) / len(own)
                spread = (sum((r - mean) ** 2 for r in own) / len(own)) ** 0.5
                upper = float(np.quantile(own, 0.75))
                last = max(*own, mean + langid.SPREAD * spread, langid.TIMES * upper)
            row.append(last)
        out.append(row)
    return out


def test_pipeline_against_brute_force(spark, sf_dir, monkeypatch, tmp_path):
    monkeypatch.setattr(toxicity, "STEPS", 120)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rng = random.Random(9)
    sounds = ["qzo", "xiq", "wub", "yog", "zuk", "jox"]
    strange = [(900_000 + i, " ".join("".join(rng.choice(sounds) for _ in range(3)) for _ in range(80)), None, "far", 0) for i in range(4)]
    docs.unionByName(spark.createDataFrame(strange, docs.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    sf_dir = str(tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    data = {r.doc_id: r for r in docs.collect()}
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    ids = sorted(data)
    stay = [i for i, s in zip(ids, toxicity.scores([data[i].text for i in ids], *model), strict=True) if s < 0.5]
    left = docs.filter(F.col("doc_id").isin(stay))
    learn, left_out = langid.labelled_split(langid.learnable(left), "text", "lang", "doc_id")
    models = langid.automata(learn)
    most = language_cuts(left_out, models)
    rates, length = langid.parse([data[i].text for i in stay], models)
    cut = lambda k, n: most[k][min(langid._CLASSES - 1, int(n).bit_length() - 1)]
    known = [i for i, r, n in zip(stay, rates, length, strict=True) if n and r.min() <= cut(int(r.argmin()), n)]
    assert not {i for i, *_ in strange} & set(known)  # a language that nobody labelled goes
    stay = known
    best: dict[str, int] = {}
    for i in sorted(stay, key=lambda i: (-len(data[i].text), i)):
        best.setdefault(re.sub("[\x20\x09-\x0d]", "", data[i].text), i)
    stay = sorted(best.values())
    prints = {i: simhash.fingerprint(data[i].text) for i in stay}
    root = {i: i for i in stay}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in stay:
        for b in stay:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    stay = {i for i in stay if find(i) == i}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == stay and len(stay) < len(data)
    check_bins(rows, {i: (data[i].text, data[i].source) for i in stay}, packing.CAPACITY, packing.PER_SOURCE)


def test_stages_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs


def test_queries_are_registered():
    assert [re.match(r"op\d+_", n)[0] for n in sorted(queries.QUERIES, key=lambda n: int(re.match(r"op(\d+)", n)[1]))] == [f"op{i}_" for i in range(1, 14)]


def test_slices_hold_all_rows():
    import pyarrow as pa

    texts = ["a" * n for n in (0, 5, 9, 100, 1, 1)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], ["i", "text"])
    parts = list(slices([batch], "text", 10))
    assert [x for p in parts for x in p.column("text").to_pylist()] == texts and len(parts) >= 3
