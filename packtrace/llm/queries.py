"""Registered queries of the training-data operators, and SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from packtrace.llm import ann, bpe, exact, html_text, langid, lm, packing, phrases, pii, simhash, toxicity, trie, warc
from packtrace.llm.common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(f):
    QUERIES[f.__name__] = f
    return f


@_register
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.score(docs, toxicity.train(docs, labels))
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@_register
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.learnable(docs))
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@_register
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op9_exact_dedup"] = r"""
    with t as (
        select doc_id, length(coalesce(text, '')) as n_chars,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as bare
        from documents),
    k as (
        select doc_id, bare, count(*) over (partition by bare) as group_size,
               first_value(doc_id) over (partition by bare order by n_chars desc, doc_id nulls last) as keep_id
        from t)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(bare) as text_sha256 from k"""


@_register
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_register
def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = lm.score(docs, *lm.train(lm.learnable(docs)))
    return found.select(
        "doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "bits_per_byte")


@_register
def op8_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), path or public_tokenizers.path("word_bpe_49k.json"))


@_register
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


@_register
def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.derive(warc.responses(table(spark, sf_dir, "pages")), carry="page_id")
    return found.select(
        "page_id", "warc_type", "record_id", "refers_to", "target_uri", "content_type", "content_length", "block_digest", "payload_digest",
        "source_headers")


@_register
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "piece", "start", "length", "bin_id", "offset")


@_register
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@_register
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_phrases"] = r"""
    with d as (
        select coalesce(lang, 'und') as lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
        from documents),
    p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from d),
    w as (select lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') as ws from p),
    totals as (select lang, sum(len(ws))::bigint as n from w group by lang),
    grams as (
        select lang, unnest(flatten(list_transform(range(1, 5), lambda m:
            list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))))) as phrase
        from w),
    f as (
        select lang, phrase, count(*) as f, string_split(phrase, ' ') as ws
        from grams group by lang, phrase having count(*) >= 30),
    k as (select lang, phrase, f as a, ws, unnest(range(1, len(ws))) as k from f where len(ws) > 1),
    scored as (
        select k.lang, k.phrase, a, l.f as l, r.f as r, k, (2000000::hugeint * a) // (l.f + r.f) as score
        from k join f l on l.lang = k.lang and l.phrase = array_to_string(k.ws[1:k], ' ')
        join f r on r.lang = k.lang and r.phrase = array_to_string(k.ws[k + 1:], ' ')),
    best as (
        select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    part as (
        select lang, f, unnest(flatten(list_transform(range(2, len(ws)), lambda m:
            list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))))) as phrase
        from f where len(ws) > 2),
    longer as (select lang, phrase, max(f) as f from part group by lang, phrase),
    ranked as (
        select b.*, row_number() over (partition by b.lang order by score desc, a desc, b.phrase) as rank
        from best b left join longer g on g.lang = b.lang and g.phrase = b.phrase
        where g.f is null or 100 * g.f < 80 * a)
    select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join totals using (lang) where rank <= 2000"""


@_register
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.numbered(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(*trie.shared_openings(turns))


ORACLES["op12_conversation_trie"] = """
    with turns as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
               row_number() over (partition by conv_id order by turn nulls first,
                   sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
        from conversations where conv_id is not null),
    own as (
        select conv_id, list(struct_pack(role := role, text := text) order by pos) as l from turns group by conv_id),
    crc as (  -- crc32 of the decimal id, eight steps per byte
        select conv_id, l, xor(4294967295, list_reduce(
            list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
            lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda y, i: xor(y >> 1, 3988292384 * (y & 1))))) % 6 as h
        from own),
    rebuilt as (
        select c.conv_id, list_concat(coalesce(d.l[1:c.h], []), c.l[c.h + 1:]) as l
        from crc c left join own d on d.conv_id = c.conv_id - c.conv_id % 100),
    steps as (
        select conv_id, len(l) as n, unnest(range(len(l) + 1)) as depth, l from rebuilt),
    placed as (select conv_id, n, depth, l[1:depth] as node, l[1:greatest(depth - 1, 0)] as up from steps),
    nodes as (
        select depth, node, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs,
               sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = depth), '')) as ends_sha256
        from placed group by depth, node),
    kids as (select up as node, count(*) as n_children from nodes where depth > 0 group by up),
    valued as (
        select n.*, coalesce(k.n_children, 0) as n_children,
               case when depth = 0 then 0 else (n_convs - 1) * length(n.node[depth].text) end as saved
        from nodes n left join kids k on n.node = k.node),
    lines as (select unnest(range(depth + 1)) as upto, node, n_children, saved from valued),
    sums as (
        select node[1:upto] as node, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved_tokens
        from lines group by node[1:upto])
    select v.conv_id, v.depth, p.conv_id as parent_conv_id, v.n_convs, v.n_children, s.n_leaves,
           s.saved_tokens::bigint as saved_tokens, v.ends_sha256
    from valued v join sums s on s.node = v.node
    left join valued p on v.depth > 0 and p.node = v.up"""


@_register
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base = F.col("base")
    return found.select(
        "doc_id", *[pii.count(base, kind).alias(f"n_{kind}") for kind in pii.KINDS], F.sha2(pii.written(base), 256).alias("base_sha256"),
        pii.written(F.concat("base", "added")).alias("spans"))
