"""Exact deduplication by deterministic block naming, in DataFrame operations only.

Each text, stripped of white space, is cut into blocks of fixed size. The distinct blocks are
sorted and their places become integer names; then adjacent names are paired and the distinct
pairs are named the same way, until every document is left with one name. Equal names at the
same level mean equal texts: contents are compared, never hashes alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from packtrace.llm.common import free, without_white
from packtrace.session import durable

BLOCK_CHARS = 4096


def _blocks(docs: DataFrame, id: str, text: str, block_chars: int) -> DataFrame:
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(id).cast("long").alias("doc"), whole.alias("whole"))
    rows = rows.select("doc", F.char_length("whole").cast("long").alias("n_chars"), without_white(F.col("whole")).alias("bare"))
    cut = F.regexp_extract_all("bare", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    cut = F.when(F.col("bare") == "", F.array(F.lit(""))).otherwise(cut)
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("cut", cut)
    return rows.select("row", "doc", "n_chars", "bare", F.size("cut").alias("left"), F.posexplode("cut").alias("pos", "block"))


def _hash(block: str) -> Column:
    return F.xxhash64(block)


def _named(distinct: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Sort the distinct rows of each task; a row's place, with the task's number, is its name."""
    return distinct.sortWithinPartitions(*keys).select(*keep, F.monotonically_increasing_id().alias("name"))


def _first_names(blocks: DataFrame) -> DataFrame:
    """Name every block by its content.

    Contents travel once, to be made distinct. Their names come back by a 64-bit hash, which is
    exact where one content has that hash; the blocks of clashing hashes are joined by content.
    """
    hashed = blocks.withColumn("hash", _hash("block"))
    distinct = hashed.select("hash", "block").distinct()
    names = durable(_named(distinct, ["hash", "block"], ["hash"]))
    by_hash = durable(names.groupBy("hash").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("contents")))
    first = F.col("pos") == 0
    placed = hashed.select(
        "row", "doc", "n_chars", "left", "pos", "hash", "block", F.when(first, F.sha2("bare", 256)).alias("sha")
    )
    alone = by_hash.filter("contents = 1").select("hash", "name")
    done = placed.drop("block").join(alone, "hash").drop("hash")
    clashes = by_hash.filter("contents > 1").select("hash")
    if not clashes.isEmpty():
        shared = placed.join(clashes, "hash", "left_semi")
        apart = durable(shared.select("hash", "block").distinct().sortWithinPartitions("hash", "block")
                        .select("hash", "block", (-1 - F.monotonically_increasing_id()).alias("name")))
        done = done.unionByName(shared.join(apart, ["hash", "block"]).drop("hash", "block"))
    return durable(done)


def _pair_names(level: DataFrame) -> DataFrame:
    """One level up: pair the names at places 2i and 2i+1 and name the distinct pairs."""
    odd = F.col("pos") % 2 == 1
    pairs = level.groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("place")).agg(
        F.max(F.when(~odd, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-(1 << 62))).alias("b"),
        *[F.max(c).alias(c) for c in ("doc", "n_chars", "left", "sha")],
    )
    pairs = durable(pairs)
    names = durable(_named(pairs.select("a", "b").distinct(), ["a", "b"], ["a", "b"]))
    up = pairs.join(names, ["a", "b"]).drop("a", "b").withColumnRenamed("place", "pos")
    return durable(up.withColumn("left", F.ceil(F.col("left") / 2).cast("int")))


def identities(docs: DataFrame, id: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Give every row the identity of its text: columns row, doc, n_chars, sha, level, name.

    ``level`` and ``name`` agree exactly where texts agree after deleting white space. A null
    text counts as empty. One write per level; a level holds half the rows of the one below.
    """
    level = _first_names(_blocks(docs, id, text, block_chars))
    most = level.agg(F.max("left")).first()[0] or 0
    found, depth = [], 0
    while True:
        settled = level.filter("left = 1").select("row", "doc", "n_chars", "sha", F.lit(depth).alias("level"), "name")
        found.append(settled)
        if most <= 1:
            break
        level, most, depth = _pair_names(level.filter("left > 1")), -(-most // 2), depth + 1
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, n_same, n_chars, text_sha256.

    Texts are equal when identical after deleting white space; null counts as empty. Of equal
    texts the row with most code points stays, then the smallest id (null ids last), and of
    rows repeated in full the first. ``n_same`` counts rows with the id and length of the one
    that stays. An empty table gives an empty result; columns beside id and text are not read.
    """
    named = identities(docs, id, text, block_chars)
    key = ["level", "name"]
    # repeated rows first, then the group: both steps combine before they shuffle
    same = named.groupBy(*key, "doc", "n_chars").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    order = F.struct((-F.col("n_chars")).alias("longest"), F.col("doc").isNull().alias("no_id"), "doc", "row", "n")
    groups = same.groupBy(*key).agg(F.sum("n").alias("group_size"), F.min(order).alias("best"))
    groups = durable(groups.select(*key, "group_size", F.col("best.doc").alias("keep_id"), F.col("best.row").alias("keep_row"),
                                   F.col("best.n").alias("n_same")))
    out = named.join(groups, key)
    return out.select(
        F.col("doc").alias("doc_id"), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        "n_same", "n_chars", F.col("sha").alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that stay, one per group, with all their columns, whatever those are called.

    Rows that agree in id, length and text but for white space cannot be told apart; one of them stays.
    """
    id_, chars, sha, n_same = free(docs, "_id", "_chars", "_sha", "_n_same")
    stay = durable(exact_duplicates(docs, id, text, block_chars).filter("kept").select(
        F.col("doc_id").alias(id_), F.col("n_chars").alias(chars), F.col("text_sha256").alias(sha), F.col("n_same").alias(n_same)))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    match: list[Column] = [
        F.col(id).cast("long").eqNullSafe(F.col(id_)),
        F.char_length(whole) == F.col(chars),
        F.sha2(without_white(whole), 256) == F.col(sha),
    ]
    once = docs.join(stay.filter(F.col(n_same) == 1), match, "left_semi")
    again = docs.join(stay.filter(F.col(n_same) > 1), match, "left_semi")
    again = again.withColumns({id_: F.col(id).cast("long"), sha: F.sha2(without_white(whole), 256)}).dropDuplicates([id_, sha])
    return once.unionByName(again.drop(id_, sha))
