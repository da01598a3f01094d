"""Prefix trie of conversations, with subtree totals rolled up in bands of depth.

A node is a distinct sequence of first turns. Its key is its depth and 128 bits that combine the
digests of its turns and their places, so a prefix's key follows from the key before it. Subtree
totals come in bands: within a band of fixed height every node explodes to its ancestors of the
same band; the totals of a band's roots are rolled up the same way over the tree of band roots,
and then explode once more to the ancestors in the band above. A node makes at most 2 x BAND rows
and the rounds grow with the logarithm of the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from packtrace.session import durable

BAND = 16  # depths per band
RUN = 1024  # turns of a conversation that one window holds
_CHUNK_BITS = 12  # ids per joined piece of a node's list of ends: at most 4,096
KEY = ["depth", "a", "b"]


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, item, size) per turn: its place from 1, a digest of role and text, and the text's code points.

    Turns count in the order of ``turn``, null first, ties by the digest. Null roles and texts are
    empty; rows without a conversation take no part. The order is cut into ranges over all rows,
    so that a long conversation spreads over many tasks; one row per conversation and range tells
    where its turns there begin to count.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    item = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), item.alias("item"), F.char_length(text).cast("long").alias("size"))
    rows = rows.filter("conv is not null").withColumn("tie", F.monotonically_increasing_id())
    order = ["conv", F.asc_nulls_first("turn"), "item", "tie"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    cut = durable(cut.select("conv", "item", "size", F.monotonically_increasing_id().alias("at")))
    cut = cut.withColumn("part", F.shiftright("at", 33).cast("int"))
    spans = cut.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    pos = F.col("before") + F.col("at") - F.col("first") + 1
    return durable(cut.join(spans, ["conv", "part"]).select("conv", pos.alias("pos"), "item", "size"))


def _prefixes(steps: DataFrame, most: int) -> DataFrame:
    """Combine a and b of each step with those of all steps before it; no window holds more than RUN steps."""
    run = F.floor(F.col("depth") / RUN).cast("long")
    if most < RUN:
        upto = Window.partitionBy("conv").orderBy("depth")
        return steps.withColumns({c: F.bit_xor(c).over(upto) for c in ("a", "b")})
    steps = steps.withColumn("run", run)
    totals = steps.groupBy("conv", "run").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    until = durable(_prefixes(totals.withColumnRenamed("run", "depth"), most // RUN))
    earlier = until.select("conv", (F.col("depth") + 1).alias("run"), F.col("a").alias("a0"), F.col("b").alias("b0"))
    upto = Window.partitionBy("conv", "run").orderBy("depth")
    inside = steps.withColumns({c: F.bit_xor(c).over(upto) for c in ("a", "b")}).join(earlier, ["conv", "run"], "left")
    whole = {c: F.col(c).bitwiseXOR(F.coalesce(F.col(f"{c}0"), F.lit(0).cast("long"))) for c in ("a", "b")}
    return inside.withColumns(whole).drop("run", "a0", "b0")


def _own(depth: Column, item: Column) -> list[Column]:
    """What a turn adds to the 128 bits of its prefix's key."""
    return [F.xxhash64(F.lit(1), depth, item).alias("a"), F.xxhash64(item, depth, F.lit(2)).alias("b")]


def _in_band(paths: DataFrame, band: int) -> DataFrame:
    """Per step the keys from its band's first depth down to itself; the band at the top begins with the root."""
    upto = Window.partitionBy("conv", "band").orderBy("depth")
    keys = F.collect_list(F.struct(*KEY)).over(upto)
    root = F.array(F.struct(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")))
    marked = paths.withColumn("band", F.floor(F.col("depth") / band).cast("long"))
    return marked.select("conv", "depth", F.when(F.col("band") == 0, F.concat(root, keys)).otherwise(keys).alias("path"))


def rollup(paths: DataFrame, nodes: DataFrame, values: list[str], most: int, band: int = BAND) -> DataFrame:
    """Sums of ``values`` over every node's subtree, itself included: a row per node with its key.

    ``nodes`` has KEY, values and the conversation ``conv`` that stands for it; ``paths`` has (conv,
    depth, a, b) for all steps; the root has depth 0 and key 0, 0 and no step.
    """
    lines = durable(_in_band(paths, band))
    below = nodes.filter("depth > 0").join(lines, ["conv", "depth"]).select(F.explode("path").alias("k"), *values)
    root = nodes.filter("depth = 0").select(F.struct(*KEY).alias("k"), *values)
    total = [F.sum(v).alias(v) for v in values]
    sums = below.unionByName(root).groupBy("k").agg(*total).select("k.*", *values)
    if most < band:
        return sums
    sums = durable(sums)
    heads = sums.filter(F.col("depth") % band == 0).join(nodes.select(*KEY, "conv"), KEY)
    higher = heads.withColumn("depth", (F.col("depth") / band).cast("long"))
    steps = paths.filter(F.col("depth") % band == 0).withColumn("depth", (F.col("depth") / band).cast("long"))
    whole = rollup(steps, higher, values, most // band, band).withColumn("depth", F.col("depth") * band)
    whole = whole.filter("depth > 0").join(nodes.select(*KEY, "conv"), KEY)
    above = whole.withColumn("depth", F.col("depth") - 1).drop("a", "b").join(lines, ["conv", "depth"])
    above = above.select(F.explode("path").alias("k"), *values).select("k.*", *values)
    return sums.unionByName(above).groupBy(*KEY).agg(*total)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest the pieces of each node as they come, in order; holds one piece at a time."""
    key, digest = None, None

    def out():
        return pa.RecordBatch.from_pylist([dict(zip(KEY, key, strict=True)) | {"ends_sha256": digest.hexdigest()}], schema=schema)

    schema = pa.schema([*((k, pa.int64()) for k in KEY), ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for *now, piece in zip(*(batch.column(c).to_pylist() for c in (*KEY, "piece")), strict=True):
            if now == key:
                digest.update(b",")
            else:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = now, hashlib.sha256()
            digest.update(piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
    if key is not None:
        yield out()


def ends(last: DataFrame) -> DataFrame:
    """Per node (KEY) the SHA-256 of the ids of the conversations that end there, ascending, joined by commas.

    ``last`` has KEY and conv. Ids near each other are joined first, at most 4,096 at a time, so
    the task that hashes a node's list reads few rows however many conversations end there.
    """
    chunk = F.shiftright("conv", _CHUNK_BITS)
    pieces = last.groupBy(*KEY, chunk.alias("chunk")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    pieces = pieces.select(*KEY, "chunk", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("piece"))
    parts = int(last.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.repartition(parts, *KEY).sortWithinPartitions(*KEY, "chunk").drop("chunk")
    return pieces.mapInArrow(_hash_ends, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(steps: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``steps`` has (conv, pos, item, size) with pos from 1 without gaps, as ``numbered`` gives them;
    ``convs`` has every conversation once, turnless ones too. A node stands for a distinct
    sequence of first items; conv_id is its smallest member, n_convs its members, saved_tokens the
    sum over its subtree of (n_convs - 1) x size of the last item. No conversations give no node;
    one without turns is a member of the root alone.
    """
    depth = F.col("pos").cast("long")
    steps = durable(steps.select("conv", depth.alias("depth"), "item", "size"))
    most = steps.agg(F.max("depth")).first()[0] or 0
    own = steps.select("conv", "depth", "size", *_own(F.col("depth"), F.col("item")))
    paths = _prefixes(own.withColumns({"own_a": F.col("a"), "own_b": F.col("b")}), most)
    paths = durable(paths)
    keyed = paths.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("size").alias("size"),
        F.min("own_a").alias("own_a"), F.min("own_b").alias("own_b"))
    zero = F.lit(0).cast("long")
    top = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    top = top.select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv", "n_convs", zero.alias("size"), zero.alias("own_a"), zero.alias("own_b"))
    nodes = durable(keyed.unionByName(top))
    up = [F.col("depth") - 1, F.col("a").bitwiseXOR(F.col("own_a")), F.col("b").bitwiseXOR(F.col("own_b"))]
    children = nodes.filter("depth > 0").groupBy(*[c.alias(k) for c, k in zip(up, KEY, strict=True)]).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = durable(nodes.join(children, KEY, "left").select(
        *KEY, "conv", "n_convs", *[c.alias(f"up_{k}") for c, k in zip(up, KEY, strict=True)],
        F.coalesce("n_children", zero).alias("n_children"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
        F.col("n_children").isNull().cast("long").alias("n_leaves")))
    sums = rollup(paths.select("conv", *KEY), nodes, ["n_leaves", "saved_tokens"], most, band)
    length = paths.groupBy("conv").agg(F.max("depth").alias("depth"))
    last = paths.select("conv", *KEY).join(length, ["conv", "depth"])
    empty = convs.select("conv").join(length.select("conv"), "conv", "left_anti").select("conv", *[zero.alias(k) for k in KEY])
    ended = ends(last.unionByName(empty))
    parents = nodes.select(*[F.col(k).alias(f"up_{k}") for k in KEY], F.col("conv").alias("parent_conv_id"))
    out = nodes.drop("n_leaves", "saved_tokens").join(sums, KEY).join(ended, KEY, "left").join(parents, [f"up_{k}" for k in KEY], "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def shared_openings(steps: DataFrame, group: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Give conversations the opening of another: (steps, convs) as ``prefix_trie`` takes them.

    Conversation c begins with the first h turns of conversation c - c % group (all if fewer,
    none if absent), h = crc32(c in decimal) % heads, and goes on with its own after its first h.
    """
    first = steps.filter((F.col("conv") % group == 0) & (F.col("pos") < heads))
    first = first.groupBy(F.col("conv").alias("donor")).agg(F.sort_array(F.collect_list(F.struct("pos", "item", "size"))).alias("first"))
    convs = durable(steps.select("conv").distinct())
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    given = convs.withColumns({"donor": F.col("conv") - F.col("conv") % group, "h": h}).join(first, "donor", "left")
    given = durable(given.withColumn("k", F.least("h", F.coalesce(F.size("first"), F.lit(0)).cast("long"))))
    opening = given.filter("k > 0").select("conv", F.explode(F.slice("first", 1, F.col("k").cast("int"))).alias("s"))
    opening = opening.select("conv", "s.pos", "s.item", "s.size")
    rest = steps.join(given.select("conv", "h", "k"), "conv").filter("pos > h")
    rest = rest.select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "item", "size")
    return opening.unionByName(rest), convs
