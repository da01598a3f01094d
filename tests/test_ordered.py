"""Chunked scans of hot keys give what plain windows give."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import same_rows
from packtrace.operators.ordered import Groups, _position, position
from packtrace.spec import Skew

ONE_TASK = Skew(rows_per_task=10**9)


def _rows(spark, seed: int, n: int = 300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "big" if rng.random() < 0.7 else rng.choice("abc")
        # few instants, so chunk borders fall inside ties; many values missing
        x = None if rng.random() < 0.4 else round(rng.uniform(-5, 5), 3)
        rows.append((key, rng.randrange(12 if seed % 2 else 1), i, x))
    return spark.createDataFrame(rows, "k string, t bigint, seq bigint, x double")


def _body(part, scans):
    scan, x = scans["o"], F.col("x")
    part = scan.total(part, n=F.count("x"))
    part = scan.look(part, previous={"p": x}, following={"f": x}, known_before={"kb": x}, known_until={"ku": x}, sums={"s": x})
    part = scan.look(part, sums={"again": F.coalesce("s", F.lit(1.0))}, previous={"ps": F.col("s")})
    return scan.quantile(part, q=(x, 0.3), m=(F.col("again"), 0.5))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("keys", [["k"], []])
def test_chunks_do_not_change_results(spark, seed, keys):
    df = _rows(spark, seed)
    order = {"o": ["t", "seq"]}
    plain = Groups.measure(df, keys, order, ONE_TASK)
    cut = Groups.measure(df, keys, order, Skew(rows_per_task=20, per_chunk=4))
    assert not plain.hot and cut.hot
    assert same_rows(plain.apply(df, _body), cut.apply(df, _body))


def test_borders_split_copies_of_one_instant(spark):
    df = spark.range(400).select(F.lit("a").alias("k"), F.lit(5).cast("bigint").alias("t"), F.col("id").alias("seq"))
    cut = Groups.measure(df, ["k"], {"o": ["t", "seq"]}, Skew(rows_per_task=20, per_chunk=4))

    def number(part, scans):
        chunk = scans["o"].chunk
        return part.withColumn("c", F.col(chunk) if chunk else F.lit(-1))

    sizes = cut.apply(df, number).groupBy("c").count().collect()
    assert len(sizes) > 5 and max(r["count"] for r in sizes) < 200


def test_small_groups_stay_whole(spark):
    df = _rows(spark, 1)
    assert Groups.measure(df, ["k"], {"o": ["seq"]}, Skew()).hot == []


def test_position_is_a_permutation(spark):
    df = _rows(spark, 3)
    got = position(df, [], ["t", "seq"], "at", Skew(rows_per_task=20, per_chunk=4)).orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(1, len(got) + 1))
    assert [(r["t"], r["seq"]) for r in got] == sorted((r["t"], r["seq"]) for r in got)


def test_position_search_matches_tuple_order():
    rng = np.random.default_rng(1)
    borders = sorted({(int(a), int(b)) for a, b in rng.integers(0, 6, (30, 2))})
    rows = rng.integers(-1, 7, (500, 2))
    got = _position([np.array(c) for c in zip(*borders)], [rows[:, 0], rows[:, 1]])
    want = [sum(b <= tuple(r) for b in borders) for r in rows.tolist()]
    assert got.tolist() == want
