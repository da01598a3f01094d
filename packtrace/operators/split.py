"""Reproducible train/test splits ranked by a hash of the sample or group id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_BITS, _TOP = 52, 16  # of a hash, and of the histogram that finds where a rank lies


def hash_rank(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(str(seed))))


def _place(key: str, seed: int) -> Column:
    """The first 52 bits of the hash as a number, which orders ids as the hash does."""
    return F.conv(F.substring(hash_rank(key, seed), 1, _BITS // 4), 16, 10).cast("bigint")


def _beside(rows: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """Every row next to the state of its group, a row at most."""
    named = state.withColumnsRenamed({c: f"_by_{c}" for c in by})
    match = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    return rows.join(named, match, "left").drop(*[f"_by_{c}" for c in by])


def _thresholds(rows: DataFrame, by: list[str], wanted: Column) -> DataFrame:
    """Per group the ``wanted``-th smallest ``_u``, as ``_last``; a group of which none is wanted has no row.

    One histogram over the first 16 bits, combined before it is shuffled, tells the part of the
    hashes that holds the rank; only that part, a 65,536th of the rows, is then ranked.
    """
    part = F.shiftright("_u", _BITS - _TOP)
    parts = rows.groupBy(*by, part.alias("_part")).agg(F.count(F.lit(1)).alias("k"))  # at most 65,536 per group
    group = Window.partitionBy(*by)
    parts = parts.withColumns({"n": F.sum("k").over(group), "_upto": F.sum("k").over(group.orderBy("_part"))})
    parts = parts.withColumn("_wanted", wanted.cast("bigint")).withColumn("_left", F.col("_wanted") - F.col("_upto") + F.col("k"))
    state = parts.filter("_left > 0 and _upto >= _wanted").select(*by, "_part", "_left")  # the first part that reaches it
    if by:
        held = _beside(rows.withColumn("_in", part), state.withColumnRenamed("_part", "_cut"), by).filter("_in = _cut")
    else:
        one = state.select(F.struct("_part", "_left").alias("s")).scalar()
        held = rows.filter(part == one["_part"]).withColumn("_left", one["_left"])
    held = held.groupBy(*by, "_left", "_u").agg(F.count(F.lit(1)).alias("k"))
    held = held.withColumn("_upto", F.sum("k").over(group.orderBy("_u"))).filter(F.col("_upto") >= F.col("_left"))
    return held.groupBy(*by).agg(F.min("_u").alias("_last"))


def _drawn(rows: DataFrame, limits: DataFrame, by: list[str]) -> DataFrame:
    out = _beside(rows, limits, by) if by else rows.withColumn("_last", limits.scalar())
    return out.withColumn("is_test", F.coalesce(F.col("_u") <= F.col("_last"), F.lit(False))).drop("_u", "_last")


def stratified(df: DataFrame, label: str, sample: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``: of every label, the rounded share with the smallest hashes; copies of an id stay together."""
    rows = df.withColumn("_u", _place(sample, seed))
    return _drawn(rows, _thresholds(rows.select(label, "_u"), [label], F.round(F.lit(test_size) * F.col("n"))), [label])


def by_group(df: DataFrame, sample: str, group: str | None = None, test_size: float = 0.25, seed: int = 42) -> DataFrame:
    """Add ``is_test`` so that no group has rows on both sides.

    With no group column, or a single group, rows are drawn one by one. Rows learn their side by
    comparing a hash with one threshold; no job starts here.
    """
    place = _place(sample, seed)
    if group:
        several = (F.min(group) != F.max(group)) | ((F.count(group) > 0) & (F.count(group) < F.count(F.lit(1))))
        place = F.when(F.coalesce(df.agg(several).scalar(), F.lit(False)), _place(group, seed)).otherwise(place)
    rows = df.withColumn("_u", place)
    return _drawn(rows, _thresholds(rows.select("_u").distinct(), [], F.ceil(F.lit(test_size) * F.col("n"))), [])
