"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from packtrace.session import durable


def _lowest(links: DataFrame) -> DataFrame:
    """Per node the smallest of itself and its neighbours; written, so that hot nodes can be split when joined."""
    return durable(links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node; root is the smallest node of its component.

    ``links`` has long columns u and v. Large-star and small-star steps alternate until the links
    stand still: each node then points straight at its root. Every step is written to the
    shared folder, so a lost executor costs one step at most.
    """
    now = durable(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = durable(large.distinct())
        low = _lowest(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(low.select("u", F.col("low").alias("v")))
        now = durable(small.filter("u <> v").distinct())
        last, mark = mark, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if last == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
