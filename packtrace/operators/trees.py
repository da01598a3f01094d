"""Fitted tree ensembles as tables, and per-row work that needs the single trees.

A saved MLlib ensemble holds one row per tree node. The node table is bounded by
trees x 2^(depth+1) whatever the size of the data, so it travels to the tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from packtrace.session import scratch

MAX_NODES = 5_000_000


def node_table(spark: SparkSession, model) -> DataFrame:
    """One row per node: tree, node, children, split, value, rows seen, tree weight."""
    path = scratch(spark, "model")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    return nodes.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.col("split.featureIndex").alias("feature"),
        F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
        F.col("prediction").alias("value"),
        F.col("rawCount").alias("cover"),
        F.get(weights, F.col("treeID")).alias("weight"),
    )


@dataclass(frozen=True)
class Leaf:
    """A leaf as a product game: it pays ``value`` when every feature lies in its interval.

    ``seen[j]`` is the share of training rows that pass the splits on feature j, which
    stands in for a feature that is left out.
    """

    value: float
    features: tuple[int, ...]
    low: np.ndarray
    high: np.ndarray
    seen: np.ndarray


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees, concatenated; ``feature`` is -1 at leaves."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    weight: np.ndarray

    @classmethod
    def load(cls, spark: SparkSession, model) -> Forest:
        if model.totalNumNodes > MAX_NODES:
            raise ValueError(f"model has more than {MAX_NODES} nodes")
        nodes = node_table(spark, model).toPandas().sort_values(["tree", "node"], ignore_index=True)
        start = nodes.groupby("tree")["node"].size().cumsum().shift(fill_value=0)
        base = nodes["tree"].map(start).to_numpy()
        return cls(
            roots=start.to_numpy(),
            feature=nodes["feature"].to_numpy(),
            threshold=nodes["threshold"].fillna(0.0).to_numpy(),
            left=np.where(nodes["left"] < 0, -1, nodes["left"] + base),
            right=np.where(nodes["right"] < 0, -1, nodes["right"] + base),
            value=nodes["value"].to_numpy(),
            cover=nodes["cover"].to_numpy(dtype=float),
            weight=nodes["weight"].to_numpy(),
        )

    def per_tree(self, x: np.ndarray) -> np.ndarray:
        """Prediction of every tree for every row."""
        out = np.empty((len(x), len(self.roots)))
        rows = np.arange(len(x))
        for k, root in enumerate(self.roots):
            at = np.full(len(x), root)
            inner = self.feature[at] >= 0
            while inner.any():
                go_left = x[rows, np.maximum(self.feature[at], 0)] <= self.threshold[at]
                at = np.where(inner, np.where(go_left, self.left[at], self.right[at]), at)
                inner = self.feature[at] >= 0
            out[:, k] = self.value[at]
        return out

    def leaf_values(self) -> list[list[float]]:
        """Per tree the values of its leaves, in the order in which they are numbered."""
        ends = [*self.roots[1:].tolist(), len(self.feature)]
        return [self.value[a:b][self.feature[a:b] < 0].tolist() for a, b in zip(self.roots.tolist(), ends, strict=True)]

    def leaves(self) -> list[Leaf]:
        found = []
        for root in self.roots:
            todo = [(root, {})]
            while todo:
                node, path = todo.pop()
                f = int(self.feature[node])
                if f < 0:
                    sides = [path[j] for j in path]
                    low, high, seen = (np.array(c) for c in zip(*sides)) if sides else (np.empty(0),) * 3
                    found.append(Leaf(float(self.value[node] * self.weight[node]), tuple(path), low, high, seen))
                    continue
                low, high, seen = path.get(f, (-np.inf, np.inf, 1.0))
                cut = self.threshold[node]
                for child, lo, hi in ((self.left[node], low, min(high, cut)), (self.right[node], max(low, cut), high)):
                    passed = seen * self.cover[child] / self.cover[node]
                    todo.append((child, {**path, f: (lo, hi, passed)}))
        return found


def base_value(leaves: list[Leaf]) -> float:
    """Score expected before any feature is known."""
    return float(sum(leaf.value * np.prod(leaf.seen) for leaf in leaves))


def shapley(leaves: list[Leaf], x: np.ndarray) -> np.ndarray:
    """Shapley value of each feature in the sum of the leaves' product games."""
    out = np.zeros(x.shape)
    for leaf in leaves:
        d = len(leaf.features)
        if not d:
            continue
        cols = x[:, leaf.features]
        holds = ((cols > leaf.low) & (cols <= leaf.high)).astype(float)
        chance = [math.factorial(s) * math.factorial(d - 1 - s) / math.factorial(d) for s in range(d)]
        for j, f in enumerate(leaf.features):
            # by_size[s]: worth of all coalitions of s other features, summed
            by_size = [np.ones(len(x))]
            for i in range(d):
                if i == j:
                    continue
                kept = [c * leaf.seen[i] for c in by_size] + [np.zeros(len(x))]
                joined = [np.zeros(len(x))] + [c * holds[:, i] for c in by_size]
                by_size = [a + b for a, b in zip(kept, joined)]
            share = sum(p * c for p, c in zip(chance, by_size))
            out[:, f] += leaf.value * (holds[:, j] - leaf.seen[j]) * share
    return out


def _matrix(features: pd.Series) -> np.ndarray:
    return np.stack(features.to_numpy()) if len(features) else np.empty((0, 0))


def with_tree_spread(df: DataFrame, forest: Forest, leaf: Column, name: str = "tree_std") -> DataFrame:
    """Add the population standard deviation over the trees' predictions; ``leaf`` holds the leaf reached in each tree.

    The leaves' values, bounded by MAX_NODES, are one row that a scalar subquery hands to every task.
    """
    values = df.sparkSession.createDataFrame([(forest.leaf_values(),)], "v array<array<double>>").scalar()
    n, zero = float(len(forest.roots)), F.lit(0.0)
    df = df.withColumns({"_values": values, "_reached": leaf})
    df = df.withColumn("_reached", F.zip_with("_values", "_reached", lambda v, at: F.get(v, at.cast("int"))))
    df = df.withColumn("_mean", F.aggregate("_reached", zero, lambda a, x: a + x) / n)
    square = F.aggregate("_reached", zero, lambda a, x: a + (x - F.col("_mean")) * (x - F.col("_mean")))
    return df.withColumn(name, F.sqrt(square / n)).drop("_values", "_reached", "_mean")


def attributions(forests: list[Forest], features: Column, which: Column) -> Column:
    """Array of Shapley values per row, taken from the ensemble numbered ``which``."""
    games = [forest.leaves() for forest in forests]

    @F.pandas_udf("array<double>")
    def explain(values: pd.Series, number: pd.Series) -> pd.Series:
        out = [None] * len(values)
        for k, rows in number.groupby(number).indices.items():
            found = shapley(games[int(k)], _matrix(values.iloc[rows]))
            for at, row in zip(rows, found):
                out[at] = row
        return pd.Series(out)

    return explain(features, which)
