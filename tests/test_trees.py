"""Shapley values of tree ensembles against brute force and the fitted models."""

from __future__ import annotations

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from packtrace.operators import trees


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(240).select(
        F.col("id").alias("sample_id"),
        *[(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 100).alias(f"x{k}") for k in range(4)],
    )
    df = df.withColumn("y", F.col("x0") * 2 - F.col("x1") + F.when(F.col("x2") > 5, 4).otherwise(0))
    df = df.withColumn("label", (F.col("y") > 6).cast("double"))
    return VectorAssembler(inputCols=[f"x{k}" for k in range(4)], outputCol="features").transform(df).persist()


@pytest.fixture(scope="module")
def boosted(spark, table):
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(table)
    return model, trees.Forest.load(spark, model)


def _expected(forest, root, x, known):
    """Score of one tree when only the features in ``known`` are seen."""
    f = forest.feature[root]
    if f < 0:
        return forest.value[root]
    left, right = forest.left[root], forest.right[root]
    if f in known:
        return _expected(forest, left if x[f] <= forest.threshold[root] else right, x, known)
    total = forest.cover[root]
    return sum(forest.cover[c] / total * _expected(forest, c, x, known) for c in (left, right))


def _brute(forest, x):
    def score(known):
        return sum(forest.weight[r] * _expected(forest, r, x, known) for r in forest.roots)

    n = len(x)
    out = np.zeros(n)
    for j in range(n):
        rest = [i for i in range(n) if i != j]
        for size in range(n):
            weight = factorial(size) * factorial(n - 1 - size) / factorial(n)
            out[j] += weight * sum(score({*s, j}) - score(set(s)) for s in combinations(rest, size))
    return out


def test_matches_brute_force(table, boosted):
    _, forest = boosted
    x = np.array([r.features.toArray() for r in table.limit(8).collect()])
    got = trees.shapley(forest.leaves(), x)
    assert np.allclose(got, [_brute(forest, row) for row in x], atol=1e-12)


def test_attributions_and_base_add_up_to_the_margin(table, boosted):
    model, forest = boosted
    values = trees.attributions([forest], vector_to_array("features"), F.lit(0))
    rows = model.transform(table).select(values.alias("a"), vector_to_array("rawPrediction")[1].alias("m")).collect()
    base = trees.base_value(forest.leaves())
    assert max(abs(sum(r["a"]) + base - r["m"]) for r in rows) < 1e-9


def test_mean_of_single_trees_is_the_forest(spark, table):
    model = RandomForestRegressor(labelCol="y", numTrees=7, maxDepth=4, seed=3).fit(table)
    forest = trees.Forest.load(spark, model)
    scored = model.copy({model.leafCol: "leaf"}).transform(table)
    rows = scored.select("features", "prediction").collect()
    single = forest.per_tree(np.array([r.features.toArray() for r in rows]))
    assert np.allclose(single.mean(axis=1), [r.prediction for r in rows])
    spread = trees.with_tree_spread(scored, forest, vector_to_array("leaf"), "s")
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "leaf" in spread.columns
    assert np.allclose([r.s for r in spread.collect()], single.std(axis=1), atol=1e-9)
