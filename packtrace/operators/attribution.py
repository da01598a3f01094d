"""Ranking and summarising per-sample feature attributions (long tables)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TOP_K = 8

# Which mechanism domain each fault feature belongs to.
DOMAINS = {
    "usage": ("cycle_number", "cc_phase_ratio", "soc_max"),
    "voltage": ("pack_cell_voltage_ratio", "voltage_correlation", "initial_min_voltage", "voltage_gradient"),
    "thermal": ("max_temp_diff", "max_temp_rate", "terminal_temp"),
}


def linear(df: DataFrame, sample: str, weights: dict[str, float], keep: tuple[str, ...] = ()) -> DataFrame:
    """Exact Shapley values of a linear score: weight x (value - mean).

    ``score`` is their sum per sample, the score's distance from its mean.
    """
    names = list(weights)
    rows = df.select(sample, *keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names])
    means = rows.agg(F.struct(*[F.avg(c).alias(c) for c in names]).alias("m")).scalar()
    rows = rows.withColumn("_m", means)
    parts = [(F.lit(float(w)) * (F.col(c) - F.col("_m")[c])).alias(c) for c, w in weights.items()]
    rows = rows.select(F.col(sample).alias("sample_id"), *keep, *parts)
    rows = rows.withColumn("score", sum((F.col(c) for c in names), F.lit(0.0)))
    return rows.unpivot(["sample_id", *keep, "score"], names, "feature", "shap_value")


def toward_predicted(rows: DataFrame, positive: str) -> DataFrame:
    """Turn two-class attributions, signed toward ``positive``, toward what was predicted."""
    sign = F.when(F.col("predicted_label") == positive, 1.0).otherwise(-1.0)
    return rows.withColumn("shap_value", F.col("shap_value") * sign)


def global_importance(rows: DataFrame) -> DataFrame:
    mean = F.avg(F.abs("shap_value")).alias("mean_abs_shap")
    return rows.groupBy("feature").agg(mean).orderBy(F.desc("mean_abs_shap"), "feature")


def top(rows: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k strongest features of each sample, ranked from 1."""
    strongest = Window.partitionBy("sample_id").orderBy(F.desc("abs_shap"), "feature")
    ranked = rows.withColumn("abs_shap", F.abs("shap_value"))
    return ranked.withColumn("rank", F.row_number().over(strongest)).filter(F.col("rank") <= k)


def _domain(feature: str) -> Column:
    out = F.lit(None).cast("string")
    for name, members in DOMAINS.items():
        out = F.when(F.col(feature).isin(*members), name).otherwise(out)
    return out


def domain_coverage(top_rows: DataFrame, minimum: int = 10) -> DataFrame:
    """Per domain: how many samples list one of its features, and whether that is enough."""
    named = top_rows.withColumn("domain", _domain("feature"))
    # one flag per sample and domain first, so counting needs no distinct set
    per_sample = named.groupBy("sample_id").agg(
        *[F.max((F.col("domain") == d).cast("int")).alias(d) for d in DOMAINS]
    )
    counts = per_sample.agg(*[F.coalesce(F.sum(d), F.lit(0)).cast("bigint").alias(d) for d in DOMAINS])
    rows = counts.unpivot([], list(DOMAINS), "domain", "samples")
    return rows.withColumn("covered", F.col("samples") >= minimum)
