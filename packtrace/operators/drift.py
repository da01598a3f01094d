"""Distribution shift between a source and a target feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from packtrace.functions.numeric import finite, number
from packtrace.operators import quantiles

DECILES = tuple(k / 10 for k in range(1, 10))
MIN_VALUES = 5
HIGH_SHIFT = 0.05


def common_columns(source: DataFrame, target: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [c for c in source.columns if c in target.columns and c not in skip]


def align(target: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Target columns in training order; absent or unreadable values become 0.0."""
    cols = [
        F.coalesce(number(F.col(c)), F.lit(0.0)).alias(c) if c in target.columns else F.lit(0.0).alias(c)
        for c in features
    ]
    return target.select(*keep, *cols)


def _side(df: DataFrame, features: Sequence[str], side: str, approx: bool, accuracy: int) -> DataFrame:
    found = quantiles.by_column(df, [finite(number(F.col(c))) for c in features], DECILES, approx, accuracy)
    return found.withColumnsRenamed({c: f"{c}_{side}" for c in ("n", "mean", "std", "quantiles")})


def compare(
    source: DataFrame, target: DataFrame, features: Sequence[str] | None = None, approx: bool = False, accuracy: int = quantiles.ACCURACY
) -> DataFrame:
    """One row per shared feature; NULL shifts where a side has fewer than five values.

    ``quantile_shift_scaled`` divides by the source's spread, so features of
    different units can be compared. Both tables are read wide; ``approx`` reads them once.
    """
    features = list(features or common_columns(source, target))
    names = F.array(*[F.lit(c) for c in features])
    # one short row per feature and side
    wide = _side(source, features, "s", approx, accuracy).join(F.broadcast(_side(target, features, "t", approx, accuracy)), "place")
    wide = wide.withColumn("feature", names[F.col("place")])
    enough = (F.col("n_s") >= MIN_VALUES) & (F.col("n_t") >= MIN_VALUES)
    apart = F.array_max(F.zip_with("quantiles_s", "quantiles_t", lambda a, b: F.abs(a - b)))
    return wide.select(
        "feature",
        F.when(enough, F.abs(F.col("mean_t") - F.col("mean_s"))).alias("mean_shift"),
        F.when(enough, F.col("std_t") / (F.col("std_s") + F.lit(1e-9))).alias("std_shift_ratio"),
        F.when(enough, apart).alias("quantile_shift"),
        F.when(enough, F.try_divide(apart, F.col("std_s"))).alias("quantile_shift_scaled"),
    )


def summary(shifts: DataFrame) -> DataFrame:
    return shifts.agg(
        F.count(F.lit(1)).alias("num_features"),
        F.coalesce(F.max("quantile_shift"), F.lit(0.0)).alias("max_quantile_shift"),
        F.count_if(F.col("quantile_shift") > HIGH_SHIFT).alias("high_quantile_features"),
    )
