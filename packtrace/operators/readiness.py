"""Stage summary and rollout gates."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from packtrace.operators import drift, evaluate, risk


@dataclass(frozen=True)
class GateLimits:
    """Rollout thresholds; the programme sets its own, these are starting points."""

    flagged_share: float = 0.0
    duplicate_ratio: float = 0.01
    interval_width: float = 0.1
    min_r2: float = 0.5
    max_mae: float = 0.05
    min_coverage: float = 0.9
    drifted_features: float = 0.0


_STAGE = "stage string, status string, reason string, report string"


def failed(spark: SparkSession, name: str, error: BaseException) -> DataFrame:
    """The row of a stage that ended with an error: its kind and the first line of its message."""
    lines = str(error).splitlines() or [""]
    return spark.createDataFrame([(name, "fail", f"{type(error).__name__}: {lines[0]}", None)], _STAGE)


def stage(spark: SparkSession, name: str, report: DataFrame | None, reason: str | None = None) -> DataFrame:
    """One row (stage, status, reason, report as JSON); no report means the stage was skipped."""
    if report is None:
        return spark.createDataFrame([(name, "skipped", reason, None)], _STAGE)
    return report.select(
        F.lit(name).alias("stage"),
        F.lit("ok").alias("status"),
        F.lit(None).cast("string").alias("reason"),
        F.to_json(F.struct("*")).alias("report"),
    )


def summarise(stages: list[DataFrame]) -> DataFrame:
    """One row: overall status, every stage's status and every stage's report."""
    rows = reduce(DataFrame.unionByName, stages)
    return rows.agg(
        F.when(F.bool_and(F.col("status").isin("ok", "skipped")), "pass").otherwise("fail").alias("status"),
        F.sort_array(F.collect_list(F.struct("stage", "status", "reason", "report"))).alias("steps"),
    )


def _gate_rows(df: DataFrame, found: dict[str, tuple[Column, float, bool]]) -> DataFrame:
    """Aggregate ``df`` once; one row per gate (value, threshold, whether low is good)."""
    values = df.agg(*[value.cast("double").alias(name) for name, (value, _, _) in found.items()])
    rows = []
    for name, (_, threshold, at_most) in found.items():
        ok = F.col(name) <= threshold if at_most else F.col(name) >= threshold
        rows.append(
            F.struct(
                F.lit(name).alias("gate"),
                F.col(name).alias("value"),
                F.lit(float(threshold)).alias("threshold"),
                F.coalesce(ok, F.lit(False)).alias("passed"),
            )
        )
    return values.select(F.inline(F.array(*rows)))


def gates(
    tallied: DataFrame | None = None,
    predictions: DataFrame | None = None,
    shifts: DataFrame | None = None,
    risks: DataFrame | None = None,
    limits: GateLimits = GateLimits(),
) -> DataFrame:
    """One row per gate whose input was given: gate, value, threshold, passed."""
    out = []
    if tallied is not None:
        worst = F.max(F.col("duplicate_row") / F.col("rows"))
        found = {
            "integrity_flagged_share": (F.sum("flagged_rows") / F.sum("rows"), limits.flagged_share, True),
            "timestamps_in_order": (F.sum("timestamp_reorder"), 0.0, True),
            "duplicate_ratio": (worst, limits.duplicate_ratio, True),
        }
        out.append(_gate_rows(tallied, found))
    if predictions is not None:
        metrics, cover = evaluate.regression_columns(), evaluate.coverage_columns()
        found = {
            "interval_width": (cover["test_mean_interval_width_95"], limits.interval_width, True),
            "interval_coverage": (cover["test_pi_coverage_95"], limits.min_coverage, False),
            "r2": (metrics["r2"], limits.min_r2, False),
            "mae": (metrics["mae"], limits.max_mae, True),
        }
        out.append(_gate_rows(predictions, found))
    if shifts is not None:
        high = F.count_if(F.col("quantile_shift") > drift.HIGH_SHIFT)
        out.append(_gate_rows(shifts, {"drifted_features": (high, limits.drifted_features, True)}))
    if risks is not None:
        unowned = F.count_if(risk.unowned())
        out.append(_gate_rows(risks, {"unowned_high_risk": (unowned, 0.0, True)}))
    if not out:
        raise ValueError("no input for any gate")
    return reduce(DataFrame.unionByName, out)


def artifacts_complete(spark: SparkSession, made: dict[str, DataFrame | str | None]) -> DataFrame:
    """One row per expected training artifact: is it there, and does it hold rows?"""
    parts = []
    for name, item in made.items():
        if isinstance(item, DataFrame):
            parts.append(item.limit(1).agg((F.count(F.lit(1)) > 0).alias("present")).select(F.lit(name).alias("artifact"), "present"))
        else:
            parts.append(spark.createDataFrame([(name, bool(item))], "artifact string, present boolean"))
    return reduce(DataFrame.unionByName, parts)
