"""Asset x threat risk register."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from packtrace.operators.ordered import position
from packtrace.sources.tables import THREAT_SCHEMA
from packtrace.spec import Skew

# Limits and wording that readers of the register expect.
HIGH_SCORE = 40
CONTROL_ROWS = 20
TOP_ROWS = 10
ACTION = "Define control + validation proof + due date"
STATUS = "open"
DUE = "TBD"
BANDS = (("high", 20), ("medium", 9), ("low", None))  # by least base score

_ORDER = ("_falling", "asset_pos", "threat_pos")
_COLUMNS = ("asset", "owner", "threat", "likelihood", "impact", "criticality", "risk_score", "recommended_owner", "status")


def register(assets: DataFrame, threats: Sequence[tuple]) -> DataFrame:
    """One row per asset and threat of the profile, scored.

    The profile is configuration of checked size, so each asset row is expanded in
    place: no join, no shuffle.
    """
    names = [part.split()[0] for part in THREAT_SCHEMA.split(", ")]
    profile = json.dumps([dict(zip(names, row)) for row in threats])
    listed = F.from_json(F.lit(profile), f"array<struct<{THREAT_SCHEMA.replace(' ', ':').replace(',:', ',')}>>")
    rows = assets.withColumn("t", F.explode(listed))
    base = F.col("t.impact") * F.col("t.likelihood")
    return rows.select(
        "asset_pos",
        F.col("t.pos").cast("bigint").alias("threat_pos"),
        "asset",
        "owner",
        F.col("t.threat").alias("threat"),
        F.col("t.likelihood").alias("likelihood"),
        F.col("t.impact").alias("impact"),
        "criticality",
        (base * F.greatest(F.lit(1), F.col("criticality") - 1)).alias("risk_score"),
        F.coalesce("t.owner_hint", "owner").alias("recommended_owner"),
        F.lit(STATUS).alias("status"),
        base.alias("base_score"),
        F.coalesce(*[F.when(base >= least, name) if least is not None else F.lit(name) for name, least in BANDS]).alias("priority_band"),
    )


def ranked(rows: DataFrame, skew: Skew = Skew()) -> DataFrame:
    """Add ``position``: highest score first, ties in listing order."""
    rows = rows.withColumn("_falling", -F.col("risk_score"))
    return position(rows, [], _ORDER, "position", skew).drop("_falling")


def _first(rows: DataFrame, n: int) -> DataFrame:
    """The n riskiest rows with their position, without ranking the others."""
    top = rows.withColumn("_falling", -F.col("risk_score")).orderBy(*_ORDER).limit(n)
    return top.withColumn("position", F.row_number().over(Window.orderBy(*_ORDER))).drop("_falling")


def controls_plan(rows: DataFrame, n: int = CONTROL_ROWS) -> DataFrame:
    return _first(rows, n).select(
        "position",
        "asset",
        "threat",
        F.col("recommended_owner").alias("owner"),
        F.lit(ACTION).alias("action"),
        F.lit(DUE).alias("due_by"),
    )


def summary(rows: DataFrame) -> DataFrame:
    """One row: row count, high-risk count, ten largest distinct scores, ten riskiest rows."""
    scores = rows.select("risk_score").distinct().orderBy(F.desc("risk_score")).limit(TOP_ROWS)
    scores = scores.agg(F.sort_array(F.collect_list("risk_score"), asc=False).alias("v"))
    top = _first(rows, TOP_ROWS)
    top = top.agg(F.sort_array(F.collect_list(F.struct("position", *_COLUMNS))).alias("v"))
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("risk_score") >= HIGH_SCORE).alias("high_risk_count")
    ).withColumns({"top_risk_scores": scores.scalar(), "top_ten": top.scalar()})


def unowned() -> Column:
    """Whether a register row is of high risk and nobody answers for it."""
    nobody = F.col("recommended_owner").isNull() | F.col("recommended_owner").isin("", "unassigned")
    return (F.col("risk_score") >= HIGH_SCORE) & nobody
