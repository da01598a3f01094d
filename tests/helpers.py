from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from packtrace.spec import CANONICAL

SCHEMA = ", ".join(f"{c} {t}" for c, t in CANONICAL.items())


def telemetry(spark, rows: list[dict]) -> DataFrame:
    """Canonical telemetry from partial rows; seq defaults to the listing order."""
    full = []
    for i, row in enumerate(rows):
        given = {"seq": i, "device": "a", "cycle": 0, **row}
        if "t" in given:
            given["t_us"] = int(given.pop("t") * 1_000_000)
        full.append(tuple(given.get(c) for c in CANONICAL))
    return spark.createDataFrame(full, SCHEMA)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[(F.round(c, 9) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    b = b.select(*a.columns)
    a, b = rounded(a), rounded(b)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
