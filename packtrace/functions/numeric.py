"""Column helpers for readings that may be missing, NaN or infinite."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def number(col: Column) -> Column:
    """Read as double; unreadable text and NaN become NULL."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def finite(col: Column) -> Column:
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is zero."""
    return F.try_divide(num, den)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over complete pairs; NULL (not an error) when a side is constant."""
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def share(condition: Column) -> Column:
    """Share of rows for which ``condition`` is true; NULL counts as false."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def seconds(micros: Column) -> Column:
    return micros / F.lit(1e6)


def slope(delta: Column, dt: Column) -> Column:
    """|delta| / dt where a pair at the same instant counts as flat."""
    return F.when(dt == 0, F.lit(0.0)).otherwise(F.abs(F.try_divide(delta, dt)))
