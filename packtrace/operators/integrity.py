"""Row-level integrity checks on canonical telemetry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from packtrace.operators import segments
from packtrace.sources.tables import require
from packtrace.spec import CANONICAL, IntegrityLimits, Skew

# Reasons, in the order they are listed on a flagged row.
REASONS = (
    "duplicate_row",
    "timestamp_reorder",
    "gap",
    "voltage_jump",
    "current_jump",
    "temp_jump",
    "flatline",
    "replay_pattern",
)

_PAYLOAD = ("current", "voltage", "pack_voltage", "cell_voltage", "temperature", "soc", "capacity")


def known_devices(df: DataFrame) -> DataFrame:
    """Rows without a device cannot be ordered against anything; reports count them apart."""
    return df.filter(F.col("device").isNotNull())


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _signature(df: DataFrame, replay_on: str, columns: Sequence[str] | None) -> tuple[list[str], Column]:
    """Grouping columns and text under which rows count as copies of each other."""
    if replay_on not in ("row", "payload"):
        raise ValueError("replay_on must be 'row' or 'payload'")
    if columns is None:
        columns = [c for c in df.columns if c != "seq"]
        if replay_on == "payload":
            columns = [c for c in _PAYLOAD if c in df.columns]
    keys = ["device", "t_us"] if "t_us" in columns else ["device"]
    return keys, F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def _fingerprint(text: Column) -> dict[str, Column]:
    """128 bits that stand for a row's text wherever it is shuffled or sorted."""
    return {"_fp1": F.xxhash64(text), "_fp2": F.xxhash64(F.lit(1), text)}


def _replayed(df: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """Mark rows of which more than two are equal among the rows of ``keys``.

    Equal fingerprints are verified by content inside their window; the text itself is never a key.
    """
    copies = Window.partitionBy(*keys, "_fp1", "_fp2")
    same = (F.count(F.lit(1)).over(copies) > 2) & (F.min(text).over(copies) == F.max(text).over(copies))
    return df.withColumns(_fingerprint(text)).withColumn("replay_pattern", _true(same)).drop("_fp1", "_fp2")


def _replayed_anywhere(df: DataFrame, base: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """The same for copies that no segment holds together: counted before they are shuffled, then joined back."""
    prints = [*keys, "_fp1", "_fp2"]
    often = base.withColumns(_fingerprint(text)).groupBy(*prints).agg(
        F.count(F.lit(1)).alias("_n"), F.min(text).alias("_low"), F.max(text).alias("_high"))
    often = often.filter("_n > 2 and _low = _high").select(*prints, F.lit(True).alias("replay_pattern"))
    marked = df.withColumns(_fingerprint(text)).join(often, prints, "left")
    return marked.withColumn("replay_pattern", _true(F.col("replay_pattern"))).drop("_fp1", "_fp2")


def checks(
    df: DataFrame,
    limits: IntegrityLimits = IntegrityLimits(),
    signature: Sequence[str] | None = None,
    replay_on: str = "row",
    skew: Skew = Skew(),
    only: Sequence[str] = REASONS,
) -> DataFrame:
    """The input rows plus one boolean column per reason in ``only``.

    Where every device fits a task, all windows lead with the device and cost a single shuffle.
    Longer devices are cut into segments, see ``segments``.
    """
    require(df, ["device", "seq", "t_us", "voltage", "current", "temperature"])
    only = set(only)
    base, names = known_devices(df), df.columns
    copy_keys, text = _signature(df, replay_on, signature)
    timed = bool(only - {"timestamp_reorder", "replay_pattern"})
    cut = segments.measure(base, skew)
    rows = base
    if "timestamp_reorder" in only:
        if cut:
            rows = segments.previous_arrival(rows, cut, "t_us", "_arrived")
        else:
            rows = rows.withColumn("_arrived", F.lag("t_us").over(Window.partitionBy("device").orderBy("seq")))
        rows = rows.withColumn("timestamp_reorder", _true(F.col("t_us") < F.col("_arrived")))
    if timed:
        rows = _around_in_segments(rows, base, cut, only) if cut else _around(rows, limits, only)
        rows = _timeline_checks(rows, limits, only)
    if "replay_pattern" in only:
        if cut and (cut.crowded is not None or "t_us" not in copy_keys):
            rows = _replayed_anywhere(rows, base, copy_keys, text)
        elif cut:
            rows = rows if timed else cut.by_time(rows)
            rows = _replayed(rows, [*copy_keys, segments.SEG], text)
        else:
            rows = _replayed(rows, copy_keys, text)
    return rows.select(*names, *[r for r in REASONS if r in only])


def _around(df: DataFrame, limits: IntegrityLimits, only: set[str]) -> DataFrame:
    """Each row beside the reading before it, the instant after it, its run and the median step."""
    line = Window.partitionBy("device").orderBy("t_us", "seq")
    before = {f"_b_{c}": F.lag(c).over(line) for c in ("t_us", "voltage", "current", "temperature")}
    df = df.withColumns({**before, "_next": F.lead("t_us").over(line), "_pos": F.row_number().over(line)})
    if "gap" in only:
        step = F.col("t_us") - F.col("_b_t_us")
        median = F.percentile(F.when(step != 0, F.abs(step)), F.lit(0.5)).over(Window.partitionBy("device"))
        df = df.withColumn("_median", median)
    if "flatline" in only:
        moved = F.max(F.when(~segments.same_reading("", "_b_"), F.col("_pos")))
        df = df.withColumn("_run", F.col("_pos") - moved.over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return df


def _around_in_segments(df: DataFrame, base: DataFrame, cut: segments.Cut, only: set[str]) -> DataFrame:
    """The same with windows that stay inside a segment; its small row brings what crosses the border."""
    carried = segments.carried(segments.summaries(base, cut), "gap" in only)
    line = Window.partitionBy("device", segments.SEG).orderBy("t_us", "seq")
    columns = ("t_us", "voltage", "current", "temperature")
    df = cut.by_time(df).withColumns({
        "_pos": F.row_number().over(line), **{f"_b_{c}": F.lag(c).over(line) for c in columns}, "_next": F.lead("t_us").over(line)})
    df = segments.joined(df, carried)
    first = F.col("_pos") == 1
    df = df.withColumns({f"_b_{c}": F.when(first, F.col(f"_c_{c}")).otherwise(F.col(f"_b_{c}")) for c in columns})
    df = df.withColumn("_next", F.coalesce("_next", "_c_next"))
    if "flatline" in only:
        moved = F.max(F.when(~segments.same_reading("", "_b_"), F.col("_pos"))).over(line.rowsBetween(Window.unboundedPreceding, 0))
        df = df.withColumn("_run", F.col("_pos") - F.coalesce(moved, -F.col("_c_run")))
    return df


def _timeline_checks(df: DataFrame, limits: IntegrityLimits, only: set[str]) -> DataFrame:
    out = {}
    if "duplicate_row" in only:
        # rows come in time order, so copies of an instant are neighbours
        out["duplicate_row"] = _true(F.col("t_us") == F.col("_b_t_us")) | _true(F.col("t_us") == F.col("_next"))
    if "gap" in only:
        out["gap"] = _true(F.col("t_us") - F.col("_b_t_us") > limits.gap_multiplier * F.col("_median"))
    for reason, column, limit in (
        ("voltage_jump", "voltage", limits.voltage_jump),
        ("current_jump", "current", limits.current_jump),
        ("temp_jump", "temperature", limits.temp_jump),
    ):
        if reason in only:
            out[reason] = _true(F.abs(F.col(column) - F.col(f"_b_{column}")) > limit)
    if "flatline" in only:
        out["flatline"] = segments.same_reading("", "_b_") & (F.col("_run") >= limits.flatline_window)
    return df.withColumns(out)


def flagged(checked: DataFrame) -> DataFrame:
    """Only rows with a reason, with ``flagged``, ``reasons`` (array) and ``asset_id``."""
    listed = F.array(*[F.when(F.col(r), F.lit(r)) for r in REASONS if r in checked.columns])
    out = checked.withColumn("reasons", F.filter(listed, lambda r: r.isNotNull()))
    out = out.filter(F.size("reasons") > 0).drop(*REASONS)
    return out.withColumns({"flagged": F.lit(True), "asset_id": F.col("device")})


def flag(df: DataFrame, limits: IntegrityLimits = IntegrityLimits(), **options) -> DataFrame:
    return flagged(checks(df, limits, **options))


def any_reason(checked: DataFrame) -> Column:
    out = F.lit(False)
    for reason in REASONS:
        if reason in checked.columns:
            out = out | F.col(reason)
    return out


def tally(checked: DataFrame) -> DataFrame:
    """One row per device: rows, flagged rows and rows per reason.

    Every report and gate below reads this small table, so the checks run once.
    """
    present = [r for r in REASONS if r in checked.columns]
    return checked.groupBy("device").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(any_reason(checked)).alias("flagged_rows"),
        *[F.count_if(r).alias(r) for r in present],
    )


def _sum(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).alias(column)


def severity(tallied: DataFrame) -> DataFrame:
    """One row per reason, also for reasons that never fired."""
    present = [r for r in REASONS if r in tallied.columns]
    return tallied.agg(*[_sum(r) for r in present]).unpivot([], present, "reason", "rows")


def report(
    tallied: DataFrame, limits: IntegrityLimits = IntegrityLimits(), source: DataFrame | None = None, observed: dict | None = None
) -> DataFrame:
    """One row: totals, severity struct and parameters.

    ``source`` is the canonical table before rows without a device were set aside;
    given, the total covers it as well. ``observed`` holds the counts that ``tables.normalise`` took
    in passing; it replaces the second read and adds the rows read and those without a time.
    """
    present = [r for r in REASONS if r in tallied.columns]
    parameters = F.struct(
        F.lit(limits.voltage_jump).alias("voltage_jump_threshold"),
        F.lit(limits.current_jump).alias("current_jump_threshold"),
        F.lit(limits.temp_jump).alias("temp_jump_threshold"),
        F.lit(limits.flatline_window).alias("flatline_window"),
        F.lit(limits.gap_multiplier).alias("gap_multiplier"),
    )
    out = tallied.agg(
        _sum("rows").alias("rows_total"), _sum("flagged_rows"), F.struct(*[_sum(r) for r in present]).alias("severity")
    ).withColumn("parameters", parameters)
    unknown = F.lit(0 if observed is None else observed["rows_null_device"]).cast("bigint")
    if observed is not None:
        out = out.withColumns({c: F.lit(observed[c]).cast("bigint") for c in ("rows_read", "rows_without_time")})
    elif source is not None:
        unknown = source.agg(F.count_if(F.col("device").isNull()).alias("n")).scalar()
    out = out.withColumn("rows_null_device", unknown)
    return out.withColumn("rows_total", F.col("rows_total") + F.col("rows_null_device"))


def duplicate_ratio(tallied: DataFrame) -> DataFrame:
    """Share of duplicate packets per device."""
    return tallied.select("device", "rows", (F.col("duplicate_row") / F.col("rows")).alias("duplicate_ratio"))
