"""Per-cycle reduction of telemetry: fault features and State-of-Health features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from packtrace.functions.numeric import finite, pearson, ratio, seconds, share, slope
from packtrace.operators import segments
from packtrace.spec import FaultLimits, Skew, SohLimits

CYCLE = ("device", "cycle")

# Feature names and their order.
FAULT_FEATURES = (
    "cycle_number",
    "cc_phase_ratio",
    "soc_max",
    "pack_cell_voltage_ratio",
    "voltage_correlation",
    "initial_min_voltage",
    "voltage_gradient",
    "max_temp_diff",
    "max_temp_rate",
    "terminal_temp",
)
SOH_FEATURES = (
    "cycle_points",
    "time_span_sec",
    "time_unique_points",
    "capacity_ah",
    "energy_wh",
    "voltage_mean",
    "voltage_std",
    "voltage_range",
    "cc_ratio",
    "cv_ratio",
    "temp_range",
    "temp_max_abs_rate",
    "temp_mean_abs_rate",
    "soc_min",
    "soc_max",
    "soc_span",
    "dqdv_peak_abs",
    "dqdv_peak_q",
    "dqdv_mean_abs",
    "dqdv_spread_v",
    "dqdv_peak_to_mean_ratio",
    "resistance_proxy",
    "terminal_temp",
    "terminal_voltage",
    "terminal_soc",
    "terminal_ohmic_proxy",
)
SOH_LABELS = ("soh_proxy_from_input", "soh_proxy", "soh_trend_5")

SEGMENT_CYCLES = 100_000  # cycles of a device that one window holds



def _usable(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    keep = F.lit(True)
    for key in keys:
        keep = keep & F.col(key).isNotNull()
    return df.filter(keep)


def _last(column: str) -> Column:
    """Value in the last row of the cycle, NULL if that row has none."""
    return F.max_by(column, F.struct("t_us", "seq"))


def _spread(column: str) -> Column:
    return F.max(column) - F.min(column)


def fault_features(
    df: DataFrame,
    limits: FaultLimits = FaultLimits(),
    keys: Sequence[str] = CYCLE,
    skew: Skew = Skew(),
) -> DataFrame:
    """One row per cycle: the ten fault features and ``max_abs_temp_rate``. Long cycles are cut into segments.

    ``max_temp_rate`` is the mean absolute rate, which is what the name has always
    meant here; ``max_abs_temp_rate`` is the largest one.
    """
    rows = _usable(df, keys).select(
        *dict.fromkeys([*keys, "seq", "t_us", "voltage", "pack_voltage", "cell_voltage", "temperature", "soc", "cycle"])
    )
    cut = segments.measure(rows, skew, keys)
    around = ("t_us", "voltage", "temperature")
    if cut:
        rows = segments.numbered_after(rows, cut, around)
    else:
        line = Window.partitionBy(*keys).orderBy("t_us", "seq")
        before = {f"_b_{c}": F.lag(c).over(line) for c in around}
        rows = rows.withColumns({"_pos": F.row_number().over(line), "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys)), **before})
    dt = seconds(F.col("t_us") - F.col("_b_t_us"))
    rows = rows.withColumns(
        {
            "_slope": slope(F.col("voltage") - F.col("_b_voltage"), dt),
            "_rate": slope(F.col("temperature") - F.col("_b_temperature"), dt),
            "_early": F.col("_pos") <= F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(limits.initial_share))),
        }
    )
    slow = F.sum((F.col("_slope") <= limits.cc_slope).cast("int"))
    enough = (F.count(F.lit(1)) >= 3) & (F.count("_slope") > 0)
    return rows.groupBy(*keys).agg(
        F.max("cycle").cast("double").alias("cycle_number"),
        F.when(enough, slow / (F.count(F.lit(1)) - 1)).alias("cc_phase_ratio"),
        F.max("soc").alias("soc_max"),
        ratio(F.avg("pack_voltage"), F.avg("cell_voltage")).alias("pack_cell_voltage_ratio"),
        F.when(F.count(F.lit(1)) > 2, pearson(F.col("pack_voltage"), F.col("cell_voltage"))).alias("voltage_correlation"),
        F.min(F.when(F.col("_early"), F.col("voltage"))).alias("initial_min_voltage"),
        F.avg("_slope").alias("voltage_gradient"),
        _spread("temperature").alias("max_temp_diff"),
        F.avg("_rate").alias("max_temp_rate"),
        F.max("_rate").alias("max_abs_temp_rate"),
        _last("temperature").alias("terminal_temp"),
    )


def soh_features(
    df: DataFrame,
    limits: SohLimits = SohLimits(),
    keys: Sequence[str] = CYCLE,
    skew: Skew = Skew(),
) -> DataFrame:
    """One row per cycle: 26 State-of-Health features and the last capacity proxy.

    A cycle of fewer than two rows keeps only its keys and ``cycle_points``.
    """
    sensors = ["current", "voltage", "temperature", "soc", "capacity"]
    rows = _usable(df, keys).select(
        *keys, "seq", "t_us", *[finite(F.col(c)).alias(c) for c in sensors]
    )
    cut = segments.measure(rows, skew, keys)
    around = _soh_around_in_segments(rows, cut, limits) if cut else _soh_around(rows, keys, limits)
    return _soh_reduce(around, limits, keys)


def _complete() -> Column:
    return F.col("voltage").isNotNull() & F.col("current").isNotNull()


def _charge(before: str) -> Column:
    """Charge moved since the latest row with voltage and current."""
    return -0.5 * (F.col("current") + F.col(f"{before}.i")) * seconds(F.col("t_us") - F.col(f"{before}.t")) / 3600


def _ohm(before: Sequence[Column], limits: SohLimits) -> Column:
    """Change of voltage over a change of current that is large enough."""
    v, i = before
    return F.when(F.abs(F.col("current") - i) > limits.min_current_step, F.abs((F.col("voltage") - v) / (F.col("current") - i)))


def _soh_around(df: DataFrame, keys: Sequence[str], limits: SohLimits) -> DataFrame:
    """Each row beside the readings before it, its place among complete rows, the charge so far, and its cycle's quantiles."""
    line = Window.partitionBy(*keys).orderBy("t_us", "seq")
    before, upto = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({
        "_t": F.lag("t_us").over(line), "_v": F.lag("voltage").over(line), "_i": F.lag("current").over(line), "_temp": F.lag("temperature").over(line),
        "_pv": F.last(_reading_v(), ignorenulls=True).over(before), "_pc": F.last(_reading_c(), ignorenulls=True).over(before)})
    df = df.withColumn("_dq", F.when(_complete(), _charge("_pc")))
    group = Window.partitionBy(*keys)
    return df.withColumns({
        "_k": F.sum(_complete().cast("bigint")).over(upto), "_q": F.sum("_dq").over(upto),
        "_high": F.percentile("voltage", F.lit(limits.cv_quantile)).over(group),
        "_ohm_median": F.percentile(_ohm((F.col("_v"), F.col("_i")), limits), F.lit(0.5)).over(group)})


def _reading_v() -> Column:
    return F.when(F.col("voltage").isNotNull(), F.struct(F.col("t_us").alias("t"), F.col("voltage").alias("v")))


def _reading_c() -> Column:
    return F.when(_complete(), F.struct(F.col("t_us").alias("t"), F.col("voltage").alias("v"), F.col("current").alias("i")))


def _soh_around_in_segments(df: DataFrame, cut: segments.Cut, limits: SohLimits) -> DataFrame:
    """The same with windows that stay inside a segment. A small row per segment brings what crosses its border."""
    keys, at = cut.keys, F.struct("t_us", "seq")
    line = segments.by_key([*keys, segments.SEG], ["t_us", "seq"])
    before, upto = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(Window.unboundedPreceding, 0)
    around = {
        "_t": F.lag("t_us").over(line), "_v": F.lag("voltage").over(line), "_i": F.lag("current").over(line), "_temp": F.lag("temperature").over(line),
        "_pv": F.last(_reading_v(), ignorenulls=True).over(before), "_pc": F.last(_reading_c(), ignorenulls=True).over(before)}
    narrow = cut.by_time(df.select(*keys, "seq", "t_us", "voltage", "current", "temperature"))
    narrow = narrow.withColumns({"_pc": around["_pc"], "_rv": _reading_v(), "_rc": _reading_c()})
    small = narrow.groupBy(*keys, segments.SEG).agg(
        F.max_by(F.struct("t_us", "voltage", "current", "temperature"), at).alias("tail"),
        F.max_by("_rv", F.when(F.col("_rv").isNotNull(), at)).alias("pv"), F.max_by("_rc", F.when(F.col("_rc").isNotNull(), at)).alias("pc"),
        F.min_by("_rc", F.when(F.col("_rc").isNotNull(), at)).alias("fc"), F.count("_rc").alias("k"), F.sum(F.when(_complete(), _charge("_pc"))).alias("q"))
    order = segments.by_key(keys)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    small = small.withColumns({
        "_c_tail": F.lag("tail").over(order), "_c_pv": F.last("pv", ignorenulls=True).over(earlier),
        "_c_pc": F.last("pc", ignorenulls=True).over(earlier), "_c_k": F.coalesce(F.sum("k").over(earlier), F.lit(0))})
    across = -0.5 * (F.col("fc.i") + F.col("_c_pc.i")) * seconds(F.col("fc.t") - F.col("_c_pc.t")) / 3600
    moved = F.coalesce("q", F.lit(0.0)) + F.coalesce(across, F.lit(0.0))
    small = small.withColumn("moved", moved).withColumn("_c_q", F.coalesce(F.sum("moved").over(earlier), F.lit(0.0)))
    high = segments.ranked_quantile(df.select(*keys, F.col("voltage").alias("x")), keys, limits.cv_quantile, "_high")
    pairs = segments.numbered_after(df.select(*keys, "seq", "t_us", "voltage", "current"), cut, ("voltage", "current"))
    steps = pairs.select(*keys, _ohm((F.col("_b_voltage"), F.col("_b_current")), limits).alias("x"))
    median = segments.ranked_quantile(steps, keys, 0.5, "_ohm_median")
    small = small.select(*keys, segments.SEG, "_c_tail", "_c_pv", "_c_pc", "_c_k", "_c_q").join(high, keys, "left").join(median, keys, "left")
    df = cut.by_time(df).withColumns({"_pos": F.row_number().over(line), **around})
    df = segments.joined(df, small, keys)
    first = F.col("_pos") == 1
    tail = {"_t": "t_us", "_v": "voltage", "_i": "current", "_temp": "temperature"}
    df = df.withColumns({
        **{n: F.when(first, F.col("_c_tail")[c]).otherwise(F.col(n)) for n, c in tail.items()},
        "_pv": F.coalesce("_pv", "_c_pv"), "_pc": F.coalesce("_pc", "_c_pc")})
    df = df.withColumn("_dq", F.when(_complete(), _charge("_pc")))
    return df.withColumns({
        "_k": F.col("_c_k") + F.sum(_complete().cast("bigint")).over(upto), "_q": F.col("_c_q") + F.coalesce(F.sum("_dq").over(upto), F.lit(0.0))})


def _soh_reduce(df: DataFrame, limits: SohLimits, keys: Sequence[str]) -> DataFrame:
    t, v, i, temp = (F.col(c) for c in ("t_us", "voltage", "current", "temperature"))
    complete = _complete()
    dt = seconds(t - F.col("_t"))
    df = df.withColumns(
        {
            "_ah": 0.5 * (i + F.col("_i")) * dt / 3600,
            "_wh": 0.5 * (v * i + F.col("_v") * F.col("_i")) * dt / 3600,
            "_rate": F.when(dt != 0, F.abs(temp - F.col("_temp")) / dt),
            "_slope": F.when(v.isNotNull(), slope(v - F.col("_pv.v"), seconds(t - F.col("_pv.t")))),
            "_step": F.when(complete, seconds(t - F.col("_pc.t"))),
            "_dv": F.when(complete, v - F.col("_pc.v")),
            "_mid": F.when(complete, 0.5 * (v + F.col("_pc.v"))),
        }
    )
    # The first complete interval never enters the dQ/dV curve.
    used = complete & (F.col("_k") >= 3) & (F.abs("_dv") > limits.min_voltage_step)
    df = df.withColumn("_dqdv", F.when(used, F.abs(F.col("_dq") / F.col("_dv"))))
    df = df.withColumn("_q_mid", F.col("_q") - F.col("_dq") / 2)

    n = F.count(F.lit(1))
    curve = (F.count_if(complete) >= 4) & (F.max("_step") >= 1e-9)
    peak = F.max(F.when(F.col("_dqdv").isNotNull(), F.struct("_dqdv", (-F.col("_k")).alias("k"), F.col("_q_mid").alias("q"))))
    in_cv = F.col("_slope").isNotNull() & (F.col("_pv.v") >= F.col("_high"))
    on_curve = F.col("_dqdv").isNotNull()
    known_v = F.count("voltage") >= 3
    agg = {
        "time_span_sec": seconds(F.max("t_us") - F.min("t_us")),
        # rows come in time order, so a new instant is one that differs from the row before
        "time_unique_points": F.count_if(F.col("_t").isNull() | (t != F.col("_t"))),
        "capacity_ah": F.when(F.count("current") == n, -F.sum("_ah")),
        "energy_wh": F.when((F.count("current") == n) & (F.count("voltage") == n), F.sum("_wh")),
        "voltage_mean": F.avg("voltage"),
        "voltage_std": F.stddev_pop("voltage"),
        "voltage_range": _spread("voltage"),
        "cc_ratio": F.when(known_v, F.avg((F.col("_slope") <= limits.cc_slope).cast("double"))),
        "cv_ratio": F.when(known_v, F.avg(F.when(in_cv, (F.col("_slope") <= limits.cv_slope).cast("double")))),
        "temp_range": _spread("temperature"),
        "temp_max_abs_rate": F.when(n >= 3, F.max("_rate")),
        "temp_mean_abs_rate": F.when(n >= 3, F.avg("_rate")),
        "soc_min": F.min("soc"),
        "soc_max": F.max("soc"),
        "soc_span": _spread("soc"),
        "dqdv_peak_abs": F.when(curve, peak["_dqdv"]),
        "dqdv_peak_q": F.when(curve, peak["q"]),
        "dqdv_mean_abs": F.when(curve, F.avg("_dqdv")),
        "dqdv_spread_v": F.when(curve, F.max(F.when(on_curve, F.col("_mid"))) - F.min(F.when(on_curve, F.col("_mid")))),
        "dqdv_peak_to_mean_ratio": F.when(curve, ratio(peak["_dqdv"], F.avg("_dqdv"))),
        "resistance_proxy": F.when(n >= 3, F.max("_ohm_median")),
        "terminal_temp": _last("temperature"),
        "terminal_voltage": _last("voltage"),
        "terminal_soc": _last("soc"),
        "terminal_ohmic_proxy": F.max("temperature"),
    }
    proxy = F.max_by("capacity", F.when(F.col("capacity").isNotNull(), F.struct("t_us", "seq")))
    return df.groupBy(*keys).agg(
        n.alias("cycle_points"),
        *[F.when(n >= 2, c).alias(name) for name, c in agg.items()],
        proxy.alias("soh_proxy_from_input"),
    )


def soh_labels(features: DataFrame, keys: Sequence[str] = CYCLE, segment: int = SEGMENT_CYCLES) -> DataFrame:
    """Add ``soh_proxy`` (relative to the device's first cycle) and ``soh_trend_5``.

    The trend is the least-squares slope over five consecutive cycles; against positions 0..4 that
    slope is a fixed weighting of the five values. Windows hold ``segment`` cycles of a device; one
    small row per segment brings the device's first capacity and the four values before it. Starts
    no job; the features are read twice, so pass a written table if they are costly.
    """
    device = [k for k in keys if k != "cycle"]
    placed = features.withColumn("_seg", F.floor(F.col("cycle") / segment))
    proxy = F.col("soh_proxy_from_input")
    small = placed.groupBy(*device, "_seg").agg(
        F.min_by(proxy, F.when(proxy.isNotNull(), F.col("cycle"))).alias("_first"),
        F.slice(F.sort_array(F.collect_list(F.struct("cycle", proxy.alias("y"))), asc=False), 1, 4).alias("_last"))  # of one segment
    line = Window.partitionBy(*device).orderBy("_seg")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.flatten(F.reverse(F.collect_list("_last").over(line.rowsBetween(-4, -1))))  # newest first
    small = small.select(*device, "_seg", F.first("_first", ignorenulls=True).over(whole).alias("_base"), before["y"].alias("_before"))
    inside = Window.partitionBy(*device, "_seg").orderBy("cycle")
    rows = placed.withColumn("_at", F.row_number().over(inside))
    rows = rows.withColumns({f"_y{k}": F.lag(proxy, k).over(inside) for k in range(1, 5)})
    rows = rows.join(small, [*device, "_seg"], "left").withColumn("soh_proxy", ratio(proxy, F.col("_base")))
    y = {k: ratio(F.when(F.col("_at") > k, F.col(f"_y{k}")).otherwise(F.get("_before", k - F.col("_at"))), F.col("_base")) for k in range(1, 5)}
    trend = (2 * F.col("soh_proxy") + y[1] - y[3] - 2 * y[4]) / 10
    return rows.select(*features.columns, "soh_proxy", F.when(y[2].isNotNull(), trend).alias("soh_trend_5"))


def feature_stats(features: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """One row per column: how many rows there are and what share is missing."""
    names = [c for c in features.columns if c not in skip]
    rates = features.agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names]
    )
    return rates.unpivot(["rows"], names, "feature", "nan_rate")


def stats_report(features: DataFrame, keys: Sequence[str] = CYCLE) -> DataFrame:
    """One row: rows, columns, cycles, missing rate per column."""
    names = features.columns
    return features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.lit(1)).alias("cycles"),
        F.lit(max(1, len([c for c in names if c not in keys]))).alias("features"),
        F.array(*[F.lit(c) for c in names]).alias("columns"),
        F.struct(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names]).alias("nan_rates"),
    )


def cycles_with_enough_points(df: DataFrame, minimum: int = 5, keys: Sequence[str] = CYCLE) -> DataFrame:
    """Cycles whose derivative features can be trusted, with their row count."""
    return _usable(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("points")).filter(F.col("points") >= minimum)
