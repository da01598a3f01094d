"""Registered queries over the supplied tables, each with its check in plain SQL.

A query is a function (spark, sf_dir) -> DataFrame. Computed doubles are rounded to
six places on both sides; the operators themselves never round.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from packtrace.operators import (
    attribution,
    cycles,
    drift,
    evaluate,
    integrity,
    models,
    prompts,
    readiness,
    risk,
    split,
    trees,
)
from packtrace.plans import views, workflow
from packtrace.session import durable, scratch
from packtrace.sources import sinks, store, tables
from packtrace.spec import ColumnSpec, FaultLimits, IntegrityLimits, Skew, SohLimits
from packtrace.streaming import live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Thresholds suited to the coarse fixture values.
LIMITS = IntegrityLimits(current_jump=0.5, flatline_window=3)
FAULT = FaultLimits(cc_slope=1e-4)
SOH = SohLimits(cc_slope=1e-4, cv_slope=1e-4)
# Small enough that the fixture's devices and cycles count as too large for a task.
TIGHT = Skew(rows_per_task=400, per_chunk=8)
# two days of a device, or 5,000 arrivals, per segment
SEGMENTS = Skew(segment_us=172_800_000_000, segment_seq=5_000)
TIGHT_CYCLE = Skew(rows_per_task=20, per_chunk=4)


def _round(df: DataFrame) -> DataFrame:
    return df.select(*[(F.round(c, 6) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register a query; ``doubles`` names the SQL columns to round."""

    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: _round(fn(spark, sf_dir))
        if sql is not None:
            fixed = ", ".join(f"round({c}, 6) + 0.0 as {c}" for c in doubles.split())
            ORACLES[name] = f"select * replace ({fixed}) from ({sql}) o" if fixed else sql
        return fn

    return add


def _lines(spark, path: str) -> DataFrame:
    """Lines of written text files, numbered from 1 over all files in name order."""
    files = spark.read.text(path, wholetext=True).filter("value <> ''")
    files = files.select(F.input_file_name().alias("file"), F.split(F.regexp_replace("value", r"\n\z", ""), "\n").alias("lines"))
    # a row per file, not per line
    earlier = F.coalesce(F.sum(F.size("lines")).over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = files.withColumn("earlier", earlier).select("earlier", F.posexplode("lines").alias("at", "line"))
    return lines.select((F.col("earlier") + F.col("at") + 1).cast("bigint").alias("line_no"), "line")


def _dense(spark, sf):
    return views.view(spark, sf, "telemetry_dense")


def _cycles(spark, sf):
    return views.view(spark, sf, "telemetry_cycles")


# --- integrity ---------------------------------------------------------------------

_CHECKED = """
with t as ({view}),
a as (select *, lag(t_us) over arrive as arrived from t window arrive as (partition by device order by seq)),
b as (select *, lag(t_us) over w as pt, lag(voltage) over w as pv, lag(current) over w as pi,
             lag(temperature) over w as ptemp, row_number() over w as pos,
             count(*) over (partition by device, t_us) as copies,
             count(*) over (partition by device, t_us, {sig}) as replays
      from a window w as (partition by device order by t_us, seq)),
m as (select device, quantile_cont(cast(abs(t_us - pt) as double), 0.5) as med from b where t_us <> pt group by device),
c as (select b.*, med, coalesce(voltage = pv and current = pi, false) as flat from b left join m using (device)),
d as (select *, sum(case when flat then 0 else 1 end) over (partition by device order by t_us, seq) as island from c),
e as (select *, sum(case when flat then 1 else 0 end) over (partition by device, island order by t_us, seq) as run from d),
checked as (
  select seq, device, t_us, voltage, current, temperature, copies > 1 as duplicate_row,
         coalesce(t_us < arrived, false) as timestamp_reorder,
         coalesce(t_us - pt > 3 * med, false) as gap,
         coalesce(abs(voltage - pv) > 3.0, false) as voltage_jump,
         coalesce(abs(current - pi) > 0.5, false) as current_jump,
         coalesce(abs(temperature - ptemp) > 8.0, false) as temp_jump,
         flat and run >= 3 as flatline, replays > 2 as replay_pattern
  from e)
"""
_SIGNATURE = (
    "concat_ws('|', device, cast(t_us as varchar), cast(current as varchar), cast(voltage as varchar), "
    "cast(temperature as varchar))"
)
_DENSE_CHECKED = _CHECKED.format(view=views.duckdb("telemetry_dense"), sig=_SIGNATURE)
_UNORDERED_CHECKED = _CHECKED.format(view=views.duckdb("telemetry_unordered"), sig=_SIGNATURE)


def _one_check(reason: str):
    view = "telemetry_unordered" if reason == "timestamp_reorder" else "telemetry_dense"
    base = _UNORDERED_CHECKED if view == "telemetry_unordered" else _DENSE_CHECKED

    @query(f"integrity_{reason}", f"{base} select seq, device, t_us from checked where {reason}")
    def one(spark, sf):
        rows = integrity.checks(views.view(spark, sf, view), LIMITS, only=[reason])
        return rows.filter(reason).select("seq", "device", "t_us")


for _reason in integrity.REASONS:
    _one_check(_reason)


@query(
    "integrity_payload_replay",
    f"""with t as ({views.duckdb('telemetry_dense')})
    select seq, device, t_us from (
      select *, count(*) over (partition by device, concat_ws('|', cast(current as varchar),
             cast(voltage as varchar), cast(temperature as varchar))) as n from t) x where n > 2""",
)
def _(spark, sf):
    rows = integrity.checks(_dense(spark, sf), LIMITS, replay_on="payload", only=["replay_pattern"])
    return rows.filter("replay_pattern").select("seq", "device", "t_us")


_REASON_TEXT = "concat_ws(',', " + ", ".join(f"case when {r} then '{r}' end" for r in integrity.REASONS) + ")"
_ANY = " or ".join(integrity.REASONS)
_FLAGGED = f"""select seq, device, t_us, voltage, current, temperature, true as flagged, {_REASON_TEXT} as reasons,
               device as asset_id from checked where {_ANY}"""


_SENSORS = "voltage current temperature"


def _flag_rows(df: DataFrame) -> DataFrame:
    cols = ["seq", "device", "t_us", "voltage", "current", "temperature", "flagged"]
    return df.select(*cols, F.array_join("reasons", ",").alias("reasons"), "asset_id")


@query("integrity_flags", f"{_DENSE_CHECKED} {_FLAGGED}", _SENSORS)
def _(spark, sf):
    return _flag_rows(integrity.flag(_dense(spark, sf), LIMITS))


@query("integrity_flags_unordered", f"{_UNORDERED_CHECKED} {_FLAGGED}", _SENSORS)
def _(spark, sf):
    return _flag_rows(integrity.flag(views.view(spark, sf, "telemetry_unordered"), LIMITS))


@query("integrity_flags_hot_devices", f"{_DENSE_CHECKED} {_FLAGGED}", _SENSORS)
def _(spark, sf):
    return _flag_rows(integrity.flag(_dense(spark, sf), LIMITS, skew=SEGMENTS))


@query("integrity_flags_sampled_segments", f"{_DENSE_CHECKED} {_FLAGGED}", _SENSORS)
def _(spark, sf):
    return _flag_rows(integrity.flag(_dense(spark, sf), LIMITS, skew=TIGHT))


@query("integrity_flags_unordered_segments", f"{_UNORDERED_CHECKED} {_FLAGGED}", _SENSORS)
def _(spark, sf):
    skew = Skew(segment_us=SEGMENTS.segment_us, segment_seq=20_000_000_000)
    return _flag_rows(integrity.flag(views.view(spark, sf, "telemetry_unordered"), LIMITS, skew=skew))


def _tally(spark, sf):
    return integrity.tally(integrity.checks(_dense(spark, sf), LIMITS))


_SEVERITY = " union all ".join(
    f"select '{r}' as reason, count(*) filter (where {r}) as rows from checked" for r in integrity.REASONS
)


@query("integrity_severity", f"{_DENSE_CHECKED} {_SEVERITY}")
def _(spark, sf):
    return integrity.severity(_tally(spark, sf))


_PARAMETERS = """3.0::double as voltage_jump_threshold, 0.5::double as current_jump_threshold, 8.0::double as temp_jump_threshold,
    3 as flatline_window, 3.0::double as gap_multiplier"""
_REPORT_SQL = f"""{_DENSE_CHECKED} select count(*) as rows_total, count(*) filter (where {_ANY}) as flagged_rows,
    {', '.join(f'count(*) filter (where {r}) as {r}' for r in integrity.REASONS)}, {_PARAMETERS},
    cast(0 as bigint) as rows_null_device from checked"""


def _whole_report(report: DataFrame) -> DataFrame:
    return report.select("rows_total", "flagged_rows", "severity.*", "parameters.*", "rows_null_device")


@query("integrity_report", _REPORT_SQL)
def _(spark, sf):
    return _whole_report(integrity.report(_tally(spark, sf), LIMITS, _dense(spark, sf)))


@query(
    "integrity_duplicate_ratio",
    f"""{_DENSE_CHECKED} select device, count(*) as rows, avg(case when duplicate_row then 1e0 else 0e0 end)
    as duplicate_ratio from checked group by device""",
    "duplicate_ratio",
)
def _(spark, sf):
    return integrity.duplicate_ratio(integrity.tally(integrity.checks(_dense(spark, sf), LIMITS, only=["duplicate_row"])))


# --- cycle features ----------------------------------------------------------------

_FAULT_SQL = f"""
with t as ({views.duckdb('telemetry_cycles')}),
a as (select *, (t_us - lag(t_us) over w) / 1e6 as dt, voltage - lag(voltage) over w as dv,
             temperature - lag(temperature) over w as dtemp, row_number() over w as pos,
             count(*) over (partition by device, cycle) as n
      from t window w as (partition by device, cycle order by t_us, seq)),
b as (select *, case when dt = 0 then 0e0 else abs(dv / dt) end as slope,
             case when dt = 0 then 0e0 else abs(dtemp / dt) end as rate from a),
fault as (
  select device, cycle, cast(max(cycle) as double) as cycle_number,
    case when count(*) >= 3 and count(slope) > 0
         then count(*) filter (where slope <= 1e-4) / cast(count(*) - 1 as double) end as cc_phase_ratio,
    max(soc) as soc_max, avg(pack_voltage) / avg(cell_voltage) as pack_cell_voltage_ratio,
    case when count(*) > 2 then corr(pack_voltage, cell_voltage) end as voltage_correlation,
    min(voltage) filter (where pos <= greatest(1, ceil(0.2 * n))) as initial_min_voltage,
    avg(slope) as voltage_gradient, max(temperature) - min(temperature) as max_temp_diff,
    avg(rate) as max_temp_rate, max(rate) as max_abs_temp_rate,
    max_by(temperature, pos) as terminal_temp
  from b group by device, cycle)
"""
_FAULT_COLUMNS = " ".join((*cycles.FAULT_FEATURES, "max_abs_temp_rate"))


def _fault(spark, sf, skew=Skew()):
    return cycles.fault_features(_cycles(spark, sf), FAULT, skew=skew)


def _fault_part(name: str, columns: str, skew: Skew = Skew()):
    cols = columns.split()

    @query(name, f"{_FAULT_SQL} select device, cycle, {', '.join(cols)} from fault", columns)
    def part(spark, sf):
        return _fault(spark, sf, skew).select("device", "cycle", *cols)


_fault_part("fault_features", _FAULT_COLUMNS)
_fault_part("fault_features_hot_cycles", _FAULT_COLUMNS, TIGHT_CYCLE)
_fault_part("fault_usage", "cycle_number cc_phase_ratio soc_max")
_fault_part("fault_voltage", "pack_cell_voltage_ratio voltage_correlation initial_min_voltage voltage_gradient")
_fault_part("fault_thermal", "max_temp_diff max_temp_rate max_abs_temp_rate terminal_temp")


@query(
    "fault_features_fleet_cycles",
    _FAULT_SQL.replace("partition by device, cycle", "partition by cycle")
    .replace("select device, cycle, cast(max", "select cycle, cast(max")
    .replace("group by device, cycle", "group by cycle")
    + f" select cycle, {', '.join(_FAULT_COLUMNS.split())} from fault",
    _FAULT_COLUMNS,
)
def _(spark, sf):
    return cycles.fault_features(_cycles(spark, sf), FAULT, keys=["cycle"])


_SOH_SQL = f"""
with t as ({views.duckdb('telemetry_cycles')}),
a as (select *, (t_us - lag(t_us) over w) / 1e6 as dt, lag(current) over w as pi, lag(voltage) over w as pv,
             lag(temperature) over w as ptemp, row_number() over w as pos
      from t window w as (partition by device, cycle order by t_us, seq)),
plain as (
  select device, cycle, count(*) as cycle_points, (max(t_us) - min(t_us)) / 1e6 as time_span_sec,
    count(distinct t_us) as time_unique_points,
    case when count(current) = count(*) then -sum(0.5 * (current + pi) * dt) / 3600 end as capacity_ah,
    case when count(current) = count(*) and count(voltage) = count(*)
         then sum(0.5 * (voltage * current + pv * pi) * dt) / 3600 end as energy_wh,
    avg(voltage) as voltage_mean, stddev_pop(voltage) as voltage_std, max(voltage) - min(voltage) as voltage_range,
    max(temperature) - min(temperature) as temp_range,
    case when count(*) >= 3 then max(case when dt <> 0 then abs(temperature - ptemp) / dt end) end as temp_max_abs_rate,
    case when count(*) >= 3 then avg(case when dt <> 0 then abs(temperature - ptemp) / dt end) end as temp_mean_abs_rate,
    min(soc) as soc_min, max(soc) as soc_max, max(soc) - min(soc) as soc_span,
    case when count(*) >= 3 then quantile_cont(case when abs(current - pi) > 1e-3
         then abs((voltage - pv) / (current - pi)) end, 0.5) end as resistance_proxy,
    quantile_cont(voltage, 0.9) as high, count(voltage) as known_v,
    max(temperature) as terminal_ohmic_proxy,
    max_by(capacity, pos) as soh_proxy_from_input
  from a group by device, cycle),
tail as (
  select device, cycle, temperature as terminal_temp, voltage as terminal_voltage, soc as terminal_soc
  from (select *, row_number() over (partition by device, cycle order by t_us desc, seq desc) as r from t) x where r = 1),
v as (select t.*, lag(voltage) over w as pv, (t_us - lag(t_us) over w) / 1e6 as dt from t where voltage is not null
      window w as (partition by device, cycle order by t_us, seq)),
vs as (select v.*, high, case when dt = 0 then 0e0 else abs((voltage - pv) / dt) end as slope
       from v join plain using (device, cycle) where pv is not null),
ratios as (
  select device, cycle, avg(case when slope <= 1e-4 then 1e0 else 0e0 end) as cc,
         avg(case when pv >= high then (case when slope <= 1e-4 then 1e0 else 0e0 end) end) as cv
  from vs group by device, cycle),
c as (select device, cycle, t_us, seq, voltage as v, current as i, lag(voltage) over w as pv, lag(current) over w as pi,
             (t_us - lag(t_us) over w) / 1e6 as dt, row_number() over w as k
      from t where voltage is not null and current is not null
      window w as (partition by device, cycle order by t_us, seq)),
cq as (select *, -0.5 * (i + pi) * dt / 3600 as dq, v - pv as dv, 0.5 * (v + pv) as mid from c),
cs as (select *, sum(dq) over (partition by device, cycle order by t_us, seq) as q from cq),
cu as (select *, case when k >= 3 and abs(dv) > 1e-6 then abs(dq / dv) end as dqdv, q - dq / 2 as q_mid from cs),
cr as (select *, row_number() over (partition by device, cycle order by dqdv desc nulls last, k) as best,
              count(*) over (partition by device, cycle) as complete,
              max(dt) over (partition by device, cycle) as longest from cu),
curve as (
  select device, cycle, max(dqdv) as peak, max(case when best = 1 and dqdv is not null then q_mid end) as peak_q,
         avg(dqdv) as mean_abs, max(case when dqdv is not null then mid end) - min(case when dqdv is not null then mid end)
         as spread from cr where complete >= 4 and longest >= 1e-9 group by device, cycle),
whole as (
  select plain.*, terminal_temp, terminal_voltage, terminal_soc,
    case when known_v >= 3 then cc end as cc_ratio, case when known_v >= 3 then cv end as cv_ratio,
    peak as dqdv_peak_abs, peak_q as dqdv_peak_q, mean_abs as dqdv_mean_abs, spread as dqdv_spread_v,
    peak / nullif(mean_abs, 0) as dqdv_peak_to_mean_ratio
  from plain join tail using (device, cycle) left join ratios using (device, cycle) left join curve using (device, cycle)),
soh as (
  select device, cycle, cycle_points, soh_proxy_from_input,
    {", ".join(f"case when cycle_points >= 2 then {c} end as {c}" for c in cycles.SOH_FEATURES[1:])} from whole),
based as (select *, first_value(soh_proxy_from_input) over (partition by device order by cycle) as base from soh),
proxied as (select *, soh_proxy_from_input / nullif(base, 0) as soh_proxy from based),
labelled as (
  select *, case when count(soh_proxy) over f = 5 then regr_slope(soh_proxy, cast(cycle_rank as double)) over f end as soh_trend_5
  from (select *, row_number() over (partition by device order by cycle) as cycle_rank from proxied) x
  window f as (partition by device order by cycle rows between 4 preceding and current row))
"""


def _soh(spark, sf, skew=Skew()):
    return cycles.soh_features(_cycles(spark, sf), SOH, skew=skew)


def _soh_part(name: str, columns: str, skew: Skew = Skew()):
    cols = columns.split()
    whole = ("cycle_points", "time_unique_points")
    doubles = " ".join(c for c in cols if c not in whole)
    last = any(c in cycles.SOH_LABELS[1:] for c in cols)

    @query(name, f"{_SOH_SQL} select device, cycle, {', '.join(cols)} from {'labelled' if last else 'soh'}", doubles)
    def part(spark, sf):
        out = _soh(spark, sf, skew)
        if last:
            # the tight bound for rows of a cycle is also tight for the cycles of a device
            out = cycles.soh_labels(out, segment=3 if skew is TIGHT_CYCLE else cycles.SEGMENT_CYCLES)
        return out.select("device", "cycle", *cols)


_soh_part("soh_features", " ".join((*cycles.SOH_FEATURES, *cycles.SOH_LABELS)))
_soh_part("soh_features_hot_cycles", " ".join((*cycles.SOH_FEATURES, *cycles.SOH_LABELS)), TIGHT_CYCLE)
_soh_part("soh_points", "cycle_points time_span_sec time_unique_points")
_soh_part("soh_capacity_energy", "capacity_ah energy_wh")
_soh_part("soh_voltage", "voltage_mean voltage_std voltage_range")
_soh_part("soh_cc_ratio", "cc_ratio")
_soh_part("soh_cv_ratio", "cv_ratio")
_soh_part("soh_thermal", "temp_range temp_max_abs_rate temp_mean_abs_rate")
_soh_part("soh_charge_state", "soc_min soc_max soc_span")
_soh_part("soh_dqdv", "dqdv_peak_abs dqdv_peak_q dqdv_mean_abs dqdv_spread_v dqdv_peak_to_mean_ratio")
_soh_part("soh_resistance", "resistance_proxy")
_soh_part("soh_terminal", "terminal_temp terminal_voltage terminal_soc terminal_ohmic_proxy")
_soh_part("soh_proxy", "soh_proxy_from_input soh_proxy")
_soh_part("soh_trend", "soh_trend_5")

_STATS = " union all ".join(
    f"select count(*) as rows, '{c}' as feature, avg(case when {c} is null then 1e0 else 0e0 end) as nan_rate from soh"
    for c in cycles.SOH_FEATURES
)


@query("feature_stats", f"{_SOH_SQL} {_STATS}", "nan_rate")
def _(spark, sf):
    return cycles.feature_stats(_soh(spark, sf).select(*cycles.SOH_FEATURES))


_FAULT_COLUMNS = ("device", "cycle", *cycles.FAULT_FEATURES, "max_abs_temp_rate")


@query(
    "feature_stats_report",
    f"""{_FAULT_SQL} select count(*) as rows, count(*) as cycles, 11 as features, '{",".join(_FAULT_COLUMNS)}' as columns,
    {', '.join(f"avg(case when {c} is null then 1e0 else 0e0 end) as {c}_missing" for c in _FAULT_COLUMNS)} from fault""",
    " ".join(f"{c}_missing" for c in _FAULT_COLUMNS),
)
def _(spark, sf):
    report = cycles.stats_report(_fault(spark, sf).select(*_FAULT_COLUMNS))
    rates = [F.col(f"nan_rates.{c}").alias(f"{c}_missing") for c in _FAULT_COLUMNS]
    return report.select("rows", "cycles", "features", F.array_join("columns", ",").alias("columns"), *rates)


@query(
    "cycles_with_enough_points",
    f"""with t as ({views.duckdb('telemetry_cycles')})
    select device, cycle, count(*) as points from t group by device, cycle having count(*) >= 30""",
)
def _(spark, sf):
    return cycles.cycles_with_enough_points(_cycles(spark, sf), minimum=30)


# --- sources and preparation -------------------------------------------------------

_RAW_SPARK = """
select event_id, case when event_id % 10 = 3 then 'not a time' else cast(ts as string) end as stamp,
       concat('cell-', cast(user_id % 10 as string)) as cell,
       case when event_id % 11 = 0 then 'NaN' when event_id % 13 = 0 then 'n/a'
            else cast(value as string) end as volts,
       case when event_id % 17 = 0 then null else concat(cast(event_id % 29 as string), '.7') end as lap
from parquet.`{sf}/events.parquet`"""
_RAW_VOLTS = "case when event_id % 11 = 0 or event_id % 13 = 0 then null else value end"


def _raw(spark, sf):
    return spark.sql(_RAW_SPARK.replace("{sf}", sf))


@query(
    "normalise_text_telemetry",
    f"""select event_id as seq, epoch_us(ts) as t_us, concat('cell-', cast(user_id % 10 as varchar)) as device,
    {_RAW_VOLTS} as voltage from events where event_id % 10 <> 3""",
    "voltage",
)
def _(spark, sf):
    spec = ColumnSpec(time="stamp", order="event_id", device="cell", voltage="volts")
    return tables.normalise(_raw(spark, sf), spec).select("seq", "t_us", "device", "voltage")


@query(
    "normalise_single_device",
    "select 'all' as device, count(*) as rows, count(distinct t_us) as instants "
    "from (select epoch_us(ts) as t_us from events) e",
)
def _(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    rows = tables.normalise(events, ColumnSpec(time="ts", order="event_id", voltage="value"))
    return rows.groupBy("device").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("t_us").alias("instants"))


@query(
    "normalise_epoch_seconds",
    "select event_id as seq, (1700000000 + event_id * 12) * 1000000 as t_us, value as voltage from events",
    "voltage",
)
def _(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("clock", 1_700_000_000.0 + F.col("event_id") * 12.0)
    rows = tables.normalise(events, ColumnSpec(time="clock", order="event_id", voltage="value"))
    return rows.select("seq", "t_us", "voltage")


@query(
    "csv_epoch_scan",
    """select event_id as seq, concat('cell-', user_id % 10) as device, (1700000000 + event_id * 12) * 1000000 as t_us,
    value as voltage, event_type from events""",
    "voltage",
)
def _(spark, sf):
    """A CSV folder without a suffix or a schema, its time in epoch seconds; a column without a role stays."""
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        (1_700_000_000.0 + F.col("event_id") * 12.0).alias("timestamp"), F.col("event_id").alias("n"),
        F.concat(F.lit("cell-"), F.col("user_id") % 10).alias("cell_id"), F.col("value").alias("voltage"), "event_type")
    path = scratch(spark, "epoch")
    sinks.write_table(events, path, "csv")
    spec = ColumnSpec(time="timestamp", order="n", device="cell_id", voltage="voltage")
    return tables.normalise(tables.read_table(spark, path, fmt="csv"), spec).select("seq", "device", "t_us", "voltage", "event_type")


@query(
    "unreadable_times",
    """select count(*) as rows_read, count(*) filter (where event_id % 10 = 3) as rows_without_time from events""",
)
def _(spark, sf):
    return tables.unreadable_times(_raw(spark, sf), ColumnSpec(time="stamp", order="event_id"))


@query(
    "integrity_report_observed",
    """select count(*) filter (where event_id % 10 <> 3) as rows_total, count(*) as rows_read,
    count(*) filter (where event_id % 10 = 3) as rows_without_time,
    count(*) filter (where event_id % 10 <> 3 and event_id % 17 = 0) as rows_null_device from events""",
)
def _(spark, sf):
    seen = Observation("normalised")
    spec = ColumnSpec(time="stamp", order="event_id", device="lap", voltage="volts")
    tallied = durable(integrity.tally(integrity.checks(tables.normalise(_raw(spark, sf), spec, observation=seen), LIMITS, skew=SEGMENTS)))
    return integrity.report(tallied, LIMITS, observed=seen.get).select("rows_total", "rows_read", "rows_without_time", "rows_null_device")


_STUMP_RUN = dict(model="gb", n_trees=2, max_depth=1, n_bootstrap=2, features=["cycle_points"])


@query(
    "workflow_with_a_failing_stage",
    f"""with t as ({views.duckdb('telemetry_cycles')}), c as (select count(*) as n from (select distinct device, cycle from t) x),
    s as (select * from (values ('telemetry_integrity', 'ok'), ('soh_feature_extraction', 'ok'), ('soh_train', 'fail'), ('security_audit', 'ok')) v(stage, status))
    select 'fail' as overall, stage, status, case stage when 'telemetry_integrity' then (select count(*) from t)
      when 'soh_feature_extraction' then (select n from c) when 'security_audit' then 60 end as counted from s""",
)
def _(spark, sf):
    run = workflow.run(spark, _cycles(spark, sf), integrity_limits=LIMITS, soh_limits=SOH, keep_going=True, model="no such learner")
    steps = run.summary.select(F.col("status").alias("overall"), F.explode("steps").alias("s")).select("overall", "s.stage", "s.status", "s.report")
    counted = F.coalesce(*[F.get_json_object("report", f"$.{c}") for c in ("rows_total", "rows", "total_rows")]).cast("bigint")
    return steps.select("overall", "stage", "status", counted.alias("counted"))


@query(
    "workflow_stages_and_artifacts",
    f"""with t as ({views.duckdb('telemetry_cycles')}), c as (select distinct device, cycle from t),
    a as (select 'integrity_report' as artifact, 1 as rows union all select 'soh_feature_stats', 1
      union all select 'soh_features', (select count(*) from c) union all select 'soh_metrics', 1
      union all select 'soh_model', 1 union all select 'risk_register', 60 union all select 'controls_plan', 20
      union all select 'risk_summary', 1 union all select 'gates', 8 union all select 'soh_feature_importance', 1)
    select artifact, cast(rows as bigint) as rows, 'pass' as status, true as timed from a""",
)
def _(spark, sf):
    run, path = workflow.run(spark, _cycles(spark, sf), integrity_limits=LIMITS, soh_limits=SOH, **_STUMP_RUN), scratch(spark, "field-run")
    workflow.write(run, path)
    summary = spark.read.json(f"{path}/summary")
    named = summary.select("status", (F.col("finished_utc") >= F.col("started_utc")).alias("timed"), F.explode("artifacts.artifact").alias("artifact"))
    kinds = {"soh_features": "parquet", "risk_register": "parquet", "controls_plan": "parquet", "soh_feature_importance": "parquet", "soh_model": "manifest"}
    counts = None
    for name in ("integrity_report", "soh_feature_stats", "soh_metrics", "risk_summary", "gates", *kinds):
        kind = kinds.get(name, "json")
        table = spark.read.parquet(f"{path}/{name}") if kind == "parquet" else spark.read.json(f"{path}/{name}" + "/manifest" * (kind == "manifest"))
        one = table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("artifact"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return named.join(counts, "artifact")


@query(
    "normalise_cycle_ids",
    "select event_id % 29 as cycle, count(*) as rows from events where event_id % 17 <> 0 and event_id % 10 <> 3 group by 1",
)
def _(spark, sf):
    spec = ColumnSpec(time="stamp", order="event_id", device="cell", cycle="lap")
    rows = tables.normalise(_raw(spark, sf), spec)
    return rows.filter(F.col("cycle").isNotNull()).groupBy("cycle").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "finite_and_ratio",
    """select event_id, case when event_id % 5 = 0 then null else value end as value,
    case when event_id % 7 = 0 then null else value / (event_id % 7) end as ratio from events""",
    "value ratio",
)
def _(spark, sf):
    from packtrace.functions.numeric import finite, ratio

    events = spark.read.parquet(f"{sf}/events.parquet")
    reading = F.when(F.col("event_id") % 5 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    return events.select(
        "event_id",
        finite(reading).alias("value"),
        ratio(F.col("value"), (F.col("event_id") % 7).cast("double")).alias("ratio"),
    )


@query(
    "cycles_from_row_count",
    f"""with t as ({views.duckdb('telemetry_cycles')})
    select seq, device, cast(floor((row_number() over (partition by device order by seq) - 1) / 50) as bigint) as cycle
    from t""",
)
def _(spark, sf):
    return tables.assign_cycles(_cycles(spark, sf), 50).select("seq", "device", "cycle")


@query(
    "cycles_from_row_count_global",
    f"""with t as ({views.duckdb('telemetry_cycles')})
    select seq, device, cast(floor((row_number() over (order by t_us, seq) - 1) / 120) as bigint) as cycle from t""",
)
def _(spark, sf):
    rows = tables.assign_cycles(_cycles(spark, sf), 120, per_device=False, order=("t_us", "seq"), skew=TIGHT)
    return rows.select("seq", "device", "cycle")


@query(
    "positional_sample_ids",
    "select o_orderkey, row_number() over (order by o_orderkey) - 1 as sample_id from orders",
)
def _(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    return tables.number_samples(orders, ["o_orderkey"], skew=TIGHT)


@query(
    "feature_matrix",
    f"""{_FAULT_SQL} select device, cycle, coalesce(soc_max, 0) as soc_max,
    coalesce(voltage_gradient, 0) as voltage_gradient, 0e0 as note from fault""",
    "soc_max voltage_gradient note",
)
def _(spark, sf):
    rows = _fault(spark, sf).withColumn("note", F.lit("n/a"))
    return models.feature_matrix(rows, ["soc_max", "voltage_gradient", "note"], ["device", "cycle"])


_PAIRS = views.duckdb("regression_pairs")
_GAPPY = f"select *, case when sample_id % 9 = 0 then null when sample_id % 100 = 1 then 'Infinity'::double else y_true end as y from ({_PAIRS}) p"


def _gappy(spark, sf):
    pairs = views.view(spark, sf, "regression_pairs")
    y = F.when(F.col("sample_id") % 9 == 0, None).when(F.col("sample_id") % 100 == 1, F.lit(float("inf")))
    return pairs.withColumn("y", y.otherwise(F.col("y_true"))).drop("y_true")


_IMPUTED = f"""with g as ({_GAPPY}), m as (select quantile_cont(y, 0.5) as med from g)
select sample_id, coalesce(y, med) as y_true from g, m where coalesce(y, med) < 'Infinity'::double"""


@query("impute_label", _IMPUTED, "y_true")
def _(spark, sf):
    return models.impute_label(_gappy(spark, sf), "y").select("sample_id", "y_true")


@query("impute_label_large_table", _IMPUTED, "y_true")
def _(spark, sf):
    return models.impute_label(_gappy(spark, sf), "y", accuracy=100).select("sample_id", "y_true")


@query(
    "align_target",
    "select l_tax, 0e0 as unseen, l_quantity from lineitem where l_linestatus = 'O'",
    "l_tax unseen l_quantity",
)
def _(spark, sf):
    return drift.align(views.view(spark, sf, "drift_target"), ["l_tax", "unseen", "l_quantity"])


def _csv_round_trip(spark, df: DataFrame) -> DataFrame:
    path = scratch(spark, "csv")
    sinks.write_table(df, f"{path}.csv", "csv")
    schema = ", ".join(f"{c} {t if not t.startswith('array') else 'string'}" for c, t in df.dtypes)
    return tables.read_table(spark, f"{path}.csv", schema)


@query(
    "csv_telemetry_scan",
    f"""with t as ({views.duckdb('telemetry_cycles')}) select seq, device, t_us, cycle, voltage, soc from t""",
    "voltage soc",
)
def _(spark, sf):
    rows = _csv_round_trip(spark, _cycles(spark, sf).select("seq", "device", "t_us", "cycle", "voltage", "soc"))
    spec = ColumnSpec(time="t_us", time_unit="us", order="seq", device="device", cycle="cycle", voltage="voltage", soc="soc")
    return tables.normalise(rows, spec).select("seq", "device", "t_us", "cycle", "voltage", "soc")


@query("csv_flag_sink", f"{_DENSE_CHECKED} {_FLAGGED}", _SENSORS)
def _(spark, sf):
    rows = integrity.flag(_dense(spark, sf), LIMITS)
    cols = ["seq", "device", "t_us", "voltage", "current", "temperature", "flagged", "reasons", "asset_id"]
    return _csv_round_trip(spark, rows.select(*cols))


@query("json_report_sink", _REPORT_SQL)
def _(spark, sf):
    path = f"{scratch(spark, 'report')}.json"
    report = integrity.report(_tally(spark, sf), LIMITS)
    sinks.write_json(report, path)
    return _whole_report(spark.read.schema(report.schema).json(path))


@query(
    "required_columns",
    "select 'Missing columns: volts, amps' as message, count(*) as rows from events",
)
def _(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    try:
        tables.require(events, ["ts", "volts", None, "amps", "user_id"])
        said = ""
    except ValueError as error:
        said = str(error)
    return events.agg(F.lit(said).alias("message"), F.count(F.lit(1)).alias("rows"))


@query(
    "markdown_integrity_summary",
    f"""{_DENSE_CHECKED}, s as ({_SEVERITY})
    select cast(line_no as bigint) as line_no, line from (select 1 as line_no, '# Telemetry Integrity Summary' as line union all select 2, ''
    union all select 3, '- Total rows: ' || count(*) from checked
    union all select 4, '- Flagged rows: ' || count(*) from checked where {_ANY}
    union all select 5, '' union all select 6, '## Severity counts'
    union all select 6 + list_position({list(integrity.REASONS)}, reason), '- ' || reason || ': ' || rows from s
    union all select {len(integrity.REASONS) + 7}, ''
    union all select {len(integrity.REASONS) + 8}, 'Action: investigate flagged rows first; if `replay_pattern` exceeds zero, treat as possible tampering.') z""",
)
def _(spark, sf):
    report = integrity.report(_tally(spark, sf), LIMITS)
    path = scratch(spark, "summary")
    sinks.write_lines(sinks.integrity_summary(report), path)
    return _lines(spark, path)


# --- splits ------------------------------------------------------------------------


@query(
    "split_stratified",
    """select doc_id, quality, r <= round(0.2 * n) as is_test from (
      select doc_id, quality, count(*) over (partition by quality) as n,
             row_number() over (partition by quality order by md5(concat_ws('#', cast(doc_id as varchar), '42'))) as r
      from labels) x""",
)
def _(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    return split.stratified(labels, "quality", "doc_id")


_ORDER_SPLIT = """with h as (select o_orderkey, o_orderpriority, o_custkey,
      md5(concat_ws('#', cast({key} as varchar), '42')) as h from orders),
    r as (select h, row_number() over (order by h) as r, count(*) over () as n from (select distinct h from h) x),
    cut as (select max(h) as c from r where r <= ceil(0.25 * n))
    select o_orderkey, {key} as {name}, h <= c as is_test from h, cut"""


@query("split_by_group", _ORDER_SPLIT.format(key="o_custkey", name="o_custkey"))
def _(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey")
    return split.by_group(orders, "o_orderkey", "o_custkey")


@query("split_rows_large_table", _ORDER_SPLIT.format(key="o_orderkey", name="sample"))
def _(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.col("o_orderkey").alias("sample"))
    return split.by_group(orders, "sample")


@query(
    "split_stratified_hot_label",
    """select o_orderkey, o_orderstatus, r <= round(0.2 * n) as is_test from (
      select o_orderkey, o_orderstatus, count(*) over (partition by o_orderstatus) as n, row_number() over
      (partition by o_orderstatus order by md5(concat_ws('#', cast(o_orderkey as varchar), '42'))) as r from orders) x""",
)
def _(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus")
    return split.stratified(orders, "o_orderstatus", "o_orderkey")


# --- evaluation --------------------------------------------------------------------

_SCORED = f"""with s as (select sample_id, cast(y_true as varchar) as true_label,
  case when p1 >= 0.5 then '1' else '0' end as predicted_label, p1 from ({views.duckdb('scored_labels')}) v)"""


def _scored(spark, sf):
    rows = views.view(spark, sf, "scored_labels")
    return rows.select(
        "sample_id",
        F.col("y_true").cast("string").alias("true_label"),
        F.when(F.col("p1") >= 0.5, "1").otherwise("0").alias("predicted_label"),
        "p1",
        F.array(1 - F.col("p1"), F.col("p1")).alias("probability"),
    )


@query(
    "classification_metrics",
    f"""{_SCORED}, l as (select distinct true_label as label from s union select distinct predicted_label from s),
    c as (select label, count(*) filter (where true_label = label) as sup,
                 count(*) filter (where predicted_label = label) as said,
                 count(*) filter (where predicted_label = label and true_label = label) as hit from l, s group by label),
    m as (select sup, hit, case when said = 0 then 0e0 else hit / said end as p,
                 case when sup = 0 then 0e0 else hit / sup end as r,
                 case when sup + said = 0 then 0e0 else 2 * hit / (sup + said) end as f from c)
    select sum(hit) / sum(sup) as accuracy, avg(p) as precision_macro, avg(r) as recall_macro, avg(f) as f1_macro from m""",
    "accuracy precision_macro recall_macro f1_macro",
)
def _(spark, sf):
    return evaluate.classification_metrics(_scored(spark, sf))


@query(
    "confusion_counts",
    f"{_SCORED} select true_label as truth, predicted_label as predicted, count(*) as rows from s group by all",
)
def _(spark, sf):
    return evaluate.confusion(_scored(spark, sf))


_RANK_AUC = """select (sum(rk) filter (where y) - count(*) filter (where y) * (count(*) filter (where y) + 1) / 2)
    / (count(*) filter (where y) * count(*) filter (where not y)) as auroc
    from (select y, rank() over (order by p) + (count(*) over (partition by p) - 1) / 2 as rk from z) x"""


@query("auroc_binary", f"{_SCORED}, z as (select true_label = '1' as y, p1 as p from s) {_RANK_AUC}", "auroc")
def _(spark, sf):
    return evaluate.auroc_macro(_scored(spark, sf), ["0", "1"], "probability", "true_label")


@query(
    "auroc_large_table",
    f"""with z as (select o_orderstatus = 'F' as y, ((o_orderkey * 7919) % 9973) / 9973e0 as p from orders) {_RANK_AUC}""",
    "auroc",
)
def _(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    score = ((F.col("o_orderkey") * 7919) % 9973) / F.lit(9973e0)
    rows = orders.select(score.alias("p"), (F.col("o_orderstatus") == "F").alias("y"))
    return evaluate.auroc(rows, "p", F.col("y"))


_THREE = [f"(((o_orderkey * {a}) % 997) + 1) / 1000e0" for a in (31, 57, 83)]
_THREE_SQL = f"""with raw as (select o_orderkey as sample_id, o_orderstatus as true_label, {_THREE[0]} as a,
  {_THREE[1]} as b, {_THREE[2]} as c from orders),
s as (select sample_id, true_label, a / (a + b + c) as pf, b / (a + b + c) as po, c / (a + b + c) as pp from raw)"""


def _three(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    rows = orders.selectExpr(
        "o_orderkey as sample_id", "o_orderstatus as true_label", *[f"{e} as {n}" for e, n in zip(_THREE, "abc")]
    )
    total = F.col("a") + F.col("b") + F.col("c")
    rows = rows.withColumn("probability", F.array(*[F.col(n) / total for n in "abc"]))
    best = F.array_position("probability", F.array_max("probability")).cast("int") - 1
    label = F.get(F.array(*[F.lit(x) for x in "FOP"]), best)
    return rows.select("sample_id", "true_label", "probability", label.alias("predicted_label"))


@query(
    "auroc_multiclass",
    f"""{_THREE_SQL}, z as (select 'F' as k, true_label = 'F' as y, pf as p from s union all
    select 'O', true_label = 'O', po from s union all select 'P', true_label = 'P', pp from s),
    r as (select k, y, rank() over (partition by k order by p) + (count(*) over (partition by k, p) - 1) / 2 as rk from z),
    u as (select k, (sum(rk) filter (where y) - count(*) filter (where y) * (count(*) filter (where y) + 1) / 2)
    / (count(*) filter (where y) * count(*) filter (where not y)) as a from r group by k)
    select avg(a) as auroc from u""",
    "auroc",
)
def _(spark, sf):
    return evaluate.auroc_macro(_three(spark, sf), list("FOP"), "probability", "true_label")


@query(
    "hard_cases_binary",
    f"""{_SCORED} select sample_id, predicted_label, true_label, greatest(p1, 1 - p1) as max_prob from s
    where abs(p1 - 0.5) < 0.12""",
    "max_prob",
)
def _(spark, sf):
    return evaluate.hard_cases(_scored(spark, sf), classes=2)


@query(
    "hard_cases_multiclass",
    f"""{_THREE_SQL}, g as (select *, greatest(pf, po, pp) as hi, least(pf, po, pp) as lo from s)
    select sample_id, case when pf = hi then 'F' when po = hi then 'O' else 'P' end as predicted_label, true_label,
    hi as max_prob from g where round(hi - (pf + po + pp - hi - lo), 12) < 0.12""",
    "max_prob",
)
def _(spark, sf):
    return evaluate.hard_cases(_three(spark, sf), classes=3)


_METRICS = """avg(abs(y_pred - y_true)) as mae, sqrt(avg((y_pred - y_true) * (y_pred - y_true))) as rmse,
  1 - avg((y_pred - y_true) * (y_pred - y_true)) / var_pop(y_true) as r2,
  100 * avg(case when y_true <> 0 then (y_pred - y_true) / y_true end) as mpe_percent"""


@query("regression_metrics", f"select {_METRICS} from ({_PAIRS}) p", "mae rmse r2 mpe_percent")
def _(spark, sf):
    return evaluate.regression_metrics(views.view(spark, sf, "regression_pairs"))


_INTERVAL = f"""select *, y_pred + 0.5 as bootstrap_mean, u as uncertainty, y_pred + 0.5 - 1.96 * u as y_pi_lower_95,
  y_pred + 0.5 + 1.96 * u as y_pi_upper_95, (y_pred + 0.5 + 1.96 * u) - (y_pred + 0.5 - 1.96 * u) as pi_width,
  y_true - y_pred as residual from (select sample_id, y_true, y_pred, greatest(uncertainty, 2.5e0) as u from ({_PAIRS}) p) q"""


def _intervals(spark, sf):
    rows = views.view(spark, sf, "regression_pairs").withColumnsRenamed({"uncertainty": "tree_std"})
    rows = rows.withColumns({"bootstrap_std": F.lit(2.5), "bootstrap_mean": F.col("y_pred") + 0.5})
    return evaluate.with_interval(rows)


_INTERVAL_COLUMNS = "uncertainty y_pi_lower_95 y_pi_upper_95 pi_width residual"


@query(
    "prediction_intervals",
    f"select sample_id, {', '.join(_INTERVAL_COLUMNS.split())} from ({_INTERVAL}) i",
    _INTERVAL_COLUMNS,
)
def _(spark, sf):
    return _intervals(spark, sf).select("sample_id", *_INTERVAL_COLUMNS.split())


_COVERED = "avg(case when y_true >= y_pi_lower_95 and y_true <= y_pi_upper_95 then 1e0 else 0e0 end)"


@query(
    "interval_coverage",
    f"select {_COVERED} as test_pi_coverage_95, avg(pi_width) as test_mean_interval_width_95 from ({_INTERVAL}) i",
    "test_pi_coverage_95 test_mean_interval_width_95",
)
def _(spark, sf):
    return evaluate.coverage(_intervals(spark, sf))


@query(
    "uncertainty_table",
    f"""with i as ({_INTERVAL}) select sample_id, uncertainty as uncertainty_95, pi_width as interval_width_95,
    (select {_COVERED} from i) as coverage_95 from i""",
    "uncertainty_95 interval_width_95 coverage_95",
)
def _(spark, sf):
    return evaluate.uncertainty_table(_intervals(spark, sf))


@query(
    "run_counts",
    """with x as (select quality, row_number() over (partition by quality order by
      md5(concat_ws('#', cast(doc_id as varchar), '42'))) <= round(0.2 * count(*) over (partition by quality)) as t from labels)
    select count(*) filter (where not t) as n_train, count(*) filter (where t) as n_test, 3 as n_features,
           string_agg(distinct cast(quality as varchar), ',' order by cast(quality as varchar)) as classes from x""",
)
def _(spark, sf):
    labels = split.stratified(spark.read.parquet(f"{sf}/labels.parquet"), "quality", "doc_id")
    counts = evaluate.run_counts(labels, "quality", features=3)
    return counts.withColumn("classes", F.array_join("classes", ","))


# --- attribution and prompts -------------------------------------------------------

# A fixed linear fault score over the ten features, standing in for a trained model.
WEIGHTS = {
    "cycle_number": 0.03,
    "cc_phase_ratio": -0.8,
    "soc_max": 1.5,
    "pack_cell_voltage_ratio": 0.6,
    "voltage_correlation": -40.0,
    "initial_min_voltage": 2.0,
    "voltage_gradient": 150.0,
    "max_temp_diff": 0.4,
    "max_temp_rate": 60.0,
    "terminal_temp": 0.05,
}
_LINEAR = f"""{_FAULT_SQL}, f as (select concat_ws('/', device, cast(cycle as varchar)) as sample_id,
  case when max_temp_diff > 11 then 'thermal' else 'normal' end as true_label,
  {', '.join(f'coalesce({c}, 0) as {c}' for c in WEIGHTS)} from fault),
m as (select {', '.join(f'avg({c}) as m_{c}' for c in WEIGHTS)} from f),
parts as ({' union all '.join(f"select sample_id, '{c}' as feature, round({w}::double * ({c} - m_{c}), 9) as shap_value from f, m" for c, w in WEIGHTS.items())}),
said as (select sample_id, case when sum(shap_value) > 0 then 'thermal' else 'normal' end as predicted_label
         from parts group by sample_id),
attr as (select sample_id, predicted_label, true_label, feature, shap_value
         from parts join said using (sample_id) join f using (sample_id)),
ranked as (select *, abs(shap_value) as abs_shap, row_number() over
           (partition by sample_id order by abs(shap_value) desc, feature) as rank from attr)
"""


def _linear(spark, sf):
    """Long attributions with labels; the weights are those of the fixed score."""
    truth = F.when(F.col("max_temp_diff") > 11, "thermal").otherwise("normal")
    rows = _fault(spark, sf).withColumns(
        {"sample_id": F.concat_ws("/", "device", F.col("cycle").cast("string")), "true_label": truth}
    )
    parts = attribution.linear(rows, "sample_id", WEIGHTS, keep=("true_label",))
    label = F.when(F.col("score") > 0, "thermal").otherwise("normal")
    # nine places: far below any attribution, above the noise of summation order
    return parts.select(
        "sample_id",
        label.alias("predicted_label"),
        "true_label",
        "feature",
        F.round("shap_value", 9).alias("shap_value"),
    )


@query("linear_attribution", f"{_LINEAR} select sample_id, feature, shap_value from attr", "shap_value")
def _(spark, sf):
    return _linear(spark, sf).select("sample_id", "feature", "shap_value")


@query(
    "attribution_toward_predicted",
    f"""{_LINEAR} select sample_id, feature,
    case when predicted_label = 'thermal' then shap_value else -shap_value end as shap_value from attr""",
    "shap_value",
)
def _(spark, sf):
    return attribution.toward_predicted(_linear(spark, sf), "thermal").select("sample_id", "feature", "shap_value")


@query(
    "global_importance",
    f"{_LINEAR} select feature, avg(abs(shap_value)) as mean_abs_shap from attr group by feature",
    "mean_abs_shap",
)
def _(spark, sf):
    return attribution.global_importance(_linear(spark, sf))


_TOP_COLUMNS = "sample_id, predicted_label, true_label, rank, feature, shap_value, abs_shap"


@query(
    "top_attributions",
    f"{_LINEAR} select {_TOP_COLUMNS.replace('rank', 'cast(rank as int) as rank')} from ranked where rank <= 8",
    "shap_value abs_shap",
)
def _(spark, sf):
    return attribution.top(_linear(spark, sf)).select(*_TOP_COLUMNS.split(", "))


@query(
    "prompt_context",
    f"{_LINEAR} select sample_id, cast(rank as int) as rank, feature, shap_value from ranked where rank <= 5",
    "shap_value",
)
def _(spark, sf):
    rows = prompts.select_context(attribution.top(_linear(spark, sf)))
    return rows.select("sample_id", "rank", "feature", "shap_value")


@query(
    "prompt_context_first_samples",
    f"""{_LINEAR} select sample_id, cast(rank as int) as rank, feature, shap_value from ranked
    where rank <= 5 and sample_id in (select distinct sample_id from ranked order by sample_id limit 100)""",
    "shap_value",
)
def _(spark, sf):
    rows = prompts.select_context(attribution.top(_linear(spark, sf)), sample_limit=100)
    return rows.select("sample_id", "rank", "feature", "shap_value")


_MECHANISM_SQL = " ".join(f"when '{f}' then '{m}'" for f, m in tables.MECHANISMS.items() if f != "soc_max")


def _partial_map():
    """The mechanism map without one feature, so the default text occurs."""
    return {f: m for f, m in tables.MECHANISMS.items() if f != "soc_max"}


@query(
    "mechanism_lookup",
    f"""{_LINEAR} select sample_id, feature, case feature {_MECHANISM_SQL} else 'unknown mechanism' end as mechanism,
    case when shap_value > 0 then 'supports' else 'opposes' end as direction from attr""",
)
def _(spark, sf):
    rows = prompts.with_mechanism(_linear(spark, sf), _partial_map())
    return rows.select("sample_id", "feature", "mechanism", "direction")


_PROMPT_SQL = f"""{_LINEAR}, kept as (select * from ranked where rank <= 5),
bullets as (select sample_id, min(predicted_label) as p, min(true_label) as t, string_agg(
  '- [' || rank || '] ' || feature || ' (' || case when shap_value > 0 then 'supports' else 'opposes' end || '): '
  || case feature {_MECHANISM_SQL} else 'unknown mechanism' end || ' (SHAP ' || printf('%.3f', shap_value) || ')',
  chr(10) order by rank) as b from kept group by sample_id)
select sample_id, 'markdown' as format, concat_ws(chr(10), '# Diagnosis Prompt for sample_id=' || sample_id,
  '- Predicted: ' || p, '- True (if known): ' || t, '- Context:', '{prompts.CONTEXT}', '- Top feature evidence:', b,
  {', '.join(f"'{line}'" for line in prompts.OUTPUT_FIELDS)}) as prompt from bullets"""


# the lines of a prompt pack, from a table p of prompts
_PACK_SQL = """x as (select 0 as block, null as id, ['# LLM Prompt Pack', ''] as ls
    union all select 1, {order}, string_split(prompt || chr(10) || chr(10) || '---' || chr(10), chr(10)) from p),
  y as (select block, id, unnest(ls) as line, generate_subscripts(ls, 1) as place from x)
select row_number() over (order by block, id, place) as line_no, line from y"""


@query("prompt_markdown", _PROMPT_SQL)
def _(spark, sf):
    rows = prompts.compose(attribution.top(_linear(spark, sf)), _partial_map())
    return rows.select("sample_id", "format", "prompt")


@query(
    "prompt_jsonl_sink",
    f"""{_LINEAR} select sample_id, 'json' as format, min(predicted_label) as predicted_fault,
    string_agg(feature, ',' order by rank) as features from ranked where rank <= 5
    group by sample_id""",
)
def _(spark, sf):
    path = f"{scratch(spark, 'prompts')}.jsonl"
    sinks.write_json(prompts.compose(attribution.top(_linear(spark, sf)), _partial_map(), fmt="json"), path)
    body = "struct<predicted_fault:string,top_contributors:array<struct<feature:string,rank:int>>>"
    rows = tables.read_table(spark, path, "sample_id string, format string, prompt string")
    rows = rows.withColumn("b", F.from_json("prompt", body))
    return rows.select(
        "sample_id",
        "format",
        F.col("b.predicted_fault").alias("predicted_fault"),
        F.array_join(F.col("b.top_contributors")["feature"], ",").alias("features"),
    )


@query(
    "mechanism_file_lookup",
    f"""{_LINEAR} select sample_id, feature, case feature {_MECHANISM_SQL} else 'unknown mechanism' end as mechanism
    from attr""",
)
def _(spark, sf):
    path = scratch(spark, "mechanisms")
    spark.createDataFrame([(json.dumps(_partial_map()),)], "value string").coalesce(1).write.text(path)
    mapping = prompts.mechanism_map(tables.mechanism_table(spark, path))
    return prompts.with_mechanism(_linear(spark, sf), mapping).select("sample_id", "feature", "mechanism")


@query(
    "prompt_pack_markdown",
    f"""with p as ({_PROMPT_SQL}), {_PACK_SQL.format(order="sample_id")}""",
)
def _(spark, sf):
    path = scratch(spark, "pack")
    packed = prompts.compose(attribution.top(_linear(spark, sf)), _partial_map())
    sinks.write_lines(sinks.prompt_markdown(packed), path)
    return _lines(spark, path)


# attributions with numeric ids, half of them without a label
_NUMERIC_SPARK = """select doc_id as sample_id, case when doc_id % 2 = 0 then 'thermal' end as predicted_label,
    case when doc_id % 3 = 0 then 'normal' end as true_label, r as rank,
    case r when 1 then 'soc_max' else 'terminal_temp' end as feature, (doc_id % 7 - 3) / (r * 2e0) as shap_value"""
_NUMERIC_SQL = f"""n as ({_NUMERIC_SPARK} from labels, (select unnest([1, 2]) as r) u)"""


def _numeric(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("r"))
    rows = spark.sql(f"{_NUMERIC_SPARK} from {{labels}}", labels=labels)
    path = f"{scratch(spark, 'numeric')}.csv"
    sinks.write_table(rows, path, "csv")
    return tables.read_attributions(spark, path)


_NUMERIC_PROMPTS = f"""bullets as (select sample_id, min(predicted_label) as p, min(true_label) as t, string_agg(
  '- [' || rank || '] ' || feature || ' (' || case when shap_value > 0 then 'supports' else 'opposes' end || '): '
  || case feature when 'soc_max' then '{tables.MECHANISMS["soc_max"]}' else '{tables.MECHANISMS["terminal_temp"]}' end
  || ' (SHAP ' || printf('%.3f', shap_value) || ')', chr(10) order by rank) as b from n group by sample_id),
p as (select sample_id, concat_ws(chr(10), '# Diagnosis Prompt for sample_id=' || sample_id,
  '- Predicted: ' || coalesce(p, ''), '- True (if known): ' || coalesce(t, ''), '- Context:', '{prompts.CONTEXT}',
  '- Top feature evidence:', b, {', '.join(f"'{line}'" for line in prompts.OUTPUT_FIELDS)}) as prompt from bullets)"""


@query("prompt_pack_numeric_ids", f"with {_NUMERIC_SQL}, {_NUMERIC_PROMPTS}, {_PACK_SQL.format(order='sample_id')}")
def _(spark, sf):
    path = scratch(spark, "pack")
    sinks.write_lines(sinks.prompt_markdown(prompts.compose(_numeric(spark, sf), tables.mechanism_table(spark))), path)
    return _lines(spark, path)


@query(
    "prompt_first_numeric_ids",
    f"""with {_NUMERIC_SQL} select cast(sample_id as varchar) as sample_id, cast(rank as int) as rank, feature from n
    where sample_id in (select distinct sample_id from n order by sample_id limit 25)""",
)
def _(spark, sf):
    return prompts.select_context(_numeric(spark, sf), sample_limit=25).select("sample_id", "rank", "feature")


@query(
    "prompt_json_nulls",
    f"""with {_NUMERIC_SQL} select cast(sample_id as varchar) as sample_id, min(predicted_label) is null as null_predicted,
    min(true_label) is null as null_true, true as has_predicted, true as has_true from n group by sample_id""",
)
def _(spark, sf):
    rows = prompts.compose(_numeric(spark, sf), tables.MECHANISMS, fmt="json").select("sample_id", F.from_json("prompt", "map<string,string>").alias("m"))
    return rows.select(
        "sample_id", F.col("m")["predicted_fault"].isNull().alias("null_predicted"), F.col("m")["true_fault"].isNull().alias("null_true"),
        F.map_contains_key("m", "predicted_fault").alias("has_predicted"), F.map_contains_key("m", "true_fault").alias("has_true"))


@query(
    "feature_table_scan",
    f"{_FAULT_SQL} select device, cycle, {', '.join(cycles.FAULT_FEATURES)} from fault",
    " ".join(cycles.FAULT_FEATURES),
)
def _(spark, sf):
    return _csv_round_trip(spark, _fault(spark, sf).select("device", "cycle", *cycles.FAULT_FEATURES))


@query(
    "attribution_csv_scan",
    f"{_LINEAR} select sample_id, cast(rank as int) as rank, feature, shap_value from ranked where rank <= 8",
    "shap_value",
)
def _(spark, sf):
    path = f"{scratch(spark, 'attributions')}.csv"
    sinks.write_table(attribution.top(_linear(spark, sf)), path, "csv")
    return tables.read_attributions(spark, path).select("sample_id", "rank", "feature", "shap_value")


def _domain_sql() -> str:
    cases = " ".join(f"when feature in ({', '.join(repr(f) for f in fs)}) then '{d}'" for d, fs in attribution.DOMAINS.items())
    return f"""{_LINEAR}, d as (select sample_id, case {cases} end as domain from ranked where rank <= 8)
    select domain, count(distinct sample_id) as samples, count(distinct sample_id) >= 10 as covered from d group by domain"""


@query("domain_coverage", _domain_sql())
def _(spark, sf):
    return attribution.domain_coverage(attribution.top(_linear(spark, sf)))


# --- drift -------------------------------------------------------------------------

_DRIFT_COLUMNS = "mean_shift std_shift_ratio quantile_shift quantile_shift_scaled"
_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _drift_sql() -> str:
    parts = []
    for side, status in (("s", "F"), ("t", "O")):
        for f in _FEATURES:
            cuts = ", ".join(f"quantile_cont({f}, {k / 10}) as q{k}" for k in range(1, 10))
            parts.append(
                f"select '{f}' as feature, '{side}' as side, avg({f}) as m, stddev_samp({f}) as sd, {cuts} "
                f"from lineitem where l_linestatus = '{status}'"
            )
    apart = ", ".join(f"abs(t.q{k} - s.q{k})" for k in range(1, 10))
    return f"""with x as ({' union all '.join(parts)}),
    d as (select s.feature, abs(t.m - s.m) as mean_shift, t.sd / (s.sd + 1e-9) as std_shift_ratio,
    greatest({apart}) as quantile_shift, greatest({apart}) / s.sd as quantile_shift_scaled
    from x s join x t on s.feature = t.feature and s.side = 's' and t.side = 't')"""


def _shifts(spark, sf, **how):
    return drift.compare(views.view(spark, sf, "drift_source"), views.view(spark, sf, "drift_target"), **how)


@query("drift_features", f"{_drift_sql()} select * from d", _DRIFT_COLUMNS)
def _(spark, sf):
    return _shifts(spark, sf)


@query("drift_features_large_tables", f"{_drift_sql()} select * from d", _DRIFT_COLUMNS)
def _(spark, sf):
    return _shifts(spark, sf, accuracy=1000)


@query(
    "drift_summary",
    f"""{_drift_sql()} select count(*) as num_features, coalesce(max(quantile_shift), 0) as max_quantile_shift,
    count(*) filter (where quantile_shift > 0.05) as high_quantile_features from d""",
    "max_quantile_shift",
)
def _(spark, sf):
    return drift.summary(_shifts(spark, sf))


@query(
    "target_metrics",
    f"select {_METRICS} from ({_PAIRS}) p where sample_id % 9 <> 0 and sample_id % 100 <> 1",
    "mae rmse r2 mpe_percent",
)
def _(spark, sf):
    return evaluate.regression_metrics(_gappy(spark, sf).withColumnRenamed("y", "y_true"))


# --- risk --------------------------------------------------------------------------

_THREAT_ROWS = ", ".join(
    "({}, '{}', {}, {}, {})".format(i, t, l, m, f"'{o}'" if o else "null")
    for i, (t, l, m, o) in enumerate(tables.DEFAULT_THREATS)
)
_RISK_SQL = f"""
with a as (select pos as asset_pos, trim(asset) as asset, coalesce(nullif(trim(owner), ''), 'unassigned') as owner,
           coalesce(criticality, 3) as criticality from ({views.duckdb('fleet_assets')}) v),
h as (select * from (values {_THREAT_ROWS}) x(threat_pos, threat, likelihood, impact, hint)),
r as (select asset_pos, threat_pos, asset, owner, threat, likelihood, impact, criticality,
      likelihood * impact * greatest(1, criticality - 1) as risk_score, coalesce(hint, owner) as recommended_owner,
      'open' as status, likelihood * impact as base_score,
      case when likelihood * impact >= 20 then 'high' when likelihood * impact >= 9 then 'medium' else 'low' end as priority_band
      from a, h),
p as (select *, row_number() over (order by risk_score desc, asset_pos, threat_pos) as position from r)
"""
_RISK_COLUMNS = "asset, owner, threat, likelihood, impact, criticality, risk_score, recommended_owner, status"


def _assets(spark, sf):
    return tables.assets(views.view(spark, sf, "fleet_assets"), "pos")


def _risks(spark, sf):
    return risk.register(_assets(spark, sf), tables.threats(spark))


@query("asset_source", f"{_RISK_SQL} select * from a")
def _(spark, sf):
    return _assets(spark, sf)


@query("risk_register", f"{_RISK_SQL} select {_RISK_COLUMNS}, base_score, priority_band from r")
def _(spark, sf):
    return _risks(spark, sf).select(*_RISK_COLUMNS.split(", "), "base_score", "priority_band")


@query("risk_ranking", f"{_RISK_SQL} select position, {_RISK_COLUMNS} from p")
def _(spark, sf):
    return risk.ranked(_risks(spark, sf), skew=TIGHT).select("position", *_RISK_COLUMNS.split(", "))


@query(
    "risk_threat_profile",
    f"""{_RISK_SQL} select asset, threat, risk_score * 1 as risk_score, recommended_owner from (
      select asset, owner as recommended_owner, 'Firmware rollback' as threat, 2 * 3 * greatest(1, criticality - 1) as risk_score from a
      union all select asset, 'Ops', 'Gateway spoofing', 3 * 5 * greatest(1, criticality - 1) from a) q""",
)
def _(spark, sf):
    path = scratch(spark, "profile")
    text = '{"threats": [{"threat": "Firmware rollback", "likelihood": 2}, {"threat": "Gateway spoofing", "impact": 5, "owner_hint": "Ops"}]}'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    rows = risk.register(_assets(spark, sf), tables.threats(spark, path))
    return rows.select("asset", "threat", "risk_score", "recommended_owner")


@query(
    "controls_plan",
    f"""{_RISK_SQL} select cast(position as int) as position, asset, threat, recommended_owner as owner,
    '{risk.ACTION}' as action, 'TBD' as due_by from p where position <= 20""",
)
def _(spark, sf):
    return risk.controls_plan(_risks(spark, sf))


@query(
    "risk_summary",
    f"""{_RISK_SQL} select (select count(*) from r) as total_rows,
    (select count(*) from r where risk_score >= 40) as high_risk_count,
    (select string_agg(cast(s as varchar), ',' order by s desc) from
       (select distinct risk_score as s from r order by 1 desc limit 10) x) as top_risk_scores""",
)
def _(spark, sf):
    out = risk.summary(_risks(spark, sf))
    scores = F.array_join(F.col("top_risk_scores").cast("array<string>"), ",").alias("top_risk_scores")
    return out.select("total_rows", "high_risk_count", scores)


@query(
    "risk_top_ten",
    f"{_RISK_SQL} select cast(position as int) as position, {_RISK_COLUMNS} from p where position <= 10",
)
def _(spark, sf):
    return risk.summary(_risks(spark, sf)).select(F.explode("top_ten").alias("r")).select("r.*")


_MD_ROW = "'| ' || concat_ws(' | ', {}) || ' |'"


@query(
    "risk_markdown",
    f"""{_RISK_SQL} select cast(line_no as bigint) as line_no, line from (select 1 as line_no, '# Battery Security Risk Register' as line union all select 2, ''
    union all select 3, '| Asset | Threat | Likelihood | Impact | Criticality | Risk Score | Owner | Recommended Owner | Status |'
    union all select 4, '|---|---|---:|---:|---:|---:|---|---|---|'
    union all select 4 + position, {_MD_ROW.format("asset, threat, likelihood, impact, criticality, risk_score, owner, recommended_owner, status")} from p) z""",
)
def _(spark, sf):
    path = scratch(spark, "register")
    sinks.write_lines(sinks.risk_markdown(risk.ranked(_risks(spark, sf))), path)
    return _lines(spark, path)


@query(
    "controls_markdown",
    f"""{_RISK_SQL} select cast(line_no as bigint) as line_no, line from (select 1 as line_no, '# Battery Security Controls Plan' as line union all select 2, ''
    union all select 3, '| Asset | Threat | Owner | Action | Due By |' union all select 4, '|---|---|---|---|---|'
    union all select 4 + position, {_MD_ROW.format(f"asset, threat, recommended_owner, '{risk.ACTION}', 'TBD'")} from p where position <= 20) z""",
)
def _(spark, sf):
    path = scratch(spark, "controls")
    sinks.write_lines(sinks.controls_markdown(risk.controls_plan(_risks(spark, sf))), path)
    return _lines(spark, path)


# --- readiness ---------------------------------------------------------------------

_GATE_SQL = f"""{_DENSE_CHECKED}, i as ({_INTERVAL}),
v as (
  select 'integrity_flagged_share' as gate, (select avg(case when {_ANY} then 1e0 else 0e0 end) from checked) as value, 0.0 as threshold, true as at_most
  union all select 'timestamps_in_order', (select count(*) from checked where timestamp_reorder), 0.0, true
  union all select 'duplicate_ratio', (select max(x) from (select avg(case when duplicate_row then 1e0 else 0e0 end) as x from checked group by device) y), 0.01, true
  union all select 'interval_width', (select avg(pi_width) from i), 0.1, true
  union all select 'interval_coverage', (select {_COVERED} from i), 0.9, false
  union all select 'r2', (select 1 - avg(residual * residual) / var_pop(y_true) from i), 0.5, false
  union all select 'mae', (select avg(abs(residual)) from i), 0.05, true)
select gate, cast(value as double) as value, cast(threshold as double) as threshold,
  case when at_most then value <= threshold else value >= threshold end as passed from v"""


@query("rollout_gates", _GATE_SQL, "value threshold")
def _(spark, sf):
    return readiness.gates(tallied=_tally(spark, sf), predictions=_intervals(spark, sf))


@query(
    "rollout_gates_drift_risk",
    f"""{_drift_sql()}, r as (select case when s_suppkey % 4 = 0 then 'Team' else 'unassigned' end as owner,
      coalesce(case when s_suppkey % 7 > 0 then 1 + s_suppkey % 5 end, 3) as criticality from supplier)
    select 'drifted_features' as gate, cast(count(*) as double) as value, 0e0 as threshold, count(*) = 0 as passed
    from d where quantile_shift > 0.05
    union all select 'unowned_high_risk', cast(count(*) as double), 0e0, count(*) = 0 from r
    where owner = 'unassigned' and 20 * greatest(1, criticality - 1) >= 40""",
)
def _(spark, sf):
    rows = risk.register(_assets(spark, sf), [(0, "Unowned threat", 4, 5, None)])
    return readiness.gates(shifts=_shifts(spark, sf), risks=rows)


@query(
    "stage_summary",
    f"""{_DENSE_CHECKED} select 'pass' as status, 'soh_train:skipped,telemetry_integrity:ok' as steps,
    cast(count(*) filter (where {_ANY}) as bigint) as flagged_rows from checked""",
)
def _(spark, sf):
    report = integrity.report(_tally(spark, sf), LIMITS)
    out = readiness.summarise(
        [readiness.stage(spark, "telemetry_integrity", report), readiness.stage(spark, "soh_train", None, "no label")]
    )
    steps = F.transform("steps", lambda s: F.concat_ws(":", s["stage"], s["status"]))
    flagged = F.get_json_object(F.col("steps")[1]["report"], "$.flagged_rows").cast("bigint")
    return out.select("status", F.array_join(steps, ",").alias("steps"), flagged.alias("flagged_rows"))


# --- trained models (no SQL counterpart) -------------------------------------------

def _labelled_faults(spark, sf, classes: int) -> DataFrame:
    """Fault features labelled by rule: cycles that end warmer or swing faster than the average one."""
    rows = _fault(spark, sf).withColumn("sample_id", F.concat_ws("/", "device", F.col("cycle").cast("string")))
    means = rows.agg(F.struct(F.avg("terminal_temp").alias("t"), F.avg("voltage_gradient").alias("g"))).scalar()
    rows = rows.withColumn("_m", means)
    warm, swift = F.col("terminal_temp") > F.col("_m.t"), F.col("voltage_gradient") > F.col("_m.g")
    label = F.when(warm, "thermal").otherwise("normal")
    if classes == 3:
        label = F.when(warm & swift, "both").when(warm | swift, "one").otherwise("normal")
    return rows.withColumn("fault", label).drop("device", "cycle", "max_abs_temp_rate", "_m")


_FITTED: dict[tuple, object] = {}


def _once(spark, *what, fit):
    """A model that several queries of one session use is fitted once, at its documented size."""
    key = (spark.sparkContext.applicationId, *what)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]


def _fault_run(spark, sf, classes=2):
    return _once(spark, "fault", sf, classes, fit=lambda: models.fit_fault(_labelled_faults(spark, sf, classes), "fault", "sample_id"))


@query("fault_model_metrics")
def _(spark, sf):
    return _fault_run(spark, sf).metrics()


@query("fault_model_multiclass_metrics")
def _(spark, sf):
    return _fault_run(spark, sf, 3).metrics()


@query("fault_model_predictions")
def _(spark, sf):
    rows = _fault_run(spark, sf, 3).predictions
    return rows.select("sample_id", "true_label", "predicted_label", F.array_max("probability").alias("max_prob"))


@query("fault_model_attributions")
def _(spark, sf):
    run = _fault_run(spark, sf)
    return attribution.top(run.model.explain(run.predictions))


@query("fault_model_attributions_multiclass")
def _(spark, sf):
    run = _fault_run(spark, sf, 3)
    return attribution.top(run.model.explain(run.predictions))


@query("fault_model_prompts")
def _(spark, sf):
    run = _fault_run(spark, sf)
    rows = attribution.top(run.model.explain(run.predictions, toward="predicted"))
    return prompts.compose(rows, tables.MECHANISMS).select("sample_id", "format", "prompt")


_SAMPLES_SQL = f"""{_FAULT_SQL}, f as (select concat_ws('/', device, cast(cycle as varchar)) as sample_id, terminal_temp,
  case when terminal_temp > (select avg(terminal_temp) from fault) then 'thermal' else 'normal' end as y from fault),
s as (select *, row_number() over (partition by y order by md5(concat_ws('#', sample_id, '42'))) <= round(0.2 * count(*) over (partition by y)) as is_test from f)"""


@query(
    "fault_model_counts",
    f"""{_SAMPLES_SQL} select count(*) filter (where not is_test) as n_train, count(*) filter (where is_test) as n_test,
    cast(10 as int) as n_features, cast(0.2 as double) as test_size from s""",
)
def _(spark, sf):
    return _fault_run(spark, sf).metrics().select("n_train", "n_test", "n_features", "test_size")


@query(
    "fault_model_artifacts",
    f"""{_SAMPLES_SQL}, n as (select count(*) filter (where is_test) as tests from s)
    select artifact, true as present, cast(case artifact when 'attributions' then 8 * tests when 'importance' then 10
      when 'metrics' then 1 when 'model' then 1 else tests end as bigint) as rows
    from n, unnest(['attributions', 'importance', 'metrics', 'model', 'predictions', 'prompts']) u(artifact)
    union all select 'prompt_pack', true, tests from n""",
)
def _(spark, sf):
    path = scratch(spark, "fault-job")
    job = workflow.run_fault(_labelled_faults(spark, sf, 2), "fault", "sample_id", fitted=_fault_run(spark, sf))
    present = workflow.write_fault(job, path)
    made = {n: spark.read.parquet(f"{path}/{n}") for n in ("attributions", "importance", "predictions")}
    made |= {n: spark.read.json(f"{path}/{n}") for n in ("metrics", "prompts")}
    made |= {"model": spark.read.json(f"{path}/model/manifest"), "prompt_pack": spark.read.text(f"{path}/prompt_pack").filter("value = '---'")}
    counts = None
    for name, table in made.items():
        one = table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("artifact"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return present.join(counts, "artifact")


@query(
    "saved_fault_model_scores",
    f"""{_SAMPLES_SQL} select count(*) filter (where is_test) as rows, count(*) filter (where is_test) as same_label,
    0e0 as largest_difference from s""",
)
def _(spark, sf):
    run, path = _fault_run(spark, sf), scratch(spark, "saved-fault")
    store.save_fault(spark, run.model, path)
    again = store.load_fault(spark, path).predict(run.rows.filter("is_test"), ("sample_id",))
    pick = lambda df, c: df.select("sample_id", F.col("predicted_label").alias(f"label_{c}"), F.col("probability").alias(f"p_{c}"))
    both = pick(run.predictions, "a").join(pick(again, "b"), "sample_id")
    apart = F.array_max(F.zip_with("p_a", "p_b", lambda a, b: F.abs(a - b)))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("label_a") == F.col("label_b")).alias("same_label"), F.max(apart).alias("largest_difference"))


# --- models of one split, which SQL can fit as well ---------------------------------

# a twelve-valued feature; the label leans on it, with noise from the key
_STUMP_ROWS = """select o_orderkey as sample_id, cast(o_orderkey * 31 % 12 as double) as k, (o_orderkey * 7919) % 100 as noise from orders"""
_STUMP_FAULT = f"""select sample_id, k, case when noise < case when k < 5 then 22e0 else 71e0 end then 'worn' else 'fine' end as fault from ({_STUMP_ROWS}) s"""
_STUMP_SOH = f"""select sample_id, k, case when k < 8 then 0.9e0 else 0.7e0 end + noise / 1000e0 as soh from ({_STUMP_ROWS}) s"""


def _stump_rows(spark, sf, text: str) -> DataFrame:
    return spark.sql(text.replace("from orders", f"from parquet.`{sf}/orders.parquet`"))


def _stump_sql(name: str, weight: str, target: str) -> str:
    """The split of ``train`` that removes most variance, and the means on its two sides."""
    return f"""{name}_v as (select k, sum({weight}) as w, sum({weight} * {target}) as s from train where {weight} > 0 group by k),
    {name}_c as (select k, lead(k) over (order by k) as up, sum(w) over (order by k) as lw, sum(s) over (order by k) as ls,
      sum(w) over () as tw, sum(s) over () as ts from {name}_v),
    {name} as (select (k + up) / 2 as cut, ls / lw as low, (ts - ls) / (tw - lw) as high, lw / tw as share, ts / tw as mean from {name}_c
      where up is not null order by ls * ls / lw + (ts - ls) * (ts - ls) / (tw - lw) desc limit 1)"""


@query(
    "fault_stump_predictions",
    f"""with t as ({_STUMP_FAULT}),
    h as (select *, row_number() over (partition by fault order by md5(concat_ws('#', cast(sample_id as varchar), '42')))
      <= round(0.2 * count(*) over (partition by fault)) as is_test, case when fault = 'worn' then 1e0 else -1e0 end as y from t),
    train as (select * from h where not is_test), {_stump_sql("m", "1e0", "y")},
    p as (select sample_id, fault as true_label, case when k <= cut then low else high end as margin, mean from h, m where is_test)
    select sample_id, true_label, case when margin > 0 then 'worn' else 'fine' end as predicted_label, 1 / (1 + exp(-2 * margin)) as p_worn,
      margin - mean as shap_value from p""",
    "p_worn shap_value",
)
def _(spark, sf):
    rows = _stump_rows(spark, sf, _STUMP_FAULT)
    run = models.fit_fault(rows, "fault", "sample_id", features=["k"], model_kwargs={"maxIter": 1, "maxDepth": 1})
    explained = run.model.explain(run.predictions).select("sample_id", "shap_value")
    said = run.predictions.select("sample_id", "true_label", "predicted_label", F.col("probability")[1].alias("p_worn"))
    return said.join(explained, "sample_id")


@query(
    "fault_stump_nodes",
    f"""with t as ({_STUMP_FAULT}),
    h as (select *, row_number() over (partition by fault order by md5(concat_ws('#', cast(sample_id as varchar), '42')))
      <= round(0.2 * count(*) over (partition by fault)) as is_test, case when fault = 'worn' then 1e0 else -1e0 end as y from t),
    train as (select * from h where not is_test), {_stump_sql("m", "1e0", "y")}, n as (select count(*) as n from train)
    select 0 as node, 1 as "left", 2 as "right", cut as threshold, mean as value, n as cover from m, n
    union all select 1, -1, -1, null, low, cast(round(n * share) as bigint) from m, n
    union all select 2, -1, -1, null, high, n - cast(round(n * share) as bigint) from m, n""",
    "threshold value",
)
def _(spark, sf):
    rows = _stump_rows(spark, sf, _STUMP_FAULT)
    run = models.fit_fault(rows, "fault", "sample_id", features=["k"], model_kwargs={"maxIter": 1, "maxDepth": 1})
    nodes = trees.node_table(spark, run.model.fitted)
    inner = F.col("left") >= 0
    return nodes.select("node", "left", "right", F.when(inner, F.col("threshold")).alias("threshold"), "value", "cover")


_REFITS = 3


def _stump_soh_sql(final: str) -> str:
    u = "('0x' || substr(md5(concat_ws('#', cast(sample_id as varchar), '{k}')), 1, 13))::ubigint"
    times = lambda k: "(" + " + ".join(f"case when {u.format(k=k)} / 4503599627370496e0 >= {c!r} then 1e0 else 0e0 end" for c in models.POISSON) + ")"
    draws = ", ".join(f"{times(142 + k)} as w{k}" for k in range(_REFITS))
    fits = ", ".join(_stump_sql(f"m{k}", f"w{k}", "soh") for k in range(_REFITS))
    said = ", ".join(f"case when k <= m{k}.cut then m{k}.low else m{k}.high end as b{k}" for k in range(_REFITS))
    mean = "(" + " + ".join(f"b{k}" for k in range(_REFITS)) + f") / {_REFITS}"
    square = " + ".join(f"(b{k} - centre) * (b{k} - centre)" for k in range(_REFITS))
    return f"""with t as ({_STUMP_SOH}),
    h as (select *, row_number() over (order by {u.format(k=42)}) <= ceil(0.25 * count(*) over ()) as is_test from t),
    train as (select *, 1e0 as w, {draws} from h where not is_test), {_stump_sql("m", "w", "soh")}, {fits},
    p as (select sample_id, soh as y_true, case when k <= m.cut then m.low else m.high end as y_pred, {said}
      from h, m, {', '.join(f'm{k}' for k in range(_REFITS))} where is_test),
    q as (select *, {mean} as centre from p), r as (select *, sqrt(({square}) / {_REFITS}) as spread from q)
    {final}"""


def _stump_soh(spark, sf):
    fit = lambda: models.fit_soh(
        _stump_rows(spark, sf, _STUMP_SOH), "soh", "sample_id", features=["k"], model="gb", n_trees=2, max_depth=1, n_bootstrap=_REFITS)
    return _once(spark, "stump", sf, fit=fit)


@query(
    "soh_stump_predictions",
    _stump_soh_sql("""select sample_id, y_true, y_pred, 0e0 as tree_std, centre as bootstrap_mean, spread as bootstrap_std, spread as uncertainty,
      centre - 1.96 * spread as y_pi_lower_95, centre + 1.96 * spread as y_pi_upper_95 from r"""),
    "y_true y_pred bootstrap_mean bootstrap_std uncertainty y_pi_lower_95 y_pi_upper_95",
)
def _(spark, sf):
    return _stump_soh(spark, sf).predictions.drop("pi_width", "residual")


@query(
    "soh_stump_metrics",
    _stump_soh_sql(f"""select (select count(*) from h) as n_rows, count(*) as n_test, avg(abs(y_pred - y_true)) as mae,
      sqrt(avg((y_pred - y_true) * (y_pred - y_true))) as rmse, {_REFITS} as bootstrap_reps,
      avg(case when y_true between centre - 1.96 * spread and centre + 1.96 * spread then 1e0 else 0e0 end) as test_pi_coverage_95 from r"""),
    "mae rmse test_pi_coverage_95",
)
def _(spark, sf):
    return _stump_soh(spark, sf).metrics().select("n_rows", "n_test", "test.mae", "test.rmse", "bootstrap_reps", "test_pi_coverage_95")


@query(
    "soh_stump_target_scores",
    _stump_soh_sql("""select l_orderkey * 10 + l_linenumber as sample_id, l_discount as y_true,
      case when l_linenumber * 3 <= m.cut then m.low else m.high end as y_pred from lineitem, m"""),
    "y_true y_pred",
)
def _(spark, sf):
    target = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row"), (F.col("l_linenumber") * 3.0).alias("k"), F.col("l_discount").alias("other"))
    return models.score_target(_stump_soh(spark, sf), target, "row", "other")


@query("soh_stump_importance", "select distinct 'k' as feature, 1e0 as importance from orders")
def _(spark, sf):
    return _stump_soh(spark, sf).model.importance(spark)


@query("fault_model_nodes")
def _(spark, sf):
    return trees.node_table(spark, _fault_run(spark, sf).model.fitted)


def _soh_table(spark, sf) -> DataFrame:
    rows = cycles.soh_labels(_soh(spark, sf))
    return rows.withColumn("sample_id", F.concat_ws("/", "device", F.col("cycle").cast("string")))


def _soh_run(spark, sf, model="rf"):
    return _once(spark, "soh", sf, model, fit=lambda: _fit_soh(spark, sf, model))


def _fit_soh(spark, sf, model):
    return models.fit_soh(
        _soh_table(spark, sf),
        "soh_proxy",
        "sample_id",
        group="device",
        model=model,
    )


def _draws_sql() -> str:
    u = "('0x' || substr(md5(concat_ws('#', cast(o_orderkey as varchar), '{k}')), 1, 13))::ubigint / 4503599627370496e0"
    times = " + ".join(f"case when u >= {c!r} then 1e0 else 0e0 end" for c in models.POISSON)
    parts = " union all ".join(f"select o_orderkey, {k} as seed, {u.format(k=k)} as u from orders" for k in (142, 143))
    return f"select o_orderkey, seed, {times} as weight from ({parts}) d"


@query("bootstrap_draws", _draws_sql())
def _(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    one = [orders.select("o_orderkey", F.lit(k).alias("seed"), models.bootstrap_weight("o_orderkey", k).alias("weight")) for k in (142, 143)]
    return one[0].unionByName(one[1])


@query("soh_model_predictions")
def _(spark, sf):
    return _soh_run(spark, sf).predictions


@query("soh_model_metrics")
def _(spark, sf):
    return _soh_run(spark, sf).metrics().select("*", "test.*").drop("test")


@query("soh_model_boosted_predictions")
def _(spark, sf):
    return _soh_run(spark, sf, "gb").predictions


@query("soh_model_importance")
def _(spark, sf):
    return _soh_run(spark, sf).model.importance(spark)


@query("soh_model_target_scores")
def _(spark, sf):
    run = _soh_run(spark, sf)
    other = _soh_table(spark, sf).withColumn("voltage_mean", F.col("voltage_mean") + 0.2)
    return models.score_target(run, other, "sample_id", "soh_proxy")


@query("field_workflow")
def _(spark, sf):
    run = workflow.run(
        spark,
        _cycles(spark, sf),
        assets=_assets(spark, sf),
        target=_soh_table(spark, sf),
        integrity_limits=LIMITS,
        soh_limits=SOH,
    )
    return run.summary.select(F.col("status").alias("overall"), F.explode("steps").alias("s")).select("overall", "s.*")


# --- live checks -------------------------------------------------------------------


def _stream(spark, sf, name: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    # as a pattern, so that the table may be one file, which a stream cannot take as its folder, or a folder of them
    events = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    return views.over(spark, events, name)


@query(
    "live_window_counts",
    f"""with t as ({views.duckdb('telemetry_dense')}),
    i as (select t_us - t_us % 21600000000 as window_start_us, device, t_us, count(*) as n, min(voltage) as vl,
          max(voltage) as vh, min(current) as cl, max(current) as ch, min(temperature) as tl, max(temperature) as th
          from t group by device, t_us),
    g as (select window_start_us, device, cast(sum(n) as bigint) as rows,
          cast(sum(case when n > 1 then n else 0 end) as bigint) as duplicate_rows, min(vl) as voltage_min,
          min(cl) as current_min, min(tl) as temperature_min, max(vh) as voltage_max, max(ch) as current_max,
          max(th) as temperature_max from i group by window_start_us, device)
    select * from g""",
)
def _(spark, sf):
    return live.drain_windows(_stream(spark, sf, "telemetry_dense"), "6 hours")


@query("live_distinct_packets", f"with t as ({views.duckdb('telemetry_dense')}) select distinct device, t_us from t")
def _(spark, sf):
    rows = live.distinct_packets(_stream(spark, sf, "telemetry_dense"))
    return live.drain(rows, "packets").select("device", "t_us")


@query(
    "live_arrival_flags",
    f"""with t as ({views.duckdb('telemetry_unordered')}),
    a as (select *, lag(t_us) over w as pt, lag(voltage) over w as pv, lag(current) over w as pi, lag(temperature) over w as pk
          from t window w as (partition by device order by seq))
    select seq, device, coalesce(t_us < pt, false) as timestamp_reorder, coalesce(abs(voltage - pv) > 3, false) as voltage_jump,
      coalesce(abs(current - pi) > 0.5, false) as current_jump, coalesce(abs(temperature - pk) > 8, false) as temp_jump from a""",
)
def _(spark, sf):
    # three files of rising arrival order, a batch each
    rows, path = views.view(spark, sf, "telemetry_unordered"), scratch(spark, "arriving")
    third = 1_000_003 * 1_000_003 // 3
    part = F.when(F.col("seq") < third, 0).when(F.col("seq") < 2 * third, 1).when(F.col("seq").isNotNull(), 2)
    for k in range(3):
        rows.filter(part == k).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    flags = live.drain_arrivals(stream, LIMITS)
    return flags.drop("t_us", "voltage", "current", "temperature")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["integrity_severity"](spark, sf_dir)
