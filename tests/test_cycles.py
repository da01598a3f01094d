from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from helpers import same_rows, telemetry
from packtrace.operators import cycles, segments
from packtrace.plans import views
from packtrace.spec import FaultLimits, Skew, SohLimits

TIGHT = Skew(rows_per_task=4, per_chunk=2)

# time, voltage, current, temperature, soc
SIX = [(0, 3.0, -1.0, 20.0, 0.9), (10, 3.1, -1.0, 21.0, 0.8), (20, 3.3, -2.0, 21.0, 0.7),
       (30, 3.3, -2.0, 24.0, 0.6), (40, 3.2, -1.0, 23.0, 0.5), (60, 3.6, -3.0, 25.0, 0.4)]


def _six(spark):
    names = ("t", "voltage", "current", "temperature", "soc")
    return telemetry(spark, [{**dict(zip(names, r)), "capacity": 2.0} for r in SIX])


def test_soh_features_by_hand(spark):
    got = cycles.soh_features(_six(spark), SohLimits(cc_slope=0.015, cv_slope=0.003)).first()
    dt = [10, 10, 10, 10, 20]
    current = [r[2] for r in SIX]
    volts = [r[1] for r in SIX]
    charge = [-0.5 * (current[k] + current[k + 1]) * dt[k] / 3600 for k in range(5)]
    assert got["capacity_ah"] == pytest.approx(sum(charge))
    power = [v * i for v, i in zip(volts, current)]
    assert got["energy_wh"] == pytest.approx(sum(0.5 * (power[k] + power[k + 1]) * dt[k] for k in range(5)) / 3600)
    assert got["time_span_sec"] == 60 and got["cycle_points"] == 6 and got["time_unique_points"] == 6
    # slopes .01 .02 0 .01 .02
    assert got["cc_ratio"] == pytest.approx(3 / 5)
    # 0.9 quantile of voltage is 3.45: only the last row reaches it, and it starts no pair
    assert got["cv_ratio"] is None
    # curve: intervals 2..5 without the flat one
    curve = {k: abs(charge[k] / (volts[k + 1] - volts[k])) for k in (1, 3, 4)}
    best = max(curve, key=curve.get)
    assert got["dqdv_peak_abs"] == pytest.approx(curve[best])
    assert got["dqdv_peak_q"] == pytest.approx(sum(charge[:best]) + charge[best] / 2)
    assert got["dqdv_mean_abs"] == pytest.approx(sum(curve.values()) / 3)
    assert got["dqdv_spread_v"] == pytest.approx(3.4 - 3.2)
    assert got["resistance_proxy"] == pytest.approx(0.2)
    assert got["temp_max_abs_rate"] == pytest.approx(0.3) and got["temp_mean_abs_rate"] == pytest.approx(0.6 / 5)
    assert (got["terminal_voltage"], got["terminal_temp"], got["terminal_soc"]) == (3.6, 25.0, 0.4)
    assert got["terminal_ohmic_proxy"] == 25.0 and got["soc_span"] == pytest.approx(0.5)
    mean = sum(volts) / 6
    assert got["voltage_std"] == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in volts) / 6))


def test_missing_current_voids_the_integrals_only(spark):
    df = _six(spark).withColumn("current", F.when(F.col("seq") != 2, F.col("current")))
    got = cycles.soh_features(df).first()
    assert got["capacity_ah"] is None and got["energy_wh"] is None
    assert got["voltage_mean"] is not None and got["dqdv_peak_abs"] is not None


def test_single_row_cycle_keeps_only_its_size(spark):
    got = cycles.soh_features(telemetry(spark, [{"t": 1, "voltage": 3.0}])).first()
    assert got["cycle_points"] == 1
    assert all(got[c] is None for c in cycles.SOH_FEATURES[1:])


def test_same_instant_counts_as_flat_for_voltage_but_not_for_temperature_rates(spark):
    rows = [{"t": t, "voltage": v, "temperature": c} for t, v, c in ((0, 1.0, 10.0), (0, 2.0, 12.0), (10, 3.0, 13.0))]
    df = telemetry(spark, rows)
    fault = cycles.fault_features(df).first()
    assert fault["voltage_gradient"] == pytest.approx(0.05) and fault["cc_phase_ratio"] == pytest.approx(0.5)
    assert fault["max_temp_rate"] == pytest.approx(0.05) and fault["max_abs_temp_rate"] == pytest.approx(0.1)
    soh = cycles.soh_features(df).first()
    assert soh["temp_mean_abs_rate"] == pytest.approx(0.1)


def test_fault_features_by_hand(spark):
    rows = [{"t": i * 10, "voltage": v, "pack_voltage": 10.0, "cell_voltage": v, "soc": s, "temperature": 20.0 + i}
            for i, (v, s) in enumerate([(3.2, 0.5), (3.0, 0.7), (3.4, 0.6), (3.5, 0.4), (3.6, 0.3), (2.0, 0.2)])]
    got = cycles.fault_features(telemetry(spark, rows), FaultLimits(cc_slope=0.02)).first()
    assert got["initial_min_voltage"] == 3.0  # ceil(0.2 * 6) = 2 rows
    assert got["soc_max"] == 0.7 and got["cycle_number"] == 0.0 and got["terminal_temp"] == 25.0
    assert got["cc_phase_ratio"] == pytest.approx(2 / 5)
    assert got["voltage_correlation"] is None  # a constant pack voltage is no error
    assert got["pack_cell_voltage_ratio"] == pytest.approx(10 / (18.7 / 6))


def test_optional_columns_may_be_absent(spark):
    got = cycles.fault_features(telemetry(spark, [{"t": t, "voltage": 3.0} for t in range(4)])).first()
    assert got["voltage_gradient"] == 0.0
    assert got["pack_cell_voltage_ratio"] is None and got["max_temp_diff"] is None and got["soc_max"] is None


def test_trend_and_proxy_start_with_the_first_cycle(spark):
    rows = [{"t": c, "cycle": c, "capacity": None if c == 0 else 2.0 - 0.1 * c} for c in range(8)]
    rows += [{"t": c + 0.5, "cycle": c} for c in range(8)]
    got = cycles.soh_labels(cycles.soh_features(telemetry(spark, rows))).orderBy("cycle").collect()
    assert got[0]["soh_proxy"] is None and got[1]["soh_proxy"] == pytest.approx(1.0)
    assert [r["soh_trend_5"] is None for r in got] == [True] * 5 + [False] * 3
    assert got[7]["soh_trend_5"] == pytest.approx(-0.1 / 1.9)


@pytest.mark.parametrize("keys", [("device", "cycle"), ("cycle",)])
def test_chunked_cycles_match(spark, sf_dir, keys):
    df = views.view(spark, sf_dir, "telemetry_cycles")
    assert same_rows(cycles.fault_features(df, keys=keys), cycles.fault_features(df, keys=keys, skew=TIGHT))


@pytest.mark.parametrize("us, arrivals", [(1, 1), (3_600_000_000, 3), (10**12, 10**9)])
def test_segments_of_cycles_match(spark, sf_dir, us, arrivals):
    df = views.view(spark, sf_dir, "telemetry_cycles")
    cut = cycles.fault_features(df, skew=Skew(segment_us=us, segment_seq=arrivals))
    assert same_rows(cycles.fault_features(df), cut)


def test_a_cycle_of_one_instant_is_cut_by_arrival(spark):
    rows = [{"t": 5, "seq": i, "voltage": 3.0 + i % 7, "temperature": float(i % 5), "pack_voltage": 1.0 * i, "cell_voltage": 2.0} for i in range(200)]
    rows += [{"t": t, "seq": 1000 + t, "voltage": 4.0, "temperature": 9.0} for t in (1, 2, 8, 9)]
    df = telemetry(spark, rows)
    assert segments.measure(df, TIGHT, ["device", "cycle"]).crowded is not None
    assert same_rows(cycles.fault_features(df), cycles.fault_features(df, skew=TIGHT))


def test_chunked_soh_cycles_match(spark, sf_dir):
    df = views.view(spark, sf_dir, "telemetry_cycles")
    limits = SohLimits(cc_slope=1e-4, cv_slope=1e-4)
    plain = cycles.soh_labels(cycles.soh_features(df, limits))
    cut = cycles.soh_labels(cycles.soh_features(df, limits, skew=TIGHT), segment=2)
    assert same_rows(plain, cut)


@pytest.mark.parametrize("us, arrivals", [(1, 1), (3_600_000_000, 3), (10**12, 10**9)])
def test_segments_of_soh_cycles_match(spark, sf_dir, us, arrivals):
    df = views.view(spark, sf_dir, "telemetry_cycles")
    holes = df.withColumns({c: F.when(F.col("seq") % n != 0, F.col(c)) for c, n in (("voltage", 5), ("current", 7), ("temperature", 3))})
    limits = SohLimits(cc_slope=1e-4, cv_slope=1e-4)
    for rows in (df, holes):
        cut = cycles.soh_features(rows, limits, skew=Skew(segment_us=us, segment_seq=arrivals))
        plan = cut._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "SinglePartition" not in plan
        assert same_rows(cycles.soh_features(rows, limits), cut)


def test_shift_and_stretch(spark):
    df = _six(spark)
    plain = cycles.soh_features(df).first()
    shifted = cycles.soh_features(df.withColumn("voltage", F.col("voltage") + 1)).first()
    slower = cycles.soh_features(df.withColumn("t_us", F.col("t_us") * 2)).first()
    assert shifted["voltage_range"] == pytest.approx(plain["voltage_range"])
    assert shifted["dqdv_peak_abs"] == pytest.approx(plain["dqdv_peak_abs"])
    assert slower["temp_max_abs_rate"] == pytest.approx(plain["temp_max_abs_rate"] / 2)
