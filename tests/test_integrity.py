from __future__ import annotations

import random
from collections import Counter, defaultdict
from statistics import median

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import telemetry
from packtrace.operators import integrity
from packtrace.spec import IntegrityLimits, Skew

TIGHT = Skew(rows_per_task=20, per_chunk=4)


def _fired(df, limits=IntegrityLimits(), **options):
    rows = integrity.checks(df, limits, **options).collect()
    return {r: {row["seq"] for row in rows if row[r]} for r in integrity.REASONS if rows and r in rows[0]}


def test_flatline_starts_at_sample_window_plus_one(spark):
    df = telemetry(spark, [{"t": i, "voltage": 3.7, "current": 1.0} for i in range(23)])
    assert _fired(df)["flatline"] == {20, 21, 22}


def test_missing_reading_breaks_a_flatline(spark):
    rows = [{"t": i, "voltage": None if i == 10 else 3.7, "current": 1.0} for i in range(25)]
    assert _fired(telemetry(spark, rows))["flatline"] == set()


@pytest.mark.parametrize("copies,flagged", [(2, False), (3, True)])
def test_replay_needs_more_than_two_copies(spark, copies, flagged):
    rows = [{"t": 5, "voltage": 3.5, "current": 1.0}] * copies + [{"t": 9, "voltage": 3.6, "current": 1.0}]
    fired = _fired(telemetry(spark, rows))
    assert fired["replay_pattern"] == (set(range(copies)) if flagged else set())
    assert fired["duplicate_row"] == set(range(copies))


def test_payload_replay_ignores_time(spark):
    rows = [{"t": i, "voltage": 3.5, "current": 1.0} for i in range(3)]
    assert _fired(telemetry(spark, rows), replay_on="payload")["replay_pattern"] == {0, 1, 2}
    assert _fired(telemetry(spark, rows))["replay_pattern"] == set()


def test_reorder_is_judged_in_arrival_order(spark):
    df = telemetry(spark, [{"t": 1}, {"t": 5}, {"t": 3}, {"t": 6}])
    assert _fired(df)["timestamp_reorder"] == {2}


def test_gap_is_strict_and_needs_a_median(spark):
    df = telemetry(spark, [{"t": t} for t in (0, 1, 2, 3, 6, 10)])
    assert _fired(df)["gap"] == {5}
    assert _fired(telemetry(spark, [{"t": 1}, {"t": 1}]))["gap"] == set()


def test_jumps_are_strict_and_skip_missing(spark):
    rows = [{"t": i, "voltage": v, "current": 0.0, "temperature": 20.0} for i, v in enumerate([1.0, 4.0, None, 9.0, 12.5])]
    assert _fired(telemetry(spark, rows))["voltage_jump"] == {4}


def test_devices_do_not_mix(spark):
    rows = [{"t": 0, "voltage": 1.0, "device": "a"}, {"t": 1, "voltage": 9.0, "device": "b"}]
    assert _fired(telemetry(spark, rows))["voltage_jump"] == set()


def test_reasons_keep_their_order_and_report_counts(spark):
    rows = [{"t": 5, "voltage": 0.0, "current": 0.0}, {"t": 5, "voltage": 9.0, "current": 99.0}, {"t": 6, "device": None}]
    df = telemetry(spark, rows)
    checked = integrity.checks(df)
    flagged = {r["seq"]: r for r in integrity.flagged(checked).collect()}
    assert flagged[1]["reasons"] == ["duplicate_row", "voltage_jump", "current_jump"]
    assert flagged[1]["asset_id"] == "a" and flagged[1]["flagged"]
    report = integrity.report(integrity.tally(checked), source=df).first()
    assert (report["rows_total"], report["flagged_rows"], report["rows_null_device"]) == (3, 2, 1)
    assert report["severity"]["duplicate_row"] == 2 and report["severity"]["flatline"] == 0


def test_empty_input_reports_zero(spark):
    tally = integrity.tally(integrity.checks(telemetry(spark, [])))
    report = integrity.report(tally).first()
    assert report["rows_total"] == 0 and report["severity"]["gap"] == 0
    assert integrity.severity(tally).count() == 8


def _by_hand(rows, limits):
    """The rules, one device at a time in plain Python."""
    out = defaultdict(set)
    devices = defaultdict(list)
    for row in rows:
        devices[row["device"]].append(row)
    for mine in devices.values():
        arrival = sorted(mine, key=lambda r: r["seq"])
        for a, b in zip(arrival, arrival[1:]):
            if b["t_us"] < a["t_us"]:
                out["timestamp_reorder"].add(b["seq"])
        line = sorted(mine, key=lambda r: (r["t_us"], r["seq"]))
        instants = Counter(r["t_us"] for r in line)
        sig = Counter((r["t_us"], str([r[c] for c in ("voltage", "current", "temperature") if r[c] is not None])) for r in line)
        steps = [b["t_us"] - a["t_us"] for a, b in zip(line, line[1:])]
        middle = median([s for s in steps if s]) if any(steps) else None
        run = 0
        for i, row in enumerate(line):
            if instants[row["t_us"]] > 1:
                out["duplicate_row"].add(row["seq"])
            if sig[(row["t_us"], str([row[c] for c in ("voltage", "current", "temperature") if row[c] is not None]))] > 2:
                out["replay_pattern"].add(row["seq"])
            if not i:
                continue
            prev = line[i - 1]
            if middle and steps[i - 1] > limits.gap_multiplier * middle:
                out["gap"].add(row["seq"])
            for reason, c, limit in (
                ("voltage_jump", "voltage", limits.voltage_jump),
                ("current_jump", "current", limits.current_jump),
                ("temp_jump", "temperature", limits.temp_jump),
            ):
                if row[c] is not None and prev[c] is not None and abs(row[c] - prev[c]) > limit:
                    out[reason].add(row["seq"])
            flat = all(row[c] is not None and row[c] == prev[c] for c in ("voltage", "current"))
            run = run + 1 if flat else 0
            if run >= limits.flatline_window:
                out["flatline"].add(row["seq"])
    return out


reading = st.one_of(st.none(), st.integers(0, 3).map(float))
packet = st.fixed_dictionaries(
    {
        "device": st.sampled_from(["a", "a", "a", "b"]),
        "t_us": st.integers(0, 30).map(lambda t: t * 1_000_000),
        "voltage": reading,
        "current": reading,
        "temperature": reading,
    }
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(st.lists(packet, min_size=5, max_size=120))
def test_rules_match_a_plain_loop(spark, rows):
    limits = IntegrityLimits(voltage_jump=1.0, current_jump=1.0, temp_jump=2.0, flatline_window=2, gap_multiplier=1.5)
    rows = [{"seq": i, **r} for i, r in enumerate(rows)]
    want = _by_hand(rows, limits)
    fired = _fired(telemetry(spark, rows), limits)
    assert {r: fired[r] for r in integrity.REASONS} == {r: want[r] for r in integrity.REASONS}


@pytest.mark.parametrize("us, arrivals", [(1, 1), (3_000_000, 7), (10_000_000, 50), (10**9, 1000)])
def test_segments_match_a_plain_loop(spark, us, arrivals):
    """Segments of one instant, of a few readings, and of everything; flat runs and gaps cross borders."""
    rng = random.Random(us)
    rows, t = [], 0
    for i in range(240):
        t = max(0, t + rng.choice((0, 0, 1, 1, 1, 1, 2, 9, -4)))
        same = rng.random() < 0.75 and rows
        rows.append({
            "seq": i, "device": rng.choice("aaab"), "t_us": t * 1_000_000,
            "voltage": rows[-1]["voltage"] if same else rng.choice((None, 1.0, 2.0)),
            "current": rows[-1]["current"] if same else rng.choice((None, 1.0)), "temperature": rng.choice((None, 20.0, 25.0)),
        })
    limits = IntegrityLimits(voltage_jump=0.5, current_jump=0.5, temp_jump=2.0, flatline_window=4, gap_multiplier=1.5)
    want = _by_hand(rows, limits)
    skew = Skew(segment_us=us, segment_seq=arrivals)
    fired = _fired(telemetry(spark, rows).repartition(3), limits, skew=skew)
    assert {r: fired[r] for r in integrity.REASONS} == {r: want[r] for r in integrity.REASONS}
    payload = lambda s: _fired(telemetry(spark, rows), limits, skew=s, replay_on="payload", only=["replay_pattern"])
    assert payload(skew) == payload(Skew())


def test_hot_device_and_hot_copies_match_a_plain_loop(spark):
    rng = random.Random(5)
    rows = []
    for i in range(260):
        copy = rng.random() < 0.4
        rows.append(
            {
                "seq": i,
                "device": "hot" if rng.random() < 0.8 else "cold",
                "t_us": 7_000_000 if copy else rng.randrange(40) * 1_000_000,
                "voltage": 2.0 if copy else float(rng.randrange(4)),
                "current": 1.0,
                "temperature": 20.0 if copy else float(rng.randrange(30)),
            }
        )
    limits = IntegrityLimits(voltage_jump=1.0, temp_jump=10.0, flatline_window=2, gap_multiplier=1.5)
    want = _by_hand(rows, limits)
    fired = _fired(telemetry(spark, rows), limits, skew=TIGHT)
    assert {r: fired[r] for r in integrity.REASONS} == {r: want[r] for r in integrity.REASONS}


def test_row_order_and_partitioning_do_not_matter(spark, sf_dir):
    from helpers import same_rows
    from packtrace.plans import views

    df = views.view(spark, sf_dir, "telemetry_dense")
    limits = IntegrityLimits(current_jump=0.5, flatline_window=3)
    mixed = df.orderBy(F.rand(3)).repartition(7)
    assert same_rows(integrity.checks(df, limits), integrity.checks(mixed, limits))


def test_flags_are_monotone_in_thresholds(spark, sf_dir):
    from packtrace.plans import views

    df = views.view(spark, sf_dir, "telemetry_dense")
    loose = _fired(df, IntegrityLimits(current_jump=1.5, flatline_window=5, gap_multiplier=4))
    tight = _fired(df, IntegrityLimits(current_jump=0.5, flatline_window=3, gap_multiplier=2))
    for reason in ("current_jump", "flatline", "gap"):
        assert loose[reason] <= tight[reason]
