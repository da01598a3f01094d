"""Sources, sinks, drift, risk, workflow and plan shapes."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import Observation, functions as F

from helpers import same_rows, telemetry
from packtrace.operators import cycles, drift, integrity, models, readiness, risk
from packtrace.plans import views, workflow
from packtrace.session import durable, scratch
from packtrace.sources import sinks, tables
from packtrace.spec import ColumnSpec, IntegrityLimits, Skew, SohLimits


def _exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)


def test_checks_shuffle_once(spark, sf_dir):
    df = views.view(spark, sf_dir, "telemetry_dense")
    checked = integrity.checks(df, IntegrityLimits())
    assert _exchanges(checked) == ["hashpartitioning"]
    assert _exchanges(integrity.tally(checked)) == ["hashpartitioning"]


def test_segments_move_rows_twice_and_start_no_job(spark, sf_dir):
    df = views.view(spark, sf_dir, "telemetry_dense")
    tracker, group = spark.sparkContext.statusTracker(), "segments"
    spark.sparkContext.setJobGroup(group, group)
    flags = integrity.flag(df, IntegrityLimits(flatline_window=3), skew=Skew(segment_us=3_600_000_000 * 48, segment_seq=500))
    assert not tracker.getJobIdsForGroup(group)
    flags.collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = flags._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") <= 4 and "Python" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan
    moved = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(device#\d+L?, _seg", line)]
    rows = [line for line in plan.splitlines() if "Sort [device" in line and "_seg" in line]
    assert len(moved) >= 2 and rows


def test_cycle_features_shuffle_once(spark, sf_dir):
    df = views.view(spark, sf_dir, "telemetry_cycles")
    assert _exchanges(cycles.fault_features(df)) == ["hashpartitioning"]
    assert _exchanges(cycles.soh_features(df)) == ["hashpartitioning"]


def test_a_narrow_question_reads_few_columns(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = tables.normalise(df, ColumnSpec(time="ts", order="event_id", device="user_id", voltage="value"))
    only = integrity.checks(rows, only=["voltage_jump"]).groupBy("device").agg(F.count_if("voltage_jump"))
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in plan and "props" not in plan


def test_risk_register_needs_no_shuffle(spark):
    rows = risk.register(tables.assets_from_names(spark, "a,b"), tables.threats(spark))
    assert _exchanges(rows) == [] and rows.count() == 20


def test_missing_columns_are_listed_together(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError, match="Missing columns: t, n, v"):
        tables.normalise(df, ColumnSpec(time="t", order="n", voltage="v"))


def test_unreadable_values_become_null_and_bad_times_are_dropped(spark):
    raw = [("2024-01-01 00:00:01", 1, "3.5"), ("nonsense", 2, "3.6"), ("2024-01-01 00:00:02", 3, "NaN"),
           ("2024-01-01 00:00:03", 4, "n/a")]
    df = spark.createDataFrame(raw, "t string, n int, v string")
    rows = tables.normalise(df, ColumnSpec(time="t", order="n", voltage="v")).orderBy("seq").collect()
    assert [(r.seq, r.voltage, r.device) for r in rows] == [(1, 3.5, "all"), (3, None, "all"), (4, None, "all")]
    assert rows[0].t_us == 1_704_067_201_000_000


@pytest.mark.parametrize("unit,value", [("s", 1.5), ("ms", 1500.0), ("us", 1500000.0)])
def test_time_units(spark, unit, value):
    df = spark.createDataFrame([(value, 1)], "t double, n int")
    spec = ColumnSpec(time="t", order="n", time_unit=unit)
    assert tables.normalise(df, spec).first().t_us == 1_500_000


def test_cycles_by_counting_rows(spark):
    df = telemetry(spark, [{"t": i, "device": "ab"[i % 2]} for i in range(10)])
    rows = tables.assign_cycles(df, 2).orderBy("seq").collect()
    assert [r.cycle for r in rows] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]
    rows = tables.assign_cycles(df, 4, per_device=False).orderBy("seq").collect()
    assert [r.cycle for r in rows] == [0] * 4 + [1] * 4 + [2] * 2
    with pytest.raises(ValueError):
        tables.assign_cycles(df, 0)


def test_assets_and_threats(spark):
    df = spark.createDataFrame([(0, " pack ", " ", None), (1, "app", "Ana", 5)], "at int, asset string, owner string, criticality int")
    rows = tables.assets(df, "at").orderBy("asset_pos").collect()
    assert [(r.asset, r.owner, r.criticality) for r in rows] == [("pack", "unassigned", 3), ("app", "Ana", 5)]
    path = scratch(spark, "threats")
    spark.createDataFrame([('[{"threat": "x", "likelihood": 5}]',)], "v string").coalesce(1).write.text(path)
    assert tables.threats(spark, path) == [(0, "x", 5, 3, None)]
    with pytest.raises(ValueError):
        tables.assets_from_names(spark, " , ")


def test_assets_of_several_files_keep_their_order(spark):
    path = scratch(spark, "assets")
    for k in (2, 0, 1):
        names = [(f"asset {k}{i:02}",) for i in range(20)]
        spark.createDataFrame(names, "asset string").coalesce(1).write.option("header", True).csv(f"{path}/{k}.csv")
    rows = tables.assets(spark.read.option("header", True).csv([f"{path}/{k}.csv" for k in (1, 0, 2)])).orderBy("asset_pos").collect()
    assert [r.asset_pos for r in rows] == list(range(60)) and [r.asset for r in rows] == sorted(r.asset for r in rows)


def test_observed_counts_need_no_second_read(spark):
    raw = [("2024-01-01 00:00:01", 1, "a"), ("nonsense", 2, "a"), ("2024-01-01 00:00:02", 3, None), (None, 4, None)]
    df = spark.createDataFrame(raw, "t string, n int, cell string").withColumn("v", F.lit(1.0))
    seen = Observation("seen")
    rows = tables.normalise(df, ColumnSpec(time="t", order="n", device="cell", voltage="v"), observation=seen)
    tallied = durable(integrity.tally(integrity.checks(rows)))
    report = integrity.report(tallied, observed=seen.get).first()
    assert (report.rows_read, report.rows_without_time, report.rows_null_device, report.rows_total) == (4, 2, 1, 2)


def test_a_failing_stage_is_recorded_or_ends_the_run(spark, sf_dir):
    rows = views.view(spark, sf_dir, "telemetry_cycles")
    options = dict(soh_limits=SohLimits(cc_slope=1e-4), skip_integrity=True, threat_profile="/no/such/profile")
    with pytest.raises(Exception, match="no/such"):
        workflow.run(spark, rows, skip_soh=True, **options)
    run = workflow.run(spark, rows, keep_going=True, model="none", **options)
    summary = run.summary.first()
    steps = {s.stage: s for s in summary.steps}
    assert summary.status == "fail" and steps["security_audit"].status == steps["soh_train"].status == "fail"
    assert "rf or gb" in steps["soh_train"].reason and steps["soh_feature_extraction"].status == "ok"
    assert run.risks is None and run.soh is None and run.gates is None
    path = scratch(spark, "failed-run")
    made = workflow.write(run, path)
    written = spark.read.json(f"{path}/summary").first()
    assert written.status == "fail" and written.started_utc <= written.finished_utc
    assert [a.artifact for a in written.artifacts] == [n for n in made if n != "summary"] == ["soh_feature_stats", "soh_features"]


def test_risk_scores(spark):
    listed = spark.createDataFrame([(0, "pack", "Ana", 5), (1, "app", "Bo", 1)], "asset_pos bigint, asset string, owner string, criticality int")
    rows = risk.register(listed, [(0, "spoof", 4, 5, None), (1, "leak", 1, 2, "Ops")])
    got = {(r.asset, r.threat): (r.risk_score, r.recommended_owner, r.priority_band) for r in rows.collect()}
    assert got[("pack", "spoof")] == (80, "Ana", "high") and got[("app", "leak")] == (2, "Ops", "low")
    assert [r.asset for r in risk.ranked(rows).orderBy("position").collect()] == ["pack", "app", "pack", "app"]
    found = risk.summary(rows).first()
    assert (found.total_rows, found.high_risk_count, found.top_risk_scores) == (4, 1, [80, 20, 8, 2])


def test_register_markdown_is_written_in_order(spark):
    rows = risk.ranked(risk.register(tables.assets_from_names(spark, "a"), tables.threats(spark)))
    path = scratch(spark, "md")
    sinks.write_lines(sinks.risk_markdown(rows), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[0] == "# Battery Security Risk Register" and len(lines) == 14
    assert lines[4] == "| a | Sensor data spoofing | 4 | 5 | 3 | 40 | unassigned | Controls + Data | open |"


def test_drift_with_itself_is_zero(spark, sf_dir):
    df = views.view(spark, sf_dir, "drift_source")
    for r in drift.compare(df, df).collect():
        assert r.mean_shift == 0 and r.quantile_shift == 0 and r.std_shift_ratio == pytest.approx(1, abs=1e-6)


def test_drift_needs_five_values(spark):
    four = spark.createDataFrame([(float(i),) for i in range(4)], "x double")
    row = drift.compare(four, four).first()
    assert row.feature == "x" and row.mean_shift is None and row.quantile_shift is None
    assert drift.summary(drift.compare(four, four)).first().max_quantile_shift == 0.0


def test_csv_of_no_flags_keeps_its_header(spark):
    flags = integrity.flag(telemetry(spark, [{"t": 1}, {"t": 2}]))
    path = f"{scratch(spark, 'flags')}.csv"
    sinks.write_table(flags, path, "csv")
    assert "flagged" in flags.columns and tables.read_table(spark, path, "seq int").count() == 0


@pytest.mark.parametrize("text,want", [("1700000012", 1_700_000_012_000_000), ("1700000012.5", 1_700_000_012_500_000),
                                       ("2023-11-14 22:13:32", 1_700_000_012_000_000), ("soon", None), ("NaN", None), (None, None)])
def test_times_as_text(spark, text, want):
    df = spark.createDataFrame([(text, 1, 2.0)], "t string, n int, v double")
    assert df.select(tables.micros(df, "t").alias("us")).first().us == want


def test_extra_columns_pass_and_tell_rows_apart(spark):
    raw = [("a", 1.0, i, 3.0, f"frame {i}") for i in range(4)]
    df = spark.createDataFrame(raw, "cell string, t double, n int, v double, note string")
    spec = ColumnSpec(time="t", order="n", device="cell", voltage="v")
    rows = tables.normalise(df, spec)
    assert "note" in rows.columns and "note" not in tables.normalise(df, spec, extras=[]).columns
    only = ["replay_pattern"]
    assert integrity.checks(rows, only=only).filter("replay_pattern").isEmpty()
    assert integrity.checks(rows.drop("note"), only=only).filter("replay_pattern").count() == 4


def test_formats_by_name_or_choice(spark):
    path = scratch(spark, "plain-folder")
    spark.range(3).write.option("header", True).csv(path)
    assert tables.read_table(spark, path, fmt="csv").count() == 3
    with pytest.raises(ValueError):
        tables.read_table(spark, path, fmt="xml")


def test_wide_quantiles_start_no_job_and_are_exact(spark):
    import numpy as np
    from packtrace.operators import quantiles

    rng = np.random.default_rng(4)
    values = np.round(rng.normal(size=4000), 2)
    df = spark.createDataFrame([(float(v), None, 7.0) for v in values], "x double, none double, same double").repartition(3)
    tracker, group = spark.sparkContext.statusTracker(), "wide-quantiles"
    spark.sparkContext.setJobGroup(group, group)
    probs = [0.0, 0.1, 0.333, 0.5, 0.99, 1.0]
    plan = quantiles.by_column(df, [F.col(c) for c in df.columns], probs, accuracy=200)
    assert not tracker.getJobIdsForGroup(group)
    found = {r.place: r for r in plan.collect()}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert np.allclose(found[0].quantiles, np.quantile(values, probs)) and found[0].n == 4000
    assert found[1].n == 0 and found[2].quantiles == [7.0] * len(probs)


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_drift_reads_each_side_twice(spark, sf_dir):
    plan = _executed(drift.compare(views.view(spark, sf_dir, "drift_source"), views.view(spark, sf_dir, "drift_target")))
    assert plan.count("FileScan") <= 4 and "NestedLoop" not in plan


def test_imputation_reads_twice_and_then_fills(spark, sf_dir):
    plan = _executed(models.impute_label(views.view(spark, sf_dir, "regression_pairs"), "y_true", "y"))
    assert plan.count("FileScan") <= 3 and "NestedLoop" not in plan


def test_a_rank_outside_its_bracket_is_an_error(spark, monkeypatch):
    from packtrace.operators import quantiles

    df = spark.range(5000).select((F.col("id") * 1.0).alias("x"))
    wrong = lambda name, *rest: F.array(*[F.max(name)] * 2)
    monkeypatch.setattr(quantiles.F, "percentile_approx", wrong)
    with pytest.raises(Exception, match="bracket"):
        quantiles.by_column(df, [F.col("x")], [0.5], accuracy=100).collect()


def test_positions_pass_through_no_single_task(spark, sf_dir):
    from packtrace.operators.ordered import position

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey").repartition(5)
    out = position(orders, [], ["o_custkey", "o_orderkey"], "at")
    plan = _executed(out)
    assert "SinglePartition" not in plan and "Python" not in plan and "Window" not in plan
    rows = out.orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(1, len(rows) + 1)) and rows == sorted(rows, key=lambda r: (r.o_custkey, r.o_orderkey))
    assert position(orders.limit(0), [], ["o_custkey"], "at").count() == 0


def test_areas_merge_over_score_ranges(spark, monkeypatch):
    import random

    from packtrace.operators import evaluate

    monkeypatch.setattr(evaluate, "RANGES", 7)
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice((0.1, 0.5, rng.random())), rng.random() < 0.4) for _ in range(400)]
    rows += [("one side", 0.3, True), ("one side", 0.4, True)]
    df = spark.createDataFrame(rows, "k string, s double, y boolean").repartition(3)

    def area(part):
        pos, neg = [s for s, y in part if y], [s for s, y in part if not y]
        return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None

    found = evaluate.auroc_by_class(df, "k", "s", F.col("y"))
    want = {k: area([(s, y) for c, s, y in rows if c == k]) for k in ("a", "b", "one side")}
    assert {r.k: r.auroc for r in found.collect()} == pytest.approx(want)
    whole = evaluate.auroc(df, "s", F.col("y"))
    plan = _executed(whole)
    assert "NestedLoop" not in plan and "Python" not in plan
    assert whole.first().auroc == pytest.approx(area([(s, y) for _, s, y in rows]))
    assert evaluate.auroc(df.limit(0), "s", F.col("y")).count() <= 1


def test_splits_rank_only_the_part_that_holds_the_border(spark, sf_dir):
    from packtrace.operators import split

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")
    tracker, group = spark.sparkContext.statusTracker(), "splits"
    spark.sparkContext.setJobGroup(group, group)
    drawn = split.by_group(orders, "o_orderkey", "o_custkey")
    strata = split.stratified(orders, "o_orderstatus", "o_orderkey")
    assert not tracker.getJobIdsForGroup(group)
    assert _executed(strata).count("FileScan") <= 3
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    sides = drawn.groupBy("o_custkey").agg(F.count_distinct("is_test").alias("n"))
    assert sides.filter("n > 1").isEmpty()
    ids = sorted({r.o_custkey for r in orders.collect()}, key=lambda c: __import__("hashlib").md5(f"{c}#42".encode()).hexdigest()[:13])
    held = {r.o_custkey for r in drawn.filter("is_test").collect()}
    assert held == set(ids[: -(-len(ids) // 4)])
    alone = split.by_group(orders.withColumn("g", F.lit("x")), "o_orderkey", "g").filter("is_test").count()
    assert alone == -(-orders.count() // 4)


def test_clear_removes_what_was_written(spark):
    from packtrace import session

    kept, session._MADE[:] = list(session._MADE), []
    path = scratch(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.clear(spark) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    session._MADE[:] = kept


def test_durable_copy(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert same_rows(df, durable(df))


def test_workflow(spark, sf_dir):
    telemetry_rows = views.view(spark, sf_dir, "telemetry_cycles")
    run = workflow.run(
        spark, telemetry_rows, soh_limits=SohLimits(cc_slope=1e-4), n_trees=3, max_depth=2, n_bootstrap=1
    )
    summary = run.summary.first()
    steps = {s.stage: s for s in summary.steps}
    assert summary.status == "pass" and steps["soh_train"].status == "ok"
    assert json.loads(steps["telemetry_integrity"].report)["rows_total"] == telemetry_rows.count()
    assert json.loads(steps["security_audit"].report)["total_rows"] == 60
    gates = {r.gate: r.passed for r in run.gates.collect()}
    assert gates["timestamps_in_order"] and len(gates) == 8
    path = scratch(spark, "run")
    workflow.write(run, path)
    assert spark.read.parquet(f"{path}/soh_features").count() == run.features.count()
    assert spark.read.parquet(f"{path}/risk_register").count() == 60
    assert spark.read.parquet(f"{path}/controls_plan").count() == 20
    assert spark.read.json(f"{path}/gates").count() == 8
    assert spark.read.json(f"{path}/integrity_report").first().rows_total == telemetry_rows.count()
    assert spark.read.text(f"{path}/risk_register_text").count() == 64
    assert {"mae", "rmse"} <= set(spark.read.json(f"{path}/soh_metrics").select("test.*").columns)
    skipped = workflow.run(spark, telemetry_rows, label="nothing", skip_integrity=True, skip_security=True)
    steps = {s.stage: s for s in skipped.summary.first().steps}
    assert steps["soh_train"].reason == "missing label column nothing"
    assert steps["telemetry_integrity"].status == "skipped" and skipped.gates is None


def test_target_branch(spark, sf_dir):
    rows = views.view(spark, sf_dir, "telemetry_cycles")
    features = cycles.soh_labels(cycles.soh_features(rows, SohLimits(cc_slope=1e-4)))
    target = features.withColumn("sample_id", F.concat_ws("/", "device", F.col("cycle").cast("string")))
    run = workflow.run(spark, rows, target=target, skip_integrity=True, skip_security=True, soh_limits=SohLimits(cc_slope=1e-4),
                       n_trees=3, max_depth=2, n_bootstrap=1)
    measured = run.target_metrics.first()
    assert measured.target_rows == target.count() == run.target_predictions.count() and measured.mae >= 0
    path = scratch(spark, "target")
    workflow.write(run, path)
    assert spark.read.parquet(f"{path}/soh_target_predictions").count() == measured.target_rows
    assert spark.read.json(f"{path}/soh_drift_summary").first().num_features > 10


def test_gates_need_input(spark):
    with pytest.raises(ValueError):
        readiness.gates()
