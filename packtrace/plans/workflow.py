"""Whole jobs: the field workflow (integrity, features, State-of-Health training, risks, readiness) and the fault model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from packtrace.operators import attribution, cycles, drift, evaluate, integrity, models, prompts, readiness, risk
from packtrace.session import durable
from packtrace.sources import sinks, store, tables
from packtrace.spec import IntegrityLimits, Skew, SohLimits

# Assets audited when the caller names none.
ASSETS = "CellTelemetry,ChargingGateway,InverterCloud,FeatureStore,ModelRegistry,InferenceAPI"


@dataclass(frozen=True)
class FieldRun:
    checked: DataFrame | None
    features: DataFrame | None
    soh: models.SohRun | None
    shifts: DataFrame | None
    risks: DataFrame | None
    summary: DataFrame
    gates: DataFrame | None
    report: DataFrame | None = None
    target_predictions: DataFrame | None = None
    target_metrics: DataFrame | None = None
    started: str | None = None
    finished: str | None = None


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


class _Stages:
    """Rows of the stages so far. A stage that ends with an error is recorded if the run goes on, else it ends the run."""

    def __init__(self, spark: SparkSession, keep_going: bool):
        self.spark, self.keep_going, self.rows = spark, keep_going, []

    def skip(self, name: str, reason: str) -> None:
        self.rows.append(readiness.stage(self.spark, name, None, reason))

    def run(self, name: str, work):
        """The result of ``work``, a pair of result and one-row report; None after a recorded error."""
        try:
            result, report = work()
            self.rows.append(durable(readiness.stage(self.spark, name, report)))  # evaluated here, so that an error belongs to its stage
            return result
        except Exception as error:
            if not self.keep_going:
                raise
            self.rows.append(readiness.failed(self.spark, name, error))
            return None


def run(
    spark: SparkSession,
    telemetry: DataFrame,
    label: str = "soh_proxy",
    assets: str | Sequence[str] | DataFrame = ASSETS,
    threat_profile: str | None = None,
    target: DataFrame | None = None,
    skip_integrity: bool = False,
    skip_soh: bool = False,
    skip_security: bool = False,
    integrity_limits: IntegrityLimits = IntegrityLimits(),
    soh_limits: SohLimits = SohLimits(),
    gate_limits: readiness.GateLimits = readiness.GateLimits(),
    skew: Skew = Skew(),
    observation: Observation | None = None,
    keep_going: bool = False,
    **training,
) -> FieldRun:
    """Run every stage in one session on canonical telemetry.

    ``target`` is feature rows of another fleet, with a ``sample_id``: it is compared with the
    training side, scored, and evaluated if it holds ``label``. Training is skipped, not
    failed, when the features hold no ``label``. ``observation`` is the one given to
    ``tables.normalise``: its counts enter the integrity report without a second read. With
    ``keep_going`` a stage's error makes the summary fail, stages that need its result are skipped
    and the others go on; without it the error ends the run.
    """
    started, stages = _now(), _Stages(spark, keep_going)
    checked = tallied = report = None

    def check():
        checked = integrity.checks(telemetry, integrity_limits, skew=skew)
        tallied = durable(integrity.tally(checked))
        observed = observation.get if observation is not None else None
        report = durable(integrity.report(tallied, integrity_limits, None if observed else telemetry, observed))
        return (checked, tallied, report), report

    if skip_integrity:
        stages.skip("telemetry_integrity", "skipped by request")
    else:
        checked, tallied, report = stages.run("telemetry_integrity", check) or (None,) * 3

    def reduce_cycles():
        # read by labelling, training, drift and the report, so reduced from telemetry once
        found = cycles.soh_labels(durable(cycles.soh_features(telemetry, soh_limits, skew=skew)))
        found = found.withColumn("sample_id", F.concat_ws("/", *cycles.CYCLE))
        return found, cycles.stats_report(found)

    features = stages.run("soh_feature_extraction", reduce_cycles)

    def train():
        exclude = tuple(c for c in (*models.LEAKING, "cycle") if c != label)
        soh = models.fit_soh(features, label, "sample_id", group="device", exclude=exclude, **training)
        return soh, soh.metrics()

    def compare():
        rows = soh.rows.filter(~F.col("is_test"))
        shifts = durable(drift.compare(rows, drift.align(target, soh.model.features), soh.model.features))
        return shifts, drift.summary(shifts)

    def score():
        scored = durable(models.score_target(soh, target, "sample_id", label))
        measured = scored.agg(F.count(F.lit(1)).alias("target_rows"))
        if label in target.columns:
            measured = measured.withColumn("_k", evaluate.regression_metrics(scored).select(F.struct("*")).scalar()).select("target_rows", "_k.*")
        return (scored, measured), measured

    soh = shifts = scored = measured = None
    if skip_soh:
        stages.skip("soh_train", "skipped by request")
    elif features is None:
        stages.skip("soh_train", "no features")
    elif label not in features.columns:
        stages.skip("soh_train", f"missing label column {label}")
    else:
        soh = stages.run("soh_train", train)
        if target is not None and soh is not None:
            shifts = stages.run("soh_drift", compare)
            scored, measured = stages.run("soh_target", score) or (None,) * 2

    def audit():
        listed = assets if isinstance(assets, DataFrame) else tables.assets_from_names(spark, assets)
        risks = risk.register(listed, tables.threats(spark, threat_profile))
        return risks, risk.summary(risks)

    risks = None
    if skip_security:
        stages.skip("security_audit", "skipped by request")
    else:
        risks = stages.run("security_audit", audit)

    gates = None
    if tallied is not None or soh is not None or risks is not None:
        gates = readiness.gates(tallied, soh.predictions if soh else None, shifts, risks, gate_limits)
    summary = readiness.summarise(stages.rows)
    return FieldRun(checked, features, soh, shifts, risks, summary, gates, report, scored, measured, started, _now())


def write(run: FieldRun, folder: str) -> list[str]:
    """Write every result of a run below ``folder``; the summary lists them, and when the run began and ended."""
    made = []

    def put(name: str, writer, what) -> None:
        writer(what, f"{folder}/{name}")
        made.append(name)

    if run.checked is not None:
        put("integrity_flags", sinks.write_table, integrity.flagged(run.checked))
        put("integrity_report", sinks.write_json, run.report)
        put("integrity_summary", sinks.write_lines, sinks.integrity_summary(run.report))
    if run.features is not None:
        put("soh_feature_stats", sinks.write_json, cycles.stats_report(run.features))
        put("soh_features", sinks.write_table, run.features)
    if run.soh is not None:
        spark = run.features.sparkSession
        put("soh_predictions", sinks.write_table, run.soh.predictions)
        put("soh_feature_importance", sinks.write_table, run.soh.model.importance(spark))
        put("soh_model", lambda model, path: store.save_soh(spark, model, path), run.soh.model)
        put("soh_metrics", sinks.write_json, run.soh.metrics())
        put("soh_uncertainty", sinks.write_table, evaluate.uncertainty_table(run.soh.predictions))
    if run.shifts is not None:
        put("soh_drift_features", sinks.write_table, run.shifts)
        put("soh_drift_summary", sinks.write_json, drift.summary(run.shifts))
    if run.target_predictions is not None:
        put("soh_target_predictions", sinks.write_table, run.target_predictions)
        put("soh_target_metrics", sinks.write_json, run.target_metrics)
    if run.risks is not None:
        ranked = durable(risk.ranked(run.risks))
        put("risk_register", sinks.write_table, ranked)
        put("risk_register_text", sinks.write_lines, sinks.risk_markdown(ranked))
        plan = risk.controls_plan(run.risks)
        put("controls_plan", sinks.write_table, plan)
        put("controls_plan_text", sinks.write_lines, sinks.controls_markdown(plan))
        put("risk_summary", sinks.write_json, risk.summary(run.risks))
    if run.gates is not None:
        put("gates", sinks.write_json, run.gates)
    listed = F.array(*[F.struct(F.lit(n).alias("artifact"), F.lit(f"{folder}/{n}").alias("path")) for n in made])
    times = {"started_utc": F.lit(run.started), "finished_utc": F.lit(run.finished)}
    sinks.write_json(run.summary.withColumns({**times, "artifacts": listed}), f"{folder}/summary")
    return [*made, "summary"]


@dataclass(frozen=True)
class FaultJob:
    run: models.FaultRun
    metrics: DataFrame
    hard_cases: DataFrame
    importance: DataFrame
    top: DataFrame
    prompts: DataFrame


def run_fault(
    features: DataFrame,
    label: str,
    sample: str,
    mechanisms: dict[str, str] | DataFrame | None = None,
    top_k: int = attribution.TOP_K,
    fmt: str = "markdown",
    fitted: models.FaultRun | None = None,
    **training,
) -> FaultJob:
    """Train the fault model, evaluate it, explain its test rows and render their prompts."""
    run = fitted or models.fit_fault(features, label, sample, **training)
    explained = durable(run.model.explain(run.predictions, toward="predicted"))
    top = attribution.top(explained, top_k)
    hard = evaluate.hard_cases(run.predictions, len(run.model.classes))
    packed = prompts.compose(top, tables.MECHANISMS if mechanisms is None else mechanisms, fmt=fmt)
    return FaultJob(run, run.metrics(), hard, attribution.global_importance(explained), top, packed)


def write_fault(job: FaultJob, folder: str) -> DataFrame:
    """Write every result of the fault job below ``folder``; one row per artifact that must hold rows."""
    store.save_fault(job.top.sparkSession, job.run.model, f"{folder}/model")
    sinks.write_json(job.metrics, f"{folder}/metrics")
    made = {"predictions": job.run.predictions.drop("features"), "hard_cases": job.hard_cases, "importance": job.importance, "attributions": job.top}
    for name, table in made.items():
        sinks.write_table(table, f"{folder}/{name}")
    sinks.write_json(job.prompts.drop("summary"), f"{folder}/prompts")
    sinks.write_lines(sinks.prompt_markdown(job.prompts), f"{folder}/prompt_pack")
    spark = job.top.sparkSession
    back = {n: spark.read.parquet(f"{folder}/{n}") for n in ("predictions", "importance", "attributions")}
    back |= {n: spark.read.json(f"{folder}/{n}") for n in ("metrics", "prompts")}
    model = spark.read.json(f"{folder}/model/manifest")
    return readiness.artifacts_complete(spark, {"model": model, **back, "prompt_pack": spark.read.text(f"{folder}/prompt_pack")})
