"""Diagnosis prompts rendered from top attributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from packtrace.sources.tables import in_order

MAX_FEATURES = 5

# Wording of the prompt, here and in the lines that ``render`` puts together.
UNKNOWN = "unknown mechanism"
TASK = "Produce diagnosis explanation, likely root-cause path, confidence, and verification checks."
CONTEXT = "  - Use the top contributing features below to infer the likely fault mechanism path."
OUTPUT_FIELDS = (
    "- Output fields:",
    "  - likely_faults (ranked)",
    "  - confidence (0-1)",
    "  - immediate_actions",
    "  - verification_steps",
)


def select_context(rows: DataFrame, max_features: int = MAX_FEATURES, sample_limit: int | None = None) -> DataFrame:
    """First features of each sample, re-ranked from 1; with ``sample_limit`` of the first samples by id only."""
    if sample_limit is not None:
        chosen = rows.select("sample_id").distinct().orderBy(*in_order("sample_id")).limit(sample_limit)
        rows = rows.join(chosen, "sample_id", "left_semi")
    place = Window.partitionBy("sample_id").orderBy("rank", "feature")
    return rows.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= max_features)


def with_mechanism(rows: DataFrame, mechanisms: dict[str, str] | DataFrame | None) -> DataFrame:
    """Add the mechanism text and whether the feature supports or opposes the prediction.

    A map of any length may come as a table (feature, mechanism) and is joined.
    """
    direction = F.when(F.col("shap_value") > 0, "supports").otherwise("opposes")
    if isinstance(mechanisms, DataFrame):
        texts = mechanisms.groupBy("feature").agg(F.min("mechanism").alias("mechanism"))
        rows = rows.join(texts, "feature", "left")
        return rows.withColumns({"mechanism": F.coalesce("mechanism", F.lit(UNKNOWN)), "direction": direction})
    pairs = [F.lit(x) for item in (mechanisms or {}).items() for x in item]
    known = F.create_map(*pairs)[F.col("feature")] if pairs else F.lit(None).cast("string")
    return rows.withColumns(
        {
            "mechanism": F.coalesce(known, F.lit(UNKNOWN)),
            "direction": direction,
        }
    )


def mechanism_map(table: DataFrame, limit: int = 100_000) -> dict[str, str]:
    """A mechanism table as a dict; it has one row per model feature. Longer tables than ``limit`` are joined instead."""
    rows = table.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError("mechanism table is not a per-feature table")
    return {r["feature"]: r["mechanism"] for r in rows}


def render(rows: DataFrame, fmt: str = "markdown") -> DataFrame:
    """One row per sample: sample_id, format, prompt text and the structured summary."""
    if fmt not in ("markdown", "json"):
        raise ValueError("format must be markdown or json")
    item = F.struct("rank", "feature", "shap_value", "mechanism", "direction")
    per_sample = rows.groupBy("sample_id").agg(
        F.min_by("predicted_label", "rank").cast("string").alias("predicted"),
        F.min_by("true_label", "rank").cast("string").alias("truth"),
        F.sort_array(F.collect_list(item)).alias("items"),  # at most max_features per sample
    )
    sample = F.col("sample_id").cast("string")
    summary = F.struct(
        sample.alias("sample_id"),
        F.col("predicted").alias("predicted_fault"),
        F.col("truth").alias("true_fault"),
        F.col("items").alias("top_contributors"),
        F.lit(TASK).alias("requested_task"),
    )
    bullet = F.transform(
        "items",
        lambda f: F.format_string(
            "- [%d] %s (%s): %s (SHAP %.3f)", f["rank"], f["feature"], f["direction"], f["mechanism"], f["shap_value"]
        ),
    )
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("# Diagnosis Prompt for sample_id="), sample),
        F.concat(F.lit("- Predicted: "), F.coalesce("predicted", F.lit(""))),
        F.concat(F.lit("- True (if known): "), F.coalesce("truth", F.lit(""))),
        F.lit("- Context:"),
        F.lit(CONTEXT),
        F.lit("- Top feature evidence:"),
        F.array_join(bullet, "\n"),
        *[F.lit(line) for line in OUTPUT_FIELDS],
    )
    body = F.to_json(summary, {"ignoreNullFields": "false"}) if fmt == "json" else text
    return per_sample.select(
        sample.alias("sample_id"), F.lit(fmt).alias("format"), body.alias("prompt"), summary.alias("summary")
    )


def compose(
    attributions: DataFrame,
    mechanisms: dict[str, str] | DataFrame | None = None,
    max_features: int = MAX_FEATURES,
    sample_limit: int | None = None,
    fmt: str = "markdown",
) -> DataFrame:
    return render(with_mechanism(select_context(attributions, max_features, sample_limit), mechanisms), fmt)
