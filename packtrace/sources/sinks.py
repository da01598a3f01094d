"""Writers for tables, reports, prompts and models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Headings, table heads and sentences of the Markdown reports.
INTEGRITY_TITLE = "# Telemetry Integrity Summary"
INTEGRITY_TOTALS = ("- Total rows: %d", "- Flagged rows: %d")
INTEGRITY_COUNTS = "## Severity counts"
INTEGRITY_ACTION = "Action: investigate flagged rows first; if `replay_pattern` exceeds zero, treat as possible tampering."
RISK_TITLE = "# Battery Security Risk Register"
RISK_HEAD = "| Asset | Threat | Likelihood | Impact | Criticality | Risk Score | Owner | Recommended Owner | Status |"
RISK_RULE = "|---|---|---:|---:|---:|---:|---|---|---|"
CONTROLS_TITLE = "# Battery Security Controls Plan"
CONTROLS_HEAD = "| Asset | Threat | Owner | Action | Due By |"
CONTROLS_RULE = "|---|---|---|---|---|"
PROMPTS_TITLE = "# LLM Prompt Pack"
PROMPTS_RULE = "---"


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet, or CSV with a header; array columns become comma-joined text in CSV."""
    if fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
        return
    flat = [
        F.array_join(c.name, ",").alias(c.name) if isinstance(c.dataType, T.ArrayType) else F.col(c.name)
        for c in df.schema
    ]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row: a one-row report, or prompts as JSON lines."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Write ``line`` in the order of the remaining columns, sorted over all files."""
    order = [c for c in lines.columns if c != "line"]
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def _fixed(spark, text: list[str], block: int) -> DataFrame:
    rows = [(block, i, line) for i, line in enumerate(text)]
    return spark.createDataFrame(rows, "block int, at bigint, line string")


def _table_line(*cols: str) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.col(c).cast("string") for c in cols]), F.lit(" |"))


def integrity_summary(report: DataFrame) -> DataFrame:
    """Markdown lines (block, at, line) of an integrity report row."""
    from packtrace.operators.integrity import REASONS

    counted = [F.format_string("- " + r + ": %d", F.col("severity")[r]) for r in REASONS]
    lines = F.array(
        F.lit(INTEGRITY_TITLE),
        F.lit(""),
        *[F.format_string(text, c) for text, c in zip(INTEGRITY_TOTALS, ("rows_total", "flagged_rows"), strict=True)],
        F.lit(""),
        F.lit(INTEGRITY_COUNTS),
        *counted,
        F.lit(""),
        F.lit(INTEGRITY_ACTION),
    )
    return report.select(F.lit(0).alias("block"), F.posexplode(lines).alias("at", "line")).select(
        "block", F.col("at").cast("bigint").alias("at"), "line"
    )


def risk_markdown(register: DataFrame) -> DataFrame:
    """Markdown lines of a ranked register (needs its ``position``)."""
    head = [RISK_TITLE, "", RISK_HEAD, RISK_RULE]
    fields = "asset threat likelihood impact criticality risk_score owner recommended_owner status".split()
    body = register.select(F.lit(1).alias("block"), F.col("position").alias("at"), _table_line(*fields).alias("line"))
    return _fixed(register.sparkSession, head, 0).unionByName(body)


def controls_markdown(controls: DataFrame) -> DataFrame:
    head = [CONTROLS_TITLE, "", CONTROLS_HEAD, CONTROLS_RULE]
    line = _table_line("asset", "threat", "owner", "action", "due_by").alias("line")
    body = controls.select(F.lit(1).alias("block"), F.col("position").cast("bigint").alias("at"), line)
    return _fixed(controls.sparkSession, head, 0).unionByName(body)


def prompt_markdown(prompts: DataFrame) -> DataFrame:
    """Prompt pack: the bodies in sample order, numeric ids by value, each followed by a rule."""
    head = prompts.sparkSession.createDataFrame(
        [(0, None, "", f"{PROMPTS_TITLE}\n")], "block int, number decimal(38,9), at string, line string")
    text = F.col("sample_id").cast("string")
    number = text.try_cast("decimal(38,9)")
    body = prompts.select(
        F.when(number.isNull(), 2).otherwise(1).alias("block"),
        number.alias("number"),
        text.alias("at"),
        F.concat("prompt", F.lit(f"\n\n{PROMPTS_RULE}\n")).alias("line"),
    )
    return head.unionByName(body)
