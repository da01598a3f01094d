"""Readers for telemetry, feature, attribution, asset, threat and mechanism inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from packtrace.functions.numeric import number
from packtrace.operators.ordered import numbered, position
from packtrace.spec import CANONICAL, ColumnSpec, Skew

# Threat profile used when the caller brings none.
DEFAULT_THREATS = [
    ("Sensor data spoofing", 4, 5, "Controls + Data"),
    ("Replay injection", 3, 4, "Telemetry"),
    ("Timestamp manipulation", 3, 4, "Telemetry"),
    ("OTA downgrade or fake image", 2, 5, "Firmware"),
    ("Secrets leakage", 2, 5, "Platform Security"),
    ("Training data poisoning", 3, 5, "MLOps"),
    ("Model theft", 2, 4, "AI Platform"),
    ("Prompt/input injection", 3, 3, "Model Service"),
    ("Inference DoS", 4, 3, "Platform Security"),
    ("Insider over-privilege", 2, 4, "Governance"),
]
THREAT_SCHEMA = "pos int, threat string, likelihood int, impact int, owner_hint string"
MAX_THREATS = 10_000

# Mechanism text per fault feature.
MECHANISMS = {
    "cycle_number": "Usage history trend",
    "cc_phase_ratio": "Usage history / stress phase",
    "soc_max": "Usage history boundary usage",
    "pack_cell_voltage_ratio": "Voltage consistency and balancing",
    "voltage_correlation": "Voltage coupling and sensor integrity",
    "initial_min_voltage": "Initial electrical transient behavior",
    "voltage_gradient": "Dynamic voltage response",
    "max_temp_diff": "Thermal imbalance",
    "max_temp_rate": "Thermal transient stress",
    "terminal_temp": "Thermal end-state condition",
}

ATTRIBUTION_COLUMNS = ("sample_id", "predicted_label", "true_label", "rank", "feature", "shap_value")

_UNIT_MICROS = {"s": 1_000_000, "ms": 1_000, "us": 1}


def require(df: DataFrame, columns: Sequence[str | None]) -> None:
    """Raise one error naming every wanted column the table lacks."""
    missing = [c for c in columns if c and c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {', '.join(missing)}")


def read_table(spark: SparkSession, path: str, schema: str | None = None, fmt: str | None = None) -> DataFrame:
    """Parquet, JSON lines or CSV with a header: ``fmt``, or else by the name of the file or folder.

    CSV without a schema is read as text; ``normalise`` and ``read_attributions`` type it.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    name = path.rstrip("/")
    fmt = fmt or ("csv" if name.endswith((".csv", ".csv.gz")) else "json" if name.endswith((".json", ".jsonl")) else "parquet")
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError("format must be csv, json or parquet")
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.json(path) if fmt == "json" else reader.parquet(path)


def micros(df: DataFrame, column: str, unit: str = "s") -> Column:
    """Any time column as microseconds since 1970 (UTC); unreadable times are NULL.

    Text that is a number counts as one, in ``unit``, as a CSV file holds it.
    """
    kind, col = df.schema[column].dataType.typeName(), F.col(column)
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_micros(col.cast("timestamp"))
    if kind == "string":
        clock = F.round(F.trim(col).try_cast("double") * _UNIT_MICROS[unit]).try_cast("bigint")
        return F.coalesce(clock, F.unix_micros(F.try_to_timestamp(col)))
    if kind in ("byte", "short", "integer", "long"):
        return (col.cast("bigint") * _UNIT_MICROS[unit]).cast("bigint")
    return F.round(col.cast("double") * _UNIT_MICROS[unit]).try_cast("bigint")


def unreadable_times(df: DataFrame, spec: ColumnSpec) -> DataFrame:
    """One row: rows of the input, and those that ``normalise`` leaves out for want of a time."""
    lost = F.count_if(micros(df, spec.time, spec.time_unit).isNull())
    return df.agg(F.count(F.lit(1)).alias("rows_read"), lost.alias("rows_without_time"))


def normalise(
    df: DataFrame, spec: ColumnSpec, extras: Sequence[str] | None = None, observation: Observation | None = None
) -> DataFrame:
    """Canonical telemetry: every role present and typed, NaN as NULL, no NULL time.

    Without a device column all rows belong to device ``all``. Columns that play no role pass
    through, so that flagged rows keep them and copies are judged by the whole row; ``extras``
    names those to keep instead of all. An ``observation`` counts what the first job on the result
    reads, in the same pass: rows_read, rows_without_time and rows_null_device.
    """
    roles = {name: getattr(spec, name) for name in CANONICAL if name not in ("seq", "t_us")}
    require(df, [spec.time, spec.order, *roles.values()])
    out = {"seq": F.col(spec.order).cast("bigint"), "t_us": micros(df, spec.time, spec.time_unit)}
    for name, column in roles.items():
        kind = CANONICAL[name]
        if name == "device":
            out[name] = F.col(column).cast("string") if column else F.lit("all")
        elif column is None:
            out[name] = F.lit(None).cast(kind)
        elif kind == "double":
            out[name] = number(F.col(column))
        else:
            out[name] = F.col(column).try_cast("double").try_cast(kind)
    if extras is None:
        used = {spec.time, spec.order, *roles.values()}
        extras = [c for c in df.columns if c not in used and c not in CANONICAL]
    require(df, extras)
    kept = [F.col(f"`{c}`") for c in extras]
    rows = df.select(*[out[name].alias(name) for name in CANONICAL], *kept)
    if observation is not None:
        timeless = F.col("t_us").isNull()
        rows = rows.observe(
            observation, F.count(F.lit(1)).alias("rows_read"), F.count_if(timeless).alias("rows_without_time"),
            F.count_if(~timeless & F.col("device").isNull()).alias("rows_null_device"))
    return rows.filter(F.col("t_us").isNotNull())


def assign_cycles(
    df: DataFrame, samples_per_cycle: int, per_device: bool = True, order: Sequence[str] = ("seq",), skew: Skew = Skew()
) -> DataFrame:
    """Number cycles 0, 1, ... by counting off rows in arrival order."""
    if samples_per_cycle <= 0:
        raise ValueError("samples_per_cycle must be positive")
    out = position(df, ["device"] if per_device else [], order, "_pos", skew)
    return out.withColumn("cycle", F.floor((F.col("_pos") - 1) / samples_per_cycle).cast("bigint")).drop("_pos")


def number_samples(df: DataFrame, order: Sequence[str], name: str = "sample_id", skew: Skew = Skew()) -> DataFrame:
    """0-based positional id for tables that come without one."""
    return position(df, [], order, name, skew).withColumn(name, F.col(name) - 1)


def in_order(column: str) -> list[Column]:
    """Sort keys for ids of any type: numbers by value, also where they are text, then other text."""
    return [F.col(column).cast("string").try_cast("decimal(38,9)").asc_nulls_last(), F.col(column)]


def read_attributions(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    df = read_table(spark, path, fmt=fmt)
    require(df, ATTRIBUTION_COLUMNS)
    return df.withColumns({"rank": F.col("rank").cast("int"), "shap_value": F.col("shap_value").cast("double")})


def assets_from_names(spark: SparkSession, names: str | Sequence[str]) -> DataFrame:
    """Named assets get owner ``unassigned`` and criticality 3."""
    parts = names.split(",") if isinstance(names, str) else names
    clean = [p.strip() for p in parts if p.strip()]
    if not clean:
        raise ValueError("no assets given")
    rows = [(i, name, "unassigned", 3) for i, name in enumerate(clean)]
    return spark.createDataFrame(rows, "asset_pos bigint, asset string, owner string, criticality int")


def assets(df: DataFrame, listed: str | None = None) -> DataFrame:
    """Fill in an asset table; ``listed`` is the column holding the listing order.

    Without one it is the order of the files' names and of the rows in them.
    """
    require(df, ["asset", listed])
    if listed is None:
        read = {"_file": F.input_file_name(), "_block": F.input_file_block_start(), "_row": F.monotonically_increasing_id()}
        df, listed = numbered(df.withColumns(read), list(read), "_listed").withColumn("_listed", F.col("_listed") - 1), "_listed"
    at = F.col(listed)
    owner = F.col("owner") if "owner" in df.columns else F.lit(None).cast("string")
    criticality = F.col("criticality") if "criticality" in df.columns else F.lit(None).cast("int")
    return df.select(
        at.cast("bigint").alias("asset_pos"),
        F.trim("asset").alias("asset"),
        F.coalesce(F.nullif(F.trim(owner), F.lit("")), F.lit("unassigned")).alias("owner"),
        F.coalesce(criticality.cast("int"), F.lit(3)).alias("criticality"),
    )


def threats(spark: SparkSession, path: str | None = None) -> list[tuple]:
    """Threat profile rows (position, threat, likelihood, impact, owner hint).

    A profile file is a JSON list or an object holding one under ``threats``. It is
    configuration of limited size; a longer one is refused, not cut.
    """
    if path is None:
        return [(i, *row) for i, row in enumerate(DEFAULT_THREATS)]
    item = "struct<threat:string,likelihood:int,impact:int,owner_hint:string>"
    text = F.trim(F.col("value"))
    listed = F.from_json(text, f"array<{item}>")
    nested = F.from_json(text, f"struct<threats:array<{item}>>")["threats"]
    rows = (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(F.when(text.startswith("["), listed).otherwise(nested)).alias("pos", "t"))
        .select("pos", "t.*")
        .limit(MAX_THREATS + 1)
        .collect()
    )
    if not rows:
        raise ValueError("threat profile must hold a list of threats")
    if len(rows) > MAX_THREATS:
        raise ValueError(f"threat profile holds more than {MAX_THREATS} threats")
    return [
        (r.pos, r.threat, 3 if r.likelihood is None else r.likelihood, 3 if r.impact is None else r.impact, r.owner_hint)
        for r in rows
    ]


def mechanism_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """feature, mechanism; from a JSON object file or the built-in map."""
    if path is None:
        return spark.createDataFrame(list(MECHANISMS.items()), "feature string, mechanism string")
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("feature", "mechanism"))
