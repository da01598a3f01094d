"""Live checks on telemetry streams (canonical columns)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from packtrace.session import scratch
from packtrace.spec import IntegrityLimits

_KEPT = ("device", "seq", "t_us", "voltage", "current", "temperature")


def _timed(stream: DataFrame, delay: str) -> DataFrame:
    return stream.withColumn("ts", F.timestamp_micros("t_us")).withWatermark("ts", delay)


def window_counts(stream: DataFrame, size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Per device and tumbling window: rows, rows sharing their timestamp, sensor extremes.

    Counting per instant first spreads a busy device over many state rows.
    """
    sensors = ("voltage", "current", "temperature")
    instant = _timed(stream, delay).groupBy(F.window("ts", size), "device", "t_us").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(c).alias(f"{c}_min") for c in sensors],
        *[F.max(c).alias(f"{c}_max") for c in sensors],
    )
    out = instant.groupBy("window", "device").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("duplicate_rows"),
        *[F.min(f"{c}_min").alias(f"{c}_min") for c in sensors],
        *[F.max(f"{c}_max").alias(f"{c}_max") for c in sensors],
    )
    start = F.unix_micros("window.start").alias("window_start_us")
    return out.select(start, *[c for c in out.columns if c != "window"])


def distinct_packets(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop packets repeating a device and instant seen within the watermark delay."""
    return _timed(stream, delay).dropDuplicatesWithinWatermark(["device", "t_us"]).drop("ts")


_STATE = "seq bigint, t_us bigint, voltage double, current double, temperature double"
_FLAGS = "seq bigint, t_us bigint, voltage double, current double, temperature double, device string, timestamp_reorder boolean, \
voltage_jump boolean, current_jump boolean, temp_jump boolean"


def _judge(limits: IntegrityLimits, silence_ms: int | None):
    """Compare a device's new arrivals, in order, with the ones before them; the last one becomes the state."""
    jumps = {"voltage": limits.voltage_jump, "current": limits.current_jump, "temperature": limits.temp_jump}
    columns = ["seq", "t_us", *jumps]

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat([f[columns] for f in frames]).sort_values("seq", kind="stable", ignore_index=True)
        before = rows.shift(1)
        if state.exists:
            before.loc[0, columns] = [float("nan") if x is None else x for x in state.get]
        out = rows.assign(device=key[0], timestamp_reorder=(rows["t_us"] < before["t_us"]).to_numpy())
        for name, limit in jumps.items():
            out["temp_jump" if name == "temperature" else f"{name}_jump"] = ((rows[name] - before[name]).abs() > limit).to_numpy()
        last = rows.iloc[-1]
        state.update((int(last["seq"]), int(last["t_us"]), *[None if pd.isna(last[c]) else float(last[c]) for c in jumps]))
        if silence_ms is not None:
            # by event time, so that a repeated batch does the same
            state.setTimeoutTimestamp(max(int(rows["t_us"].max()) // 1000 + silence_ms, state.getCurrentWatermarkMs() + 1))
        yield out

    return run


def arrival_flags(
    stream: DataFrame, limits: IntegrityLimits = IntegrityLimits(), silence_ms: int | None = None, delay: str = "10 minutes"
) -> DataFrame:
    """Each arrival beside the one before it on its device: a time that goes back, or a reading that jumps.

    The last arrival per device is keyed state that Spark keeps, checkpoints and restores; a batch
    touches the devices it holds. With ``silence_ms`` a device that has been silent for so long
    when the watermark passes is forgotten, and its next arrival has none before it; arrivals more
    than ``delay`` behind then stay out. Without it nothing is left out. One task
    holds a device's arrivals of one batch: bound them by the source's files or bytes per trigger.
    """
    rows = stream.filter(F.col("device").isNotNull())
    rows = rows.select(*_KEPT) if silence_ms is None else _timed(rows, delay).select(*_KEPT, "ts")
    timeout = GroupStateTimeout.NoTimeout if silence_ms is None else GroupStateTimeout.EventTimeTimeout
    return rows.groupBy("device").applyInPandasWithState(_judge(limits, silence_ms), _FLAGS, _STATE, "append", timeout)


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Process all available input into a table of the shared folder and read it."""
    spark = stream.sparkSession
    path = scratch(spark, label)
    writer = stream.writeStream.format("parquet").option("path", f"{path}/out")
    query = writer.option("checkpointLocation", f"{path}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


_END_OF_TIME = 253_402_300_799_000_000  # the last second of the year 9999, in microseconds


def drain_windows(stream: DataFrame, size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """``window_counts`` of a bounded stream, its last windows included.

    Once all input is read, the same query goes on with one row of the far future from a
    source of its own: the watermark passes every window of the input, and they come out.
    """
    spark = stream.sparkSession
    path = scratch(spark, "windows")
    nothing = spark.createDataFrame([], stream.schema)
    nothing.write.parquet(f"{path}/end")
    both = stream.unionByName(spark.readStream.schema(stream.schema).parquet(f"{path}/end"))
    counts = window_counts(both, size, delay)

    def run() -> None:
        writer = counts.writeStream.format("parquet").option("path", f"{path}/out")
        writer.option("checkpointLocation", f"{path}/log").trigger(availableNow=True).start().awaitTermination()

    run()
    last = {c.name: F.lit(_END_OF_TIME if c.name == "t_us" else None).cast(c.dataType).alias(c.name) for c in stream.schema}
    spark.range(1).select(*last.values()).write.mode("append").parquet(f"{path}/end")
    run()
    return spark.read.schema(counts.schema).parquet(f"{path}/out")


def drain_arrivals(stream: DataFrame, limits: IntegrityLimits = IntegrityLimits()) -> DataFrame:
    """``arrival_flags`` of all available input."""
    return drain(arrival_flags(stream, limits), "arrivals")
