"""Live checks equal the table checks, also when input comes in several batches."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from helpers import SCHEMA, same_rows
from packtrace.operators import integrity
from packtrace.plans import views
from packtrace.session import scratch
from packtrace.spec import IntegrityLimits
from packtrace.streaming import live

LIMITS = IntegrityLimits(voltage_jump=1.0, current_jump=1.0, temp_jump=3.0)


@pytest.fixture(scope="module")
def split_input(spark, sf_dir):
    """Telemetry as files of rising arrival order."""
    rows = views.view(spark, sf_dir, "telemetry_unordered")
    path = scratch(spark, "arriving")
    for k in range(3):
        cut = rows.withColumn("_part", F.ntile(3).over(Window.orderBy("seq")))
        cut.filter(F.col("_part") == k + 1).drop("_part").coalesce(1).write.mode("append").parquet(path)
    return path, rows


def _stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(path)


def test_arrival_flags_across_batches(spark, split_input):
    path, rows = split_input
    got = live.drain_arrivals(_stream(spark, path), LIMITS)
    want = integrity.checks(rows, LIMITS, only=["timestamp_reorder"])
    reordered = got.filter("timestamp_reorder").select("seq", "device")
    assert got.count() == rows.count()
    assert same_rows(reordered, want.filter("timestamp_reorder").select("seq", "device"))


def test_restart_goes_on_from_the_checkpointed_state(spark, split_input):
    _, rows = split_input
    source, path = scratch(spark, "restart"), scratch(spark, "restarted")
    want = integrity.checks(rows, LIMITS, only=["timestamp_reorder", "voltage_jump", "current_jump", "temp_jump"])
    for part in ("seq < 300000000000", "seq >= 300000000000 and seq < 700000000000", "seq >= 700000000000"):
        rows.filter(part).coalesce(1).write.mode("append").parquet(source)
        flags = live.arrival_flags(_stream(spark, source), LIMITS)  # a new query each time, with the old checkpoint
        writer = flags.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/log")
        writer.trigger(availableNow=True).start().awaitTermination()
    names = ["seq", "device", "timestamp_reorder"]
    got = spark.read.parquet(f"{path}/out")
    assert same_rows(got.select(names), want.select(names)) and got.filter("voltage_jump").count() > 0


def test_jumps_compare_arrivals_and_skip_missing(spark):
    from helpers import telemetry

    rows = [{"t": i, "voltage": v, "current": 0.0, "temperature": 20.0} for i, v in enumerate([1.0, 4.0, None, 9.0, 12.5])]
    path = scratch(spark, "jumps")
    for k in range(2):
        telemetry(spark, rows).filter(f"seq div 2 = {k} or {k} = 1 and seq > 3").coalesce(1).write.mode("append").parquet(path)
    got = live.drain_arrivals(_stream(spark, path), IntegrityLimits(voltage_jump=2.0)).collect()
    assert sorted((r.seq, r.voltage_jump) for r in got) == [(0, False), (1, True), (2, False), (3, False), (4, True)]


def test_silent_devices_are_forgotten(spark):
    from helpers import telemetry

    path, hour = scratch(spark, "silent"), 3600
    start = 470_000 * hour
    parts = [[("a", 0, 1.0), ("b", 0, 1.0)], [("b", 5 * hour, 9.0)], [("b", 6 * hour, 9.0)], [("a", 6 * hour, 9.0)]]
    seq = 0
    for part in parts:
        listed = []
        for d, t, v in part:
            listed.append({"seq": seq, "device": d, "t": start + t, "voltage": v})
            seq += 1
        telemetry(spark, listed).coalesce(1).write.mode("append").parquet(path)
    jumped = lambda silence: {r.seq for r in live.drain(live.arrival_flags(_stream(spark, path), LIMITS, silence), "s").filter("voltage_jump").collect()}
    assert jumped(None) == {2, 4}
    assert jumped(2 * hour * 1000) == {2}  # a is forgotten before it comes back, b jumped before its silence was noticed


def test_window_counts_of_closed_windows(spark, sf_dir):
    dense = views.view(spark, sf_dir, "telemetry_dense")
    path = scratch(spark, "dense")
    dense.coalesce(1).write.parquet(path)
    got = live.drain(live.window_counts(_stream(spark, path), "1 day"), "w")
    day = 86_400_000_000
    start = F.col("t_us") - F.pmod("t_us", F.lit(day))
    last = dense.agg(F.max("t_us")).first()[0] - 600_000_000
    want = dense.withColumn("s", start).filter(F.col("s") + day <= last).groupBy("s", "device").count()
    assert same_rows(got.select("window_start_us", "device", "rows"), want.toDF("window_start_us", "device", "rows"))


def test_distinct_packets(spark, sf_dir):
    dense = views.view(spark, sf_dir, "telemetry_dense")
    path = scratch(spark, "packets")
    dense.coalesce(1).write.parquet(path)
    got = live.drain(live.distinct_packets(_stream(spark, path)), "p")
    assert same_rows(got.select("device", "t_us"), dense.select("device", "t_us").distinct())


def _events(spark, ids: list[int]):
    return spark.sql("select id as event_id, id % 3 as user_id, timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id % 1000) as ts, "
                     "cast(id % 400 as double) as value, concat('k=', id % 90) as props, 'x' as event_type from {ids}",
                     ids=spark.createDataFrame([(i,) for i in ids], "id bigint"))


def test_live_queries_read_a_table_of_several_files(spark, tmp_path):
    from packtrace.plans import catalog

    for name, parts in (("file", 1), ("folder", 3)):
        _events(spark, list(range(60))).repartition(parts).write.parquet(f"{tmp_path}/{name}/written")
    (tmp_path / "folder" / "written").rename(tmp_path / "folder" / "events.parquet")
    next((tmp_path / "file" / "written").glob("part-*.parquet")).rename(tmp_path / "file" / "events.parquet")
    for query in ("live_distinct_packets", "live_window_counts"):
        one, several = (catalog.QUERIES[query](spark, f"{tmp_path}/{name}") for name in ("file", "folder"))
        assert not one.isEmpty() and same_rows(one, several)


def test_arrivals_outside_the_thirds_stay(spark, tmp_path):
    from packtrace.plans import catalog

    prime = 1_000_003
    last = -pow(7919, -1, prime) % prime  # the id whose arrival comes last
    ids = [-5, 1, 2, 3, last, last + 4 * prime]
    _events(spark, ids).write.parquet(f"{tmp_path}/events.parquet")
    assert catalog.QUERIES["live_arrival_flags"](spark, str(tmp_path)).count() == len(ids)
