"""Telemetry-shaped views over the supplied tables, as SQL both engines accept.

``{us}`` is the only engine-specific part: microseconds of an event's timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_BASE = (
    "select *, {us} as t_us0, cast(regexp_extract(props, '([0-9]+)', 1) as double) as k from events"
)

VIEWS = {
    # coarse values and hourly time, so ties, flatlines and replays occur
    "telemetry_dense": f"""
        select event_id as seq, concat('cell-', cast(user_id % 10 as varchar(9))) as device,
               t_us0 - t_us0 % 3600000000 as t_us, cast(null as bigint) as cycle,
               cast(floor(k / 50e0) as double) as current,
               cast(floor(value / 60e0) as double) as voltage,
               cast(null as double) as pack_voltage, cast(null as double) as cell_voltage,
               k % 10 as temperature, cast(null as double) as soc, cast(null as double) as capacity
        from ({_BASE}) b""",
    # arrival order differs from time order
    "telemetry_unordered": f"""
        select event_id * 7919 % 1000003 * 1000003 + event_id as seq,
               concat('cell-', cast(user_id % 10 as varchar(9))) as device, t_us0 as t_us,
               cast(null as bigint) as cycle, (k - 50e0) / 10e0 as current, 3e0 + value / 100e0 as voltage,
               cast(null as double) as pack_voltage, cast(null as double) as cell_voltage,
               20e0 + (event_id % 17) * 0.7e0 as temperature, cast(null as double) as soc,
               cast(null as double) as capacity
        from ({_BASE}) b""",
    # 10 devices with daily cycles, some voltages missing
    "telemetry_cycles": f"""
        select event_id as seq, concat('cell-', cast(user_id % 10 as varchar(9))) as device, t_us0 as t_us,
               cast(extract(day from ts) as bigint) as cycle, (k - 50e0) / 10e0 as current,
               case when event_id % 97 = 0 then null else 3e0 + value / 100e0 end as voltage,
               96e0 * (3e0 + value / 100e0) + (event_id % 5) / 10e0 as pack_voltage,
               case when event_id % 97 = 0 then null else 3e0 + value / 100e0 end as cell_voltage,
               20e0 + (event_id % 17) * 0.7e0 as temperature, k / 100e0 as soc,
               2.2e0 - 0.0045e0 * extract(day from ts) + (event_id % 7) / 1000e0 as capacity
        from ({_BASE}) b""",
    "scored_labels": """
        select doc_id as sample_id, cast(quality as int) as y_true, ((doc_id * 7919) % 1000) / 1000e0 as p1
        from labels""",
    "regression_pairs": """
        select o_orderkey as sample_id, o_totalprice / 1000e0 as y_true,
               o_totalprice / 1000e0 + ((o_orderkey * 7919) % 201 - 100) / 10e0 as y_pred,
               1e0 + (o_orderkey % 5) as uncertainty from orders""",
    "drift_source": "select l_quantity, l_extendedprice, l_discount, l_tax from lineitem where l_linestatus = 'F'",
    "drift_target": "select l_quantity, l_extendedprice, l_discount, l_tax from lineitem where l_linestatus = 'O'",
    "fleet_assets": """
        select s_suppkey as pos, s_name as asset,
               case when s_suppkey % 4 = 0 then 'Team ' || cast(s_nationkey as varchar(9)) end as owner,
               cast(case when s_suppkey % 7 > 0 then 1 + s_suppkey % 5 end as int) as criticality
        from supplier""",
}

_SPARK_US = "unix_micros(cast(ts as timestamp))"
_DUCKDB_US = "epoch_us(ts)"
_TABLES = ("events", "labels", "orders", "lineitem", "supplier")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name].replace("{us}", _SPARK_US)
    for table in _TABLES:
        text = text.replace(f"from {table}", f"from parquet.`{sf_dir}/{table}.parquet`")
    return spark.sql(text)


def over(spark: SparkSession, events: DataFrame, name: str) -> DataFrame:
    """A telemetry view over a given (also streaming) events table."""
    events.createOrReplaceTempView("live_events")
    return spark.sql(VIEWS[name].replace("{us}", _SPARK_US).replace("from events", "from live_events"))


def duckdb(name: str) -> str:
    return VIEWS[name].replace("{us}", _DUCKDB_US)
