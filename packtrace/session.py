"""Session settings and durable scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build(master: str | None = None, app: str = "packtrace", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_REACHED: set[tuple[str, str]] = set()


def _reached(spark: SparkSession, root: str) -> str:
    """``root``, if what the executors write there is read back; once per application."""
    if (spark.sparkContext.applicationId, root) not in _REACHED:
        path, parts = f"{root}/packtrace/reach-{uuid.uuid4().hex}", max(2, spark.sparkContext.defaultParallelism)
        _MADE.append(path)
        spark.range(0, parts, 1, parts).write.parquet(path)
        found = spark.read.schema("id bigint").parquet(path).count()
        if found != parts:
            raise RuntimeError(f"set spark.checkpoint.dir to a folder shared by all executors: of {parts} rows written to {root} {found} came back")
        _REACHED.add((spark.sparkContext.applicationId, root))
    return root


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``, or else its warehouse.

    A path without a scheme lies in the session's default file system, as it does for Spark. Only
    a local master, whose executor is the driver, may fall back to a folder of this machine; other
    masters must read back what they write to one, which a disk of each machine's own fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        if not root:
            root = tempfile.mkdtemp(prefix="packtrace-")
            spark.sparkContext.setCheckpointDir(root)
        return root.rstrip("/")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root or f"{spark.conf.get('spark.sql.warehouse.dir')}/packtrace-scratch")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = system.makeQualified(path).toString().rstrip("/")
    return _reached(spark, root) if system.getScheme() == "file" else root


_MADE: list[str] = []


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    path = f"{shared_root(spark)}/packtrace/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def clear(spark: SparkSession) -> int:
    """Remove what this process wrote to the shared folder; call it when no table from there is needed any more."""
    done = 0
    while _MADE:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        done += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return done


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written copy."""
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
