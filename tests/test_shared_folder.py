"""Where a session with executors of their own keeps its intermediate tables."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pyspark
import pytest

from conftest import SF_DIR
from packtrace import session

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_RUN = """
import json, sys
from pyspark.sql import SparkSession

from packtrace import session
from packtrace.plans import catalog

here, shared, sf, *names = sys.argv[1:]
build = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "1g").config("spark.sql.shuffle.partitions", "4")
build = build.config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").config("spark.sql.warehouse.dir", f"{here}/warehouse")
build = build.config("spark.checkpoint.dir", shared) if shared else build
spark = build.config("spark.sql.session.timeZone", "UTC").getOrCreate()
rows = {name: catalog.QUERIES[name](spark, sf).count() for name in names}
print(json.dumps({"at": session.scratch(spark, "x"), "copied": session.durable(spark.range(100)).count(), "rows": rows}))
spark.stop()
"""


def _on_cluster(tmp_path, shared: str, *names: str) -> dict:
    home = tmp_path / "home"  # the executors' logs go to work in Spark's home
    (home / "work").mkdir(parents=True)
    for name in os.listdir(os.path.dirname(pyspark.__file__)):
        if name != "work":
            (home / name).symlink_to(f"{os.path.dirname(pyspark.__file__)}/{name}")
    env = os.environ | {
        "SPARK_HOME": str(home), "SPARK_LOCAL_DIRS": str(tmp_path / "local"), "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_SCALA_VERSION": "2.13",
        "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": REPO, "PYSPARK_PYTHON": sys.executable, "PYSPARK_SUBMIT_ARGS": "--driver-memory 750m pyspark-shell"}
    done = subprocess.run(
        [sys.executable, "-c", _RUN, str(tmp_path), shared, SF_DIR, *names], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return json.loads(done.stdout.splitlines()[-1])


def test_checkpoint_folder_without_a_scheme(spark, tmp_path):
    import pyarrow.parquet as pq

    from packtrace.plans import catalog

    names = ("controls_markdown", "csv_epoch_scan")
    said = _on_cluster(tmp_path, f"{tmp_path}/kept", *names)
    assert said["at"].startswith(f"file:{tmp_path}/kept/packtrace/") and said["copied"] == 100
    events = pq.read_metadata(f"{SF_DIR}/events.parquet").num_rows
    assert said["rows"] == {"controls_markdown": catalog.QUERIES["controls_markdown"](spark, SF_DIR).count(), "csv_epoch_scan": events}


def test_warehouse_stands_in_for_a_checkpoint_folder(tmp_path):
    said = _on_cluster(tmp_path, "")
    assert said["at"].startswith(f"file:{tmp_path}/warehouse/packtrace-scratch/packtrace/") and said["copied"] == 100


def test_folder_that_loses_rows_is_refused(spark, tmp_path, monkeypatch):
    kind = type(spark.range(0).write)
    monkeypatch.setattr(kind, "parquet", lambda self, path: spark.range(1).write.format("parquet").save(path))  # as if others had their own disk
    with pytest.raises(RuntimeError, match="shared by all executors"):
        session._reached(spark, str(tmp_path))
