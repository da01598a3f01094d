"""Saved models: the fitted learners beside a manifest, and their way back.

A folder holds ``manifest`` (one JSON object), ``fitted`` and, for State-of-Health models, one
folder per resampled refit below ``resampled``. Loading needs nothing of the session that trained.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, OneVsRestModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import SparkSession

from packtrace.operators import models, trees
from packtrace.sources.sinks import save_model

FORMAT = 1
_SCHEMA = "format int, kind string, learner string, features array<string>, classes array<string>, refits int, label_median double, spark string"
_LEARNERS = {c.__name__: c for c in (GBTClassificationModel, OneVsRestModel, RandomForestRegressionModel, GBTRegressionModel)}


def _manifest(spark: SparkSession, path: str, **entries) -> None:
    known = {"format": FORMAT, "spark": spark.version, "classes": None, "refits": 0, "label_median": None, **entries}
    names = [f.split()[0] for f in _SCHEMA.split(", ")]
    row = spark.createDataFrame([tuple(known[n] for n in names)], _SCHEMA)
    row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str, kind: str):
    """The manifest row; an error names what does not fit."""
    rows = spark.read.schema(_SCHEMA).json(f"{path}/manifest").take(2)
    if len(rows) != 1:
        raise ValueError(f"no single manifest below {path}")
    found = rows[0]
    if found.format != FORMAT:
        raise ValueError(f"manifest of format {found.format}, expected {FORMAT}")
    if found.kind != kind:
        raise ValueError(f"a model of kind {found.kind}, expected {kind}")
    if found.learner not in _LEARNERS:
        raise ValueError(f"unknown learner {found.learner}")
    return found


def save_fault(spark: SparkSession, model: models.FaultModel, path: str) -> None:
    save_model(model.fitted, f"{path}/fitted")
    _manifest(spark, path, kind="fault", learner=type(model.fitted).__name__, features=list(model.features), classes=list(model.classes))


def load_fault(spark: SparkSession, path: str) -> models.FaultModel:
    found = read_manifest(spark, path, "fault")
    return models.FaultModel(_LEARNERS[found.learner].load(f"{path}/fitted"), list(found.classes), list(found.features))


def save_soh(spark: SparkSession, model: models.SohModel, path: str) -> None:
    save_model(model.fitted, f"{path}/fitted")
    for k, refit in enumerate(model.resampled):
        save_model(refit, f"{path}/resampled/{k:03}")
    _manifest(spark, path, kind="soh", learner=type(model.fitted).__name__, features=list(model.features), refits=len(model.resampled),
              label_median=model.label_median)


def load_soh(spark: SparkSession, path: str) -> models.SohModel:
    found = read_manifest(spark, path, "soh")
    learner = _LEARNERS[found.learner]
    fitted = learner.load(f"{path}/fitted")
    resampled = [learner.load(f"{path}/resampled/{k:03}") for k in range(found.refits)]
    forest = trees.Forest.load(spark, fitted) if learner is RandomForestRegressionModel else None
    return models.SohModel(fitted, resampled, list(found.features), forest, found.label_median)
