"""Fault classifier and State-of-Health regressor on MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from packtrace.functions.numeric import finite, number
from packtrace.operators import attribution, evaluate, quantiles, split, trees
from packtrace.operators.drift import align
from packtrace.session import durable
from packtrace.sources.tables import require

# Defaults of the training jobs.
FAULT_TEST_SIZE = 0.2
SOH_TEST_SIZE = 0.25
SEED = 42
LEAKING = ("soh_proxy_from_input", "soh_proxy", "soh_trend_5")

# Cumulative Poisson(1) probabilities, the limit of drawing n rows out of n.
POISSON = (
    0.36787944117144233,
    0.7357588823428847,
    0.9196986029286058,
    0.9810118431238462,
    0.9963401531726563,
    0.9994058151824183,
    0.9999167588507119,
    0.9999897508033253,
    0.9999988747974021,
)
_MAX_CLASSES = 1000


def feature_columns(df: DataFrame, skip: Sequence[str | None]) -> list[str]:
    return [c for c in df.columns if c not in skip]


def feature_matrix(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Feature columns as doubles, anything missing or unreadable as 0.0."""
    return df.select(*keep, *[F.coalesce(number(F.col(c)), F.lit(0.0)).alias(c) for c in features])


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def impute_label(df: DataFrame, label: str, name: str = "y_true", accuracy: int = quantiles.ACCURACY) -> DataFrame:
    """Missing labels become the median label; infinite ones are dropped. Starts no job."""
    return _filled(df, label, _median(df, label, accuracy).scalar(), name)


def _median(df: DataFrame, label: str, accuracy: int = quantiles.ACCURACY) -> DataFrame:
    return quantiles.by_column(df, [number(F.col(label))], [0.5], accuracy=accuracy).select(F.col("quantiles")[0].alias("median"))


def _filled(df: DataFrame, label: str, median: Column, name: str = "y_true") -> DataFrame:
    return df.withColumn(name, F.coalesce(number(F.col(label)), median)).filter(finite(F.col(name)).isNotNull())


@dataclass(frozen=True)
class FaultModel:
    fitted: object
    classes: list[str]
    features: list[str]

    @property
    def binary(self) -> bool:
        return len(self.classes) == 2

    def _probability(self) -> Column:
        if self.binary:
            return vector_to_array("probability")
        votes = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
        total = F.aggregate(votes, F.lit(0.0), lambda a, b: a + b)
        return F.transform(votes, lambda v: v / total)

    def predict(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns, ``predicted_label``, ``probability`` per class and ``features``."""
        scored = self.fitted.transform(_assembled(feature_matrix(df, self.features, keep), self.features))
        names = F.array(*[F.lit(c) for c in self.classes])
        return scored.select(
            *keep,
            vector_to_array("features").alias("features"),
            F.get(names, F.col("prediction").cast("int")).alias("predicted_label"),
            self._probability().alias("probability"),
        )

    def forests(self, spark) -> list[trees.Forest]:
        members = [self.fitted] if self.binary else self.fitted.models
        return [trees.Forest.load(spark, m) for m in members]

    def explain(self, predictions: DataFrame, toward: str = "positive") -> DataFrame:
        """Long attribution table in margin space.

        With two classes values point toward the second class, or toward the predicted
        one with ``toward="predicted"``; with more, toward the predicted class.
        """
        forests = self.forests(predictions.sparkSession)
        position = F.array_position(F.array(*[F.lit(c) for c in self.classes]), F.col("predicted_label")) - 1
        which = F.lit(0) if self.binary else position.cast("int")
        values = trees.attributions(forests, F.col("features"), which)
        names = F.array(*[F.lit(f) for f in self.features])
        named = F.zip_with(names, "_a", lambda f, v: F.struct(f.alias("feature"), v.alias("shap_value")))
        keep = [c for c in ("sample_id", "predicted_label", "true_label") if c in predictions.columns]
        rows = predictions.withColumn("_a", values).select(*keep, F.explode(named).alias("s"))
        rows = rows.select(*keep, "s.feature", "s.shap_value")
        if self.binary and toward == "predicted":
            rows = attribution.toward_predicted(rows, self.classes[1])
        return rows


@dataclass(frozen=True)
class FaultRun:
    model: FaultModel
    rows: DataFrame
    predictions: DataFrame
    test_size: float = FAULT_TEST_SIZE

    def metrics(self) -> DataFrame:
        """One row: test share, counts, classes, accuracy, macro scores and AUROC on the test side."""
        classes = self.model.classes
        scores = evaluate.classification_metrics(self.predictions)
        area = evaluate.auroc_macro(self.predictions, classes, "probability", "true_label")
        counts = evaluate.run_counts(self.rows, features=len(self.model.features))
        packed = counts.select(F.struct("*").alias("c")).scalar()
        out = scores.withColumns({"auroc": area.scalar(), "_c": packed})
        return out.select("*", "_c.*", F.array(*[F.lit(c) for c in classes]).alias("classes"), F.lit(self.test_size).alias("test_size")).drop("_c")


def fit_fault(
    df: DataFrame,
    label: str,
    sample: str,
    features: Sequence[str] | None = None,
    test_size: float = FAULT_TEST_SIZE,
    seed: int = SEED,
    model_kwargs: dict | None = None,
) -> FaultRun:
    """Gradient-boosted trees on a stratified split; more than two classes go one-vs-rest."""
    require(df, [label, sample])
    features = list(features or feature_columns(df, (label, sample)))
    found = df.select(F.col(label).cast("string").alias("c")).dropna().distinct().limit(_MAX_CLASSES + 1).collect()
    classes = sorted(r.c for r in found)
    if not 2 <= len(classes) <= _MAX_CLASSES:
        raise ValueError(f"need between 2 and {_MAX_CLASSES} classes")
    rows = df.withColumnsRenamed({sample: "sample_id"}).withColumn("true_label", F.col(label).cast("string"))
    rows = feature_matrix(rows.filter(F.col("true_label").isNotNull()), features, ("sample_id", "true_label"))
    # training reads its table many times; a written one has partitions of sensible size
    rows = durable(split.stratified(rows, "true_label", "sample_id", test_size, seed))
    position = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("true_label")) - 1
    train = _assembled(rows.filter(~F.col("is_test")), features)
    train = train.select("features", position.cast("double").alias("label")).persist()
    settings = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3, "seed": seed, **(model_kwargs or {})}
    learner = GBTClassifier(**settings)
    fitted = (learner if len(classes) == 2 else OneVsRest(classifier=learner)).fit(train)
    train.unpersist()
    model = FaultModel(fitted, classes, features)
    test = rows.filter("is_test")
    return FaultRun(model, rows, model.predict(test, ("sample_id", "true_label")).persist(), test_size)


def bootstrap_weight(sample: str, seed: int) -> Column:
    """How often a row occurs in a resample: Poisson(1), drawn from a hash of its id.

    Tied to the id, a draw survives recomputation on another executor, and any engine can repeat it.
    """
    digest = F.substring(split.hash_rank(sample, seed), 1, 13)
    u = F.conv(digest, 16, 10).cast("bigint") / F.lit(float(1 << 52))
    return sum((F.when(u >= c, 1.0).otherwise(0.0) for c in POISSON), F.lit(0.0))


@dataclass(frozen=True)
class SohModel:
    fitted: object
    resampled: list = field(repr=False)
    features: list[str]
    forest: trees.Forest | None = field(repr=False)
    label_median: float | None = None

    def predict(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns, ``y_pred``, ``tree_std`` and the resampled mean and spread.

        Every model scores the same row in one pass over the table, inside the engine.
        """
        out = _assembled(align(df, self.features, keep), self.features)
        fitted = self.fitted if self.forest is None else self.fitted.copy({self.fitted.leafCol: "_leaf"})
        out = fitted.transform(out)
        names = []
        for k, model in enumerate(self.resampled):
            names.append(f"_b{k}")
            out = model.copy({model.predictionCol: names[-1]}).transform(out)
        if self.forest is None:
            out = out.withColumn("tree_std", F.lit(0.0))
        else:
            out = trees.with_tree_spread(out, self.forest, vector_to_array("_leaf"))
        out = out.select(*keep, "y_pred", "tree_std", *names)
        total = sum((F.col(n) for n in names), F.lit(0.0))
        out = out.withColumn("bootstrap_mean", total / len(names))
        square = sum(((F.col(n) - F.col("bootstrap_mean")) ** 2 for n in names), F.lit(0.0))
        return out.withColumn("bootstrap_std", F.sqrt(square / len(names))).drop(*names)

    def importance(self, spark) -> DataFrame:
        scores = self.fitted.featureImportances.toArray().tolist()
        rows = sorted(zip(self.features, scores), key=lambda r: (-r[1], r[0]))
        return spark.createDataFrame(rows, "feature string, importance double")


@dataclass(frozen=True)
class SohRun:
    model: SohModel
    rows: DataFrame
    predictions: DataFrame

    def metrics(self) -> DataFrame:
        """One row: counts, regression metrics, interval coverage and width."""
        counts = evaluate.run_counts(self.rows, features=len(self.model.features))
        test = [c.alias(n) for n, c in evaluate.regression_columns().items()]
        cover = [c.alias(n) for n, c in evaluate.coverage_columns().items()]
        scored = self.predictions.agg(F.struct(*test).alias("test"), *cover)
        out = counts.withColumn("_s", scored.select(F.struct("*")).scalar())
        out = out.select((F.col("n_train") + F.col("n_test")).alias("n_rows"), "*", "_s.*").drop("_s")
        return out.withColumn("bootstrap_reps", F.lit(len(self.model.resampled)))


def _soh_learner(model: str, n_trees: int, depth: int, seed: int):
    common = {"labelCol": "y_true", "weightCol": "_w", "predictionCol": "y_pred", "maxDepth": depth, "seed": seed}
    if model == "rf":
        return RandomForestRegressor(numTrees=n_trees, featureSubsetStrategy="all", **common)
    if model == "gb":
        return GBTRegressor(maxIter=max(1, n_trees // 2), **common)
    raise ValueError("model must be rf or gb")


def fit_soh(
    df: DataFrame,
    label: str,
    sample: str,
    group: str | None = None,
    features: Sequence[str] | None = None,
    exclude: Sequence[str] = LEAKING,
    model: str = "rf",
    n_trees: int = 300,
    max_depth: int = 10,
    test_size: float = SOH_TEST_SIZE,
    seed: int = SEED,
    n_bootstrap: int = 20,
    parallelism: int = 4,
) -> SohRun:
    """Regressor plus resampled refits; columns derived from the label are left out by default."""
    require(df, [label, sample, group])
    features = list(features or feature_columns(df, (label, sample, group, *exclude)))
    keep = ("sample_id", "y_true", "_group")
    median = _median(df, label).first().median
    rows = _filled(df, label, F.lit(median).cast("double")).withColumn("sample_id", F.col(sample))
    rows = rows.withColumn("_group", F.col(group) if group else F.lit(None).cast("string"))
    rows = feature_matrix(rows, features, keep)
    rows = durable(split.by_group(rows, "sample_id", "_group" if group else None, test_size, seed))
    train = _assembled(rows.filter(~F.col("is_test")), features).select("sample_id", "features", "y_true").persist()
    fitted = _soh_learner(model, n_trees, max_depth, seed).fit(train.withColumn("_w", F.lit(1.0)))

    def refit(k: int):
        weighed = train.withColumn("_w", bootstrap_weight("sample_id", seed + 100 + k)).filter("_w > 0")
        return _soh_learner(model, n_trees, max_depth, seed + 100 + k).fit(weighed)

    spark = df.sparkSession
    with ThreadPool(max(1, parallelism)) as pool:
        resampled = pool.map(inheritable_thread_target(spark)(refit), range(max(1, n_bootstrap)))
    train.unpersist()
    forest = trees.Forest.load(spark, fitted) if model == "rf" else None
    soh = SohModel(fitted, resampled, features, forest, median)
    predictions = evaluate.with_interval(soh.predict(rows.filter("is_test"), ("sample_id", "y_true")))
    return SohRun(soh, rows, predictions.persist())


def score_target(run: SohRun, target: DataFrame, sample: str, label: str | None = None) -> DataFrame:
    """Predictions for another fleet; ``y_true`` is NULL without a label there."""
    known = label is not None and label in target.columns
    rows = target.withColumn("_y", number(F.col(label)) if known else F.lit(None).cast("double"))
    scored = run.model.predict(rows, (sample, "_y"))
    return scored.select(F.col(sample).alias("sample_id"), F.col("_y").alias("y_true"), "y_pred")
