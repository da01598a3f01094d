"""Model evaluation on prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from packtrace.functions.numeric import number

RANGES = 256  # of scores
MARGIN = 0.12
Z95 = 1.96


def confusion(df: DataFrame, truth: str = "true_label", predicted: str = "predicted_label") -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def per_class(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 for every label seen as truth or as prediction."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("rows")).otherwise(0)
    sides = F.array(
        F.struct(F.col("truth").alias("label"), F.col("rows").alias("truth"), F.lit(0).alias("said"), hit.alias("hit")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).alias("truth"), F.col("rows").alias("said"), F.lit(0).alias("hit")),
    )
    rows = counts.select(F.explode(sides).alias("s")).select("s.*")
    sums = rows.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("truth", "said", "hit")])

    def part(num: Column, den: Column) -> Column:
        return F.coalesce(F.try_divide(num, den), F.lit(0.0))

    return sums.select(
        "label",
        F.col("truth").alias("support"),
        F.col("hit").alias("hits"),
        part(F.col("hit"), F.col("said")).alias("precision"),
        part(F.col("hit"), F.col("truth")).alias("recall"),
        part(2 * F.col("hit"), F.col("said") + F.col("truth")).alias("f1"),
    )


def classification_metrics(df: DataFrame, truth: str = "true_label", predicted: str = "predicted_label") -> DataFrame:
    """One row: accuracy and macro averages; an empty denominator counts as 0."""
    return per_class(confusion(df, truth, predicted)).agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
    )


def _areas(rows: DataFrame, by: list[str]) -> DataFrame:
    """Exact area under the ROC curve per group of ``by`` from columns _s and _y, ties counting half.

    Scores are cut into ranges at approximate percentiles, which one scalar subquery finds. Rows
    collapse by score, each range sums up as (positives, negatives, area), and those few sums are
    merged in order: a range's positives also beat the negatives of all ranges before it.
    """
    cuts = rows.agg(F.percentile_approx("_s", [k / RANGES for k in range(1, RANGES)], 10 * RANGES)).scalar()
    placed = rows.withColumn("_cuts", cuts).withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("_s"))))
    tally = placed.groupBy(*by, "_b", "_s").agg(F.count_if("_y").alias("pos"), F.count_if(~F.col("_y")).alias("neg"))
    upto = F.sum("neg").over(Window.partitionBy(*by, "_b").orderBy("_s"))
    tally = tally.withColumn("won", F.col("pos") * (upto - F.col("neg") / 2))
    sums = tally.groupBy(*by, "_b").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    listed = F.sort_array(F.collect_list(F.struct("_b", "pos", "neg", "won")))  # at most RANGES
    none = F.lit(0).cast("bigint")

    def merge(a: Column, r: Column) -> Column:
        won = a["won"] + r["won"] + r["pos"].cast("double") * a["neg"]
        return F.struct((a["pos"] + r["pos"]).alias("pos"), (a["neg"] + r["neg"]).alias("neg"), won.alias("won"))

    start = F.struct(none.alias("pos"), none.alias("neg"), F.lit(0.0).alias("won"))
    merged = sums.groupBy(*by).agg(listed.alias("r")).withColumn("m", F.aggregate("r", start, merge))
    return merged.select(*by, F.try_divide(F.col("m.won"), F.col("m.pos") * F.col("m.neg").cast("double")).alias("auroc"))


def auroc_by_class(df: DataFrame, label: str, score: str, positive: Column) -> DataFrame:
    """Area under the ROC curve per class; NULL where only one side is present."""
    return _areas(df.select(label, F.col(score).cast("double").alias("_s"), positive.alias("_y")), [label])


def auroc(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """One row; NULL when only one class is present."""
    return _areas(df.select(F.col(score).cast("double").alias("_s"), positive.alias("_y")), [])


def auroc_macro(df: DataFrame, classes: list[str], probability: str, truth: str) -> DataFrame:
    """Mean one-vs-rest area over the classes; binary input scores the second class."""
    if len(classes) == 2:
        scored = df.select(F.col(probability)[1].alias("_p"), F.col(truth).alias("_t"))
        return auroc(scored, "_p", F.col("_t") == F.lit(classes[1]))
    named = F.transform(
        F.array(*[F.lit(c) for c in classes]),
        lambda c, i: F.struct(c.alias("c"), F.get(F.col(probability), i).alias("p")),
    )
    rows = df.select(F.col(truth).alias("_t"), F.explode(named).alias("s")).select("_t", "s.c", "s.p")
    return auroc_by_class(rows, "c", "p", F.col("_t") == F.col("c")).agg(F.avg("auroc").alias("auroc"))


def hard_cases(df: DataFrame, classes: int, margin: float = MARGIN, probability: str = "probability") -> DataFrame:
    """Predictions too close to the decision border to be trusted unseen."""
    p = F.col(probability)
    ordered = F.sort_array(p, asc=False)
    close = F.abs(p[1] - 0.5) < margin if classes == 2 else (ordered[0] - ordered[1]) < margin
    return df.filter(close).select("sample_id", "predicted_label", "true_label", F.array_max(p).alias("max_prob"))


def regression_columns(truth: str = "y_true", predicted: str = "y_pred") -> dict[str, Column]:
    y, error = F.col(truth), F.col(predicted) - F.col(truth)
    return {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "r2": 1 - F.try_divide(F.avg(error * error), F.var_pop(y)),
        "mpe_percent": F.avg(F.when(y != 0, error / y)) * 100,
    }


def regression_metrics(df: DataFrame, truth: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    """One row: MAE, RMSE, R2 and mean percentage error over rows with a finite label."""
    rows = df.filter(F.abs(number(F.col(truth))) < F.lit(float("inf")))
    return rows.agg(*[c.alias(n) for n, c in regression_columns(truth, predicted).items()])


def with_interval(df: DataFrame, centre: str = "bootstrap_mean", z: float = Z95) -> DataFrame:
    """Add uncertainty, 95 % bounds, width and residual to predictions."""
    spread = F.greatest("tree_std", "bootstrap_std")
    out = df.withColumn("uncertainty", spread)
    half = F.lit(z) * F.col("uncertainty")
    out = out.withColumns({"y_pi_lower_95": F.col(centre) - half, "y_pi_upper_95": F.col(centre) + half})
    return out.withColumns(
        {"pi_width": F.col("y_pi_upper_95") - F.col("y_pi_lower_95"), "residual": F.col("y_true") - F.col("y_pred")}
    )


def coverage_columns() -> dict[str, Column]:
    inside = F.col("y_true").between(F.col("y_pi_lower_95"), F.col("y_pi_upper_95"))
    return {
        "test_pi_coverage_95": F.avg(F.coalesce(inside, F.lit(False)).cast("double")),
        "test_mean_interval_width_95": F.avg("pi_width"),
    }


def coverage(df: DataFrame) -> DataFrame:
    """One row: share of labels inside their interval, and the mean width."""
    return df.agg(*[c.alias(n) for n, c in coverage_columns().items()])


def uncertainty_table(df: DataFrame) -> DataFrame:
    covered = coverage(df).select("test_pi_coverage_95").scalar()
    return df.select(
        "sample_id",
        F.col("uncertainty").alias("uncertainty_95"),
        F.col("pi_width").alias("interval_width_95"),
        covered.alias("coverage_95"),
    )


def run_counts(split: DataFrame, label: str | None = None, features: int = 0, test: str = "is_test") -> DataFrame:
    """One row: training and test sizes, feature count and, for classifiers, the classes."""
    cols = [
        F.count_if(~F.col(test)).alias("n_train"),
        F.count_if(test).alias("n_test"),
        F.lit(features).alias("n_features"),
    ]
    if label:
        cols.append(F.sort_array(F.collect_set(F.col(label).cast("string"))).alias("classes"))
    return split.agg(*cols)
