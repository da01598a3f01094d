from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from packtrace.operators import attribution, evaluate, models, prompts, split
from packtrace.plans import catalog
from packtrace.sources import sinks, store
from packtrace.session import scratch


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    return catalog._soh_table(spark, sf_dir).fillna(0.0).persist()


@pytest.fixture(scope="module")
def soh(features):
    return models.fit_soh(
        features, "soh_proxy", "sample_id", group="device", n_trees=6, max_depth=3, n_bootstrap=2, parallelism=2
    )


@pytest.fixture(scope="module")
def fault(spark, sf_dir):
    table = catalog._labelled_faults(spark, sf_dir, 2).persist()
    return models.fit_fault(table, "fault", "sample_id", model_kwargs={"maxIter": 4})


def test_groups_stay_on_one_side(soh):
    sides = soh.rows.groupBy("_group").agg(F.count_distinct("is_test").alias("n"))
    assert sides.filter("n > 1").isEmpty()
    tested = soh.rows.filter("is_test").select("_group").distinct().count()
    assert tested == 3  # a quarter of ten devices, rounded up


def test_label_and_what_derives_from_it_are_no_features(soh):
    assert not {*models.LEAKING, "sample_id", "device"} & set(soh.model.features)


def test_interval_holds_the_resampled_mean(soh):
    rows = soh.predictions.collect()
    assert rows
    for r in rows:
        assert r.y_pi_lower_95 <= r.bootstrap_mean <= r.y_pi_upper_95
        assert r.uncertainty == max(r.tree_std, r.bootstrap_std)
        assert r.residual == pytest.approx(r.y_true - r.y_pred)


def test_soh_metrics(soh):
    row = soh.metrics().first()
    assert 0 <= row.test_pi_coverage_95 <= 1 and row.test.mae >= 0
    assert row.n_rows == row.n_train + row.n_test and row.bootstrap_reps == 2


def test_training_is_reproducible(features, soh):
    again = models.fit_soh(
        features, "soh_proxy", "sample_id", group="device", n_trees=6, max_depth=3, n_bootstrap=2, parallelism=1
    )
    pick = ("sample_id", "y_pred", "bootstrap_mean", "tree_std")
    one, two = (r.predictions.select(*pick).orderBy("sample_id").collect() for r in (soh, again))
    assert [r.sample_id for r in one] == [r.sample_id for r in two]
    for a, b in zip(one, two):
        assert tuple(a)[1:] == pytest.approx(tuple(b)[1:])


def test_saved_soh_model_scores_alike(spark, features, soh):
    path = scratch(spark, "saved-soh")
    store.save_soh(spark, soh.model, path)
    again = store.load_soh(spark, path)
    assert again.features == soh.model.features and len(again.resampled) == 2 and again.label_median == soh.model.label_median
    one, two = (m.predict(features, ("sample_id",)).orderBy("sample_id").collect() for m in (soh.model, again))
    assert one == two
    plan = again.predict(features, ("sample_id",))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    with pytest.raises(ValueError, match="kind soh, expected fault"):
        store.load_fault(spark, path)


def test_saved_fault_model_scores_alike(spark, sf_dir, fault):
    path = scratch(spark, "saved-fault")
    store.save_fault(spark, fault.model, path)
    again = store.load_fault(spark, path)
    assert (again.classes, again.features) == (fault.model.classes, fault.model.features)
    test = fault.rows.filter("is_test")
    one, two = (m.predict(test, ("sample_id",)).orderBy("sample_id").collect() for m in (fault.model, again))
    assert one == two
    spark.createDataFrame([(2, "fault", "GBTClassificationModel")], "format int, kind string, learner string").write.mode("overwrite").json(f"{path}/manifest")
    with pytest.raises(ValueError, match="format 2"):
        store.load_fault(spark, path)


def test_target_without_label_or_some_columns(features, soh):
    other = features.drop("soh_proxy", "energy_wh")
    rows = models.score_target(soh, other, "sample_id", "soh_proxy")
    assert rows.count() == other.count() and rows.filter("y_true is not null").isEmpty()
    assert rows.filter("y_pred is null").isEmpty()


def test_importance_is_ranked(spark, soh):
    scores = [r.importance for r in soh.model.importance(spark).collect()]
    assert len(scores) == len(soh.model.features) and sum(scores) == pytest.approx(1.0)


def test_fault_run(spark, fault):
    row = fault.metrics().first()
    assert row.classes == ["normal", "thermal"] and 0 <= row.accuracy <= 1 and 0 <= row.auroc <= 1
    for r in fault.predictions.collect():
        assert sum(r.probability) == pytest.approx(1.0)
        assert r.predicted_label == fault.model.classes[r.probability.index(max(r.probability))]


def test_attribution_directions(fault):
    plain = fault.model.explain(fault.predictions)
    turned = fault.model.explain(fault.predictions, toward="predicted")
    a = {(r.sample_id, r.feature): r for r in plain.collect()}
    for r in turned.collect():
        sign = 1 if r.predicted_label == "thermal" else -1
        assert r.shap_value == pytest.approx(sign * a[r.sample_id, r.feature].shap_value)


def test_top_attributions_reach_prompts(fault):
    top = attribution.top(fault.model.explain(fault.predictions), 4)
    assert top.groupBy("sample_id").count().filter("count <> 4").isEmpty()
    packed = prompts.compose(top, {}, max_features=2, sample_limit=3)
    rows = packed.orderBy("sample_id").collect()
    first = sorted(r.sample_id for r in top.select("sample_id").distinct().collect())[:3]
    assert [r.sample_id for r in rows] == first
    assert all(prompts.UNKNOWN in r.prompt and len(r.summary.top_contributors) == 2 for r in rows)


def test_model_can_be_saved(spark, fault):
    from pyspark.ml.classification import GBTClassificationModel

    path = scratch(spark, "saved")
    sinks.save_model(fault.model.fitted, path)
    assert GBTClassificationModel.load(path).totalNumNodes == fault.model.fitted.totalNumNodes


def test_one_class_is_refused(spark):
    df = spark.createDataFrame([(1, "x", 0.5), (2, "x", 0.7)], "sample_id int, fault string, f double")
    with pytest.raises(ValueError, match="classes"):
        models.fit_fault(df, "fault", "sample_id")


def test_stratified_counts_and_hot_labels(spark):
    df = spark.range(1000).select(F.col("id").alias("s"), F.when(F.col("id") % 10 < 8, "a").otherwise("b").alias("l"))
    got = split.stratified(df, "l", "s", 0.2).groupBy("l").agg(F.count_if("is_test").alias("n")).collect()
    assert {r.l: r.n for r in got} == {"a": 160, "b": 40}
    twice = split.stratified(df.unionByName(df), "l", "s", 0.2)  # copies of an id stay on one side
    assert twice.groupBy("s").agg(F.count_distinct("is_test").alias("n")).filter("n > 1").isEmpty()
    none = split.stratified(df.limit(2), "l", "s", 0.2)
    assert none.filter("is_test").isEmpty() and none.count() == 2


def test_bootstrap_weights_look_like_resampling(spark):
    df = spark.range(4000).select(models.bootstrap_weight("id", 5).alias("w"))
    row = df.agg(F.avg("w").alias("m"), F.avg((F.col("w") == 0).cast("int")).alias("z")).first()
    assert row.m == pytest.approx(1.0, abs=0.06) and row.z == pytest.approx(0.368, abs=0.03)


def test_auroc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, True), (0.9, True)], "p double, y boolean")
    assert evaluate.auroc(df, "p", F.col("y")).first()["auroc"] is None


@pytest.mark.parametrize("name, owner, fit", [("soh_model_boosted_predictions", "models", "fit_soh"), ("field_workflow", "workflow", "run")])
def test_queries_fit_at_the_documented_size(monkeypatch, name, owner, fit):
    from packtrace.plans import catalog

    class Asked(Exception):
        pass

    def record(*_, **given):
        raise Asked(given)

    for table in ("_soh_table", "_cycles", "_assets"):
        monkeypatch.setattr(catalog, table, lambda *_: None)
    monkeypatch.setattr(catalog, "_once", lambda *_, fit: fit())
    monkeypatch.setattr(getattr(catalog, owner), fit, record)
    with pytest.raises(Asked) as asked:
        catalog.QUERIES[name](None, None)
    assert not {"n_trees", "max_depth", "n_bootstrap"} & asked.value.args[0].keys()
