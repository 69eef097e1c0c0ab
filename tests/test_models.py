import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from wardlight.config import RunConfig
from wardlight.operators import explain, models, split, tuning
from wardlight.operators.metrics import ranking_areas
from wardlight.operators.score import expected_schema, predict_risk
from wardlight.plans import catalog, training
from wardlight.session import materialize
from wardlight.sources import encounters as source
from wardlight.sources import sinks


@pytest.fixture(scope="module")
def stays(spark):
    """900 stays of 300 patients whose risk grows with number_inpatient."""
    noise = F.pmod(F.xxhash64("id"), F.lit(100))
    inpatient = (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(6))).cast("int")
    readmitted = F.when(noise < 8 * inpatient, "<30").when(noise < 70, ">30").otherwise("NO")
    return materialize(
        spark.range(900).select(
            F.col("id").alias("encounter_id"), (F.col("id") % 300).alias("patient_nbr"),
            F.element_at(F.array(*map(F.lit, ["Asian", "Caucasian", "Other"])),
                         (F.pmod(F.col("id"), F.lit(3)) + 1).cast("int")).alias("race"),
            F.when(F.col("id") % 2 == 0, "[60-70)").otherwise("[70-80)").alias("age"),
            inpatient.alias("number_inpatient"), F.lit(0).alias("number_emergency"),
            F.lit(1).alias("number_outpatient"), F.lit(1).alias("discharge_disposition_id"),
            F.when(F.col("id") % 4 == 0, "428").otherwise("250.83").alias("diag_1"),
            F.lit("No").alias("insulin"), readmitted.alias("readmitted"),
        )
    )


@pytest.fixture(scope="module")
def prepared(stays):
    table = materialize(training.prepare_data(stays))
    return (
        table.where("split = 'train'").drop("split"), table.where("split = 'test'").drop("split")
    )


@pytest.fixture(scope="module")
def fitted(prepared):
    return models.fit_pipeline(prepared[0])


def newton(x, y, weights, c):
    """Minimum of 1/2 |w|^2 + c * sum(weight * log loss), free intercept."""
    design = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = penalty @ beta + c * design.T @ (weights * (p - y))
        hessian = penalty + c * (design.T * (weights * p * (1 - p))) @ design
        beta -= np.linalg.solve(hessian, gradient)
    return beta


@pytest.mark.parametrize("c", [0.05, 1.0])
def test_logistic_optimum(spark, c):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3)) * [1.0, 5.0, 0.2]
    y = (rng.random(300) < 1 / (1 + np.exp(1.5 - x[:, 0]))).astype(int)
    df = spark.createDataFrame(
        [(int(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "features"]
    )
    share = models.class_weights(df)
    weights = np.where(y == 1, share[1], share[0])
    assert share[1] == pytest.approx(300 / (2 * y.sum()))
    spec = models.ModelSpec("LogReg", models.logistic_regression, {"tol": 1e-12})
    model = models.fit_classifier(df, spec, {"C": c})
    want = newton(x, y, weights, c)
    assert model.coefficients.toArray() == pytest.approx(want[:3], abs=1e-5)
    assert model.intercept == pytest.approx(want[3], abs=1e-5)


def test_pipeline_learns_and_round_trips(spark, prepared, fitted, tmp_path):
    scored = predict_risk(fitted, prepared[1])
    assert ranking_areas(scored).first()["auc_roc"] > 0.6
    assert scored.where("score < 0 OR score > 1").count() == 0
    paths = sinks.save_model(fitted, str(tmp_path), "LogReg")
    for path in paths.values():
        again = predict_risk(sinks.load_model(path), prepared[1])
        both = scored.join(again.withColumnRenamed("score", "s2"), "encounter_id")
        assert both.where("score <> s2").count() == 0


def test_scoring_survives_missing_and_extra_columns(spark, fitted):
    one = predict_risk(fitted, source.example_record(spark), 0.5).first()
    assert 0 <= one["score"] <= 1 and one["y_pred"] in (0, 1)
    bare = spark.createDataFrame([(1, "?", "extra")], "encounter_id int, race string, x string")
    row = predict_risk(fitted, bare).first()
    assert set(row.asDict()) >= {"encounter_id", "score", "y_pred"} and 0 <= row["score"] <= 1
    assert "x" not in predict_risk(fitted, bare).columns


def test_scoring_is_narrow(prepared, fitted):
    plan = predict_risk(fitted, prepared[1])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_expected_schema_leaves_out_ids(fitted):
    names = expected_schema(fitted).names
    assert "race" in names and not {"encounter_id", "label", "group"} & set(names)


def test_coefficients_and_importances(prepared, fitted):
    top = explain.logistic_coefficients(fitted, 5).collect()
    assert len(top) == 5
    assert [r["abs_coef"] for r in top] == sorted((r["abs_coef"] for r in top), reverse=True)
    assert any("inpatient" in r["feature"] or "prior" in r["feature"] for r in top)
    forest = models.fit_pipeline(prepared[0], "RandomForest", {"n_estimators": 5, "max_depth": 3})
    assert explain.feature_importance_or_coef(forest, 3).columns == ["feature", "score", "coef"]
    assert explain.tree_importances(forest, 3).count() == 3
    with pytest.raises(AttributeError):
        explain.logistic_coefficients(forest)
    with pytest.raises(AttributeError):
        explain.tree_importances(fitted)


def test_permutation_importance(prepared, fitted):
    found = explain.permutation_importance(
        fitted, prepared[0].repartition(7), ["number_inpatient", "age"]
    ).collect()
    assert found[0]["feature"] == "number_inpatient" and found[0]["importance"] > 0.02
    with pytest.raises(ValueError, match="not inputs"):
        explain.permutation_importance(fitted, prepared[0], ["nothing"])


def test_permuted_copies_are_scored_in_tasks_by_their_number(prepared, fitted, monkeypatch):
    """However few ranges the ring has, no task scores the copies of all rows."""
    tasks, n = [], prepared[1].count()

    def ranked(scored, groups):
        tasks.append(scored.rdd.getNumPartitions())
        return ranking_areas(scored, groups=groups)

    monkeypatch.setattr(explain, "ranking_areas", ranked)
    monkeypatch.setattr(explain, "TASK_COPIES", n // 4, raising=False)
    columns = ["number_inpatient", "race"]
    explain.permutation_importance(fitted, prepared[1], columns, repeats=2)
    assert tasks[0] >= 5 * 4


@pytest.mark.parametrize("ring_rows", [explain.RING_ROWS, 40])
def test_ring_shifts_are_permutations(spark, ring_rows):
    """Whatever the ranges: the k-th next row in hash order, round the whole table."""
    table = spark.range(500).select(F.col("id").alias("encounter_id"), (F.col("id") * 3).alias("v"))
    found = explain._ring(table, ["v"], "encounter_id", 1, 4, ring_rows).select(
        "encounter_id", "__others.v").collect()
    order = [r["encounter_id"] for r in table.withColumn(
        "h", split.seeded_hash("encounter_id", 1)).orderBy("h", "encounter_id").collect()]
    place = {e: i for i, e in enumerate(order)}
    assert len(found) == 500
    for e, values in found:
        assert values == [3 * order[(place[e] + k) % 500] for k in (1, 2, 3, 4)]
    few = explain._ring(table.limit(2), ["v"], "encounter_id", 1, 3, ring_rows).collect()
    assert all(len(set(x["v"] for x in r["__others"])) == 2 for r in few)


def test_all_inputs_permuted(prepared, fitted):
    found = {r["feature"]: r for r in explain.permutation_importance(
        fitted, prepared[0], repeats=3).collect()}
    assert set(found) == set(expected_schema(fitted).names)
    area = ranking_areas(predict_risk(fitted, prepared[0])).first()["auc_pr"]
    assert all(r["auc_pr"] == pytest.approx(area) for r in found.values())
    assert found["insulin"]["importance"] == pytest.approx(0, abs=1e-12)  # constant
    assert found["number_inpatient"]["deviation"] > 0


def test_excluded_attribute_is_not_a_feature(prepared):
    model = models.fit_pipeline(prepared[0], exclude=("race",))
    assert not any(n.startswith("race") for n in explain.pipeline_feature_names(model))
    assert "race" in predict_risk(model, prepared[1]).columns


def test_boosted_trees(prepared):
    model = models.fit_pipeline(prepared[0], "BoostedTrees", {"n_estimators": 10, "max_depth": 3})
    assert ranking_areas(predict_risk(model, prepared[0])).first()["auc_roc"] > 0.6


def test_trees_do_not_depend_on_partitions(prepared):
    """Equal forests, whatever the partitioning and order of the rows."""
    train = prepared[0]
    found = {
        "RandomForest": [], "BoostedTrees": [],
    }
    for name, params in (("RandomForest", {"n_estimators": 12, "max_depth": 8}),
                         ("BoostedTrees", {"n_estimators": 4, "max_depth": 3})):
        for table in (train, train.repartition(7), train.orderBy(F.desc("encounter_id")).coalesce(1)):
            model = models.fit_pipeline(table, name, params).stages[-1]
            found[name].append(model.featureImportances.toArray())
    for first, *others in found.values():
        assert first.sum() == pytest.approx(1)
        assert all(np.array_equal(first, o) or o == pytest.approx(first, abs=1e-9) for o in others)


def test_positive_weight_is_a_parameter(prepared):
    light, heavy = (
        predict_risk(models.fit_pipeline(prepared[0], "BoostedTrees", {
            "n_estimators": 3, "max_depth": 2, "positive_weight": w}), prepared[1])
        .agg(F.avg("score")).first()[0] for w in (1.0, 20.0))
    assert heavy > light + 0.1


def test_certificate(spark):
    """The gradient equals numpy's, vanishes at the optimum and not elsewhere."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < 1 / (1 + np.exp(1 - x[:, 0]))).astype(int)
    rows = models.LearningRows(spark.createDataFrame(
        [(int(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "features"]))
    spec = models.ModelSpec("LogReg", models.logistic_regression, {"tol": 1e-12})
    weights = np.where(y == 1, 400 / (2 * y.sum()), 400 / (2 * (400 - y.sum())))
    exact = models.fit_classifier(rows, spec, {"C": 2.0})
    early = models.fit_classifier(rows, spec, {"C": 2.0, "max_iter": 2})
    for model, optimal in ((exact, True), (early, False)):
        got = models.logistic_certificate(model, rows, 2.0, tolerance=1e-6).first()
        w, b = model.coefficients.toArray(), model.intercept
        p = 1 / (1 + np.exp(-x @ w - b))
        r = weights * (p - y)
        gradient = np.append(w + 2 * x.T @ r, 2 * r.sum())
        assert got["gradient_norm"] == pytest.approx(np.linalg.norm(gradient), rel=1e-6, abs=1e-7)
        loss = -(weights * np.where(y == 1, np.log(p), np.log(1 - p))).sum()
        assert got["objective"] == pytest.approx(w @ w / 2 + 2 * loss)
        assert (got["n_rows"], got["optimal"]) == (400, optimal)


def test_a_broken_search_goes_on(spark, prepared, tmp_path, monkeypatch):
    """Complete folds are not fitted again; other settings or rows start anew."""
    folded = materialize(split.assign_folds(prepared[0], 3))
    config = RunConfig(folds=3, models=("LogReg",), parallelism=1, grids={"LogReg": {"C": [0.1, 1.0]}})
    plain, fits = tuning.fit_classifier, []

    def counted(*args, **kwargs):
        fits.append(1)
        if len(fits) == 4:  # in the second fold
            raise RuntimeError("lost")
        return plain(*args, **kwargs)

    monkeypatch.setattr(tuning, "fit_classifier", counted)
    store = str(tmp_path / "store")
    with pytest.raises(RuntimeError):
        tuning.tune_models(folded, config, store=store)
    fits = [0] * 10
    again = tuning.tune_models(folded, config, store=store)["LogReg"]
    assert len(fits) == 10 + 4 + 1  # two folds of two points, and the best one
    fits = [0] * 10
    third = tuning.tune_models(folded, config, store=store)["LogReg"]
    assert len(fits) == 10 + 1 and third.grid_scores == again.grid_scores
    fresh = tuning.tune_models(folded, config)["LogReg"]
    assert [p["folds"] for p in fresh.grid_scores] == [
        pytest.approx(p["folds"]) for p in again.grid_scores]
    found = tuning.cv_results(spark, {"LogReg": again}).collect()
    for r in found:
        fold = again.scores.where((F.col("fold") == r["fold"]) & (
            F.col("point") == (0 if "0.1" in r["params"] else 1)))
        assert ranking_areas(fold).first()["auc_pr"] == pytest.approx(r["score"])
    fits = [0] * 10
    tuning.tune_models(folded.where("encounter_id > 5"), config, store=store)
    assert len(fits) == 10 + 6 + 1


def test_tuning_leaves_only_its_store(spark, prepared):
    from pathlib import Path

    from wardlight.session import shared_dir

    folded = materialize(split.assign_folds(prepared[0], 2))
    folder = Path(shared_dir(spark).removeprefix("file:")) / "wardlight"
    before = set(folder.rglob("*.parquet"))
    tuning.tune_models(folded, RunConfig(folds=2, models=("LogReg",), grids={"LogReg": {"C": [1.0]}}))
    left = {p.relative_to(folder).parts[1].split("-")[0] for p in set(folder.rglob("*.parquet")) - before}
    assert left == {"tuning"}


def test_grid_points():
    points = tuning.grid_points(RunConfig().grids["RandomForest"])
    assert len(points) == 24 and len(tuning.grid_points(RunConfig().grids["LogReg"])) == 4


def test_tuning(spark, prepared):
    folded = materialize(split.assign_folds(prepared[0], 3))
    config = RunConfig(folds=3, grids={
        "LogReg": {"C": [0.01, 1.0]}, "RandomForest": {"n_estimators": [5], "max_depth": [3]},
    })
    results = tuning.tune_models(folded, config, audit=["race"])
    table = tuning.summarize_tuning(spark, results).collect()
    assert table[0]["score_cv"] >= table[1]["score_cv"] and table[0]["n_folds"] == 3
    best = tuning.select_best_model(results)
    assert best.model_name == table[0]["model"]
    # every training row is scored once, by a model that has not seen it
    oof = best.out_of_fold
    assert oof.count() == folded.count() == oof.select("encounter_id").distinct().count()
    assert "race" in oof.columns
    with pytest.raises(ValueError, match="no such model"):
        tuning.tune_models(folded, RunConfig(models=("Nothing",)))


@pytest.mark.parametrize("where", ["validation", "holdout"])
def test_training_run(spark, stays, tmp_path, where):
    config = RunConfig(folds=2, models=("LogReg",), threshold_source=where)
    result = training.run_training(spark, stays, str(tmp_path / "run"), config, quick=True)
    assert result["best_model_name"] == "LogReg" and 0 <= result["optimal_threshold"] <= 1
    for name in ("named", "default"):
        assert (tmp_path / "run" / "models").exists() and result["paths"][name]
    metrics = spark.read.json(result["paths"]["holdout_metrics"]).collect()
    assert {r["model"] for r in metrics} == {"LogReg", "LogReg_optimal_threshold"}
    report = spark.read.option("header", True).csv(result["paths"]["fairness_report"])
    assert {r["attribute"] for r in report.collect()} == {"race", "age"}
    assert spark.read.option("header", True).csv(result["paths"]["cost_curve"]).count() == 200


def test_ablation(prepared):
    table = training.ablation(*prepared, {
        "plain": ("LogReg", {}, None), "weighted": ("LogReg", {}, "balanced"),
    }).collect()
    assert {r["configuration"] for r in table} == {"plain", "weighted"}
    assert table[0]["auc_pr"] >= table[1]["auc_pr"]


def test_ablation_encodes_once(prepared, monkeypatch):
    fits, plain = [], models.fit_encoder
    monkeypatch.setattr(models, "fit_encoder", lambda *a, **k: fits.append(1) or plain(*a, **k))
    points = {"plain": ("LogReg", {}, None), "forest": (
        "RandomForest", {"n_estimators": 3, "max_depth": 3}, "balanced")}
    table = {r["configuration"]: r for r in training.ablation(*prepared, points).collect()}
    assert len(fits) == 1
    for name, (model, params, weight) in points.items():
        alone = models.fit_pipeline(prepared[0], model, params, class_weight=weight)
        area = ranking_areas(predict_risk(alone, prepared[1])).first()["auc_pr"]
        assert table[name]["auc_pr"] == pytest.approx(area)


def test_streamed_records_are_built_once(spark, folder, monkeypatch):
    """The records sent twice are read from one stored table, not made twice."""
    class Seen(Exception):
        pass

    def seen(spark, table, name):
        raise Seen(table.inputFiles())

    monkeypatch.setattr(catalog, "_fitted", lambda *_: None)
    monkeypatch.setattr(catalog, "_stream_of", seen)
    with pytest.raises(Seen) as found:
        catalog.all_queries()["stream_prediction_log"](spark, folder)
    assert found.value.args[0] and not any("lineitem" in f for f in found.value.args[0])


def test_longest_generated_method_is_one_that_is_compiled(spark):
    """HotSpot interprets longer ones for ever; ``configure`` sets the limit."""
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_spellings_of_missing_score_alike(spark, fitted):
    """A kept model input is normalised like the others."""
    one = source.example_record(spark)
    scores = {
        predict_risk(fitted, one.withColumn("race", F.lit(text)), 0.5).first()["score"]
        for text in (None, "?", "None", " ")
    }
    assert len(scores) == 1


def test_best_model_needs_a_score():
    from types import SimpleNamespace

    from wardlight.operators.tuning import select_best_model

    found = {"a": SimpleNamespace(best_score=float("nan")), "b": SimpleNamespace(best_score=0.2)}
    assert select_best_model(found) is found["b"]


def test_registered_search_has_every_point():
    """The search of the queries is that of the full run."""
    full = RunConfig()
    assert (catalog.TUNING.models, catalog.TUNING.folds) == (full.models, full.folds)
    assert catalog.TUNING.grids == full.grids
    assert sum(len(tuning.grid_points(catalog.TUNING.grids[m])) for m in full.models) == 28


def test_calibration_tunes_its_own_model_only(monkeypatch):
    searched = []
    monkeypatch.setattr(catalog, "_TUNED", {})
    monkeypatch.setattr(catalog, "_prepared", lambda spark, folder: (None, None))
    monkeypatch.setattr(catalog.split, "assign_folds", lambda table, folds: table)
    monkeypatch.setattr(catalog, "materialize", lambda table: table)
    monkeypatch.setattr(catalog.training, "spread", lambda table: table)
    monkeypatch.setattr(catalog.tuning, "tune_models", lambda table, config: searched.append(
        config.models) or dict.fromkeys(config.models, "found"))

    class Session:
        class sparkContext:
            applicationId = "app"

    assert catalog._tuned(Session, "f", ("LogReg",)) == {"LogReg": "found"}
    assert len(catalog._tuned(Session, "f")) == 2
    assert len(catalog._tuned(Session, "f", ("LogReg",))) == 2  # the wider search is there
    assert searched == [("LogReg",), ("LogReg", "RandomForest")]
