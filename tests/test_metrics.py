import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wardlight.operators import calibrate, drift, metrics, prefix, threshold

TOY = [(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0), (0.6, 1), (0.2, 0)]


@pytest.fixture
def toy(spark):
    return spark.createDataFrame(TOY, "score double, label int")


@pytest.fixture
def many(spark):
    """4,000 rows, a third of which share one score."""
    return spark.range(4000).select(
        F.col("id").alias("encounter_id"),
        F.when(F.col("id") % 3 == 0, 0.5)
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("score"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)) == 0).cast("int").alias("label"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(3)).alias("unit"),
    )


def test_areas_by_hand(toy):
    row = metrics.ranking_areas(toy).first()
    assert row["auc_pr"] == pytest.approx(1 / 3 + 2 / 9 + 1 / 5, abs=1e-9)
    assert row["auc_roc"] == pytest.approx(0.722222, abs=1e-6)


def test_areas_do_not_depend_on_ranges(many):
    whole = metrics.ranking_areas(many).first()
    cut = metrics.ranking_areas(many, rows_per_range=200).first()
    assert whole["auc_pr"] == pytest.approx(cut["auc_pr"], abs=1e-12)
    assert whole["auc_roc"] == pytest.approx(cut["auc_roc"], abs=1e-12)


def test_areas_with_one_class(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "score double, label int")
    row = metrics.ranking_areas(df).first()
    assert row["auc_pr"] is None and row["auc_roc"] is None


def test_unusable_scores_rank_last(spark):
    rows = [(0.9, 1), (None, 0), (float("nan"), 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert metrics.ranking_areas(df).first()["auc_roc"] == 1.0
    assert metrics.classification_metrics(df).first()["tn"] == 2


def test_metrics_row(toy):
    row = metrics.classification_metrics(toy, 0.65).first()
    assert (row["tp"], row["fp"], row["tn"], row["fn"]) == (2, 1, 2, 1)
    assert row["precision"] == pytest.approx(2 / 3) and row["recall"] == pytest.approx(2 / 3)
    assert row["f2"] == pytest.approx(10 / 15) and row["threshold"] == 0.65


def test_undefined_metrics_are_zero(toy):
    row = metrics.classification_metrics(toy, 0.99).first()
    assert (row["recall"], row["precision"], row["f1"], row["f2"]) == (0, 0, 0, 0)


def test_given_labels_are_used(toy):
    row = metrics.classification_metrics(
        toy.withColumn("p", F.lit(1)), 0.5, pred="p"
    ).first()
    assert (row["tp"], row["fp"], row["threshold"]) == (3, 3, 0.5)


def test_running_totals_equal_a_plain_window(many):
    rows = prefix.add_ranges(many.withColumn("one", F.lit(1)), "encounter_id", 300)
    assert rows.select(prefix.BUCKET).distinct().count() > 10
    got = prefix.running_totals(rows, ["encounter_id"], {"n": "one"}, ["unit"], {"all": "one"})
    plain = W.partitionBy("unit").orderBy("encounter_id")
    want = many.select("encounter_id", F.row_number().over(plain).alias("want"))
    both = got.join(want, "encounter_id")
    assert both.count() == 4000 and both.where("n <> want").count() == 0
    sizes = many.groupBy("unit").agg(F.count("*").alias("size"))
    assert got.join(sizes, "unit").where("`all` <> size").count() == 0


def test_running_totals_need_no_global_sort(many):
    rows = prefix.add_ranges(many.withColumn("one", F.lit(1)), "encounter_id", 300)
    got = prefix.running_totals(rows, ["encounter_id"], {"n": "one"})
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The only single partition is the one over the table of range totals.
    assert plan.count("SinglePartition") == 1
    single = plan[plan.index("SinglePartition"):].split("\n")[1]
    assert "HashAggregate" in single


def test_curves_are_monotone(many):
    roc = metrics.roc_curve(many, rows_per_range=300).orderBy(F.desc("threshold")).collect()
    assert (roc[0]["fpr"], roc[0]["tpr"]) == (0.0, 0.0)
    assert (roc[-1]["fpr"], roc[-1]["tpr"]) == (1.0, 1.0)
    assert all(a["tpr"] <= b["tpr"] and a["fpr"] <= b["fpr"] for a, b in zip(roc, roc[1:]))
    pr = metrics.precision_recall_curve(many).orderBy(F.desc("threshold")).collect()
    assert (pr[0]["precision"], pr[0]["recall"]) == (1.0, 0.0) and pr[-1]["recall"] == 1.0


def test_grid_is_numpys():
    assert threshold.threshold_grid(200) == list(np.linspace(0, 1, 200))


def test_cost_curve_against_every_cut(spark):
    cuts = threshold.threshold_grid(200)
    # scores exactly on cuts, outside of [0, 1], and unusable
    rows = [(c, i % 3 == 0) for i, c in enumerate(cuts)]
    rows += [(-0.5, True), (1.5, False), (None, True), (float("nan"), False)]
    df = spark.createDataFrame([(s, int(y)) for s, y in rows], "score double, label int")
    curve = threshold.cost_curve(df).orderBy("threshold").collect()
    score = np.array([-np.inf if s is None or s != s else s for s, _ in rows])
    label = np.array([int(y) for _, y in rows])
    assert len(curve) == 200
    for row, cut in zip(curve, cuts):
        flagged = score >= cut
        assert row["tp"] == int((flagged & (label == 1)).sum())
        assert row["fp"] == int((flagged & (label == 0)).sum())
        assert row["tp"] + row["fp"] + row["tn"] + row["fn"] == len(rows)
        assert row["cost"] == row["fp"] + 5.0 * row["fn"]


def test_optimum_takes_the_lowest_of_ties(toy):
    curve = threshold.cost_curve(toy)
    best = threshold.optimal_threshold(curve).first()
    costs = curve.orderBy("threshold").collect()
    least = min(r["cost"] for r in costs)
    assert best["optimal_cost"] == least
    assert best["optimal_threshold"] == next(r["threshold"] for r in costs if r["cost"] == least)


def test_cost_curve_scans_once(many):
    plan = threshold.cost_curve(many)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


@pytest.mark.parametrize("units", [[], ["unit"]])
def test_top_share_is_exact(many, units):
    got = threshold.flag_top_share(many, 0.4, units=units, rows_per_range=300)
    order = W.partitionBy(*units).orderBy(F.desc("score"), "encounter_id")
    size = F.count("*").over(W.partitionBy(*units))
    want = many.select(
        "encounter_id",
        F.when(F.row_number().over(order) <= F.floor(F.lit(0.4) * size), 1).otherwise(0)
        .alias("want"),
    )
    both = got.join(want, "encounter_id")
    assert both.count() == 4000 and both.where("flagged <> want").count() == 0


def test_metrics_at_thresholds(toy):
    rows = metrics.metrics_at_thresholds(toy, [0.5, 0.65]).orderBy("threshold").collect()
    assert [r["tp"] for r in rows] == [3, 2] and "f3" in rows[0].asDict()


def test_score_tables(many):
    histogram = metrics.score_histogram(many, bins=10).collect()
    assert sum(r["n"] for r in histogram) == 4000
    assert sum(r["share"] for r in histogram) == pytest.approx(1.0)
    table = metrics.reliability_table(many).collect()
    assert all(0 <= r["observed_rate"] <= 1 for r in table)


def test_drift(spark):
    same = spark.range(1000).select((F.col("id") % 10).alias("x"), (F.col("id") % 20 >= 10).cast("int").alias("side"))
    assert drift.ks_drift(same, ["x"], "side").first()["ks"] == 0.0
    moved = same.withColumn("x", F.col("x") + 5 * F.col("side"))
    row = drift.ks_drift(moved, ["x"], "side", rows_per_range=100).first()
    assert row["ks"] == pytest.approx(0.5) and row["alert"] == 1


def test_calibration_is_monotone(many):
    model = calibrate.fit_calibration(many)
    rows = calibrate.calibrated(model, many).orderBy("score").collect()
    assert all(a["calibrated"] <= b["calibrated"] + 1e-12 for a, b in zip(rows, rows[1:]))


def test_evaluator_round_trip(toy, tmp_path):
    evaluator = metrics.AveragePrecisionEvaluator(rawPredictionCol="score")
    evaluator.write().save(str(tmp_path / "e"))
    again = metrics.AveragePrecisionEvaluator.load(str(tmp_path / "e"))
    assert again.evaluate(toy) == pytest.approx(0.755556, abs=1e-6) and again.isLargerBetter()
