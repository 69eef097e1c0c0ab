import pytest
from pyspark.sql import functions as F

from wardlight.operators import fairness, threshold


@pytest.fixture
def toy(spark):
    # A: all 6 positives of 8 found; B: 1 of 4 positives of 16 found, nothing false.
    rows = [(1, 1, "A")] * 6 + [(0, 0, "A")] * 2
    rows += [(1, 1, "B")] + [(1, 0, "B")] * 3 + [(0, 0, "B")] * 12
    other = ["X"] * 7 + ["Y"] * 17
    return spark.createDataFrame(
        [(*r, o) for r, o in zip(rows, other)],
        "label int, y_pred int, `group` string, other string",
    )


def gaps(df, attributes):
    table = fairness.aggregate_fairness_metrics(df, attributes)
    return {r["attribute"]: r for r in table.collect()}


def test_report(toy):
    rows = {r["value"]: r for r in fairness.fairness_report(toy, ["group"]).collect()}
    assert set(rows) == {"A", "B"}
    assert (rows["A"]["recall"], rows["B"]["recall"]) == (1.0, 0.25)
    assert (rows["B"]["count"], rows["B"]["base_rate"], rows["B"]["selection_rate"]) == (
        16, 0.25, 0.0625)
    assert (rows["B"]["false_positive_rate"], rows["B"]["specificity"]) == (0.0, 1.0)
    assert rows["B"]["false_negative_rate"] == pytest.approx(0.75)


def test_gaps(toy):
    found = gaps(toy, ["group", "other"])
    assert found["group"]["demographic_parity_gap"] == pytest.approx(0.6875)
    assert found["group"]["equalized_odds_gap"] == pytest.approx(0.75)
    assert found["group"]["predictive_parity_gap"] == pytest.approx(0.0)
    assert found["other"]["n_groups"] == 2


def test_perfect_model_has_no_odds_gap(spark):
    df = spark.createDataFrame([(y, y, g) for y in (0, 1) for g in "AABB"], "label int, y_pred int, g string")
    assert gaps(df, ["g"])["g"]["equalized_odds_gap"] == 0.0


def test_absent_attribute_has_no_gap(toy):
    assert gaps(toy, ["group", "nothing"])["nothing"]["demographic_parity_gap"] is None


def test_null_group(spark):
    df = spark.createDataFrame([(1, 1, None), (0, 0, "A")], "label int, y_pred int, g string")
    kept = fairness.fairness_report(df, ["g"]).collect()
    assert {r["value"] for r in kept} == {"A", "Unknown"}
    assert fairness.fairness_report(df, ["g"], null_group="drop").count() == 1


def test_precision_without_predictions_is_null(spark):
    df = spark.createDataFrame([(1, 0, "A"), (0, 0, "A")], "label int, y_pred int, g string")
    row = fairness.fairness_report(df, ["g"]).first()
    assert row["precision"] is None and row["recall"] == 0.0


def test_empty_denominator_can_be_null(spark):
    df = spark.createDataFrame([(0, 0, "A")], "label int, y_pred int, g string")
    assert fairness.fairness_report(df, ["g"]).first()["recall"] == 0.0
    assert fairness.fairness_report(df, ["g"], zero_division=None).first()["recall"] is None


def test_intersection(toy):
    report = fairness.intersection_report(toy, ["group", "other"])
    assert report.count() == 3
    filled = fairness.intersection_report(toy, ["group", "other"], fill_absent=True)
    assert filled.count() == 4 and filled.where("count IS NULL").count() == 1


def test_all_attributes_in_one_scan(spark, folder):
    from wardlight.plans import encounter_view as view

    orders = view.visits(spark, folder).select(
        F.col("gender"), F.col("admission_type_id").alias("kind"),
        (F.col("encounter_id") % 2).alias("label"), (F.col("encounter_id") % 3 % 2).alias("y_pred"),
    )
    plan = fairness.aggregate_fairness_metrics(orders, ["gender", "kind"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1


def test_subgroup_areas(spark):
    df = spark.createDataFrame(
        [(0.9, 1, "A"), (0.1, 0, "A"), (0.1, 1, "B"), (0.9, 0, "B"), (0.3, 0, "C")],
        "score double, label int, g string",
    )
    rows = {r["value"]: r for r in fairness.subgroup_areas(df, ["g"]).collect()}
    assert rows["A"]["auc_roc"] == 1.0 and rows["B"]["auc_roc"] == 0.0
    assert rows["C"]["auc_roc"] is None


def test_reweighting_makes_group_and_label_independent(toy):
    skewed = toy.where("NOT (`group` = 'A' AND label = 0 AND other = 'X')")
    rows = fairness.add_reweighting(skewed.where("other = 'Y' OR label = 1"), "group")
    rates = rows.groupBy("group").agg(
        (F.sum(F.col("weight") * F.col("label")) / F.sum("weight")).alias("rate")
    ).collect()
    assert rates[0]["rate"] == pytest.approx(rates[1]["rate"])


def test_group_thresholds_close_the_recall_gap(spark):
    rows = [(0.5 + i / 40, 1, "A") for i in range(10)] + [(i / 40, 0, "A") for i in range(10)]
    rows += [(0.2 + i / 40, 1, "B") for i in range(10)] + [(i / 80, 0, "B") for i in range(10)]
    df = spark.createDataFrame(rows, "score double, label int, g string")
    curve = threshold.cost_curve(df, groups=["g"])
    cuts = threshold.group_thresholds(curve, ["g"], 1.0)
    out = threshold.apply_group_thresholds(df, cuts, ["g"])
    plain = df.withColumn("y_pred", (F.col("score") >= 0.5).cast("int"))
    before, after = (gaps(x, ["g"])["g"]["equalized_odds_gap"] for x in (plain, out))
    assert after < before and cuts.count() == 2


def test_missed_positives(toy):
    rows = {r["value"]: r for r in fairness.missed_positives(toy, ["group"]).collect()}
    assert (rows["A"]["n_missed"], rows["B"]["n_missed"]) == (0, 3)
    assert rows["B"]["missed_share"] == pytest.approx(0.75)
