import pytest
from pyspark.sql import functions as F

from wardlight.operators import profile, split


def patients(spark, n, each):
    return spark.range(n * each).select(
        F.col("id").alias("encounter_id"), (F.col("id") % n).alias("patient_nbr"),
        (F.xxhash64("id") % 2 == 0).cast("int").alias("label"),
    )


def test_split_keeps_patients_whole(spark):
    df = patients(spark, 50, 4)
    out = split.group_split(df)
    assert out.count() == df.count()
    assert split.leaking_groups(out).count() == 0
    sides = {r["split"] for r in out.select("split").distinct().collect()}
    assert sides == {"train", "test"}


def test_split_share_and_stability(spark):
    df = patients(spark, 4000, 1)
    share = split.group_split(df).where("split = 'test'").count() / 4000
    assert abs(share - 0.2) < 0.03
    later = split.group_split(patients(spark, 4000, 2))
    both = split.group_split(df).alias("a").join(
        later.alias("b"), F.col("a.patient_nbr") == F.col("b.patient_nbr")
    )
    assert both.where("a.split <> b.split").count() == 0


def test_exact_split_counts_groups(spark):
    out = split.exact_group_split(patients(spark, 53, 3))
    tested = out.where("split = 'test'").select("patient_nbr").distinct().count()
    assert tested == 11  # ceil(0.2 * 53)
    assert split.leaking_groups(out).count() == 0


@pytest.mark.parametrize("mode", ["stratified", "hash"])
def test_folds_partition_patients(spark, mode):
    df = patients(spark, 80, 3)
    out = split.assign_folds(df, 3, group="patient_nbr", mode=mode)
    assert out.count() == df.count()
    assert split.leaking_groups(out, side="fold").count() == 0
    assert {r["fold"] for r in out.select("fold").distinct().collect()} == {0, 1, 2}


def test_folds_balance_positives(spark):
    out = split.assign_folds(patients(spark, 600, 3), 5, group="patient_nbr")
    rates = [r["positive_rate"] for r in
             split.split_summary(out, group="patient_nbr", side="fold").collect()]
    assert max(rates) - min(rates) < 0.02


def test_leakage_check(spark):
    a, b = patients(spark, 3, 1), patients(spark, 5, 1)
    with pytest.raises(AssertionError, match="3 groups"):
        split.assert_no_group_leakage(a, b)
    split.assert_no_group_leakage(a, b.where("patient_nbr > 2"))


def test_undersample_keeps_the_rare_class(spark):
    df = patients(spark, 2000, 1)
    out = split.undersample(df, {0: 0.25})
    assert out.where("label = 1").count() == df.where("label = 1").count()
    assert abs(out.where("label = 0").count() / df.where("label = 0").count() - 0.25) < 0.05


def test_hash_sample_is_repeatable(spark):
    df = patients(spark, 500, 1)
    first = split.hash_sample(df, 20).select("encounter_id").collect()
    assert len(first) == 20
    assert first == split.hash_sample(df.repartition(7), 20).select("encounter_id").collect()


def test_readmission_label(spark):
    df = spark.createDataFrame(
        [(1, 9, "2020-01-01"), (2, 9, "2020-01-20"), (3, 9, "2020-01-20"), (4, 9, "2020-02-19"),
         (5, 9, "2020-05-01"), (6, 8, "2020-01-01"), (7, 7, None)],
        "encounter_id int, patient_nbr int, d string",
    ).select("encounter_id", "patient_nbr", F.col("d").cast("timestamp").alias("admitted"))
    got = {r["encounter_id"]: r["readmitted"] for r in profile.derive_readmission(df).collect()}
    assert got == {1: "<30", 2: "<30", 3: ">30", 4: ">30", 5: "NO", 6: "NO", 7: "NO"}


def test_readmission_label_of_a_hot_patient(spark):
    """Same labels as a plain window when one patient has a third of the rows."""
    df = spark.range(3000).select(
        F.col("id").alias("encounter_id"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 400).alias("patient_nbr"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(200_000_000))).alias("admitted"),
    )
    from pyspark.sql import Window as W

    following = F.lead("admitted").over(
        W.partitionBy("patient_nbr").orderBy("admitted", "encounter_id")
    )
    gap = F.datediff(following, F.col("admitted"))
    plain = df.select(
        "encounter_id",
        F.when(gap.isNull(), "NO").when(gap < 30, "<30").otherwise(">30").alias("want"),
    )
    both = profile.derive_readmission(df).join(plain, "encounter_id")
    assert both.count() == 3000 and both.where("readmitted <> want").count() == 0


def test_edge_encounters(spark):
    df = patients(spark, 10, 5)
    first = profile.edge_encounters(df, "first")
    last = profile.edge_encounters(df, "last")
    assert first.columns == df.columns
    assert sorted(r["encounter_id"] for r in first.collect()) == list(range(10))
    assert sorted(r["encounter_id"] for r in last.collect()) == list(range(40, 50))


def test_repeat_rows(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "encounter_id int, patient_nbr int")
    assert sorted(r["encounter_id"] for r in profile.repeat_rows(df).collect()) == [1, 2]
    found = profile.encounters_per_patient(df).first()
    assert (found["n_patients"], found["n_repeat_patients"], found["max_encounters"]) == (2, 1, 2)
    assert found["pct_rows_repeat"] == 66.67


def test_null_groups_have_folds_units_and_cuts(spark):
    """A NULL key meets the NULL key: no row leaves, and none falls back to a default."""
    from wardlight.operators import threshold

    rows = [(i, i % 3, (i * 37 % 100) / 100.0, [None, "a", "b"][i % 3], int(i % 5 == 0))
            for i in range(300)]
    df = spark.createDataFrame(
        rows, "encounter_id long, g int, score double, unit string, label int"
    ).withColumn("group", F.when(F.col("g") > 0, F.col("encounter_id")))
    for mode in ("stratified", "hash"):
        assert split.assign_folds(df, 3, mode=mode).where("fold IS NULL").count() == 0
    flagged = threshold.flag_top_share(df, 0.2, units=["unit"]).groupBy("unit").agg(
        F.sum("flagged").alias("n"))
    assert {r["unit"]: r["n"] for r in flagged.collect()} == {None: 20, "a": 20, "b": 20}
    cuts = spark.createDataFrame([(None, 0.9), ("a", 0.1)], "unit string, threshold double")
    labelled = threshold.apply_group_thresholds(df, cuts, ["unit"])
    assert labelled.where("unit IS NULL AND (y_pred = 1) <> (score >= 0.9)").count() == 0


def test_rows_without_a_patient_count_alone(spark):
    from wardlight.operators import profile

    rows = [(i, None if i % 10 == 0 else i // 2, 1) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "encounter_id long, patient_nbr long, label int")
    known = {r[1] for r in rows if r[1] is not None}
    assert profile.edge_encounters(df).count() == len(known) + 10
    assert profile.encounters_per_patient(df).first()["n_patients"] == len(known)
    found = {r["visit"]: r["n_rows"] for r in profile.first_versus_later(df).collect()}
    assert found["first"] == len(known) + 10
