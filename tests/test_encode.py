import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wardlight.operators import encode
from wardlight.plans import catalog


def test_column_groups(spark):
    df = spark.createDataFrame(
        [], "a int, b string, c double, admission_type_id int, d boolean, e timestamp"
    )
    groups = encode.infer_column_groups(df.schema, skip=["c"])
    assert groups == {"numeric": ["a", "d"], "categorical": ["b", "admission_type_id"]}


def test_statistics_of_imputed_columns(spark):
    rows = [(1, 1.0), (2, None), (3, 2.5), (10, float("nan")), (None, 4.0)]
    df = spark.createDataFrame(rows, "a int, b double")
    got = encode.numeric_statistics(df, ["a", "b"])
    a = np.array([1, 2, 3, 10, 2.5])
    b = np.array([1.0, 2.5, 2.5, 2.5, 4.0])
    for name, want in (("a", a), ("b", b)):
        assert got[name]["median"] == 2.5
        assert got[name]["mean"] == pytest.approx(want.mean())
        assert got[name]["std"] == pytest.approx(want.std())


def test_ranked_median_equals_numpy(spark):
    df = spark.range(1001).select(
        F.pmod(F.xxhash64("id"), F.lit(5000)).alias("a"),
        F.when(F.col("id") % 2 == 0, F.pmod(F.xxhash64("id", F.lit(3)), F.lit(50))).alias("b"),
    )
    pdf = df.toPandas()
    got = encode.exact_medians(df, ["a", "b"], rows_per_range=100)
    assert got == {"a": pdf["a"].median(), "b": pdf["b"].median()}


def test_wide_columns_are_ranked(spark, monkeypatch):
    monkeypatch.setattr(encode, "MEDIAN_VALUES", 5)
    df = spark.range(100).select(F.col("id").alias("a"), (F.col("id") / 2).alias("b"))
    got = encode.numeric_statistics(df, ["a", "b"])
    assert (got["a"]["median"], got["b"]["median"]) == (49.5, 24.75)


def test_scaler_model(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (3, 5), (None, 5)], "a int, b int")
    model = encode.MedianScaler(inputCols=["a", "b"]).fit(df)
    model.write().save(str(tmp_path / "scaler"))
    again = encode.MedianScalerModel.load(str(tmp_path / "scaler"))
    rows = again.transform(df).collect()
    spread = np.array([1, 3, 2]).std()
    assert [r["scaled__a"] for r in rows] == pytest.approx([-1 / spread, 1 / spread, 0])
    assert [r["scaled__b"] for r in rows] == [0, 0, 0]  # constant column


def test_empty_column_is_left_out(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b int")
    assert encode.MedianScaler(inputCols=["a", "b"]).fit(df).getInputCols() == ["a"]


@pytest.fixture
def coloured(spark):
    rows = [("red",)] * 12 + [("blue",)] * 11 + [("teal",)] * 3 + [("pink",)] * 2 + [(None,)] * 10
    return spark.createDataFrame(rows, "c string")


def vector(model, spark, value):
    df = spark.createDataFrame([(value,)], "c string")
    return model.transform(df).first()["features"].toArray().tolist()


def test_onehot_with_floor(spark, coloured, tmp_path):
    fitted = encode.Preprocessor(categoricalCols=["c"]).fit(coloured)
    fitted.write().save(str(tmp_path / "pre"))
    for model in (fitted, PipelineModel.load(str(tmp_path / "pre"))):
        names = encode.feature_names(model.transform(coloured))
        assert names == ["c_Unknown", "c_blue", "c_red", "c_infrequent_sklearn"]
        assert vector(model, spark, "red") == [0, 0, 1, 0]
        assert vector(model, spark, "teal") == vector(model, spark, "pink") == [0, 0, 0, 1]
        assert vector(model, spark, None) == [1, 0, 0, 0]
        assert vector(model, spark, "new") == [0, 0, 0, 0]  # unseen


def test_unseen_can_be_pooled(spark, coloured):
    model = encode.Preprocessor(categoricalCols=["c"], unseen="infrequent").fit(coloured)
    assert vector(model, spark, "new") == vector(model, spark, "teal") == [0, 0, 0, 1]


def test_no_rare_category_no_pooled_column(spark, coloured):
    model = encode.Preprocessor(categoricalCols=["c"], minFrequency=1).fit(coloured)
    assert len(vector(model, spark, "red")) == 5 and sum(vector(model, spark, "new")) == 0


def test_too_wide_a_vector_raises(spark, coloured, monkeypatch):
    monkeypatch.setattr(encode, "MAX_COMMON", 2)
    for unseen in ("zeros", "infrequent"):
        with pytest.raises(ValueError, match="entries"):
            encode.Preprocessor(
                categoricalCols=["c"], unseen=unseen, inlineCategories=0).fit(coloured)


def test_stored_rare_categories(spark, coloured, tmp_path):
    """The same vectors whether rare values are in the model or in its table."""
    fitted = encode.Preprocessor(categoricalCols=["c"], inlineCategories=0).fit(coloured)
    fitted.write().save(str(tmp_path / "pre"))
    asked = spark.createDataFrame(
        [(v,) for v in ("red", "teal", "pink", None, "new", "Unknown", "rare__key", "")], "c string")
    plain = encode.Preprocessor(categoricalCols=["c"]).fit(coloured).transform(asked)
    want = sorted((str(r["c"]), r["features"].toArray().tolist()) for r in plain.collect())
    for model in (fitted, PipelineModel.load(str(tmp_path / "pre"))):
        got = model.transform(asked)
        assert got.columns == plain.columns
        assert encode.feature_names(got) == encode.feature_names(plain)
        assert sorted((str(r["c"]), r["features"].toArray().tolist()) for r in got.collect()) == want


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_many_rare_categories(spark, tmp_path, broadcast):
    """300,000 rare values in one column, a name with a dash, and a column without rare ones."""
    rows = spark.range(320_000)
    table = rows.select(
        F.when(F.col("id") < 300_000, F.concat(F.lit("v"), "id")).otherwise("often").alias("a-b"),
        (F.col("id") % 3).cast("string").alias("d"), (F.col("id") % 7).alias("n"),
    )
    fitted = encode.Preprocessor(numericCols=["n"], categoricalCols=["a-b", "d"]).fit(table)
    assert len(fitted.stages[2].labelsArray[0]) == 1  # the indexer holds the common value only
    fitted.write().save(str(tmp_path / "pre"))
    asked = spark.createDataFrame(
        [("v7", "1", 0), ("v299999", "2", 1), ("often", "0", 2), ("v300000", "1", 3), (None, None, None)],
        "`a-b` string, d string, n long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = PipelineModel.load(str(tmp_path / "pre")).transform(asked)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (broadcast != "-1")
        found = {r["a-b"]: r["features"].toArray().tolist()[1:] for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert encode.feature_names(got) == ["n", "a-b_often", "a-b_infrequent_sklearn", "d_0", "d_1", "d_2"]
    assert found == {
        "v7": [0, 1, 0, 1, 0], "v299999": [0, 1, 0, 0, 1], "often": [1, 0, 1, 0, 0],
        "v300000": [0, 0, 0, 1, 0], None: [0, 0, 0, 0, 0],
    }


def test_vectors_are_sparse(spark, coloured):
    model = encode.Preprocessor(categoricalCols=["c"]).fit(coloured)
    assert type(model.transform(coloured).first()["features"]).__name__ == "SparseVector"


def test_numbers_and_categories_together(spark):
    df = spark.range(40).select(F.col("id").alias("n"), (F.col("id") % 2).cast("string").alias("c"))
    model = encode.Preprocessor(numericCols=["n"], categoricalCols=["c"]).fit(df)
    assert encode.feature_names(model.transform(df)) == ["n", "c_0", "c_1"]


def test_entries_send_the_names_not_the_rows(spark, tmp_path):
    rows = [(i, "train", float(i), "ab"[i % 2]) for i in range(40)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "encounter_id long, split string, x double, c string").write.parquet(path)
    table = spark.read.parquet(path)
    model = encode.Preprocessor(numericCols=["x"], categoricalCols=["c"]).fit(table)
    entries = catalog._entries(model.transform(table))
    plan = entries._jdf.queryExecution().sparkPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan
    assert entries.where("value = 1").groupBy("feature").count().count() == 2
