import pytest
from pyspark.sql import functions as F

from wardlight.functions import clinical
from wardlight.functions.icd9 import RANGES, add_diagnosis_categories, icd9_category
from wardlight.operators.features import EncounterFeatures

CODES = {
    "Circulatory": ["401.9", "414", "440.21", " 402 ", "785.1"],
    "Diabetes": ["250.02", "250.9", "250.00"],
    "Digestive": ["530.81", "577", "787.2"],
    "Genitourinary": ["584.9", "599", "788.3"],
    "Injury": ["812.2", "996.1", "920"],
    "Missing": [None, "   ", "", "nan"],
    "Musculoskeletal": ["715.3", "724", "733.0"],
    "Neoplasms": ["153.9", "174", "233.1"],
    "Other": ["E812", "V45", "v70.1", "276.5", "41x", "xyz", "1203"],
    "Respiratory": ["466", "491.2", "518", "786.05"],
}


def test_icd9_categories(spark):
    rows = [(code, category) for category, codes in CODES.items() for code in codes]
    df = spark.createDataFrame(rows, "code string, want string")
    wrong = df.withColumn("got", icd9_category(F.col("code"))).where("got <> want").collect()
    assert wrong == []


def test_icd9_bounds_matched_once(spark):
    """Every whole code falls in its range, and a code is matched and cast once."""
    def want(code):
        for name, (low, high, symptom) in RANGES.items():
            if low <= code < high or code == symptom:
                return name
        return "Other"

    codes = [c for c in range(1_010) if not str(c).startswith("250")]
    rows = [(f"{c}{end}", want(c)) for c in codes for end in ("", ".", ".99")]
    rows += [(text, "Other") for text in ("9" * 400, "12345678901234567890", "-428", "4e2")]
    df = spark.createDataFrame(rows, "code string, want string")
    found = df.withColumn("got", icd9_category(F.col("code")))
    assert found.where("got IS DISTINCT FROM want").collect() == []
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1


def test_numeric_code_column(spark):
    df = spark.createDataFrame([(250.0,), (428.0,), (None,)], "code double")
    got = [r[0] for r in df.select(icd9_category(F.col("code"))).collect()]
    assert got == ["Diabetes", "Circulatory", "Missing"]


def test_three_diagnoses(spark):
    df = spark.createDataFrame(
        [("414", "E812", "174"), ("250.02", "491.2", "812.2"), (None, "724", "250.9")],
        "diag_1 string, diag_2 string, diag_3 string",
    )
    rows = add_diagnosis_categories(df).collect()
    assert [r["diag_1_cat"] for r in rows] == ["Circulatory", "Diabetes", "Missing"]
    assert rows[2]["diag_3_cat"] == "Diabetes"
    assert df.columns == ["diag_1", "diag_2", "diag_3"]


@pytest.fixture
def stays(spark):
    return spark.createDataFrame(
        [
            ("No", "Steady", 1, None, 2, "428", "250", "486", ">7", None, "Ch", "Yes"),
            ("Up", None, 0, 1, 0, "V1", "486", "?", "None", "Norm", "No", "No"),
        ],
        "insulin string, `glyburide-metformin` string, number_outpatient int, "
        "number_emergency int, number_inpatient int, diag_1 string, diag_2 string, "
        "diag_3 string, A1Cresult string, max_glu_serum string, change string, "
        "diabetesMed string",
    )


def test_derived_features(stays):
    a, b = EncounterFeatures().transform(stays).collect()
    assert (a["n_med_prescribed"], a["n_med_changed"]) == (1, 0)
    assert (b["n_med_prescribed"], b["n_med_changed"]) == (2, 1)  # NULL counts
    assert (a["prior_healthcare_use"], b["prior_healthcare_use"]) == (7.0, 2.0)
    assert (a["has_diabetes_diag"], a["has_respiratory_comorb"], a["has_circulatory_comorb"]) == (1, 1, 0)
    assert (a["A1C_measured"], b["A1C_measured"]) == (1, 0)
    assert (a["glu_measured"], b["glu_measured"]) == (0, 1)
    assert (a["change_flag"], a["diabetesMed_flag"], b["change_flag"]) == (1, 1, 0)


def test_unknown_medication_can_count_as_none(stays):
    out = EncounterFeatures(nullMed="not_prescribed", priorWeights=[1.0, 2.0, 4.0]).transform(stays)
    assert [r["n_med_prescribed"] for r in out.collect()] == [1, 1]
    assert [r["prior_healthcare_use"] for r in out.collect()] == [9.0, 2.0]


def test_changed_never_exceeds_prescribed(stays):
    out = EncounterFeatures().transform(stays)
    assert out.where("n_med_changed > n_med_prescribed OR n_med_changed < 0").count() == 0


def test_drop_originals_and_partial_input(stays):
    out = EncounterFeatures(dropOriginals=True).transform(stays)
    assert "insulin" not in out.columns and "n_med_prescribed" in out.columns
    few = EncounterFeatures().transform(stays.select("number_inpatient", "diag_1"))
    assert few.columns == ["number_inpatient", "diag_1", "diag_1_cat"]


def test_stage_save_and_load(stays, tmp_path):
    EncounterFeatures(nullMed="not_prescribed").write().save(str(tmp_path / "stage"))
    again = EncounterFeatures.load(str(tmp_path / "stage"))
    assert again.getOrDefault(again.nullMed) == "not_prescribed"
    assert again.transform(stays).count() == 2


def test_ordinal(spark):
    df = spark.createDataFrame([("No",), ("Steady",), ("Up",), ("Down",), (None,)], "m string")
    got = [r[0] for r in df.select(clinical.medication_ordinal(F.col("m"))).collect()]
    assert got == [0, 1, 2, 2, None]


def test_prediction_at_the_cut(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (None,), (float("nan"),)], "s double")
    got = [r[0] for r in df.select(clinical.predicted(F.col("s"), 0.5)).collect()]
    assert got == [1, 0, 0, 0]
