"""One registered query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.config import FULL_GRIDS, PATIENT_ID, RunConfig
from wardlight.functions import clinical
from wardlight.functions.icd9 import add_diagnosis_categories
from wardlight.operators import (
    calibrate, clean, drift, encode, explain, fairness, metrics, models, profile,
    score, split, threshold, tuning,
)
from wardlight.operators.features import EncounterFeatures
from wardlight.plans import encounter_view as view
from wardlight.plans import training
from wardlight.session import configure, materialize, scratch_path
from wardlight.sources import encounters as source
from wardlight.sources import sinks
from wardlight.streaming import monitor, scoring

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

NUMERIC = [
    "num_lab_procedures", "number_diagnoses", "number_outpatient", "number_emergency",
    "number_inpatient", "num_medications", "time_in_hospital", "charge",
]
CATEGORICAL = ["race", "age", "gender", "medical_specialty", "diag_1", "discharge_disposition_id"]
PROFILED = [
    "race", "age", "gender", "medical_specialty", "payer_code", "diag_1", "diag_2", "diag_3",
    "max_glu_serum", "A1Cresult", "number_outpatient", "num_medications", "time_in_hospital",
    "charge", "change", "metformin",
]
MEDS = list(view.LINE_MEDICATIONS)


def tidy(df: DataFrame) -> DataFrame:
    """Whole numbers as long, fractions rounded to 6 digits."""
    columns = []
    for field in df.schema.fields:
        column = clinical.quoted(field.name)
        if isinstance(field.dataType, T.IntegralType):
            column = column.cast("long")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            value = column.cast("double")
            endless = F.abs(value) == float("inf")
            column = F.when(endless, value).otherwise(F.round(value, 6))
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return tidy(function(configure(spark), folder.rstrip("/")))

    _QUERIES[function.__name__] = run
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources and sinks ------------------------------------------------------

def _as_file_table(spark: SparkSession, folder: str) -> DataFrame:
    """The raw view in the column order of the public file."""
    return source.align_to_schema(view.raw_encounters(spark, folder), source.ENCOUNTER_SCHEMA)


@query
def source_encounters_csv(spark, folder):
    path = scratch_path(spark, "encounters-csv")
    _as_file_table(spark, folder).write.option("header", True).csv(path)
    return source.load_encounters(spark, path)


@query
def source_json_records(spark, folder):
    path = scratch_path(spark, "encounters-json")
    _as_file_table(spark, folder).write.json(path)
    return source.load_records(spark, path)


@query
def source_code_table(spark, folder):
    path = scratch_path(spark, "codes")
    nations = view.read(spark, folder, "nation")
    nations.select(
        (F.col("n_nationkey") + 1).alias("code"), F.col("n_name").alias("description")
    ).write.option("header", True).csv(path)
    codes = source.load_code_table(spark, path, "admission_source_id")
    # Three codes of the stays are not in the table.
    stays = view.visits(spark, folder).select(
        "encounter_id", (F.col("admission_source_id") + 3).alias("admission_source_id")
    )
    return clean.describe_codes(stays, codes, "admission_source_id").select(
        "encounter_id", "admission_source_id", "admission_source_id_description"
    )


@query
def sink_csv_report(spark, folder):
    report = fairness.fairness_report(
        view.scored_people(spark, folder), ["race", "age", "gender"]
    )
    path = sinks.write_report(report, scratch_path(spark, "report"))
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query
def sink_json_metrics(spark, folder):
    found = metrics.classification_metrics(view.scored_visits(spark, folder), 0.4)
    path = sinks.write_metrics(found, scratch_path(spark, "metrics"))
    return spark.read.schema(found.schema).json(path)


@query
def sink_prediction_log(spark, folder):
    scored = view.scored_visits(spark, folder).withColumn("score_date", F.to_date("admitted"))
    path = scratch_path(spark, "log")
    for odd in (0, 1):
        sinks.append_predictions(scored.where(F.col("encounter_id") % 2 == odd), path)
    return spark.read.parquet(path).groupBy(
        F.date_format("score_date", "yyyy-MM-dd").alias("score_date")
    ).agg(
        F.count("*").alias("n"), F.sum("y_pred").alias("n_flagged"),
        F.sum(F.round(F.col("score") * 1e8).cast("long")).alias("score_sum"),
    )


# --- cleaning ---------------------------------------------------------------


def _stays(spark, folder):
    return profile.derive_readmission(view.visits(spark, folder))


@query
def clean_binarize(spark, folder):
    return clean.binarize_target(_stays(spark, folder)).select(
        "encounter_id", "readmitted", "readmitted_30d"
    )


@query
def clean_drop_unused(spark, folder):
    wide = view.visits(spark, folder).select(
        "encounter_id", PATIENT_ID, "gender", "num_procedures", "weight", "payer_code",
        "examide", "citoglipton",
    )
    return clean.drop_unused_columns(wide)


@query
def clean_drop_expired(spark, folder):
    return clean.drop_expired_patients(view.visits(spark, folder)).select(
        "encounter_id", PATIENT_ID, "discharge_disposition_id"
    )


@query
def clean_basic(spark, folder):
    cleaned = clean.basic_clean(_stays(spark, folder))
    return cleaned.select(
        "encounter_id", PATIENT_ID, "gender", "admission_type_id", "discharge_disposition_id",
        "num_procedures", "readmitted", "readmitted_30d",
    )


@query
def clean_roles(spark, folder):
    cleaned = clean.basic_clean(_stays(spark, folder)).select(
        "encounter_id", PATIENT_ID, "gender", "admission_type_id", "discharge_disposition_id",
        "num_procedures", "readmitted", "readmitted_30d",
    )
    return clean.select_roles(cleaned)


@query
def clean_exclusions(spark, folder):
    return clean.exclusion_counts(view.visits(spark, folder), invalid="P")


@query
def clean_drop_gender(spark, folder):
    return clean.drop_invalid_gender(view.visits(spark, folder), invalid="P").select(
        "encounter_id", "gender"
    )


@query
def clean_group_categories(spark, folder):
    nation, region = view.read(spark, folder, "nation"), view.read(spark, folder, "region")
    # Three specialties of the stays are not in the mapping.
    mapping = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("Specialty"), F.col("n_nationkey") + 3).alias("medical_specialty"),
        F.col("r_name").alias("specialty_group"),
    )
    stays = source.normalize_nulls(
        view.with_demographics(view.visits(spark, folder), spark, folder).select(
            "encounter_id", "medical_specialty"
        )
    )
    return clean.group_categories(
        stays, "medical_specialty", mapping, "specialty_group", missing="Unknown"
    ).select("encounter_id", "medical_specialty", "specialty_group")


@query
def score_align(spark, folder):
    schema = T.StructType([
        T.StructField("gender", T.StringType()), T.StructField("admission_type_id", T.LongType()),
        T.StructField("insulin", T.StringType()), T.StructField("number_inpatient", T.LongType()),
    ])
    return source.align_to_schema(view.visits(spark, folder), schema, keep=["encounter_id"])


@query
def score_threshold(spark, folder):
    return view.scored_visits(spark, folder).select(
        "encounter_id", clinical.predicted(F.col("score"), 0.27).alias("y_pred")
    )


@query
def join_scores_attributes(spark, folder):
    scores = view.scored_visits(spark, folder).select("encounter_id", "y_pred")
    people = source.normalize_nulls(
        view.with_demographics(view.visits(spark, folder), spark, folder).select(
            "encounter_id", "race"
        )
    )
    return scores.join(people, "encounter_id").groupBy("race").agg(
        F.count("*").alias("n"), F.sum("y_pred").alias("n_flagged")
    )


# --- features ---------------------------------------------------------------


def _lines(spark, folder):
    stays = view.visits(spark, folder)
    return source.normalize_nulls(view.with_lines(stays, spark, folder))


@query
def label_rate_by_diagnosis(spark, folder):
    stays = view.with_lines(_stays(spark, folder), spark, folder)
    cleaned = source.normalize_nulls(stays, keep=("readmitted",)).transform(clean.basic_clean)
    return profile.rate_by(
        add_diagnosis_categories(cleaned, ("diag_1",)), ["diag_1_cat"], "readmitted_30d"
    )


@query
def icd9_categories(spark, folder):
    codes = _lines(spark, folder).select("encounter_id", "diag_1", "diag_2", "diag_3")
    return add_diagnosis_categories(codes)


@query
def icd9_distribution(spark, folder):
    return profile.value_distribution(
        add_diagnosis_categories(_lines(spark, folder)), "diag_1_cat"
    )


@query
def feat_medication_counts(spark, folder):
    return _lines(spark, folder).select(
        "encounter_id", clinical.medications_prescribed(MEDS).alias("n_med_prescribed"),
        clinical.medications_changed(MEDS).alias("n_med_changed"),
    )


@query
def feat_prior_use(spark, folder):
    visits = ("number_outpatient", "number_emergency", "number_inpatient")
    return _lines(spark, folder).select(
        "encounter_id",
        clinical.prior_use(dict(zip(visits, (1, 2, 3)))).alias("prior_healthcare_use"),
        clinical.prior_use(dict(zip(visits, (1, 2, 4)))).alias("prior_utilization_score"),
    )


FLAGS = ["has_circulatory_comorb", "has_respiratory_comorb", "has_diabetes_diag"]


def _features(spark, folder):
    return EncounterFeatures().transform(_lines(spark, folder))


@query
def feat_comorbidity(spark, folder):
    return _features(spark, folder).select("encounter_id", *FLAGS)


@query
def feat_lab_flags(spark, folder):
    return _features(spark, folder).select("encounter_id", "A1C_measured", "glu_measured")


@query
def feat_change_flags(spark, folder):
    return _features(spark, folder).select("encounter_id", "change_flag", "diabetesMed_flag")


@query
def feat_all(spark, folder):
    return _features(spark, folder).select(
        "encounter_id", "n_med_prescribed", "n_med_changed", "prior_healthcare_use",
        "diag_1_cat", "diag_2_cat", "diag_3_cat", *FLAGS, "A1C_measured", "glu_measured",
        "change_flag", "diabetesMed_flag",
    )


@query
def feat_medication_ordinal(spark, folder):
    return _lines(spark, folder).select(
        "encounter_id", *[clinical.medication_ordinal(F.col(m)).alias(m) for m in MEDS]
    )


# --- encoders ---------------------------------------------------------------


@query
def encode_column_groups(spark, folder):
    table = view.encounters(spark, folder).select(*NUMERIC, *CATEGORICAL)
    kinds = encode.infer_column_groups(table.schema)
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.lit(kind).alias("kind"),
            F.count(F.col(c)).alias("n_known"),
        ) for kind, columns in kinds.items() for c in columns
    ])
    return table.agg(entries.alias("entries")).select(F.inline("entries"))


@query
def encode_numeric_stats(spark, folder):
    table = materialize(view.encounters(spark, folder).select(*NUMERIC))
    found = encode.numeric_statistics(table, NUMERIC)
    rows = [(c, s["median"], s["mean"], s["std"]) for c, s in found.items()]
    return spark.createDataFrame(rows, "column_name string, median double, mean double, std double")


@query
def encode_scaled(spark, folder):
    table = materialize(view.encounters(spark, folder).select("encounter_id", *NUMERIC))
    model = encode.MedianScaler(inputCols=NUMERIC).fit(table)
    return model.transform(table).select("encounter_id", *model.getOutputCols())


def _categories(spark, folder):
    table = view.encounters(spark, folder).select("encounter_id", PATIENT_ID, *CATEGORICAL)
    return split.group_split(table)


@query
def encode_category_floor(spark, folder):
    train = _categories(spark, folder).where("split = 'train'")
    return encode.category_counts(train, CATEGORICAL).withColumn(
        "infrequent", F.when(F.col("n") < 10, 1).otherwise(0)
    )


def _entries(encoded: DataFrame) -> DataFrame:
    """The non-zero entries of each row's vector: encounter_id, split, feature, value.

    The names, a row per entry of the vector, are what is broadcast: Spark takes a table
    made of local rows for endless and would send the entries of all rows instead.
    """
    names = encoded.sparkSession.createDataFrame(
        list(enumerate(encode.feature_names(encoded))), "place int, feature string"
    )
    entries = F.posexplode(vector_to_array("features")).alias("place", "value")
    return (
        encoded.select("encounter_id", "split", entries).where("abs(value) > 5e-7")
        .join(F.broadcast(names), "place").drop("place")
    )


def _onehot(spark, folder, **options):
    """One-hot columns set per row, counted by feature and split."""
    table = _categories(spark, folder)
    train = table.where("split = 'train'")
    model = encode.Preprocessor(categoricalCols=CATEGORICAL, **options).fit(train)
    return _entries(model.transform(table)).where("value = 1").groupBy("feature", "split").agg(
        F.count("*").alias("n"), F.sum("encounter_id").alias("id_sum")
    )


@query
def encode_onehot(spark, folder):
    return _onehot(spark, folder)


@query
def encode_onehot_stored(spark, folder):
    """The same with the rare categories in a stored table instead of the model."""
    return _onehot(spark, folder, inlineCategories=0)


@query
def encode_features(spark, folder):
    """Both branches in one vector: every entry of every row."""
    columns = dict.fromkeys(["encounter_id", PATIENT_ID, *NUMERIC, *CATEGORICAL])
    table = materialize(split.group_split(view.encounters(spark, folder).select(*columns)))
    model = encode.Preprocessor(numericCols=NUMERIC, categoricalCols=CATEGORICAL).fit(
        table.where("split = 'train'"))
    return _entries(model.transform(table))


# --- profile ----------------------------------------------------------------


def _profiled(spark, folder):
    return view.encounters(spark, folder).select(*PROFILED)


@query
def profile_missing(spark, folder):
    return profile.missing_summary(_profiled(spark, folder))


@query
def profile_marker(spark, folder):
    raw = view.with_lines(
        view.with_demographics(view.visits(spark, folder), spark, folder), spark, folder
    )
    return profile.marker_summary(raw)


@query
def profile_value_counts(spark, folder):
    return profile.value_distribution(_stays(spark, folder), "readmitted")


def _people(spark, folder):
    return source.normalize_nulls(
        view.with_demographics(view.labelled_visits(spark, folder), spark, folder)
        .select("race", "age", "gender", "label")
    )


@query
def profile_rate_by_group(spark, folder):
    people = _people(spark, folder)
    long = people.select(
        "label", F.inline(F.array(*[
            F.struct(F.lit(c).alias("attribute"), F.col(c).alias("value"))
            for c in ("race", "age", "gender")
        ]))
    )
    return profile.rate_by(long, ["attribute", "value"])


@query
def profile_patients(spark, folder):
    return profile.encounters_per_patient(view.visits(spark, folder))


@query
def profile_cardinality(spark, folder):
    return profile.cardinality(_profiled(spark, folder))


@query
def profile_rate_cube(spark, folder):
    return profile.rate_cube(_people(spark, folder), ["race", "age"])


@query
def profile_rate_pivot(spark, folder):
    return profile.rate_pivot(_people(spark, folder), "race", "gender", ["F", "O", "P"])


@query
def profile_top_codes(spark, folder):
    codes = _lines(spark, folder).select("diag_1", "diag_2")
    tops = [
        profile.top_values(codes, c).withColumn("column_name", F.lit(c)) for c in codes.columns
    ]
    return tops[0].unionByName(tops[1])


@query
def profile_correlation(spark, folder):
    table = view.with_lines(view.labelled_visits(spark, folder), spark, folder)
    return profile.label_correlation(
        table, ["number_inpatient", "number_emergency", "num_medications", "charge"]
    )


@query
def profile_missed_describe(spark, folder):
    missed = view.scored_visits(spark, folder).where("label = 1 AND y_pred = 0")
    return profile.describe_rows(
        view.with_lines(missed, spark, folder),
        ["number_inpatient", "num_medications", "time_in_hospital"],
    )


@query
def profile_first_last(spark, folder):
    stays = _stays(spark, folder).select(PATIENT_ID, "encounter_id", "admitted", "readmitted")
    parts = [
        profile.edge_encounters(stays, which, order=("admitted", "encounter_id")).select(
            F.lit(which).alias("which"), PATIENT_ID, "encounter_id", "readmitted"
        ) for which in ("first", "last")
    ]
    return parts[0].unionByName(parts[1])


@query
def profile_first_later(spark, folder):
    return profile.first_versus_later(
        view.labelled_visits(spark, folder), order=("admitted", "encounter_id")
    )


@query
def profile_repeat_rows(spark, folder):
    return profile.repeat_rows(view.visits(spark, folder)).select("encounter_id", PATIENT_ID)


@query
def derive_readmission(spark, folder):
    return _stays(spark, folder).select("encounter_id", "readmitted")


# --- splits -----------------------------------------------------------------


@query
def split_group_holdout(spark, folder):
    return split.group_split(view.visits(spark, folder)).select(
        "encounter_id", PATIENT_ID, "split"
    )


@query
def split_exact_holdout(spark, folder):
    return split.exact_group_split(view.visits(spark, folder)).select("encounter_id", "split")


@query
def split_summary(spark, folder):
    tagged = split.group_split(view.labelled_visits(spark, folder))
    return split.split_summary(tagged, group=PATIENT_ID)


@query
def split_leakage(spark, folder):
    by_row = split.group_split(view.visits(spark, folder), group="encounter_id")
    return split.leaking_groups(by_row)


@query
def split_shared_groups(spark, folder):
    stays = view.visits(spark, folder)
    return split.shared_groups(
        stays.where(F.col("admitted") < "1997-01-01"),
        stays.where(F.col("admitted") >= "2000-01-01"),
    )


def _some_unknown(spark, folder):
    """Stays of which every eleventh has no patient."""
    known = F.when(F.col("encounter_id") % 11 != 0, F.col(PATIENT_ID))
    return view.visits(spark, folder).withColumn(PATIENT_ID, known)


@query
def split_exact_unknown(spark, folder):
    """Rows without a patient are in train, and no group of their own."""
    return split.exact_group_split(_some_unknown(spark, folder)).select(
        "encounter_id", PATIENT_ID, "split")


@query
def split_shared_unknown(spark, folder):
    """Groups on both sides of a year, and groups on both sides of a split by row."""
    stays = _some_unknown(spark, folder)
    year = F.to_date("admitted") < F.lit("1997-01-01").cast("date")
    shared = split.shared_groups(stays.where(year), stays.where(~year))
    sided = stays.withColumn("split", F.when(F.col("encounter_id") % 3 == 0, "test").otherwise("train"))
    return shared.withColumn("kind", F.lit("shared")).unionByName(
        split.leaking_groups(sided).select(PATIENT_ID, F.lit("leaking").alias("kind")))


@query
def sample_first_unknown(spark, folder):
    """Rows without a patient are a patient each."""
    return profile.edge_encounters(
        _some_unknown(spark, folder), order=("admitted", "encounter_id")
    ).select("encounter_id", PATIENT_ID)


@query
def cv_group_folds(spark, folder):
    return split.group_folds(view.labelled_visits(spark, folder), group=PATIENT_ID)


@query
def cv_assigned_folds(spark, folder):
    tagged = split.assign_folds(view.labelled_visits(spark, folder), group=PATIENT_ID)
    return split.split_summary(tagged, group=PATIENT_ID, side="fold").drop("positive_rate")


@query
def cv_hash_folds(spark, folder):
    return split.assign_folds(
        view.visits(spark, folder), group=PATIENT_ID, mode="hash"
    ).select("encounter_id", "fold")


@query
def sample_undersample(spark, folder):
    return split.undersample(view.labelled_visits(spark, folder), {0: 0.25}).select(
        "encounter_id", "label"
    )


@query
def sample_first_encounter(spark, folder):
    stays = view.visits(spark, folder).select(PATIENT_ID, "encounter_id", "admitted")
    return profile.edge_encounters(stays, order=("admitted", "encounter_id")).drop("admitted")


@query
def sample_hash(spark, folder):
    return split.hash_sample(view.visits(spark, folder)).select("encounter_id", PATIENT_ID)


@query
def prepare_data(spark, folder):
    return training.prepare_data(view.encounters(spark, folder)).select(
        "encounter_id", "label", "group", "split", "race", "age", "diag_1", "num_medications"
    )


# --- metrics, curves, thresholds --------------------------------------------


def _scored(spark, folder):
    """Scores stored once: ranking reads them more than once."""
    slim = view.scored_visits(spark, folder).select(
        "encounter_id", "gender", "admission_type_id", "label", "score", "y_pred"
    )
    return materialize(slim)


@query
def metric_confusion(spark, folder):
    return metrics.confusion(view.scored_visits(spark, folder))


@query
def metric_auc_roc(spark, folder):
    return metrics.ranking_areas(_scored(spark, folder)).select("auc_roc")


@query
def metric_auc_pr(spark, folder):
    return metrics.ranking_areas(_scored(spark, folder)).select("auc_pr")


@query
def metric_ap_evaluator(spark, folder):
    evaluator = metrics.AveragePrecisionEvaluator(rawPredictionCol="score")
    value = evaluator.evaluate(_scored(spark, folder))
    return spark.createDataFrame([(value,)], "auc_pr double")


@query
def metric_report(spark, folder):
    return metrics.classification_metrics(_scored(spark, folder), 0.4)


@query
def metric_at_thresholds(spark, folder):
    return metrics.metrics_at_thresholds(
        view.scored_visits(spark, folder), [0.1, 0.27, 0.5, 0.75]
    )


@query
def metric_histogram(spark, folder):
    return metrics.score_histogram(view.scored_visits(spark, folder), bins=20)


@query
def metric_calibration(spark, folder):
    return metrics.reliability_table(view.scored_visits(spark, folder), bins=10)


def _shown(curve):
    """Raw scores are ranked; the shown threshold is whole, -1 for the infinite one."""
    whole = F.round(F.col("threshold") * 1e8)
    return curve.withColumn("threshold", F.when(
        F.col("threshold") < 2, whole).otherwise(-1).cast("long"))


@query
def curve_roc(spark, folder):
    return _shown(metrics.roc_curve(_scored(spark, folder)))


@query
def curve_pr(spark, folder):
    return _shown(metrics.precision_recall_curve(_scored(spark, folder)))


@query
def prefix_running_total(spark, folder):
    """Running totals by group, cut into many ranges on purpose."""
    ranked = metrics.ranked_scores(
        _scored(spark, folder), groups=["gender"], rows_per_range=2_000
    )
    return ranked.withColumn("score", F.round(F.col("score") * 1e8).cast("long"))


@query
def compare_models(spark, folder):
    scored = _scored(spark, folder)
    both = scored.select("label", F.inline(F.array(
        F.struct(F.lit("exact").alias("model"), F.col("score").alias("score")),
        F.struct(
            F.lit("rounded").alias("model"),
            (F.floor(F.col("score") * 100.0) / 100.0).alias("score"),
        ),
    )))
    return metrics.compare_models(
        metrics.classification_metrics(both, 0.4, groups=["model"])
    )


@query
def threshold_cost_at(spark, folder):
    return threshold.cost_at_threshold(view.scored_visits(spark, folder), 0.27)


@query
def threshold_cost_curve(spark, folder):
    return threshold.cost_curve(view.scored_visits(spark, folder))


@query
def threshold_optimum(spark, folder):
    return threshold.optimal_threshold(threshold.cost_curve(view.scored_visits(spark, folder)))


@query
def rank_capacity(spark, folder):
    return threshold.flag_top_share(_scored(spark, folder), 0.15).select(
        "encounter_id", "flagged"
    )


@query
def rank_capacity_by_unit(spark, folder):
    return threshold.flag_top_share(
        _scored(spark, folder), 0.15, units=["admission_type_id"],
        rows_per_range=2_000,
    ).select("encounter_id", "admission_type_id", "flagged")


# --- fairness ---------------------------------------------------------------

AUDITED = ["race", "age", "gender"]


@query
def fair_report(spark, folder):
    return fairness.fairness_report(view.scored_people(spark, folder), AUDITED)


@query
def fair_report_custom(spark, folder):
    agreement = F.avg((F.col("label") == F.col("y_pred")).cast("double"))
    return fairness.fairness_report(
        view.scored_people(spark, folder), AUDITED, extra={"accuracy": agreement}
    ).select("attribute", "value", "count", "accuracy")


@query
def fair_report_documents(spark, folder):
    return fairness.fairness_report(view.scored_documents(spark, folder), ["lang", "source"])


@query
def fair_report_drop_null(spark, folder):
    return fairness.fairness_report(
        view.scored_people(spark, folder), ["race"], null_group="drop"
    )


@query
def fair_intersection(spark, folder):
    return fairness.intersection_report(view.scored_people(spark, folder), ["race", "age"])


@query
def fair_intersection_filled(spark, folder):
    return fairness.intersection_report(
        view.scored_documents(spark, folder), ["lang", "source"], fill_absent=True
    )


@query
def fair_gaps(spark, folder):
    return fairness.aggregate_fairness_metrics(view.scored_people(spark, folder), AUDITED)


@query
def fair_over_alerting(spark, folder):
    return fairness.over_alerting(
        fairness.fairness_report(view.scored_people(spark, folder), AUDITED)
    )


@query
def fair_subgroup_areas(spark, folder):
    return fairness.subgroup_areas(materialize(view.scored_people(spark, folder)), AUDITED)


@query
def fair_missed_positives(spark, folder):
    return fairness.missed_positives(view.scored_people(spark, folder), AUDITED)


def _gender_cuts(spark, folder):
    scored = _scored(spark, folder)
    overall = metrics.confusion(scored).first()
    target = overall["tp"] / (overall["tp"] + overall["fn"])
    curve = threshold.cost_curve(scored, groups=["gender"])
    return scored, threshold.group_thresholds(curve, ["gender"], target)


@query
def fair_group_thresholds(spark, folder):
    return _gender_cuts(spark, folder)[1]


@query
def fair_group_thresholds_applied(spark, folder):
    scored, cuts = _gender_cuts(spark, folder)
    labelled = threshold.apply_group_thresholds(scored, cuts, ["gender"])
    return fairness.fairness_gaps(fairness.fairness_report(labelled, ["gender"]))


@query
def fair_reweighting(spark, folder):
    return fairness.reweighting(view.scored_people(spark, folder), "race")


@query
def fair_weighted_rates(spark, folder):
    people = view.scored_people(spark, folder)
    weighted = fairness.add_reweighting(people, "race")
    return weighted.groupBy(F.coalesce("race", F.lit("Unknown")).alias("value")).agg(
        (F.sum(F.col("weight") * F.col("label")) / F.sum("weight")).alias("weighted_rate"),
        F.count("*").alias("n"),
    )


# --- models -----------------------------------------------------------------

# Points of the grids in config.py: the largest forest with a depth limit, and the one
# boosting run.
FOREST = {"n_estimators": max(FULL_GRIDS["RandomForest"]["n_estimators"]),
          "max_depth": FULL_GRIDS["RandomForest"]["max_depth"][1]}
BOOST = {k: v[0] for k, v in FULL_GRIDS["BoostedTrees"].items()}
# Well inside the certificate's tolerance.
PARAMS = {"LogReg": {"tol": 1e-6}, "RandomForest": FOREST, "BoostedTrees": BOOST}
# The search of the full run: both models, all points of their grids, all folds.
TUNING = RunConfig()
_PREPARED: dict[tuple, tuple[DataFrame, DataFrame]] = {}
_FITTED: dict[tuple, PipelineModel] = {}
_TUNED: dict[tuple, dict[str, tuning.TuningResult]] = {}


def _prepared(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Train and holdout rows, prepared once per session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _PREPARED:
        table = training.prepare_data(view.encounters(spark, folder).drop("admitted", "charge"))
        stored = materialize(table)
        table = training.spread(stored)
        if table is not stored:  # dealt anew: not once more for every reader
            table = materialize(table)
        _PREPARED[key] = (
            table.where("split = 'train'").drop("split"),
            table.where("split = 'test'").drop("split"),
        )
    return _PREPARED[key]


def _fitted(spark, folder, name="LogReg") -> PipelineModel:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _FITTED:
        _FITTED[key] = models.fit_pipeline(_prepared(spark, folder)[0], name, PARAMS[name])
    return _FITTED[key]


def _tuned(spark, folder, names=TUNING.models) -> dict[str, tuning.TuningResult]:
    """The search of the named models, or a wider one that has been made."""
    session = (spark.sparkContext.applicationId, folder)
    for key in ((*session, TUNING.models), (*session, names)):
        if key in _TUNED:
            return _TUNED[key]
    folded = materialize(split.assign_folds(_prepared(spark, folder)[0], TUNING.folds))
    _TUNED[key] = tuning.tune_models(training.spread(folded), replace(TUNING, models=names))
    return _TUNED[key]


def _outside(scored: DataFrame, cut: float = 0.5) -> DataFrame:
    """Rows, and those whose score is outside [0, 1] or whose label misses the cut."""
    good = F.col("score").between(0, 1) & (
        F.col("y_pred") == F.when(F.col("score") >= cut, 1).otherwise(0))
    return scored.agg(F.count("*").alias("n_holdout"),
                      F.count_if(~F.coalesce(good, F.lit(False))).alias("n_outside"))


def _tree_report(spark, folder, name) -> DataFrame:
    """Size of a fitted ensemble, whether its importances sum to 1, and its holdout rows."""
    train, holdout = _prepared(spark, folder)
    model = _fitted(spark, folder, name)
    total = float(model.stages[-1].featureImportances.toArray().sum())
    return _outside(score.predict_risk(model, holdout)).select(
        F.lit(train.count()).alias("n_train"), "n_holdout", "n_outside",
        F.lit(model.stages[-1].getNumTrees).alias("n_trees"), F.lit(total).alias("importances"),
    )


def _in_order(top: DataFrame, value: str, names: list[str]) -> DataFrame:
    """Per place of a ranked table: whether it is in order and names a feature."""
    rows = top.collect()
    return top.sparkSession.createDataFrame([
        (i, i == 0 or rows[i - 1][value] >= r[value], r["feature"] in names)
        for i, r in enumerate(rows)
    ], "place int, in_order boolean, known boolean")


@query
def ml_class_weights(spark, folder):
    labelled = view.labelled_visits(spark, folder)
    weights = models.class_weights(labelled)
    return labelled.groupBy("label").agg(F.count("*").alias("n")).withColumn(
        "weight", models.weight_column(weights)
    )


@query
def ml_logistic_regression(spark, folder):
    """Whether the fit is at its optimum, by the gradient over all training rows."""
    train, holdout = _prepared(spark, folder)
    model = _fitted(spark, folder)
    encoded = PipelineModel(model.stages[:-1]).transform(train).select("label", "features")
    found = models.logistic_certificate(model.stages[-1], materialize(encoded)).first()
    return _outside(score.predict_risk(model, holdout)).select(
        F.lit(found["n_rows"]).alias("n_train"), "n_holdout", "n_outside",
        F.lit(found["optimal"]).alias("optimal"),
    )


@query
def ml_random_forest(spark, folder):
    return _tree_report(spark, folder, "RandomForest")


@query
def ml_boosted_trees(spark, folder):
    return _tree_report(spark, folder, "BoostedTrees")


@query
def ml_predict_risk(spark, folder):
    scored = score.predict_risk(_fitted(spark, folder), view.encounters(spark, folder), 0.5)
    flagged = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select(
        "encounter_id", "race", F.col("score").between(0, 1).alias("in_range"),
        (F.col("y_pred") == flagged).alias("agrees"),
    )


@query
def ml_score_spellings(spark, folder):
    """A missing race scores alike however it is spelled, though the column is kept."""
    holdout, spellings = _prepared(spark, folder)[1], ("NULL", "?", "None", "NA", " ")
    spelled = holdout.withColumn(
        "spelling", F.explode(F.array(*[F.lit(s) for s in spellings]))
    ).withColumn("race", F.when(F.col("spelling") != "NULL", F.col("spelling")))
    scored = materialize(score.predict_risk(
        _fitted(spark, folder), spelled, keep=("encounter_id", "spelling", "race")
    ))
    plain = scored.where("spelling = 'NULL'").select(
        "encounter_id", F.col("score").alias("plain")
    )
    return scored.join(plain, "encounter_id").groupBy("spelling").agg(
        F.count("*").alias("n_rows"),
        F.count_if((F.col("score") != F.col("plain")) | F.col("race").isNotNull())
        .alias("n_different"),
    )


@query
def ml_models_scored(spark, folder):
    """Holdout rows each model scores; none outside [0, 1], none without a label."""
    fitted = {name: _fitted(spark, folder, name) for name in models.MODELS}
    scored = [
        score.predict_risk(model, _prepared(spark, folder)[1]).withColumn("model", F.lit(name))
        for name, model in fitted.items()
    ]
    good = F.col("score").between(0, 1) & F.col("y_pred").isin(0, 1)
    return reduce(DataFrame.unionByName, scored).groupBy("model").agg(
        F.count("*").alias("n_rows"), F.count_if(~good).alias("n_outside")
    )


@query
def ml_example_record(spark, folder):
    scored = score.predict_risk(_fitted(spark, folder), source.example_record(spark))
    return _outside(scored).withColumnRenamed("n_holdout", "n_rows")


@query
def ml_save_load(spark, folder):
    model = _fitted(spark, folder)
    paths = sinks.save_model(model, scratch_path(spark, "model"), "LogReg")
    holdout = _prepared(spark, folder)[1]
    before = score.predict_risk(model, holdout).select("encounter_id", "score")
    after = score.predict_risk(sinks.load_model(paths["default"]), holdout).select(
        "encounter_id", F.col("score").alias("again")
    )
    return before.join(after, "encounter_id").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("score") != F.col("again")).alias("n_different"),
    )


@query
def ml_top_coefficients(spark, folder):
    model = _fitted(spark, folder)
    names = explain.pipeline_feature_names(model)
    return _in_order(explain.logistic_coefficients(model), "abs_coef", names)


@query
def ml_top_importances(spark, folder):
    model = _fitted(spark, folder, "RandomForest")
    names = explain.pipeline_feature_names(model)
    return _in_order(explain.feature_importance_or_coef(model), "score", names)


@query
def ml_permutation_importance(spark, folder):
    """Every input of the model, five permutations each."""
    model, holdout = _fitted(spark, folder), _prepared(spark, folder)[1]
    found = explain.permutation_importance(model, holdout)
    area = metrics.ranking_areas(score.predict_risk(model, holdout)).first()["auc_pr"]
    return found.select(
        "feature", (F.abs(F.col("auc_pr") - area) < 1e-9).alias("same_base"),
        (F.abs(F.col("auc_pr") - F.col("auc_pr_permuted") - F.col("importance")) < 1e-9)
        .alias("is_drop"), (F.col("deviation") >= 0).alias("has_deviation"),
    )


@query
def ml_tune_models(spark, folder):
    """Per model: points, scored rows, and whether the best point has the best mean."""
    rows = []
    for name, found in _tuned(spark, folder).items():
        means = [sum(p["folds"].values()) / len(p["folds"]) for p in found.grid_scores]
        best = found.grid_scores[means.index(max(means))]["params"]
        rows.append((name, len(means), found.n_folds, found.scores.count(),
                     found.out_of_fold.count(), best == found.best_params))
    return spark.createDataFrame(
        rows, "model string, n_points int, n_folds int, n_scores long, n_out_of_fold long, "
        "best_is_best boolean")


@query
def ml_cv_results(spark, folder):
    """The score store, point by point and fold by fold, with the areas ranked once more."""
    results = _tuned(spark, folder)
    stored = reduce(DataFrame.unionByName, [r.scores for r in results.values()])
    per_score = stored.groupBy("model", "point", "fold", "score").agg(
        F.count("*").alias("n"), F.sum("label").alias("pos"))
    ranked = W.partitionBy("model", "point", "fold").orderBy(F.desc("score"))
    ranked = per_score.withColumns({
        "tp": F.sum("pos").over(ranked), "seen": F.sum("n").over(ranked)})
    again = ranked.groupBy("model", "point", "fold").agg(
        F.sum("n").alias("n_rows"), F.sum("pos").alias("n_pos"),
        (F.sum(F.col("pos") * F.col("tp") / F.col("seen")) / F.sum("pos")).alias("area"))
    places = spark.createDataFrame([
        (name, p["place"], str(p["params"]), int(fold), value)
        for name, r in results.items() for p in r.grid_scores for fold, value in p["folds"].items()
    ], "model string, point int, params string, fold int, found double")
    return again.join(places, ["model", "point", "fold"]).select(
        "model", "params", "fold", "n_rows", "n_pos",
        (F.abs(F.col("area") - F.col("found")) < 1e-9).alias("same_area"))


@query
def ml_select_best(spark, folder):
    """The model with the best cross-validated score comes first, and is the one chosen."""
    results = _tuned(spark, folder)
    table = [r.asDict() for r in tuning.summarize_tuning(spark, results).collect()]
    chosen = tuning.select_best_model(results).model_name
    return spark.createDataFrame([
        (i, i == 0 or table[i - 1]["score_cv"] >= r["score_cv"], (r["model"] == chosen) == (i == 0))
        for i, r in enumerate(table)
    ], "place int, in_order boolean, chosen_first boolean")


@query
def ml_ablation(spark, folder):
    train, holdout = _prepared(spark, folder)
    table = training.ablation(train, holdout, {
        "LogReg": ("LogReg", {}, None), "LogReg balanced": ("LogReg", {}, "balanced"),
        "RandomForest balanced": ("RandomForest", FOREST, "balanced"),
    })
    measures = ("auc_pr", "auc_roc", "threshold", "recall", "precision")
    good = reduce(and_, [F.col(c).between(0, 1) for c in measures])
    return table.select("configuration", good.alias("in_range"))


def _groups_scored(model: PipelineModel, holdout: DataFrame, attributes: list[str]) -> DataFrame:
    """Rows and base rate per group of the holdout, and features made from the attribute."""
    names = explain.pipeline_feature_names(model)
    used = {a: sum(n.startswith(f"{a}_") for n in names) for a in attributes}
    report = fairness.fairness_report(score.predict_risk(model, holdout), attributes)
    counts = F.create_map(*[F.lit(x) for pair in used.items() for x in pair])
    return report.select("attribute", "value", "count", "base_rate",
                         (F.element_at(counts, F.col("attribute")) > 0).alias("is_input"))


@query
def ml_exclude_protected(spark, folder):
    train, holdout = _prepared(spark, folder)
    model = models.fit_pipeline(train, exclude=("race", "age"))
    return _groups_scored(model, holdout, ["race", "age"])


@query
def ml_reweighted(spark, folder):
    train, holdout = _prepared(spark, folder)
    weighted = fairness.add_reweighting(train, "race", into="row_weight")
    features = EncounterFeatures()
    featured = materialize(features.transform(weighted))
    encoder = models.fit_encoder(featured, exclude=("row_weight",))
    encoded = materialize(
        encoder.transform(featured).select("encounter_id", "label", "features", "row_weight")
    )
    classifier = models.fit_classifier(encoded, models.MODELS["LogReg"], weight="row_weight")
    model = models.scoring_pipeline(models.input_schema(train), features, encoder, classifier)
    return _groups_scored(model, holdout, ["race"])


@query
def ml_calibrated(spark, folder):
    """Isotonic fit on out-of-fold scores: it keeps their mean, and never falls."""
    found = _tuned(spark, folder, ("LogReg",))["LogReg"]
    isotonic = calibrate.fit_calibration(found.out_of_fold)
    shift = calibrate.calibrated(isotonic, found.out_of_fold).agg(
        F.avg("calibrated") - F.avg("label")).first()[0]
    scored = calibrate.calibrated(
        isotonic, score.predict_risk(found.model, _prepared(spark, folder)[1]))
    # One row per bin of scores reaches the window, 50 at most.
    bins = scored.groupBy(F.floor(F.col("score") * 50).alias("bin")).agg(
        F.count("*").alias("n"), F.min("calibrated").alias("low"), F.max("calibrated").alias("high"))
    falls = F.col("low") < F.lag("high").over(W.orderBy("bin"))
    return bins.withColumn("falls", falls).agg(
        F.sum("n").alias("n_holdout"), F.count_if("falls").alias("n_falls"),
        F.lit(abs(shift) < 1e-9).alias("mean_kept"),
    )


@query
def ml_training_run(spark, folder):
    """The quick run of both models: counts and point metrics of its holdout table."""
    raw = view.encounters(spark, folder).drop("admitted", "charge")
    result = training.run_training(
        spark, raw, scratch_path(spark, "run"), RunConfig(), quick=True)
    table = spark.read.schema(result["holdout_metrics"].schema).json(
        result["paths"]["holdout_metrics"])
    recall = metrics.ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    precision = metrics.ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    kind = F.when(F.col("model").endswith("_optimal_threshold"), "optimal").otherwise(F.col("model"))
    return table.select(
        kind.alias("kind"), (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n"),
        (F.col("tp") + F.col("fn")).alias("n_pos"),
        ((F.abs(F.col("recall") - recall) < 1e-9) & (F.abs(F.col("precision") - precision) < 1e-9))
        .alias("from_counts"),
    )


# --- drift and streams ------------------------------------------------------


@query
def monitor_ks(spark, folder):
    events = view.read(spark, folder, "events")
    halves = events.select(
        "value", F.length("event_type").alias("type_length"),
        F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), 0).otherwise(1).alias("side"),
    )
    return drift.ks_drift(halves, ["value", "type_length"], "side", rows_per_range=2_000)


@query
def monitor_ks_split(spark, folder):
    stays = materialize(
        split.group_split(view.with_lines(view.visits(spark, folder), spark, folder))
        .select("split", "num_medications", "charge")
    )
    sides = stays.withColumn("side", F.when(F.col("split") == "train", 0).otherwise(1))
    return drift.ks_drift(sides, ["num_medications", "charge"], "side")


def _stream_of(spark: SparkSession, table: DataFrame, name: str) -> DataFrame:
    """A file stream over a table written to the shared folder."""
    path = scratch_path(spark, name)
    table.write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def _scored_stream(spark, folder):
    scored = view.scored_visits(spark, folder).select(
        F.col("admitted").cast("timestamp").alias("ts"), "encounter_id", "gender", "label",
        "score", "y_pred", "payer_code",
    )
    return _stream_of(spark, source.normalize_nulls(scored), "scored")


@query
def stream_monitor(spark, folder):
    windows = monitor.monitoring_windows(_scored_stream(spark, folder), watched=["payer_code"])
    path = scratch_path(spark, "windows")
    running = (
        windows.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", scratch_path(spark, "windows-state"))
        .trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return spark.read.parquet(path).withColumn(
        "window_start", F.unix_timestamp("window_start")
    ).drop("window_end")


@query
def stream_fairness(spark, folder):
    counts = monitor.group_counts(_scored_stream(spark, folder), ["gender"])
    path = scratch_path(spark, "gaps")
    monitor.start_gap_log(counts, path, scratch_path(spark, "gaps-state")).awaitTermination()
    return spark.read.parquet(path).drop("batch").withColumn(
        "window_start", F.unix_timestamp("window_start")
    )


@query
def stream_drift(spark, folder):
    """Drift of each closed window against the stays before 1997, from sketches."""
    stays = view.scored_visits(spark, folder).select(
        F.col("admitted").cast("timestamp").alias("ts"), "charge", "num_procedures")
    columns = ["charge", "num_procedures"]
    reference = monitor.reference_sketches(stays.where("ts < '1997-01-01'"), columns).collect()
    windows = monitor.drift_windows(_stream_of(spark, stays, "visits"), columns)
    path = scratch_path(spark, "drift")
    monitor.start_drift_log(
        windows, reference, path, scratch_path(spark, "drift-state")
    ).awaitTermination()
    return spark.read.parquet(path).select(
        F.unix_timestamp("window_start").alias("window_start"), "column_name", "n", "alert")


@query
def stream_prediction_log(spark, folder):
    """Records sent twice are scored once and logged by day, with the batch's scores."""
    model = _fitted(spark, folder)
    # The stream's table holds them twice and the batch reads them again: built once.
    records = materialize(view.encounters(spark, folder).withColumn(
        "discharged", F.col("admitted").cast("timestamp")
    ))
    scored = scoring.score_stream(model, _stream_of(spark, records.unionByName(records), "records"))
    path = scratch_path(spark, "prediction-log")
    scoring.start_prediction_log(
        scored, path, scratch_path(spark, "prediction-state")
    ).awaitTermination()
    plain = score.predict_risk(model, records).select("encounter_id", F.col("score").alias("plain"))
    logged = scoring.read_prediction_log(spark, path).join(plain, "encounter_id", "left")
    return logged.groupBy(F.date_format("score_date", "yyyy-MM-dd").alias("score_date")).agg(
        F.count("*").alias("n"), F.count_distinct("encounter_id").alias("n_records"),
        F.count_if(~F.col("score").eqNullSafe(F.col("plain"))).alias("n_different"),
    )
