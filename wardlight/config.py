"""Run configuration, column roles and fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names of the public Diabetes 130-US hospitals table.
ENCOUNTER_ID = "encounter_id"
PATIENT_ID = "patient_nbr"
RAW_TARGET = "readmitted"
LABEL = "readmitted_30d"
POSITIVE_VALUE = "<30"
PROTECTED = ("race", "age")
OPTIONAL_PROTECTED = ("gender",)

# Columns dropped before modelling.
UNUSED_COLUMNS = ("weight", "examide", "citoglipton", "payer_code")

# Discharge codes for death or hospice.
TERMINAL_DISCHARGES = (11, 13, 14, 19, 20, 21)

# Integer columns that hold codes and not quantities.
CODE_COLUMNS = ("admission_type_id", "discharge_disposition_id", "admission_source_id")

# Diabetes medication columns.
MEDICATIONS = (
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide", "insulin",
    "glyburide-metformin", "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone",
)

DIAGNOSES = ("diag_1", "diag_2", "diag_3")

# "?" is the table's own marker; the rest are spellings that CSV readers
# commonly take for a missing value, so that a record means the same thing
# whether it comes from CSV, JSON or Parquet.
NULL_TOKENS = (
    "?", "", "None", "NA", "N/A", "n/a", "<NA>", "NULL", "null", "NaN", "nan",
)


@dataclass(frozen=True)
class RunConfig:
    """Settings of one training run. Defaults equal the documented ones."""

    seed: int = 42
    test_size: float = 0.2
    folds: int = 5
    threshold: float = 0.5
    cost_fn_over_fp: float = 5.0
    n_thresholds: int = 200
    class_weight: str | None = "balanced"
    min_frequency: int = 10
    parallelism: int = 4
    # "validation" tunes the cut on out-of-fold scores; "holdout" tunes it on
    # the rows it is then reported on.
    threshold_source: str = "validation"
    exclude_features: tuple[str, ...] = ()
    protected: tuple[str, ...] = PROTECTED
    models: tuple[str, ...] = ("LogReg", "RandomForest")
    grids: dict = field(default_factory=lambda: dict(FULL_GRIDS))


# Hyperparameter grids of the full run and of the quick run.
FULL_GRIDS = {
    "LogReg": {"C": [0.01, 0.1, 1.0, 10.0]},
    "RandomForest": {
        "n_estimators": [200, 400],
        "max_depth": [None, 12, 20],
        "min_samples_leaf": [1, 5],
        "max_features": ["sqrt", 0.5],
    },
    "BoostedTrees": {"n_estimators": [400]},
}
QUICK_GRIDS = {
    "LogReg": {"C": [1.0]},
    "RandomForest": {
        "n_estimators": [100],
        "max_depth": [12],
        "min_samples_leaf": [1],
        "max_features": ["sqrt"],
    },
    "BoostedTrees": {"n_estimators": [400]},
}
