"""Readmission-risk analytics on PySpark."""

from wardlight.config import FULL_GRIDS, QUICK_GRIDS, RunConfig
from wardlight.functions.icd9 import add_diagnosis_categories, icd9_category
from wardlight.operators.clean import (
    basic_clean, binarize_target, drop_expired_patients, drop_unused_columns, select_roles,
)
from wardlight.operators.fairness import (
    aggregate_fairness_metrics, fairness_gaps, fairness_report, intersection_report,
)
from wardlight.operators.features import EncounterFeatures
from wardlight.operators.metrics import (
    classification_metrics, compare_models, precision_recall_curve, roc_curve,
)
from wardlight.operators.models import fit_pipeline
from wardlight.operators.profile import missing_summary
from wardlight.operators.score import predict_risk
from wardlight.operators.split import assert_no_group_leakage, assign_folds, group_split
from wardlight.operators.threshold import cost_curve, optimal_threshold
from wardlight.operators.tuning import select_best_model, summarize_tuning, tune_models
from wardlight.plans.training import prepare_data, run_training
from wardlight.session import configure, local_session
from wardlight.sources.encounters import example_record, load_encounters, load_records
from wardlight.sources.sinks import load_model, save_model

__all__ = [
    "EncounterFeatures", "FULL_GRIDS", "QUICK_GRIDS", "RunConfig", "add_diagnosis_categories",
    "aggregate_fairness_metrics", "assert_no_group_leakage", "assign_folds", "basic_clean",
    "binarize_target", "classification_metrics", "compare_models", "configure", "cost_curve",
    "drop_expired_patients", "drop_unused_columns", "example_record", "fairness_gaps",
    "fairness_report", "fit_pipeline", "group_split", "icd9_category", "intersection_report",
    "load_encounters", "load_model", "load_records", "local_session", "missing_summary",
    "optimal_threshold", "precision_recall_curve", "predict_risk", "prepare_data", "roc_curve",
    "run_training", "save_model", "select_best_model", "select_roles", "summarize_tuning",
    "tune_models",
]
