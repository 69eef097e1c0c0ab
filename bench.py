"""Time the headline queries and the model steps; prints one JSON line.

Each query and short model step runs once to warm up and is then timed (median
of BENCH_RUNS, one by default). The forest and the tuning runs are timed once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from dataclasses import replace

from wardlight.config import QUICK_GRIDS, RunConfig
from wardlight.operators import metrics, models, score, split, tuning
from wardlight.operators.features import EncounterFeatures
from wardlight.plans import catalog, training
from wardlight.plans import encounter_view as view
from wardlight.session import local_session, materialize, shared_dir

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CORES = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
HEADLINE = [
    "clean_basic", "label_rate_by_diagnosis", "feat_all", "profile_missing",
    "profile_first_later", "derive_readmission", "split_group_holdout", "cv_group_folds",
    "encode_numeric_stats", "encode_category_floor", "metric_report", "curve_pr",
    "threshold_optimum", "rank_capacity", "fair_report", "fair_gaps", "fair_subgroup_areas",
    "fair_group_thresholds_applied", "monitor_ks_split",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(times: dict, name: str, function, warm: bool = False):
    if warm:
        function()
    start = time.perf_counter()
    result = function()
    times[name] = round(time.perf_counter() - start, 3)
    print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    return result


def model_steps(spark, times: dict) -> None:
    """The steps the published figures name: fits, quick run, scoring."""
    raw = view.encounters(spark, FOLDER).drop("admitted", "charge")
    table = timed(times, "prepare", lambda: materialize(
        training.spread(materialize(training.prepare_data(raw)))
    ))
    train = table.where("split = 'train'").drop("split")
    holdout = table.where("split = 'test'").drop("split")
    features = EncounterFeatures()
    featured = features.transform(train).persist()
    encoder = timed(times, "fit_encoder", lambda: models.fit_encoder(featured), warm=True)
    encoded = timed(times, "encode", lambda: materialize(
        models.learning_rows(encoder, featured)
    ))
    logistic = timed(times, "fit_logistic", lambda: models.fit_classifier(
        encoded, models.MODELS["LogReg"]
    ), warm=True)
    timed(times, "fit_forest_100x12", lambda: models.fit_classifier(
        encoded, models.MODELS["RandomForest"], {"n_estimators": 100, "max_depth": 12}
    ))
    fitted = models.scoring_pipeline(models.input_schema(train), features, encoder, logistic)
    timed(times, "score_holdout", lambda: drain(score.predict_risk(fitted, holdout)),
          warm=True)
    timed(times, "holdout_metrics", lambda: metrics.classification_metrics(
        score.predict_risk(fitted, holdout).persist()
    ).collect())
    featured.unpersist()
    if os.environ.get("BENCH_QUICK_RUN", "1") != "0":
        # The quick run of both models: 5 folds of one point and the refit, each.
        folded = training.spread(materialize(split.assign_folds(train)))
        quick = replace(RunConfig(), grids=QUICK_GRIDS)
        for name, step in (("LogReg", "tune_logistic_5_folds"), ("RandomForest", "tune_forest_5_folds")):
            alone = replace(quick, models=(name,))
            timed(times, step, lambda: tuning.tune_models(folded, alone))


def main() -> None:
    spark = local_session(CORES)
    shared_dir(spark)
    queries, times = catalog.all_queries(), {}
    for name in HEADLINE:
        drain(queries[name](spark, FOLDER))
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            drain(queries[name](spark, FOLDER))
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    model_steps(spark, times)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": FOLDER.rsplit("/", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
