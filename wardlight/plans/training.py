"""From a raw encounter table to a model folder and its reports."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.config import PATIENT_ID, QUICK_GRIDS, RunConfig
from wardlight.operators import clean, fairness, metrics, split, threshold, tuning
from wardlight.operators.models import fit_pipelines
from wardlight.operators.score import predict_risk
from wardlight.session import Scratch
from wardlight.sources import sinks


def prepare_data(raw: DataFrame, config: RunConfig = RunConfig()) -> DataFrame:
    """Clean, pick roles and split by patient, in one narrow plan.

    Columns: label, group, split, encounter_id and the features.
    """
    return (
        raw.transform(clean.basic_clean)
        .transform(lambda df: clean.select_roles(df, drop_ids=False))
        .drop(PATIENT_ID)
        .transform(lambda df: split.group_split(df, "group", config.test_size, config.seed))
    )


def spread(df: DataFrame, key: str = "encounter_id", rows_per_task: int = 1_000) -> DataFrame:
    """Give a small stored table enough partitions to keep all cores busy.

    A table that already has as many partitions as cores is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()
    if have >= cores:
        return df
    wanted = min(cores, -(-df.count() // rows_per_task))
    return df.repartition(wanted, key) if wanted > have else df


def _named(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("model"), "*")


def run_training(
    spark: SparkSession, raw: DataFrame, out: str, config: RunConfig = RunConfig(),
    quick: bool = False,
) -> dict:
    """Prepare, tune, evaluate, pick a threshold, audit and write everything.

    Returns the result tables, the best model and the written paths. Only what is in
    ``out`` stays: the models, the reports and the score store of the search, with which a
    broken run goes on.
    """
    if quick:
        config = replace(config, grids=QUICK_GRIDS)
    with Scratch(spark, "run") as scratch:
        table = scratch.store(prepare_data(raw, config), "prepared")
        train = table.where("split = 'train'").drop("split")
        holdout = table.where("split = 'test'").drop("split")
        split.assert_no_group_leakage(train, holdout, "group")
        folded = spread(scratch.store(
            split.assign_folds(train, config.folds, seed=config.seed), "folded"))

        audit = [a for a in config.protected if a in table.columns]
        results = tuning.tune_models(folded, config, audit=audit, store=f"{out}/tuning")
        cv_summary = tuning.summarize_tuning(spark, results)
        best = tuning.select_best_model(results)

        rows, best_scored = [], None
        for name, result in results.items():
            scored = predict_risk(result.model, holdout, config.threshold).persist()
            rows.append(_named(
                metrics.classification_metrics(scored, config.threshold), name
            ).first())
            if name == best.model_name:
                best_scored = scored
            else:
                scored.unpersist()

        judged = best.out_of_fold if config.threshold_source == "validation" else best_scored
        curve = threshold.cost_curve(judged, config.cost_fn_over_fp, config.n_thresholds)
        optimum_row = threshold.optimal_threshold(curve).first()
        optimum = spark.createDataFrame([optimum_row])
        cut = optimum_row["optimal_threshold"]
        rows.append(_named(
            metrics.classification_metrics(best_scored, cut), f"{best.model_name}_optimal_threshold"
        ).first())
        holdout_metrics = metrics.compare_models(spark.createDataFrame(rows))

        labelled = best_scored.withColumn(
            "y_pred", F.when(F.col("score") >= cut, 1).otherwise(0)
        )
        report = fairness.fairness_report(labelled, audit) if audit else None
        gaps = fairness.fairness_gaps(report) if audit else None

        paths = sinks.save_model(best.model, f"{out}/models", best.model_name)
        paths["cv_summary"] = sinks.write_report(cv_summary, f"{out}/reports/cv_summary")
        paths["cv_results"] = sinks.write_report(
            tuning.cv_results(spark, results), f"{out}/reports/cv_results"
        )
        paths["holdout_metrics"] = sinks.write_metrics(
            holdout_metrics, f"{out}/reports/holdout_metrics"
        )
        chosen = spark.createDataFrame(
            [(best.model_name, cut, json.dumps(best.best_params))],
            "best_model string, optimal_threshold double, best_params string",
        )
        paths["choice"] = sinks.write_metrics(chosen, f"{out}/reports/choice")
        tables = {
            "cost_curve": curve, "threshold": optimum,
            "roc_curve": metrics.roc_curve(best_scored),
            "precision_recall_curve": metrics.precision_recall_curve(best_scored),
        }
        if audit:
            tables |= {"fairness_report": report, "fairness_summary": gaps}
        for name, df in tables.items():
            paths[name] = sinks.write_report(df, f"{out}/reports/{name}")
        best_scored.unpersist()
        return {
            "best_model_name": best.model_name, "best_model": best.model, "results": results,
            "cv_summary": cv_summary, "holdout_metrics": holdout_metrics, "choice": chosen,
            "optimal_threshold": cut, "paths": paths,
        }


def ablation(
    train: DataFrame, holdout: DataFrame, points: dict[str, tuple[str, dict, str | None]],
    cost_fn_over_fp: float = 5.0,
) -> DataFrame:
    """One row per configuration: areas, and recall/precision at its best cut.

    ``points`` maps a name to (model, parameters, class weight). The cut is
    the least-cost one on the training rows, which are encoded once for all fits.
    """
    spark = train.sparkSession
    rows = []
    for name, fitted in zip(points, fit_pipelines(train, list(points.values()))):
        cut = threshold.optimal_threshold(
            threshold.cost_curve(predict_risk(fitted, train), cost_fn_over_fp)
        ).first()["optimal_threshold"]
        scored = predict_risk(fitted, holdout, cut).persist()
        found = metrics.classification_metrics(scored, cut).first()
        scored.unpersist()
        rows.append((name, found["auc_pr"], found["auc_roc"], cut, found["recall"],
                     found["precision"]))
    return spark.createDataFrame(
        rows, "configuration string, auc_pr double, auc_roc double, threshold double, "
        "recall double, precision double",
    ).orderBy(F.desc("auc_pr"))
