"""Classification metrics, curves and score tables for imbalanced labels.

Everything ranks on the table of distinct scores: rows are first collapsed to
``(score, positives, negatives)`` with map-side partial sums, so a score that
a third of all rows share is one row, and the ranking itself runs on
distributed running totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasLabelCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wardlight.functions.clinical import predicted
from wardlight.operators.prefix import BUCKET, ROWS_PER_RANGE, add_ranges, running_totals


def usable_score(score: str | Column) -> Column:
    """Scores for ranking: NULL and NaN rank below everything."""
    column = F.col(score) if isinstance(score, str) else score
    lowest = F.lit(float("-inf"))
    return F.coalesce(F.nanvl(column.cast("double"), lowest), lowest)


def ratio(top: Column, bottom: Column, empty: float | None = 0.0) -> Column:
    """top / bottom, and ``empty`` where the denominator is 0."""
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(empty).cast("double"))


def f_beta(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    b2 = float(beta) ** 2
    return ratio((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp)


def confusion_columns(label: Column, pred: Column) -> dict[str, Column]:
    """Aggregates of the 2x2 confusion table; all four are always there."""
    return {
        "tp": F.count_if((label == 1) & (pred == 1)),
        "fp": F.count_if((label == 0) & (pred == 1)),
        "tn": F.count_if((label == 0) & (pred == 0)),
        "fn": F.count_if((label == 1) & (pred == 0)),
    }


def confusion(
    scored: DataFrame, label: str = "label", pred: str = "y_pred", groups: Sequence[str] = ()
) -> DataFrame:
    counts = confusion_columns(F.col(label), F.col(pred))
    return scored.groupBy(*groups).agg(*[c.alias(k) for k, c in counts.items()])


def point_metrics(counts: DataFrame, betas: Sequence[float] = (1, 2)) -> DataFrame:
    """Recall, precision and F-beta from tp/fp/fn columns; 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {"recall": ratio(tp, tp + fn), "precision": ratio(tp, tp + fp)}
        | {f"f{b:g}": f_beta(tp, fp, fn, b) for b in betas}
    )


def ranked_scores(
    scored: DataFrame, score: str = "score", label: str = "label",
    groups: Sequence[str] = (), pred: Column | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Distinct scores with positives, negatives and running tp/fp from the top.

    Columns: groups, score, pos, neg, tp, fp, n_pos, n_neg, and with ``pred``
    also hit (positives predicted 1) and alarm (negatives predicted 1).
    """
    positive = F.col(label) == 1
    slim = scored.select(
        *groups, usable_score(score).alias("score"), positive.alias("__positive"),
        *([] if pred is None else [(pred == 1).alias("__flagged")]),
    )
    slim = add_ranges(slim, "score", rows_per_range)
    keys = [*groups, "score", *([BUCKET] if BUCKET in slim.columns else [])]
    parts = [
        F.count_if("__positive").alias("pos"),
        F.count_if(~F.col("__positive")).alias("neg"),
    ]
    if pred is not None:
        flagged = F.col("__flagged")
        parts += [
            F.count_if(F.col("__positive") & flagged).alias("hit"),
            F.count_if(~F.col("__positive") & flagged).alias("alarm"),
        ]
    return running_totals(
        slim.groupBy(*keys).agg(*parts), ["score"], {"tp": "pos", "fp": "neg"}, groups,
        {"n_pos": "pos", "n_neg": "neg"}, descending=True,
    )


def _area_columns() -> dict[str, Column]:
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    above = tp - pos
    n_pos, n_neg = F.sum(pos), F.sum(neg)
    return {
        # Pairs ranked right, ties count one half.
        "auc_roc": ratio(F.sum(neg * (above + pos / 2)), n_pos * n_neg, None),
        # Step-wise average precision: recall gain times precision at each score.
        "auc_pr": ratio(F.sum(pos * tp / (tp + fp)), n_pos, None),
    }


def ranking_areas(
    scored: DataFrame, score: str = "score", label: str = "label",
    groups: Sequence[str] = (), rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """AUC-ROC (ties one half) and average precision, per group if given."""
    ranked = ranked_scores(scored, score, label, groups, rows_per_range=rows_per_range)
    return ranked.groupBy(*groups).agg(*[c.alias(k) for k, c in _area_columns().items()])


def average_precision(scored: DataFrame, score: str = "score", label: str = "label") -> float:
    return ranking_areas(scored, score, label).first()["auc_pr"]


def classification_metrics(
    scored: DataFrame, threshold: float = 0.5, score: str = "score", label: str = "label",
    pred: str | None = None, groups: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Areas, point metrics and confusion counts in one row (per group).

    With ``pred`` the given labels are used and the threshold is only recorded.
    """
    flagged = predicted(usable_score(score), threshold) if pred is None else F.col(pred)
    ranked = ranked_scores(scored, score, label, groups, flagged, rows_per_range)
    counted = ranked.groupBy(*groups).agg(
        *[c.alias(k) for k, c in _area_columns().items()],
        *[F.coalesce(F.sum(n), F.lit(0)).alias(c) for c, n in {
            "tp": F.col("hit"), "fp": F.col("alarm"), "tn": F.col("neg") - F.col("alarm"),
            "fn": F.col("pos") - F.col("hit")}.items()],
    )
    return point_metrics(counted).select(
        *groups, "auc_roc", "auc_pr", "recall", "precision", "f1", "f2",
        F.lit(float(threshold)).alias("threshold"), "tp", "fp", "tn", "fn",
    )


def roc_curve(
    scored: DataFrame, score: str = "score", label: str = "label",
    groups: Sequence[str] = (), rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, and the (inf, 0, 0) start."""
    ranked = ranked_scores(scored, score, label, groups, rows_per_range=rows_per_range)
    points = ranked.select(
        *groups, F.col("score").alias("threshold"),
        ratio(F.col("fp"), F.col("n_neg"), None).alias("fpr"),
        ratio(F.col("tp"), F.col("n_pos"), None).alias("tpr"),
    )
    start = _one_row(scored, groups).select(
        *groups, F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(start)


def precision_recall_curve(
    scored: DataFrame, score: str = "score", label: str = "label",
    groups: Sequence[str] = (), rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, and (inf, 1, 0)."""
    ranked = ranked_scores(scored, score, label, groups, rows_per_range=rows_per_range)
    points = ranked.select(
        *groups, F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        ratio(F.col("tp"), F.col("n_pos"), 1.0).alias("recall"),
    )
    end = _one_row(scored, groups).select(
        *groups, F.lit(float("inf")).alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def _one_row(scored: DataFrame, groups: Sequence[str]) -> DataFrame:
    return scored.select(*groups).distinct() if groups else scored.sparkSession.range(1)


def metrics_at_thresholds(
    scored: DataFrame, thresholds: Sequence[float], betas: Sequence[float] = (1, 2, 3),
    score: str = "score", label: str = "label",
) -> DataFrame:
    """Confusion counts, precision, recall and F-beta at a list of cuts.

    One pass: two conditional counts per cut, unpivoted afterwards.
    """
    hit, value = F.col(label) == 1, usable_score(score)
    cuts = [float(t) for t in thresholds]
    counted = scored.agg(
        F.count_if(hit).alias("n_pos"), F.count_if(~hit).alias("n_neg"),
        F.array(*[
            F.struct(
                F.lit(t).alias("threshold"),
                F.count_if(hit & (value >= t)).alias("tp"),
                F.count_if(~hit & (value >= t)).alias("fp"),
            ) for t in cuts
        ]).alias("points"),
    )
    rows = counted.select("n_pos", "n_neg", F.inline("points"))
    return point_metrics(
        rows.select(
            "threshold", "tp", "fp", (F.col("n_neg") - F.col("fp")).alias("tn"),
            (F.col("n_pos") - F.col("tp")).alias("fn"),
        ),
        betas,
    )


def _binned(scored: DataFrame, score: str, bins: int) -> DataFrame:
    edges = [i / bins for i in range(bins + 1)]
    return Bucketizer(
        splits=edges, inputCol="__score", outputCol="__bin", handleInvalid="keep"
    ).transform(scored.withColumn("__score", F.col(score).cast("double"))).withColumn(
        "bin", F.col("__bin").cast("int")
    )


def score_histogram(scored: DataFrame, score: str = "score", bins: int = 20) -> DataFrame:
    """Count and share of rows per equal-width score bin (last bin closed)."""
    counts = _binned(scored, score, bins).groupBy("bin").agg(F.count("*").alias("n"))
    # At most bins + 1 rows are left here.
    total = F.sum("n").over(W.partitionBy())
    return counts.select(
        "bin", (F.col("bin") / bins).alias("low"), ((F.col("bin") + 1) / bins).alias("high"),
        "n", (F.col("n") / total).alias("share"),
    )


def reliability_table(
    scored: DataFrame, score: str = "score", label: str = "label", bins: int = 10
) -> DataFrame:
    """Mean score against observed rate per score bin."""
    return _binned(scored, score, bins).groupBy("bin").agg(
        F.count("*").alias("n"), F.avg(score).alias("mean_score"),
        F.avg(label).alias("observed_rate"),
    ).withColumn("gap", F.col("observed_rate") - F.col("mean_score"))


def compare_models(metrics: DataFrame, by: str = "auc_pr") -> DataFrame:
    """Model table, best first."""
    return metrics.orderBy(F.desc(by))


class AveragePrecisionEvaluator(
    Evaluator, HasLabelCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Step-wise average precision for Spark ML model selection."""

    def __init__(self, labelCol: str = "label", rawPredictionCol: str = "probability"):
        super().__init__()
        self._set(labelCol=labelCol, rawPredictionCol=rawPredictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        name = self.getRawPredictionCol()
        column = F.col(name)
        if dataset.schema[name].dataType.typeName() not in ("double", "float"):
            column = vector_to_array(column)[1]
        slim = dataset.select(F.col(self.getLabelCol()).alias("label"), column.alias("score"))
        return float(average_precision(slim))

    def isLargerBetter(self) -> bool:
        return True
