"""Group fairness: one scan for all protected attributes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.operators.metrics import ROWS_PER_RANGE, confusion_columns, ranking_areas, ratio
from wardlight.session import lookup_join

UNKNOWN = "Unknown"


def _group_value(column: str, null_group: str) -> Column:
    text = F.col(column).cast("string")
    return F.coalesce(text, F.lit(UNKNOWN)) if null_group == "keep" else text


def by_attribute(
    scored: DataFrame, attributes: Sequence[str], carry: Sequence[str],
    null_group: str = "keep",
) -> DataFrame:
    """One row per (row, attribute): columns attribute, value and ``carry``.

    ``null_group`` keeps rows without a value as group ``Unknown`` or drops them.
    """
    if null_group not in ("keep", "drop"):
        raise ValueError(f"null_group: {null_group!r}")
    pairs = F.array(*[
        F.struct(F.lit(a).alias("attribute"), _group_value(a, null_group).alias("value"))
        for a in attributes
    ])
    long = scored.select(*carry, F.inline(pairs))
    return long if null_group == "keep" else long.where(F.col("value").isNotNull())


def rate_columns(zero_division: float | None = 0.0) -> dict[str, Column]:
    """Rates of a group from its tp/fp/tn/fn; precision has no default."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    return {
        "count": n,
        "base_rate": ratio(tp + fn, n, None),
        "selection_rate": ratio(tp + fp, n, None),
        "recall": ratio(tp, tp + fn, zero_division),
        "specificity": ratio(tn, tn + fp, zero_division),
        "false_positive_rate": ratio(fp, tn + fp, zero_division),
        "false_negative_rate": ratio(fn, tp + fn, zero_division),
        "precision": ratio(tp, tp + fp, None),
    }


def fairness_report(
    scored: DataFrame, attributes: Sequence[str], label: str = "label",
    pred: str = "y_pred", null_group: str = "keep", zero_division: float | None = 0.0,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Rates of every group of every attribute, stacked in one table.

    ``extra`` maps names to aggregate Columns over ``label`` and ``y_pred``.
    """
    carry = [F.col(label).alias("label"), F.col(pred).alias("y_pred")]
    long = by_attribute(scored, attributes, carry, null_group)
    extra = extra or {}
    counts = confusion_columns(F.col("label"), F.col("y_pred")) | extra
    grouped = long.groupBy("attribute", "value").agg(
        *[c.alias(k) for k, c in counts.items()]
    )
    rates = rate_columns(zero_division)
    return grouped.select(
        "attribute", "value", *[c.alias(k) for k, c in rates.items()],
        "tp", "fp", "tn", "fn", *extra,
    )


def intersection_report(
    scored: DataFrame, attributes: Sequence[str], label: str = "label",
    pred: str = "y_pred", null_group: str = "keep", zero_division: float | None = 0.0,
    fill_absent: bool = False,
) -> DataFrame:
    """Rates per combination of attribute values.

    ``fill_absent`` also lists combinations no row has, with NULL rates.
    """
    keys = list(attributes)
    values = {a: _group_value(a, null_group) for a in keys}
    slim = scored.select(
        *[c.alias(a) for a, c in values.items()],
        F.col(label).alias("label"), F.col(pred).alias("y_pred"),
    )
    if null_group == "drop":
        slim = slim.dropna(subset=keys)
    counts = confusion_columns(F.col("label"), F.col("y_pred"))
    report = slim.groupBy(*keys).agg(*[c.alias(k) for k, c in counts.items()]).select(
        *keys, *[c.alias(k) for k, c in rate_columns(zero_division).items()],
    )
    if not fill_absent:
        return report
    # Value lists come from the report, so their size is that of the report.
    seen = report.agg(*[F.collect_set(a).alias(a) for a in keys])
    combinations = reduce(
        lambda df, a: df.withColumn(a, F.explode(a)), keys, seen
    )
    return combinations.join(report, keys, "left")


def _spread(column: str) -> Column:
    return F.max(column) - F.min(column)


def fairness_gaps(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per attribute (and ``by``) from a fairness report: the three gaps.

    demographic parity: spread of the selection rate; equalized odds: the
    larger spread of recall and false positive rate; predictive parity:
    spread of precision over the groups that have one.
    """
    return report.groupBy(*by, "attribute").agg(
        _spread("selection_rate").alias("demographic_parity_gap"),
        F.greatest(_spread("recall"), _spread("false_positive_rate")).alias(
            "equalized_odds_gap"
        ),
        _spread("precision").alias("predictive_parity_gap"),
        F.count("*").alias("n_groups"),
    )


def aggregate_fairness_metrics(
    scored: DataFrame, attributes: Sequence[str], label: str = "label",
    pred: str = "y_pred", null_group: str = "keep",
) -> DataFrame:
    """Gaps of all attributes; an attribute the table lacks gets NULL gaps."""
    present = [a for a in attributes if a in scored.columns]
    absent = [a for a in attributes if a not in scored.columns]
    gaps = fairness_gaps(fairness_report(scored, present, label, pred, null_group))
    if not absent:
        return gaps
    empty = scored.sparkSession.createDataFrame(
        [(a, None, None, None, 0) for a in absent], gaps.schema
    )
    return gaps.unionByName(empty)


def over_alerting(report: DataFrame) -> DataFrame:
    """Selection rate against true rate per group, above 1 means over-alerting."""
    return report.select(
        "attribute", "value", "count", "base_rate", "selection_rate",
        ratio(F.col("selection_rate"), F.col("base_rate"), None).alias("alert_ratio"),
    )


def subgroup_areas(
    scored: DataFrame, attributes: Sequence[str], score: str = "score",
    label: str = "label", null_group: str = "keep", rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """AUC-ROC and average precision of every group; NULL with one class only."""
    carry = [F.col(label).alias("label"), F.col(score).alias("score")]
    long = by_attribute(scored, attributes, carry, null_group)
    return ranking_areas(
        long, "score", "label", ["attribute", "value"], rows_per_range
    )


def missed_positives(
    scored: DataFrame, attributes: Sequence[str], label: str = "label",
    pred: str = "y_pred", null_group: str = "keep",
) -> DataFrame:
    """False negatives by group: count and share of the group's positives."""
    report = fairness_report(scored, attributes, label, pred, null_group)
    positives = F.col("tp") + F.col("fn")
    return report.select(
        "attribute", "value", positives.alias("n_positive"),
        F.col("fn").alias("n_missed"),
        ratio(F.col("fn"), positives, None).alias("missed_share"),
    )


def reweighting(
    df: DataFrame, attribute: str, label: str = "label", null_group: str = "keep"
) -> DataFrame:
    """Weight P(a) * P(y) / P(a, y) for every (attribute value, label)."""
    value = _group_value(attribute, null_group)
    cells = df.select(value.alias("value"), F.col(label).alias("label"))
    cube = cells.where(F.col("value").isNotNull()).cube("value", "label").agg(
        F.count("*").alias("n"), F.grouping_id().alias("level")
    )
    # The cube is at most (groups + 1) * 3 rows; pair up its margins.
    joint = cube.where("level = 0").select("value", "label", F.col("n").alias("n_joint"))
    of_value = cube.where("level = 1").select("value", F.col("n").alias("n_value"))
    of_label = cube.where("level = 2").select("label", F.col("n").alias("n_label"))
    total = joint.groupBy().agg(F.sum("n_joint").alias("n_total"))
    weights = joint.join(of_value, "value").join(of_label, "label")
    return weights.withColumn("n_total", total.scalar()).withColumn(
        "weight",
        F.col("n_value") * F.col("n_label") / (F.col("n_total") * F.col("n_joint")),
    )


def add_reweighting(
    df: DataFrame, attribute: str, label: str = "label", into: str = "weight"
) -> DataFrame:
    """Add the reweighting weight to every row."""
    weights = reweighting(df, attribute, label).select(
        F.col("value").alias("__value"), F.col("label").alias(label),
        F.col("weight").alias(into),
    )
    keyed = df.withColumn("__value", _group_value(attribute, "keep"))
    return lookup_join(keyed, weights, ["__value", label]).drop("__value")
