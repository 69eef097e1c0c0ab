"""Distribution drift: two-sample Kolmogorov-Smirnov distance per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.functions.clinical import quoted
from wardlight.operators.prefix import BUCKET, ROWS_PER_RANGE, add_ranges, running_totals


def ks_drift(
    df: DataFrame, columns: Sequence[str], side: str, alert: float = 0.15,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Largest distance of the two distribution functions of every column.

    ``side`` is 0 for reference rows and 1 for new rows; NULL values are left
    out. All columns share one pass: values are counted per (column, value)
    with map-side combine, and running totals give both functions.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), quoted(c).cast("double").alias("value"))
        for c in columns
    ])
    long = df.select(F.col(side).alias("side"), F.inline(pairs)).where(
        "value IS NOT NULL AND NOT isnan(value)"
    )
    long = add_ranges(long, "value", rows_per_range)
    keys = ["column_name", "value", *([BUCKET] if BUCKET in long.columns else [])]
    counted = long.groupBy(*keys).agg(
        F.count_if(F.col("side") == 0).alias("n_old"), F.count_if(F.col("side") == 1).alias("n_new")
    )
    ranked = running_totals(
        counted, ["value"], {"old_upto": "n_old", "new_upto": "n_new"}, ["column_name"],
        {"n_reference": "n_old", "n_current": "n_new"},
    )
    gap = F.abs(
        F.try_divide("old_upto", "n_reference") - F.try_divide("new_upto", "n_current")
    )
    return ranked.groupBy("column_name").agg(
        F.max(gap).alias("ks"), F.max("n_reference").alias("n_reference"),
        F.max("n_current").alias("n_current"),
    ).withColumn("alert", F.when(F.col("ks") > alert, 1).otherwise(0))
