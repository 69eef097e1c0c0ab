"""Monitoring of scored streams: volumes, alert rates and fairness gaps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import inf, nextafter

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardlight.functions.clinical import quoted
from wardlight.operators.fairness import (
    by_attribute, confusion_columns, fairness_gaps, rate_columns,
)


def monitoring_windows(
    scored: DataFrame, event_time: str = "ts", window: str = "30 days",
    delay: str = "1 day", score: str = "score", pred: str = "y_pred",
    watched: Sequence[str] = (),
) -> DataFrame:
    """Rows, mean score, alert rate and missing rates per time window.

    Works on a stream (append mode: a window appears once the watermark has
    passed it, later rows are dropped) and on a static table.
    """
    aggregates = [
        F.count("*").alias("n"), F.avg(score).alias("mean_score"),
        F.avg(F.col(pred).cast("double")).alias("alert_rate"),
        *[F.avg(quoted(c).isNull().cast("double")).alias(f"missing_{c}") for c in watched],
    ]
    dated = scored.withWatermark(event_time, delay)
    grouped = dated.groupBy(F.window(event_time, window).alias("w")).agg(*aggregates)
    rest = [c for c in grouped.columns if c != "w"]
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest
    )


def group_counts(
    scored: DataFrame, attributes: Sequence[str], event_time: str = "ts",
    window: str = "30 days", delay: str = "1 day", label: str = "label",
    pred: str = "y_pred",
) -> DataFrame:
    """Confusion counts per window, attribute and value (the streaming part)."""
    dated = scored.withWatermark(event_time, delay)
    carry = [event_time, F.col(label).alias("label"), F.col(pred).alias("y_pred")]
    long = by_attribute(dated, attributes, carry)
    counts = confusion_columns(F.col("label"), F.col("y_pred"))
    grouped = long.groupBy(
        F.window(event_time, window).alias("w"), "attribute", "value"
    ).agg(*[c.alias(k) for k, c in counts.items()])
    return grouped.select(
        F.col("w.start").alias("window_start"), "attribute", "value", *counts
    )


def window_gaps(counts: DataFrame) -> DataFrame:
    """Fairness gaps per window from group counts (static table)."""
    rates = {k: c for k, c in rate_columns().items()}
    report = counts.select(
        "window_start", "attribute", "value", *[c.alias(k) for k, c in rates.items()]
    )
    return fairness_gaps(report, by=["window_start"])


# Size of the quantile sketches, and points at which two of them are compared.
SKETCH_SIZE = 4_000
DRIFT_POINTS = 1_000


def rank_error(size: int) -> float:
    """Error of a rank read from a KLL sketch of this size, at 99 % confidence."""
    # The published fit of the sketch's single-sided rank error.
    return 2.296 / size ** 0.9021


def reference_sketches(
    df: DataFrame, columns: Sequence[str], size: int = SKETCH_SIZE, points: int = DRIFT_POINTS
) -> DataFrame:
    """One row per column of a training table: n, sketch, and its quantiles as points."""
    shares = F.lit([i / points for i in range(points + 1)])
    sketched = df.select(F.inline(_values(columns))).where("value IS NOT NULL").groupBy(
        "column_name").agg(F.count("*").alias("n"),
                           F.kll_sketch_agg_double("value", size).alias("sketch"))
    return sketched.withColumn("points", F.array_distinct(
        F.kll_sketch_get_quantile_double("sketch", shares)))


def _values(columns: Sequence[str]):
    return F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.nanvl(quoted(c).cast("double"), F.lit(None).cast("double")).alias("value"))
        for c in columns
    ])


def drift_windows(
    records: DataFrame, columns: Sequence[str], event_time: str = "ts",
    window: str = "30 days", delay: str = "1 day", size: int = SKETCH_SIZE,
) -> DataFrame:
    """Per time window and column: n and a quantile sketch (the streaming part).

    The sketch is the state: it has a fixed size however many rows a window has, and
    partial sketches of the tasks are merged.
    """
    dated = records.withWatermark(event_time, delay)
    long = dated.select(event_time, F.inline(_values(columns))).where("value IS NOT NULL")
    grouped = long.groupBy(F.window(event_time, window).alias("w"), "column_name").agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double("value", size).alias("sketch"))
    return grouped.select(F.col("w.start").alias("window_start"), "column_name", "n", "sketch")


def window_drift(
    windows: DataFrame, reference: Sequence[Row], alert: float = 0.15, size: int = SKETCH_SIZE
) -> DataFrame:
    """Kolmogorov-Smirnov distance of each window to the training reference.

    Both distribution functions are read at the reference's points and just below them.
    ``ks`` misses the exact distance by ``bound`` at most: the errors of both sketches and the
    share between two points. ``alert`` is 1 above the threshold, ``sure`` where the
    bound leaves no doubt.
    """
    if not reference:
        raise ValueError("the reference has no values")
    parts = []
    for of in reference:
        points = sorted({x for p in of["points"] for x in (p, nextafter(p, -inf))})
        mine = windows.where(F.col("column_name") == of["column_name"])
        known = mine.withColumn("__of", F.lit(bytes(of["sketch"])))
        here, there = (F.kll_sketch_get_rank_double(c, F.lit(points)) for c in ("sketch", "__of"))
        apart = F.zip_with(here, there, lambda a, b: F.abs(a - b))
        # Sketches of fewer rows than their size are exact.
        error = rank_error(size)
        bound = F.when(F.col("n") > size, error).otherwise(0.0) + F.lit(
            (error if of["n"] > size else 0.0)
            + (1 / DRIFT_POINTS if of["n"] > DRIFT_POINTS else 0.0))
        parts.append(known.select(
            "window_start", "column_name", "n", F.array_max(apart).alias("ks"),
            bound.alias("bound")))
    found = reduce(DataFrame.unionByName, parts)
    return found.withColumns({
        "alert": F.when(F.col("ks") > alert, 1).otherwise(0),
        "sure": F.abs(F.col("ks") - alert) > F.col("bound"),
    })


def start_drift_log(
    windows: DataFrame, reference: Sequence[Row], path: str, checkpoint: str,
    alert: float = 0.15, size: int = SKETCH_SIZE, available_now: bool = True,
) -> StreamingQuery:
    """Append the drift of every closed window to a Parquet log, one folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        window_drift(batch, reference, alert, size).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}")

    writer = windows.writeStream.outputMode("append").foreachBatch(write).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_gap_log(
    counts: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append the gaps of every closed window to a Parquet log.

    All groups of a window leave the stream in the same batch, so each batch
    can be turned into gaps by itself. A batch writes its own folder, and a
    replay after a failure writes the same folder again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        window_gaps(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = (
        counts.writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
