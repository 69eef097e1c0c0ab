"""Scoring a stream of records into the prediction log."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardlight.operators.score import IDS, predict_risk

_WRITING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def score_stream(
    model: PipelineModel, records: DataFrame, threshold: float = 0.5,
    event_time: str = "discharged", delay: str = "2 days", key: str = "encounter_id",
) -> DataFrame:
    """Scored records with a ``score_date``; a re-sent record is scored once.

    State is one key per record inside the delay, so it does not grow with
    the age of the stream.
    """
    fresh = records.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    scored = predict_risk(model, fresh, threshold, keep=(*IDS, event_time))
    return scored.withColumn("score_date", F.to_date(event_time))


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for the write of a batch; a stream with state has it off.

    Without it the hint to rebalance is void, and every task writes a file for every day.
    Small partitions stay apart: opening the files of many days takes longer than their rows.
    """
    before = {key: spark.conf.get(key) for key in _WRITING}
    try:
        for key, value in _WRITING.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def start_prediction_log(
    scored: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append the stream to a Parquet log: a folder per batch, in it one per day.

    A batch that is run again after a failure writes its own folder once more, so the
    log holds each record once. Rows are rebalanced by day at run time: a quiet day is
    one file of a batch, a busy one is written by several tasks.
    ``available_now`` handles what is there and stops; otherwise it runs on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with _adaptive(batch.sparkSession):
            batch.hint("rebalance", F.col("score_date")).write.mode("overwrite").partitionBy(
                "score_date").parquet(f"{path}/batch={batch_id}")

    writer = scored.writeStream.outputMode("append").foreachBatch(write).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_prediction_log(spark: SparkSession, path: str) -> DataFrame:
    """The log, with the day of each record."""
    return spark.read.parquet(path).drop("batch")
