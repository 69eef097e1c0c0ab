"""The corpus pipeline: filters, copies, leaks and the final mixture.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written as Parquet
and read back as the next one's ``docs``. All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlight.llm import decontaminate, line_dedup, mixing, near_dedup, quality_rules
from wardlight.llm.common import read_table, stored
from wardlight.session import Scratch


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the certified cutoffs of their language."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines whose template recurs; documents of nothing else go."""
    return line_dedup.drop_recurring(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: each document as often as it is taken."""
    return mixing.mixture(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing", mix_sources),
]

# SQL cannot express the near-dedup stage; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; a stage's table goes when the next one is written."""
    docs = read_table(spark, sf_dir, "documents")
    with Scratch(spark, "pipeline") as scratch:
        for name, stage in STAGES[:-1]:
            before, docs = docs, scratch.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            scratch.drop(before)
        name, stage = STAGES[-1]
        return stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
