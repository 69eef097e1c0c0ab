"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.session import scratch_path


def quoted(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The runs of characters other than white space; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), "")


def word_hashes(text: Column) -> Column:
    """A 64-bit hash of each word, in order."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def stored(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write a table to the shared folder and read it back; cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_tag(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells rows with the same doc_id but other texts apart; never NULL."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def smallest(df: DataFrame, key: Column, n: int, at_least: int) -> DataFrame:
    """The ``n`` rows with the smallest 64-bit hash ``key``, a bounded sample.

    ``at_least`` is a lower bound of the rows there are. Rows whose key lies beyond
    twice the share that is wanted are left out before the sort, so that a large
    table does not send ``n`` rows per task to it.
    """
    share = min(1.0, 2 * n / max(1, at_least))
    if share < 1:
        df = df.where(key < F.lit(int(-(1 << 63) + share * (1 << 64))))
    return df.orderBy(key).limit(n)
