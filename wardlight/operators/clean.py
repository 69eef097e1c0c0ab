"""Cohort cleaning: label, unused columns, terminal discharges, roles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.config import (
    ENCOUNTER_ID, LABEL, PATIENT_ID, POSITIVE_VALUE, RAW_TARGET, TERMINAL_DISCHARGES,
    UNUSED_COLUMNS,
)
from wardlight.functions.clinical import as_flag
from wardlight.session import lookup_join


def binarize_target(
    df: DataFrame, raw: str = RAW_TARGET, label: str = LABEL, positive: str = POSITIVE_VALUE
) -> DataFrame:
    """Add a 0/1 label; an unknown (NULL) outcome is 0."""
    if raw not in df.columns:
        raise ValueError(f"target column {raw!r} not found in {df.columns[:10]}")
    return df.withColumn(label, as_flag(F.col(raw) == positive))


def drop_unused_columns(df: DataFrame, columns: Sequence[str] = UNUSED_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def drop_expired_patients(
    df: DataFrame,
    column: str = "discharge_disposition_id",
    codes: Sequence[int] = TERMINAL_DISCHARGES,
) -> DataFrame:
    """Drop stays that ended in death or hospice; an unknown code stays."""
    if column not in df.columns:
        return df
    return df.where(F.col(column).isNull() | ~F.col(column).isin(*codes))


def basic_clean(df: DataFrame) -> DataFrame:
    return df.transform(binarize_target).transform(drop_unused_columns).transform(
        drop_expired_patients
    )


def select_roles(
    df: DataFrame, drop_ids: bool = True, label: str = LABEL, patient: str = PATIENT_ID,
    encounter: str = ENCOUNTER_ID, raw: str = RAW_TARGET,
) -> DataFrame:
    """One table with ``label``, ``group`` and the feature columns.

    Rows without a patient are their own group, named by the encounter.
    """
    if label not in df.columns:
        raise ValueError(f"label {label!r} not found: run binarize_target first")
    keys = [c for c in (patient, encounter) if c in df.columns]
    if not keys:
        raise ValueError(f"neither {patient!r} nor {encounter!r} found")
    dropped = {label, raw} | ({patient, encounter} if drop_ids else set())
    features = [c for c in df.columns if c not in dropped]
    return df.select(
        F.col(label).cast("int").alias("label"), F.coalesce(*keys).alias("group"),
        *[F.col(f"`{c}`") for c in features],
    )


def group_categories(
    df: DataFrame, column: str, mapping: DataFrame, into: str, other: str = "Other",
    missing: str | None = None,
) -> DataFrame:
    """Replace codes by the group a mapping table ``(column, into)`` gives them."""
    joined = lookup_join(df, mapping, [column])
    filled = F.coalesce(F.col(into), F.lit(other))
    if missing is not None:
        filled = F.when(F.col(column).isNull(), missing).otherwise(filled)
    return joined.withColumn(into, filled)


def describe_codes(df: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Left join of a code column to its description table."""
    return lookup_join(df, codes, [column])


def exclusion_counts(
    df: DataFrame, discharge: str = "discharge_disposition_id", gender: str = "gender",
    invalid: str = "Unknown/Invalid", codes: Sequence[int] = TERMINAL_DISCHARGES,
) -> DataFrame:
    """Rows removed by the terminal-discharge and gender rules, alone and jointly."""
    terminal = F.coalesce(F.col(discharge).isin(*codes), F.lit(False))
    unknown = F.coalesce(F.col(gender) == invalid, F.lit(False))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(terminal).alias("n_terminal"),
        F.count_if(unknown).alias("n_invalid_gender"),
        F.count_if(terminal | unknown).alias("n_removed"),
    ).withColumn(
        "pct_removed", F.round(100.0 * F.col("n_removed") / F.col("n_rows"), 2)
    )


def drop_invalid_gender(
    df: DataFrame, gender: str = "gender", invalid: str = "Unknown/Invalid"
) -> DataFrame:
    return df.where(F.col(gender).isNull() | (F.col(gender) != invalid))
