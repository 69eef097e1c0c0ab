"""ICD-9 code to diagnosis category, as one Column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIABETES, OTHER, MISSING = "Diabetes", "Other", "Missing"

# Diagnosis categories of the 2014 HbA1c readmission paper,
# table 2: first code, first code after the range, extra symptom code.
RANGES = {
    "Circulatory": (390, 460, 785),
    "Respiratory": (460, 520, 786),
    "Digestive": (520, 580, 787),
    "Injury": (800, 1000, None),
    "Musculoskeletal": (710, 740, None),
    "Genitourinary": (580, 630, 788),
    "Neoplasms": (140, 240, None),
}
CATEGORIES = (*RANGES, DIABETES, OTHER, MISSING)


def _of_whole(code: int) -> str:
    for name, (low, high, symptom) in RANGES.items():
        if low <= code < high or code == symptom:
            return name
    return OTHER


# The category of each whole code; what lies above is ``OTHER``.
_BY_CODE = [_of_whole(code) for code in range(max(high for _, high, _ in RANGES.values()))]


def icd9_category(code: Column) -> Column:
    """Category of an ICD-9 code; stays inside whole-stage codegen.

    The pattern guard keeps V/E codes and text such as ``428d`` away from the
    cast, which under ANSI mode would raise or read the trailing letter as a
    type suffix.
    """
    text = F.btrim(code.cast("string"), F.lit(" \t\r\n"))
    number = F.when(text.rlike(r"^[0-9]+(\.[0-9]*)?$"), text.try_cast("double"))
    # All bounds are whole, so the whole part decides; it is computed once a row, where a
    # chain of conditions would match the pattern and cast again in each of them.
    place = F.least(F.floor(number), F.lit(len(_BY_CODE))).cast("int")
    return F.when(
        text.isNull() | (text == "") | (F.lower(text) == "nan"), MISSING
    ).when(text.startswith("250"), DIABETES).otherwise(
        F.coalesce(F.get(F.lit(_BY_CODE), place), F.lit(OTHER)))


def add_diagnosis_categories(
    df: DataFrame, columns: tuple[str, ...] = ("diag_1", "diag_2", "diag_3"),
    suffix: str = "_cat",
) -> DataFrame:
    """Add ``<column><suffix>`` for every listed column the table has."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c + suffix: icd9_category(F.col(c)) for c in present})
