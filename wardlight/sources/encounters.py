"""Reading encounter tables, code tables and scoring records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.config import MEDICATIONS, NULL_TOKENS
from wardlight.functions.clinical import quoted

_LONGS = ("encounter_id", "patient_nbr")
_CODES = ("admission_type_id", "discharge_disposition_id", "admission_source_id")
_COUNTS = (
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
)

# Column order of the public CSV file.
CSV_COLUMNS = (
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight",
    "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", "payer_code", "medical_specialty", "num_lab_procedures",
    "num_procedures", "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "diag_1", "diag_2", "diag_3", "number_diagnoses",
    "max_glu_serum", "A1Cresult", "metformin", "repaglinide", "nateglinide",
    "chlorpropamide", "glimepiride", "acetohexamide", "glipizide", "glyburide",
    "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose", "miglitol",
    "troglitazone", "tolazamide", "examide", "citoglipton", "insulin",
    "glyburide-metformin", "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone", "change", "diabetesMed",
    "readmitted",
)


def _field(name: str) -> T.StructField:
    if name in _LONGS:
        return T.StructField(name, T.LongType())
    if name in _CODES or name in _COUNTS:
        return T.StructField(name, T.IntegerType())
    return T.StructField(name, T.StringType())


ENCOUNTER_SCHEMA = T.StructType([_field(c) for c in CSV_COLUMNS])
CODE_SCHEMA = T.StructType([
    T.StructField("code", T.IntegerType()),
    T.StructField("description", T.StringType()),
])


def normalize_nulls(
    df: DataFrame, tokens: Sequence[str] = NULL_TOKENS, keep: Sequence[str] = ()
) -> DataFrame:
    """Turn missing-value spellings into NULL in every string column."""
    strings = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in keep
    ]
    listed = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)
    return df.withColumns({
        c: F.expr(f"CASE WHEN trim(`{c}`) NOT IN ({listed}) THEN `{c}` END") for c in strings
    })


def load_encounters(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType = ENCOUNTER_SCHEMA,
    tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """Read an encounter table with a declared schema and NULLs made uniform.

    A missing path raises Spark's ``PATH_NOT_FOUND`` on this call.
    """
    reader = spark.read
    if fmt == "csv":
        # Numbers are read as text, for they may be spelled as missing values.
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        raw = (
            reader.schema(texts).option("header", True).option("mode", "FAILFAST")
            .option("enforceSchema", False).csv(path)
        )
        return normalize_nulls(raw, tokens).select([
            _typed(f).alias(f.name) for f in schema.fields
        ])
    if fmt == "json":
        reader = reader.schema(schema)
    return normalize_nulls(reader.format(fmt).load(path), tokens)


def _typed(field: T.StructField):
    """A text column as the field's type; text that is neither it nor missing fails."""
    value = quoted(field.name)
    if isinstance(field.dataType, T.StringType):
        return value
    known = F.trim(value).try_cast(field.dataType)
    problem = F.concat(F.lit(f"{field.name}: not a {field.dataType.simpleString()}: "), value)
    return F.when(value.isNull() | known.isNotNull(), known).otherwise(F.raise_error(problem))


def load_code_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read one ``<name>,description`` code file as (name, name_description)."""
    codes = (
        spark.read.schema(CODE_SCHEMA).option("header", True).option("nullValue", "NULL")
        .csv(path)
    )
    return codes.where(F.col("code").isNotNull()).select(
        F.col("code").alias(name), F.trim("description").alias(f"{name}_description")
    )


def load_records(
    spark: SparkSession, path: str, schema: T.StructType = ENCOUNTER_SCHEMA,
    tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """Read JSON scoring records; absent fields are NULL."""
    return load_encounters(spark, path, "json", schema, tokens)


def align_to_schema(
    df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """The schema's columns in its order: absent ones NULL, others dropped.

    Columns in ``keep`` (ids, times) are carried in front if present.
    """
    have = set(df.columns)
    carried = [quoted(c) for c in keep if c in have and c not in schema.names]
    wanted = [
        (quoted(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*carried, *wanted)


# A made-up stay for smoke tests of the scoring path.
EXAMPLE_RECORD = {
    "age": "[70-80)", "gender": "Male", "race": "Hispanic",
    "admission_source_id": 1, "admission_type_id": 3, "discharge_disposition_id": 6,
    "diag_1": "491.2", "diag_2": "414", "diag_3": "584.9",
    "number_diagnoses": 7, "number_emergency": 1, "number_inpatient": 2, "number_outpatient": 3,
    "num_lab_procedures": 52, "num_medications": 18, "num_procedures": 2, "time_in_hospital": 6,
    "A1Cresult": "Norm", "max_glu_serum": ">200",
    "glipizide": "Steady", "insulin": "Up", "change": "Ch", "diabetesMed": "Yes",
}


def example_record(spark: SparkSession) -> DataFrame:
    """The example as a one-row table; fields it lacks are NULL."""
    row = tuple(EXAMPLE_RECORD.get(c) for c in ENCOUNTER_SCHEMA.names)
    return spark.createDataFrame([row], ENCOUNTER_SCHEMA)


assert set(MEDICATIONS) <= set(CSV_COLUMNS)
