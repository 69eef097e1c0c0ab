"""An encounter table derived from the star-schema test tables.

Each order is one stay of its customer; lines give diagnoses, medications and
visit counts. The parts are separate functions so that a query reads only the
tables it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.config import PATIENT_ID
from wardlight.functions.clinical import as_flag
from wardlight.operators.profile import derive_readmission
from wardlight.sources.encounters import normalize_nulls

# Line numbers 1 to 7 stand for these medications.
LINE_MEDICATIONS = (
    "metformin", "repaglinide", "nateglinide", "glimepiride", "glipizide",
    "pioglitazone", "insulin",
)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """Stays with everything that the orders table alone gives."""
    orders = read(spark, folder, "orders")
    key = F.col("o_orderkey")
    a1c = F.when(key % 6 == 0, ">7").when(key % 6 == 1, ">8").when(key % 6 == 2, "Norm")
    glucose = F.when(key % 5 == 0, ">200").when(key % 5 == 1, ">300").when(key % 5 == 2, "Norm")
    priority = F.col("o_orderpriority")
    return orders.select(
        key.alias("encounter_id"),
        F.col("o_custkey").alias(PATIENT_ID),
        F.col("o_orderdate").alias("admitted"),
        F.col("o_orderstatus").alias("gender"),
        F.substring(priority, 1, 1).cast("int").alias("admission_type_id"),
        (1 + key % 28).cast("int").alias("discharge_disposition_id"),
        (1 + F.col("o_custkey") % 25).cast("int").alias("admission_source_id"),
        F.floor(F.col("o_totalprice") / 5000).cast("int").alias("num_lab_procedures"),
        (key % 7).cast("int").alias("num_procedures"),
        (1 + key % 9).cast("int").alias("number_diagnoses"),
        F.coalesce(glucose, F.lit("None")).alias("max_glu_serum"),
        F.coalesce(a1c, F.lit("None")).alias("A1Cresult"),
        F.lit("?").alias("weight"),
        F.when(key % 5 < 2, "?").otherwise("MC").alias("payer_code"),
        F.lit("No").alias("examide"),
        F.lit("No").alias("citoglipton"),
        F.col("o_totalprice").alias("charge"),
        (priority == "4-NOT SPECIFIED").alias("race_unknown"),
    )


def labelled_visits(spark: SparkSession, folder: str) -> DataFrame:
    """Visits with the outcome and its 0/1 label."""
    return derive_readmission(visits(spark, folder)).withColumn(
        "label", as_flag(F.col("readmitted") == "<30")
    )


def with_demographics(stays: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Add race, age band and specialty from the customer table."""
    customers = read(spark, folder, "customer")
    band = F.floor((F.col("c_acctbal") + 1000) / 1100)
    people = customers.select(
        F.col("c_custkey").alias(PATIENT_ID),
        F.col("c_mktsegment").alias("segment"),
        F.concat(F.lit("["), 10 * band, F.lit("-"), 10 * (band + 1), F.lit(")")).alias("age"),
        F.when(F.col("c_nationkey") % 2 == 0, "?").otherwise(
            F.concat(F.lit("Specialty"), F.col("c_nationkey"))
        ).alias("medical_specialty"),
    )
    race = F.when(F.col("race_unknown"), "?").otherwise(F.col("segment"))
    return stays.join(people, PATIENT_ID, "left").withColumn("race", race).drop(
        "segment", "race_unknown"
    )


def line_profile(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: visit counts, diagnosis codes and medications.

    The pivot keeps to integer maxima (packed diagnosis, coded dose), so it
    stays a hash aggregate with map-side combine; text is made afterwards.
    """
    lines = read(spark, folder, "lineitem")
    flag, number = F.col("l_returnflag"), F.col("l_linenumber")
    dose = F.when(flag == "A", 1).when(flag == "N", 2).when(flag == "R", 3)
    packed = F.col("l_partkey") * 10 + F.col("l_suppkey") % 10
    pivot = lines.groupBy(F.col("l_orderkey").alias("encounter_id")).agg(
        F.count_if(flag == "N").cast("int").alias("number_outpatient"),
        F.count_if(flag == "A").cast("int").alias("number_emergency"),
        F.count_if(flag == "R").cast("int").alias("number_inpatient"),
        F.count("*").cast("int").alias("num_medications"),
        F.max(number).alias("time_in_hospital"),
        *[F.max(F.when(number == i, packed)).alias(f"diag_{i}") for i in (1, 2, 3)],
        *[F.max(F.when(number == i, dose)).alias(m)
          for i, m in enumerate(LINE_MEDICATIONS, 1)],
    )
    doses = {
        m: F.when(F.col(m) == 1, "Down").when(F.col(m) == 2, "Steady")
        .when(F.col(m) == 3, "Up").otherwise("No")
        for m in LINE_MEDICATIONS
    }
    return pivot.withColumns(
        {f"diag_{i}": _diagnosis(F.col(f"diag_{i}")) for i in (1, 2, 3)} | doses
    )


def _diagnosis(packed):
    part, digit = F.floor(packed / 10), packed % 10
    return (
        F.when(part % 20 == 0, F.concat(F.lit("250."), digit))
        .when(part % 20 == 1, F.concat(F.lit("V"), 10 + part % 80))
        .when(part % 20 == 2, F.concat(F.lit("E"), 800 + part % 200))
        .when(part % 20 == 3, F.lit("?"))
        .otherwise(F.concat(100 + (part * 7) % 900, F.lit("."), digit))
    )


def with_lines(stays: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Add the line profile; stays without lines have NULL counts and no drugs."""
    joined = stays.join(line_profile(spark, folder), "encounter_id", "left")
    return joined.withColumns(
        {m: F.coalesce(m, F.lit("No")) for m in LINE_MEDICATIONS}
        | {
            "change": F.when(F.col("number_inpatient") > 0, "Ch").otherwise("No"),
            "diabetesMed": F.when(F.col("num_medications").isNotNull(), "Yes").otherwise("No"),
        }
    )


def raw_encounters(spark: SparkSession, folder: str) -> DataFrame:
    """The whole encounter table with its ``?`` markers, as a file would hold it."""
    stays = derive_readmission(visits(spark, folder))
    return with_lines(with_demographics(stays, spark, folder), spark, folder)


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    """The encounter table after ingest (markers are NULL)."""
    return normalize_nulls(raw_encounters(spark, folder), keep=("readmitted",))


def scored_visits(spark: SparkSession, folder: str) -> DataFrame:
    """Visits with a deterministic score in [0, 1] and a label at 0.4."""
    score = F.least(F.lit(1.0), F.col("charge") / 1e6 + 0.3 * F.col("label"))
    stays = labelled_visits(spark, folder).withColumn("score", score)
    return stays.withColumn("y_pred", as_flag(F.col("score") >= 0.4))


def scored_people(spark: SparkSession, folder: str) -> DataFrame:
    """Scored visits with race, age and gender for the fairness queries."""
    joined = with_demographics(scored_visits(spark, folder), spark, folder)
    return normalize_nulls(
        joined.select(
            "encounter_id", PATIENT_ID, "race", "age", "gender", "label", "score", "y_pred"
        )
    )


def scored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with a score from their length."""
    documents = read(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = read(spark, folder, "labels")
    score = F.least(F.lit(1.0), F.col("n_chars") / 4000.0)
    return documents.join(labels, "doc_id").select(
        "doc_id", "lang", "source", F.col("quality").alias("label"), score.alias("score"),
        as_flag(score >= 0.5).alias("y_pred"),
    )
