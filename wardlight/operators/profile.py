"""Data profile of an encounter table and per-patient history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from wardlight.config import PATIENT_ID
from wardlight.functions.clinical import quoted


def _count_per_column(df: DataFrame, columns: Sequence[str], condition, into: str) -> DataFrame:
    """One aggregate over all columns, turned into (column_name, count, rows)."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.count_if(condition(quoted(c))).alias(into))
        for c in columns
    ])
    return df.agg(F.count("*").alias("n_rows"), entries.alias("entries")).select(
        "n_rows", F.inline("entries")
    )


def missing_summary(df: DataFrame) -> DataFrame:
    """NULL count and percentage per column, only columns that have any."""
    counts = _count_per_column(df, df.columns, lambda c: c.isNull(), "n_missing")
    return counts.where(F.col("n_missing") > 0).select(
        "column_name", "n_missing",
        F.round(100.0 * F.col("n_missing") / F.col("n_rows"), 2).alias("pct_missing"),
    ).orderBy(F.desc("n_missing"), "column_name")


def marker_summary(df: DataFrame, marker: str = "?") -> DataFrame:
    """How often the literal marker occurs per string column."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counts = _count_per_column(df, strings, lambda c: c == marker, "n_marker")
    return counts.where(F.col("n_marker") > 0).select(
        "column_name", "n_marker",
        F.round(100.0 * F.col("n_marker") / F.col("n_rows"), 2).alias("pct_marker"),
    ).orderBy(F.desc("n_marker"), "column_name")


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of every value, most frequent first."""
    counts = df.groupBy(quoted(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.groupBy().agg(F.sum("n"))
    return counts.withColumn(
        "pct", F.round(100.0 * F.col("n") / total.scalar(), 2)
    ).orderBy(F.desc("n"), "value")


def top_values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The n most frequent values; ties in value order."""
    counts = df.where(quoted(column).isNotNull()).groupBy(quoted(column).alias("value"))
    return counts.agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n)


def rate_by(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Rows and label rate (percent) per combination of the columns."""
    return df.groupBy(*columns).agg(
        F.count("*").alias("n"), F.round(100.0 * F.avg(label), 2).alias("rate_pct")
    )


def rate_cube(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Label rate for all combinations and all margins; ``level`` tells them apart."""
    return df.cube(*columns).agg(
        F.grouping_id().cast("int").alias("level"), F.count("*").alias("n"),
        F.round(100.0 * F.avg(label), 2).alias("rate_pct"),
    )


def rate_pivot(
    df: DataFrame, row: str, column: str, values: Sequence[str], label: str = "label"
) -> DataFrame:
    """Label rate as a row x column table for the listed column values."""
    return df.groupBy(row).pivot(column, list(values)).agg(
        F.round(100.0 * F.avg(label), 2)
    )


def encounters_per_patient(df: DataFrame, patient: str = PATIENT_ID) -> DataFrame:
    """Patients, repeat patients, and the spread of encounters per patient."""
    # Encounter counts repeat: (count, patients) is a small table, and the
    # statistics below are exact on it. Rows without a patient are left out.
    per_patient = df.where(F.col(patient).isNotNull()).groupBy(patient).agg(F.count("*").alias("n"))
    sizes = per_patient.groupBy("n").agg(F.count("*").alias("patients"))
    weighted = F.sum(F.col("n") * F.col("patients"))
    many = F.col("n") > 1
    return sizes.agg(
        F.sum("patients").alias("n_patients"),
        weighted.alias("n_encounters"),
        F.coalesce(F.sum(F.when(many, F.col("patients"))), F.lit(0)).alias("n_repeat_patients"),
        F.max("n").alias("max_encounters"), F.min("n").alias("min_encounters"),
        (weighted / F.sum("patients")).alias("mean_encounters"),
        F.expr("percentile(n, 0.25, patients)").alias("q1_encounters"),
        F.expr("percentile(n, 0.5, patients)").alias("median_encounters"),
        F.expr("percentile(n, 0.75, patients)").alias("q3_encounters"),
        F.round(
            100.0 * F.coalesce(F.sum(F.when(many, F.col("n") * F.col("patients"))), F.lit(0))
            / weighted, 2,
        ).alias("pct_rows_repeat"),
    )


def repeat_rows(df: DataFrame, patient: str = PATIENT_ID) -> DataFrame:
    """All rows of patients that have more than one."""
    repeat = df.groupBy(patient).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return df.join(repeat.select(patient), patient, "left_semi")


def cardinality(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True
) -> DataFrame:
    """Distinct values per column (NULL ignored), and whether it is constant.

    The exact count unpivots to (column, value) and deduplicates map-side; the
    approximate one is a single pass of sketches.
    """
    columns = list(columns or df.columns)
    if exact:
        pairs = F.array(*[
            F.struct(F.lit(c).alias("column_name"), quoted(c).cast("string").alias("value"))
            for c in columns
        ])
        # (name, value) pairs first, so one wide column cannot fill one task
        distinct = df.select(F.inline(pairs)).distinct()
        counted = distinct.groupBy("column_name").agg(F.count("value").alias("n_distinct"))
    else:
        entries = F.array(*[
            F.struct(
                F.lit(c).alias("column_name"),
                F.approx_count_distinct(quoted(c)).alias("n_distinct"),
            ) for c in columns
        ])
        counted = df.agg(entries.alias("entries")).select(F.inline("entries"))
    return counted.withColumn("is_constant", F.when(F.col("n_distinct") == 1, 1).otherwise(0))


def label_correlation(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Pearson correlation of each column with the label, in one pass."""
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.corr(quoted(c).cast("double"), F.col(label).cast("double")).alias("corr"),
        ) for c in columns
    ])
    return df.agg(entries.alias("entries")).select(F.inline("entries"))


def describe_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, min and max of numeric columns, in one pass."""
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.count(quoted(c)).alias("n"),
            F.avg(quoted(c)).alias("mean"), F.stddev_samp(quoted(c)).alias("std"),
            F.min(quoted(c)).cast("double").alias("low"),
            F.max(quoted(c)).cast("double").alias("high"),
        ) for c in columns
    ])
    return df.agg(entries.alias("entries")).select(F.inline("entries"))


# Parts of a packed key: ids take 64 bits and one value for NULL, times 59 bits.
_ID_OFFSET, _TIME_OFFSET, _ID_SPAN = (1 << 63) + 1, (1 << 58) + 1, 1 << 65
_WIDE = T.DecimalType(38, 0)


def _wide(value: int | Column) -> Column:
    return (F.lit(str(value)) if isinstance(value, int) else value).cast(_WIDE)


def packed_order(df: DataFrame, order: Sequence[str]) -> Column | None:
    """(id) or (time, id) as one whole number that sorts alike; None for other types.

    A number is a fixed-size aggregation buffer, so its minimum is a hash aggregate
    where that of a struct needs sorted rows. NULL comes first, as in Spark's sort.
    """
    kinds = [df.schema[c].dataType for c in order]
    if not order or len(order) > 2 or not isinstance(kinds[-1], T.IntegralType):
        return None
    key = F.coalesce(_wide(quoted(order[-1])) + _wide(_ID_OFFSET), _wide(0))
    if len(order) == 2:
        if not isinstance(kinds[0], (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return None
        time = _wide(F.unix_micros(quoted(order[0]).cast("timestamp"))) + _wide(_TIME_OFFSET)
        key = key + F.coalesce(time, _wide(0)) * _wide(_ID_SPAN)
    return key


def edge_encounters(
    df: DataFrame, which: str = "first", patient: str = PATIENT_ID,
    order: Sequence[str] = ("encounter_id",),
) -> DataFrame:
    """The first or last encounter of every patient.

    An aggregate instead of a row number: map tasks send one packed key per patient,
    so a patient with very many encounters is no hot task, and the rows are joined back
    by that key. ``order`` must tell a patient's rows apart: rows that share the chosen
    key all stay. With other types than times and whole numbers, whole rows are
    aggregated. Rows without a patient are a patient each.
    """
    key = packed_order(df, order)
    if key is None:
        pick = {"first": F.min_by, "last": F.max_by}[which]
        whole = F.struct(*[quoted(c) for c in df.columns])
        known = df.where(F.col(patient).isNotNull())
        chosen = known.groupBy(patient).agg(pick(whole, F.struct(*order)).alias("row"))
        return chosen.select("row.*").unionByName(df.where(F.col(patient).isNull()))
    pick = {"first": F.min, "last": F.max}[which]
    keyed = df.withColumn("__key", key)
    chosen = (
        keyed.where(F.col(patient).isNotNull()).groupBy(F.col(patient).alias("__of"))
        .agg(pick("__key").alias("__edge"))
    )
    alone = F.col(patient).isNull()
    match = (F.col(patient) == F.col("__of")) & (F.col("__key") == F.col("__edge"))
    # One pass over the rows: those without a patient meet nobody and stay.
    joined = keyed.join(chosen, match, "left")
    return joined.where(alone | F.col("__edge").isNotNull()).select(*map(quoted, df.columns))


def first_versus_later(
    df: DataFrame, label: str = "label", patient: str = PATIENT_ID,
    order: Sequence[str] = ("encounter_id",),
) -> DataFrame:
    """Rows, positives and rate of first encounters and of later ones."""
    # Rows without a patient are a patient each, told apart by the order.
    alone = F.when(F.col(patient).isNull(), F.struct(*order)).alias("alone")
    outcome, key = F.col(label).cast("long"), packed_order(df, order)
    if key is None:
        first = F.min_by(outcome, F.struct(*order))
    else:
        # The label rides on the key's last digit: 0 for NULL, else the label and 1.
        digit = F.coalesce(_wide(outcome + 1), _wide(0))
        packed = F.min(key * _wide(4) + digit)
        digit = F.pmod(packed, _wide(4)).cast("long")
        first = F.when(digit > 0, digit - 1)
    per_patient = df.groupBy(patient, alone).agg(
        F.count("*").alias("n"), F.sum(outcome).alias("p"), first.alias("p1"),
    )
    parts = F.array(
        F.struct(F.lit("first").alias("visit"), F.lit(1).cast("long").alias("n"),
                 F.col("p1").alias("p")),
        F.struct(F.lit("later").alias("visit"), (F.col("n") - 1).alias("n"),
                 (F.col("p") - F.col("p1")).alias("p")),
    )
    return per_patient.select(F.inline(parts)).groupBy("visit").agg(
        F.sum("n").alias("n_rows"), F.sum("p").alias("n_pos"),
        F.round(100.0 * F.sum("p") / F.sum("n"), 2).alias("rate_pct"),
    )


def derive_readmission(
    visits: DataFrame, patient: str = PATIENT_ID, date: str = "admitted",
    encounter: str = "encounter_id", into: str = "readmitted", days: int = 30,
) -> DataFrame:
    """``<30`` / ``>30`` / ``NO`` from the days to the patient's next encounter.

    Encounters of one day are ordered by time and id. The next-day lookup runs
    on one row per patient and day (made by map-side aggregation), so its
    window is bounded by the calendar however many rows a patient has; the
    join back to the rows is an equi-join that AQE can split.
    """
    dated = visits.withColumn("__day", F.to_date(date))
    key = packed_order(visits, (date, encounter))
    if key is None:
        last = F.max(F.struct(F.col(date), F.col(encounter))).getField(encounter)
    else:
        # The id is the lower part of the day's greatest key.
        last = (F.pmod(F.max(key), _wide(_ID_SPAN)) - _wide(_ID_OFFSET)).cast(
            visits.schema[encounter].dataType)
    # A NULL patient has no known next stay and meets nobody in the join below.
    per_day = dated.where(F.col(patient).isNotNull()).groupBy(patient, "__day").agg(
        last.alias("__last_id"))
    following = F.lead("__day").over(W.partitionBy(patient).orderBy("__day"))
    per_day = per_day.select(
        patient, "__day", "__last_id", F.datediff(following, F.col("__day")).alias("__gap"),
    )
    joined = dated.join(per_day, [patient, "__day"], "left")
    gap = F.when(F.col(encounter) != F.col("__last_id"), F.lit(0)).otherwise(F.col("__gap"))
    value = F.when(gap.isNull(), "NO").when(gap < days, f"<{days}").otherwise(f">{days}")
    return joined.withColumn(into, value).drop("__day", "__last_id", "__gap")
