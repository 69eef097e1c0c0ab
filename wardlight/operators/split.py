"""Patient-disjoint splits, stratified group folds, leakage checks, sampling."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.config import PATIENT_ID
from wardlight.operators.prefix import BUCKET, hash_range, running_totals
from wardlight.session import lookup_join


def seeded_hash(column: str | Column, seed: int = 42) -> Column:
    """md5 of ``seed:value`` in hex; the same in any engine, run and cluster."""
    value = F.col(column) if isinstance(column, str) else column
    return F.md5(F.concat(F.lit(f"{seed}:"), value.cast("string")))


def _below(digest: Column, share: float) -> Column:
    """True for ``share`` of all digests (first 32 bits under the cut)."""
    if share >= 1.0:
        return F.lit(True)
    return F.substring(digest, 1, 8) < F.lit(f"{int(share * 2**32):08x}")


def group_split(
    df: DataFrame, group: str = PATIENT_ID, test_size: float = 0.2, seed: int = 42,
    into: str = "split",
) -> DataFrame:
    """Tag rows ``train`` or ``test`` by a hash of their group.

    The share is one of groups. A pure function of the key: no shuffle, no
    join, and new rows of a known patient land on the same side.
    """
    digest = seeded_hash(group, seed)
    return df.withColumn(into, F.when(_below(digest, test_size), "test").otherwise("train"))


def exact_group_split(
    df: DataFrame, group: str = PATIENT_ID, test_size: float = 0.2, seed: int = 42,
    into: str = "split",
) -> DataFrame:
    """Tag rows so that exactly ``ceil(test_size * groups)`` groups are in test.

    The groups with the smallest hashes are taken; rows without a group are in train and
    count as none. A histogram of hash
    prefixes (at most 65,536 rows) finds the prefix the cut falls in, and only
    the groups of that prefix are ranked.
    """
    # partial distinct first: a group that holds a third of the rows is one row
    known = (
        df.select(group).where(F.col(group).isNotNull()).distinct()
        .withColumn("__hash", seeded_hash(group, seed))
    )
    prefix = F.substring("__hash", 1, 4)
    histogram = (
        known.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n"))
        .orderBy("prefix").collect()
    )
    wanted = ceil(test_size * sum(r["n"] for r in histogram) - 1e-9)
    taken, cut = 0, ""
    for row in histogram:
        cut = row["prefix"]
        if taken + row["n"] >= wanted:
            break
        taken += row["n"]
    at_cut = (
        known.where(prefix == cut).orderBy("__hash", group).limit(wanted - taken)
        .agg(F.max(F.struct("__hash", F.col(group).alias("g"))).alias("last")).first()["last"]
    )
    if at_cut is None:
        return df.withColumn(into, F.lit("train"))
    digest = seeded_hash(group, seed)
    inside = (digest < at_cut["__hash"]) | (
        (digest == at_cut["__hash"]) & (F.col(group) <= F.lit(at_cut["g"]))
    )
    return df.withColumn(into, F.when(inside, "test").otherwise("train"))


def group_folds(
    df: DataFrame, folds: int = 5, label: str = "label", group: str = "group", seed: int = 42
) -> DataFrame:
    """One row per group with its fold, stratified by (rows, positives).

    Groups of a stratum are dealt round in hash order. Ranks come from running
    totals over hash ranges, so the giant stratum (one row, no positive) is
    spread over many tasks.
    """
    per_group = df.groupBy(group).agg(
        F.count("*").alias("n_rows"), F.sum(F.col(label).cast("long")).alias("n_pos")
    )
    hashed = per_group.withColumn("__hash", seeded_hash(group, seed)).withColumns({
        BUCKET: hash_range(F.col("__hash")), "__one": F.lit(1),
    })
    placed = running_totals(
        hashed, ["__hash", group], {"__place": "__one"}, ["n_rows", "n_pos"]
    )
    # Strata start at different folds, so that strata of one group spread too.
    start = F.col("n_rows") + F.col("n_pos")
    fold = F.pmod(F.col("__place") + start, F.lit(folds)).cast("int")
    return placed.select(group, "n_rows", "n_pos", fold.alias("fold"))


def assign_folds(
    df: DataFrame, folds: int = 5, label: str = "label", group: str = "group",
    seed: int = 42, mode: str = "stratified", into: str = "fold",
) -> DataFrame:
    """Tag every row with the fold of its group.

    ``stratified`` balances positives and joins the per-group result back;
    ``hash`` is a pure function of the key and needs no shuffle.
    """
    if mode == "hash":
        number = F.conv(F.substring(seeded_hash(group, seed), 1, 8), 16, 10).cast("long")
        return df.withColumn(
            into, F.pmod(F.coalesce(number, F.lit(0)), F.lit(folds)).cast("int")
        )
    if mode != "stratified":
        raise ValueError(f"mode: {mode!r}")
    found = group_folds(df, folds, label, group, seed)
    return lookup_join(df, found.select(group, F.col("fold").alias(into)), [group])


def leaking_groups(
    df: DataFrame, group: str = PATIENT_ID, side: str = "split"
) -> DataFrame:
    """Groups that occur on more than one side, with their number of sides.

    Rows without a group are no group.
    """
    return (
        df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(side).alias("n_sides"))
        .where(F.col("n_sides") > 1)
    )


def shared_groups(left: DataFrame, right: DataFrame, group: str = PATIENT_ID) -> DataFrame:
    """Groups present in both tables (set intersection), NULL left out.

    Each side is made distinct first, which map tasks do before the shuffle.
    """
    known = lambda df: df.select(group).where(F.col(group).isNotNull()).distinct()
    return known(left).intersect(known(right))


def assert_no_group_leakage(
    train: DataFrame, test: DataFrame, group: str = PATIENT_ID
) -> None:
    found = shared_groups(train, test, group).count()
    if found:
        raise AssertionError(f"group leakage: {found} groups on both sides")


def split_summary(
    df: DataFrame, label: str = "label", group: str = "group", side: str = "split"
) -> DataFrame:
    """Rows, groups and positive rate per side."""
    per_group = df.groupBy(side, group).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("p")
    )
    return per_group.groupBy(side).agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_groups"),
        F.sum("p").alias("n_pos"), (F.sum("p") / F.sum("n")).alias("positive_rate"),
    )


def undersample(
    df: DataFrame, fractions: dict[int, float], label: str = "label",
    key: str = "encounter_id", seed: int = 42,
) -> DataFrame:
    """Keep the given share of every class, chosen by a hash of the row key.

    Classes that are not listed are kept whole.
    """
    digest = seeded_hash(key, seed)
    keep = F.lit(True)
    for value, share in fractions.items():
        keep = F.when(F.col(label) == value, _below(digest, share)).otherwise(keep)
    return df.where(keep)


def hash_sample(df: DataFrame, n: int = 200, key: str = "encounter_id", seed: int = 0) -> DataFrame:
    """The n rows with the smallest key hash: random-like and repeatable."""
    return (
        df.withColumn("__hash", seeded_hash(key, seed)).orderBy("__hash", key).limit(n)
        .drop("__hash")
    )
