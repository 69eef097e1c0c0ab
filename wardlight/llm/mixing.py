"""Mixing sources to target weights by capped water-filling.

Sources share a word budget by weight; none may take more than ``max_epochs``
times its own words, and what it cannot take is shared again among the others.
Each document is then taken whole times plus, for the fractional rest, once more
if it lies before the cut in a seeded order of its source.

Defined cases: a NULL or empty text has size 0; the NULL source is a source like
others; equal rows share their place in the order, and which of them is taken
does not show; a source without words has target 0. Only the named columns are
read.
A text of any length is counted in its row; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm.common import quoted, stored, words

MAX_EPOCHS = 2
BUDGET_SHARE = 1.5
SEED = "mix-1"
# The seeded order is cut into 16^3 ranges per source; only the one range that
# holds the cut is ordered row by row.
RANGE_DIGITS = 3


def place(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A row's place in the seeded order, as 32 hexadecimal digits."""
    return F.md5(F.concat(
        F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
        F.md5(F.coalesce(text, F.lit(""))),
    ))


def cyclic_weights(totals: DataFrame, cycle: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """Weights that repeat over the sources in code-point order, NULL last.

    ``totals`` has one row per source, so the one window sees no more than that.
    """
    rank = F.row_number().over(W.orderBy(F.asc_nulls_last("source")))
    listed = F.array(*[F.lit(w) for w in cycle])
    return totals.withColumn("weight", F.get(listed, (rank - 1) % len(cycle)).cast("long"))


def water_fill(
    weighted: DataFrame, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Add ``target`` to one row per source with ``source_size`` and ``weight``.

    Each round clamps the sources whose share exceeds their cap and shares what is
    left among the rest; rounds end when no further source is clamped. Only the
    three sums of a round reach the driver.
    """
    cap = F.col("source_size") * max_epochs
    level, clamped = 0.0, -1
    while True:
        full = (cap <= F.lit(level) * F.col("weight")) if clamped >= 0 else F.lit(False)
        sums = weighted.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("spent"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weight"),
            F.count(F.when(full, 1)).alias("clamped"),
        ).first()
        if sums["clamped"] == clamped or sums["weight"] == 0:
            break
        clamped = sums["clamped"]
        level = (sums["size"] * budget_share - sums["spent"]) / sums["weight"]
    share = F.lit(level) * F.col("weight")
    if sums["weight"] == 0:
        share = cap.cast("double")
    return weighted.withColumn("target", F.least(cap.cast("double"), share))


def mix(
    docs: DataFrame,
    weights=cyclic_weights,
    budget_share: float = BUDGET_SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The carried columns as ``row``, and size, source_size, target, copies and taken.

    ``weights`` maps a table of (source, source_size) to one with ``weight``. The
    fractional rest of a source takes the documents whose middle word lies before
    the cut, so a source misses its target by half a document at most.
    """
    sized = stored(
        docs.select(
            F.struct(*map(quoted, carry)).alias("row"), "source",
            F.size(words(F.col("text"))).cast("long").alias("size"),
            place(F.col("doc_id"), F.col("text"), seed).alias("place"),
        ).withColumn("range", F.substring("place", 1, RANGE_DIGITS)),
        "mix-sizes",
    )
    ranges = stored(
        sized.groupBy("source", "range").agg(F.sum("size").alias("range_size")), "mix-ranges"
    )
    totals = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    targets = stored(water_fill(stored(weights(totals), "mix-weights"), budget_share, max_epochs),
                     "mix-targets")
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    targets = targets.withColumn("whole", whole).withColumn(
        "cut", F.col("target") - F.col("whole") * F.col("source_size")
    )
    # The range in which each source's cut falls, and the words before it.
    upto = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, 0)
    cuts = (
        ranges.withColumn("after", F.sum("range_size").over(upto))
        .withColumnRenamed("source", "in_source")
        .join(targets, F.col("in_source").eqNullSafe(F.col("source")))
        .groupBy("source").agg(
            F.first("source_size").alias("source_size"), F.first("target").alias("target"),
            F.first("whole").alias("whole"), F.first("cut").alias("cut"),
            F.min(F.when(F.col("after") > F.col("cut"),
                         F.struct("range", (F.col("after") - F.col("range_size")).alias("before"))))
            .alias("edge"),
        )
        .withColumnRenamed("source", "in_source")
    )
    placed = sized.join(stored(cuts, "mix-cuts"), F.col("source").eqNullSafe(F.col("in_source")))
    at_edge = F.coalesce(F.col("range") == F.col("edge.range"), F.lit(False))
    inside = F.coalesce(F.col("range") < F.col("edge.range"), F.lit(True))
    running = F.sum("size").over(
        W.partitionBy("source").orderBy("place", "size").rowsBetween(W.unboundedPreceding, 0)
    )
    middle = F.col("edge.before") + running - F.col("size") / 2
    picked = placed.where(~at_edge).withColumn("once_more", inside).unionByName(
        placed.where(at_edge).withColumn("once_more", middle <= F.col("cut"))
    )
    copies = F.col("whole") + F.col("once_more").cast("long")
    return picked.select("row", "size", "source_size", "target", copies.alias("copies"),
                         (F.col("size") * copies).alias("taken"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows: the columns of ``docs``, each row as often as it is taken."""
    mixed = mix(docs, carry=tuple(docs.columns), **options)
    return (
        mixed.where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
        .select("row.*")
    )
