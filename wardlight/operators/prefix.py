"""Running totals over a global order, without a one-task window.

A window with no (or one hot) partition key pulls all its rows into one task.
Here the order is cut into ranges by an order-preserving bucket column, each
range gets its own in-range window, and the small table of range totals gives
the offset of every range. The bucket is a pure function of the row, so a lost
executor can recompute its part and land on the same ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Rows one in-range window should hold.
ROWS_PER_RANGE = 1_000_000
# The most ranges an order is cut into.
MAX_RANGES = 65_536
BUCKET = "__bucket"


def add_ranges(
    df: DataFrame, column: str, rows_per_range: int = ROWS_PER_RANGE,
    max_ranges: int = MAX_RANGES,
) -> DataFrame:
    """Add the range number of a numeric column as ``__bucket``.

    A count tells how many ranges are wanted, and one sketch pass finds their
    bounds; rows with equal values share a range. A table that fits one range
    gets no such column, and ``running_totals`` then uses a plain window. The
    input is read more than once: store it first if it is costly to make.
    """
    rows = df.select(F.count(column)).first()[0]
    wanted = min(max_ranges, -(-rows // rows_per_range))
    if wanted <= 1:
        return df
    shares = ", ".join(f"{i / wanted!r}D" for i in range(1, wanted))
    sketch = F.expr(
        f"percentile_approx(`{column}`, array({shares}), {max(10_000, 10 * wanted)})"
    )
    found = df.select(sketch).first()[0]
    cuts = sorted({float(c) for c in found if isfinite(c)})
    bucketizer = Bucketizer(
        splits=[-float("inf"), *cuts, float("inf")], inputCol="__value", outputCol=BUCKET,
        handleInvalid="keep",
    )
    return (
        bucketizer.transform(df.withColumn("__value", F.col(column).cast("double")))
        .drop("__value").withColumn(BUCKET, F.col(BUCKET).cast("int"))
    )


def hash_range(hexadecimal: Column, digits: int = 4) -> Column:
    """Range number of a hash given in hex: its leading digits (16^digits ranges)."""
    return F.conv(F.substring(hexadecimal, 1, digits), 16, 10).cast("int").alias(BUCKET)


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    values: Mapping[str, str],
    groups: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add inclusive running totals ``{new: value}`` and group totals ``{new: value}``.

    ``order`` must be unique within a group. If the table has a ``__bucket``
    column it must grow with the order; it is dropped from the result.
    """
    totals = dict(totals or {})
    flip = F.desc if descending else F.asc
    ordered = [flip(c) for c in order]
    if BUCKET not in df.columns:
        upto = W.partitionBy(*groups).orderBy(*ordered).rowsBetween(W.unboundedPreceding, 0)
        whole = W.partitionBy(*groups)
        return df.withColumns(
            {k: F.sum(v).over(upto) for k, v in values.items()}
            | {k: F.sum(v).over(whole) for k, v in totals.items()}
        )

    needed = sorted({*values.values(), *totals.values()})
    per_range = df.groupBy(*groups, BUCKET).agg(
        *[F.sum(v).alias(f"__sum_{v}") for v in needed]
    )
    # One row per range reaches these windows: at most MAX_RANGES per group.
    whole = W.partitionBy(*groups)
    before = whole.orderBy(flip(BUCKET)).rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(
        *groups, BUCKET,
        *[F.coalesce(F.sum(f"__sum_{v}").over(before), F.lit(0)).alias(f"__off_{k}")
          for k, v in values.items()],
        *[F.sum(f"__sum_{v}").over(whole).alias(k) for k, v in totals.items()],
    )
    if not groups:
        offsets = F.broadcast(offsets)
    upto = (
        W.partitionBy(*groups, BUCKET).orderBy(*ordered).rowsBetween(W.unboundedPreceding, 0)
    )
    inside = df.withColumns({f"__in_{k}": F.sum(v).over(upto) for k, v in values.items()})
    same = [inside[g].eqNullSafe(offsets[g]) for g in (*groups, BUCKET)]
    return inside.join(offsets, same, "inner").select(
        *[inside[c] for c in df.columns if c != BUCKET],
        *[(F.col(f"__in_{k}") + F.col(f"__off_{k}")).alias(k) for k in values],
        *totals,
    )
