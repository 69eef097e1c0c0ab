"""Row-wise clinical expressions (all built-in, all inside codegen)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column by literal name, also for names that hold a dash or dot."""
    return F.col(f"`{name}`")


def as_flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def equals_flag(column: Column, value: str) -> Column:
    return as_flag(column == value)


def medications_prescribed(names: Sequence[str], null_med: str = "prescribed") -> Column:
    """How many medications are not ``No``.

    ``null_med`` says whether an unknown (NULL) medication counts as
    ``prescribed`` (default) or ``not_prescribed``.
    """
    if null_med not in ("prescribed", "not_prescribed"):
        raise ValueError(f"null_med: {null_med!r}")
    unknown = F.lit(1 if null_med == "prescribed" else 0)
    return reduce(
        add,
        (F.when(quoted(n).isNull(), unknown).otherwise(as_flag(quoted(n) != "No"))
         for n in names),
    )


def medications_changed(names: Sequence[str]) -> Column:
    """How many medications were dosed up or down."""
    return reduce(add, (as_flag(quoted(n).isin("Up", "Down")) for n in names))


def medication_ordinal(column: Column) -> Column:
    """No 0, Steady 1, Up or Down 2; anything else NULL."""
    return F.when(column == "No", 0).when(column == "Steady", 1).when(
        column.isin("Up", "Down"), 2
    )


def prior_use(weights: dict[str, float]) -> Column:
    """Weighted count of earlier visits, NULL counts as none."""
    return reduce(
        add, (F.coalesce(quoted(c), F.lit(0)) * F.lit(w) for c, w in weights.items())
    ).cast("double")


def any_equals(columns: Sequence[Column], value: str) -> Column:
    return as_flag(reduce(or_, (c == value for c in columns)))


def lab_measured(column: Column) -> Column:
    """1 if a lab value is there; NULL and the text ``None`` mean not done."""
    return as_flag(column.isNotNull() & (column != "None"))


def predicted(score: Column, threshold: float | Column) -> Column:
    """Label at a cut: 1 where the score reaches the threshold."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(score.isNotNull() & ~F.isnan(score) & (score >= cut), 1).otherwise(0)
