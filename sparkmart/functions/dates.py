"""Date expressions: spines and month arithmetic (CAL-1/2/3, FN-9..13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.functions.util import as_col


def to_date_col(c, fmt: str | None = None) -> Column:
    """Text or timestamp to date; bad text gives null instead of an ANSI error (FN-9)."""
    col = as_col(c)
    if fmt is None:
        return F.try_to_date(col.cast("string"))
    return F.try_to_date(col.cast("string"), fmt)


def first_of_month(c) -> Column:
    return F.trunc(as_col(c).cast("date"), "MM")


def month_spine_expr(start, end, inclusive: bool = True) -> Column:
    """Array of first-of-month dates from ``trunc(start)`` to ``end`` (CAL-1, CAL-3).

    ``inclusive=False`` is the half-open walk: months strictly before ``end``.
    """
    s = first_of_month(start)
    e = as_col(end).cast("date")
    if not inclusive:
        e = F.date_sub(e, 1)
    return F.when(s <= e, F.sequence(s, e, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>"))


def day_spine_expr(start, end) -> Column:
    """Array of every date in ``[start, end]`` (CAL-2)."""
    s, e = as_col(start).cast("date"), as_col(end).cast("date")
    return F.when(s <= e, F.sequence(s, e, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>"))
