"""Filters (FLT-1..9).

Date predicates are written against the *stored* column (``col >= a AND col < b``) rather than
against a derived month, so Parquet row-group statistics and partition pruning apply.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.util import as_col


def _d(v) -> Column:
    return F.lit(v).cast("date")


def in_month(c, month) -> Column:
    """FLT-1 for a monthly snapshot: ``[month, month + 1)`` on the raw date/timestamp column."""
    col = as_col(c)
    start = F.trunc(_d(month), "MM")
    return (col >= _stamp(start)) & (col < _stamp(F.add_months(start, 1)))


def in_month_range(c, start, end) -> Column:
    """FLT-2 for months ``start .. end``, both included, on the raw timestamp column."""
    col = as_col(c)
    return (col >= _stamp(F.trunc(_d(start), "MM"))) & (col < _stamp(F.add_months(F.trunc(_d(end), "MM"), 1)))


def in_month_half_open(c, start, end) -> Column:
    """FLT-3 for months from ``start`` to before ``end`` (first days of months), on the raw timestamp column."""
    col = as_col(c)
    return (col >= _stamp(_d(start))) & (col < _stamp(_d(end)))


def in_months(c, months: Iterable) -> Column:
    """FLT-5 for a list of months, on the raw timestamp column."""
    out = F.lit(False)
    for m in months:
        out = out | in_month(c, m)
    return out


def _stamp(date: Column) -> Column:
    # comparing a timestamp_ntz column with a date literal casts the column; casting the literal
    # keeps the predicate on the bare column, which is what the Parquet reader can push down
    return date.cast("timestamp_ntz")


def snapshot_eq(df: DataFrame, col: str, date) -> DataFrame:
    """FLT-1: rows of one snapshot date."""
    return df.where(F.col(col) == _d(date))


def closed_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """FLT-2: ``start <= col <= end``."""
    return df.where(F.col(col).between(_d(start), _d(end)))


def half_open_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """FLT-3: ``start <= col < end``."""
    return df.where((F.col(col) >= _d(start)) & (F.col(col) < _d(end)))


def in_dates(df: DataFrame, col: str, dates: Iterable) -> DataFrame:
    """FLT-5: ``col IN (...)``."""
    return df.where(F.col(col).isin([_d(d) for d in dates]))


def plausible(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """FLT-6: ``lo <= col <= hi``; null fails the test and is dropped."""
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """FLT-8."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def range_with_fallback(df: DataFrame, col: str, start, end) -> DataFrame:
    """FLT-4: the part of ``[start, end)`` that the store covers; raise if there is none.

    A range that runs past the store's first or last day is met by the days it shares with the store;
    an empty range shares none, so nothing is left to fall back on and the error names the coverage.
    ``isEmpty`` is a limit-1 job; the bounds are read for the message only.
    """
    picked = half_open_range(df, col, start, end)
    if picked.isEmpty():
        b = df.agg(F.min(F.col(col).cast("date")).alias("lo"), F.max(F.col(col).cast("date")).alias("hi")).first()
        held = "the store is empty" if b["lo"] is None else f"the store covers [{b['lo']}, {b['hi']}]"
        raise ValueError(f"no data in [{start}, {end}): {held}")
    return picked
