"""Text cleanup expressions used by the silver layers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.functions.util import as_col


#: A lone number written with an exponent, between other characters.
_EXPONENT = r"^[^0-9.]*([0-9]*\.?[0-9]+[eE][+-]?[0-9]+)[^0-9]*$"


def _power(text: Column) -> Column:
    """The number with an exponent in a text, empty or null if none; only texts with an ``e`` are searched."""
    return F.when(F.contains(text, F.lit("e")) | F.contains(text, F.lit("E")), F.regexp_extract(text, _EXPONENT, 1))


def strip_to_digits(c, to: str = "int") -> Column:
    """Keep only ``0-9`` and cast with ``try_cast`` (CLN-2).

    The minus sign counts as noise, as in the reference (``"-25"`` -> 25).  Casting happens on
    the cleaned text, so ``"23_"`` gives 23 instead of null.  A decimal part is dropped first
    (``"4.0"`` -> 4, not 40), and a number written with an exponent is its value without the fraction
    (``"2.5e3"`` -> 2500).
    """
    text = as_col(c).cast("string")
    power = _power(text)
    whole = F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.[0-9]*(?=[^0-9.]*$)", "")).otherwise(text)
    digits = F.regexp_replace(whole, r"[^0-9]", "")
    # no cast of empty text: each one costs an exception inside
    return F.when(power != "", power.try_cast("double").try_cast(to)).when(digits != "", digits.try_cast(to))


def strip_to_decimal(c, to: str = "double") -> Column:
    """Keep only digits and dots, then ``try_cast`` (CLN-3): ``"34847.84_"`` -> 34847.84.

    A number written with an exponent (``"1.25E7"``, as doubles of 1e7 and more are) keeps it.
    """
    text = as_col(c).cast("string")
    power, plain = _power(text), F.regexp_replace(text, r"[^0-9.]", "")
    # no cast of empty text: each one costs an exception inside
    return F.coalesce(F.when(power != "", power.try_cast(to)), F.when(plain != "", plain.try_cast(to)))


def null_if_in(c, sentinels: Iterable) -> Column:
    """Sentinel values become null (CLN-1); everything else passes through."""
    col = as_col(c)
    return F.when(col.isin(list(sentinels)), F.lit(None)).otherwise(col)


def normalise_text(c, missing: str = "MISSING") -> Column:
    """``upper(trim(coalesce(c, missing)))`` (CLN-10)."""
    return F.upper(F.trim(F.coalesce(as_col(c).cast("string"), F.lit(missing))))


def slug(value: str) -> str:
    """Column-name suffix for a category value: trim, space and '-' to '_', lower case."""
    return str(value).strip().replace(" ", "_").replace("-", "_").lower()
