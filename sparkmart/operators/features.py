"""Derived features (FEA-1..10), all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.util import as_col


def days_past_due(df: DataFrame, installment_col: str = "installment_num", due_col: str = "due_amt",
                  overdue_col: str = "overdue_amt", snapshot_col: str = "snapshot_date") -> DataFrame:
    """FEA-1..4 on a loan-book frame.

    * ``mob`` = installment number;
    * ``installments_missed`` = ``ceil(overdue / due)``, 0 when the ratio is undefined;
    * ``first_missed_date`` = snapshot minus that many months (month-end clamped), if > 0;
    * ``dpd`` = days from first missed date to snapshot when something is overdue, else 0.
      It stays null when overdue > 0 but no installment counts as missed (due 0 or null, D7).
    """
    missed = F.coalesce(F.ceil(F.try_divide(F.col(overdue_col), F.col(due_col))).try_cast("int"), F.lit(0))
    first_missed = F.when(missed > 0, F.add_months(F.col(snapshot_col), -missed))
    return (df.withColumns({"mob": F.col(installment_col).cast("int"), "installments_missed": missed})
              .withColumn("first_missed_date", first_missed.cast("date"))
              .withColumn("dpd", F.when(F.col(overdue_col) > 0,
                                        F.datediff(F.col(snapshot_col), F.col("first_missed_date")))
                                  .otherwise(0).cast("int")))


def history_months(text) -> Column:
    """FEA-5: ``"22 Years and 1 Months"`` -> 265; missing parts count as 0."""
    t = as_col(text)
    years = F.regexp_extract(t, r"(\d+)\s+Years?", 1).try_cast("int")
    months = F.regexp_extract(t, r"(\d+)\s+Months?", 1).try_cast("int")
    return (F.coalesce(years, F.lit(0)) * 12 + F.coalesce(months, F.lit(0))).cast("int")


def guarded_ratio(num, den, guard: float | None = 1.0) -> Column:
    """FEA-6: ``num / (den + guard)``; with ``guard=None`` a zero divisor gives null."""
    d = as_col(den)
    if guard is not None:
        d = d + F.lit(guard)
    return F.try_divide(as_col(num).cast("double"), d.cast("double"))


def months_since(start, snapshot) -> Column:
    """FEA-7 fractional form: ``months_between(snapshot, start)``, null -> 999."""
    return F.coalesce(F.months_between(as_col(snapshot), as_col(start)), F.lit(999.0))


def whole_months_since(start, snapshot) -> Column:
    """FEA-7 month-truncated form: whole calendar months between the two months' firsts; null stays null."""
    s = F.trunc(as_col(start).cast("date"), "MM")
    e = F.trunc(as_col(snapshot).cast("date"), "MM")
    return F.months_between(e, s).cast("int")


def valid_flag(c) -> Column:
    """FEA-8: 1 when the value is present (and not NaN), else 0."""
    col = as_col(c)
    return F.when(col.isNotNull() & ~F.isnan(col.cast("double")), 1).otherwise(0)


def term_number(text) -> Column:
    """FEA-9: first run of digits, e.g. ``" 36 months"`` -> 36."""
    return F.regexp_extract(as_col(text), r"(\d+)", 1).try_cast("int")


def tenure_years(text) -> Column:
    """FEA-10: employment length text -> int without a Python UDF.

    ``10+ years`` -> 10, ``< 1 year`` -> 0, ``missing`` -> -1, other text containing
    ``year`` -> its leading integer (or -1 if it has none), anything else -> -1, null -> null.
    """
    v = F.lower(F.trim(as_col(text)))
    lead = F.regexp_extract(v, r"^(\S+)", 1)
    lead_int = F.when(lead.rlike(r"^[+-]?[0-9]+$"), lead.try_cast("int"))
    return (F.when(v.isNull(), F.lit(None).cast("int"))
             .when(v == "10+ years", 10)
             .when(v == "< 1 year", 0)
             .when(v == "missing", -1)
             .when(v.contains("year"), F.coalesce(lead_int, F.lit(-1)))
             .otherwise(-1))
