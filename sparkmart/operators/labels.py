"""Label stores (LBL-1..3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def default_label(df: DataFrame, dpd: int = 30, mob: int = 6, id_cols=("loan_id", "Customer_ID"),
                  keep_start: bool = False, snapshot_col: str = "snapshot_date") -> DataFrame:
    """LBL-1: loans at month-on-book ``mob``; label 1 when ``dpd >= dpd`` (null dpd -> 0)."""
    cols = [*id_cols]
    if keep_start:
        cols.append("loan_start_date")
    return (df.where(F.col("mob") == mob)
              .select(*cols,
                      F.when(F.col("dpd") >= dpd, 1).otherwise(0).cast("int").alias("label"),
                      F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
                      F.col(snapshot_col)))


def grade_labels(df: DataFrame, id_col: str = "id", grade_col: str = "grade",
                 snapshot_col: str = "snapshot_date") -> DataFrame:
    """LBL-2: ``(id, snapshot_date, grade)`` rows with a grade."""
    return (df.select(F.col(id_col), F.to_date(F.col(snapshot_col)).alias(snapshot_col), F.col(grade_col))
              .where(F.col(grade_col).isNotNull()))


def bad_rate_curve(df: DataFrame, dpd: int = 30, cohort_col: str = "loan_start_date",
                   cohort_before=None) -> DataFrame:
    """LBL-3: share of loans at or beyond ``dpd`` days past due, per month on book.

    A plain grouped average: partial aggregation per mob before the (tiny) shuffle.
    """
    if cohort_before is not None:
        df = df.where(F.col(cohort_col) < F.lit(cohort_before).cast("date"))
    flag = F.when(F.col("dpd") >= dpd, 1.0).otherwise(0.0)
    return (df.groupBy("mob")
              .agg(F.avg(flag).alias("bad_rate"), F.count(F.lit(1)).alias("loans"))
              .orderBy("mob"))
