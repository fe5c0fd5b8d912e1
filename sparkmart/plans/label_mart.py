"""Label mart: loan-management CSV -> bronze -> silver (days past due) -> gold label store.

PIP-1 (bronze), PIP-2 (silver loans), PIP-7 (gold labels), PIP-13 (backfill), LBL-3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators.clean import fill_all_numeric
from sparkmart.operators.features import days_past_due
from sparkmart.operators.labels import bad_rate_curve, default_label
from sparkmart.operators.schema import enforce_schema
from sparkmart.sources.readers import read_csv, read_window
from sparkmart.sources.writers import write_snapshots

# raw columns of the loan-management extract, read as text where the source is dirty
LOAN_DAILY_RAW = T.StructType([
    T.StructField("loan_id", T.StringType()),
    T.StructField("Customer_ID", T.StringType()),
    T.StructField("loan_start_date", T.StringType()),
    T.StructField("tenure", T.StringType()),
    T.StructField("installment_num", T.StringType()),
    T.StructField("loan_amt", T.StringType()),
    T.StructField("due_amt", T.StringType()),
    T.StructField("paid_amt", T.StringType()),
    T.StructField("overdue_amt", T.StringType()),
    T.StructField("balance", T.StringType()),
    T.StructField("snapshot_date", T.StringType()),
])

LOAN_DAILY_TYPES = {
    "loan_id": "string", "Customer_ID": "string", "loan_start_date": "date", "tenure": "int",
    "installment_num": "int", "loan_amt": "double", "due_amt": "double", "paid_amt": "double",
    "overdue_amt": "double", "balance": "double", "snapshot_date": "date",
}


def _window(df: DataFrame, start, end, col: str = "snapshot_date") -> DataFrame:
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(end).cast("date"))
    return df


def bronze(spark: SparkSession, source_csv: str, bronze_root: str, start=None, end=None, fmt: str = "parquet") -> int:
    """PIP-1: land the snapshots of ``[start, end]`` partitioned by snapshot (raw text columns).

    ``fmt="csv"`` keeps the bronze layer as CSV (one folder per snapshot, written by the
    executors - never through the driver); Parquet is the default.
    """
    raw = read_csv(spark, source_csv, LOAN_DAILY_RAW)
    raw = raw.withColumn("snapshot_date", F.try_to_date("snapshot_date"))
    return write_snapshots(_window(raw, start, end), bronze_root, fmt=fmt)


def silver_frame(bronze_df: DataFrame, fill_numeric_zero: bool = True) -> DataFrame:
    """PIP-2: enforce types, fill missing numerics with 0 (CLN-6, D6), derive mob / missed / dpd.

    The zero fill runs before the derived columns; ``fill_numeric_zero=False`` leaves missing
    amounts null instead (then ``dpd`` is null wherever ``overdue_amt`` is).
    """
    typed = enforce_schema(bronze_df, LOAN_DAILY_TYPES, strict=True)
    if fill_numeric_zero:
        typed = fill_all_numeric(typed, 0)
    return days_past_due(typed)


def silver(spark: SparkSession, bronze_root: str, silver_root: str, start=None, end=None,
           fill_numeric_zero: bool = True) -> int:
    df = read_window(spark, bronze_root, start, end)
    return write_snapshots(silver_frame(df, fill_numeric_zero), silver_root)


def gold_labels(spark: SparkSession, silver_root: str, gold_root: str, start=None, end=None,
                dpd: int = 30, mob: int = 6) -> int:
    """PIP-7: label store ``loan_id, Customer_ID, label, label_def, snapshot_date``."""
    labels = default_label(read_window(spark, silver_root, start, end), dpd, mob)
    return write_snapshots(labels, gold_root)


def backfill(spark: SparkSession, source_csv: str, root: str, start, end, dpd: int = 30, mob: int = 6) -> dict:
    """PIP-13: all three layers for the months ``[trunc(start), end]``; returns the layer paths."""
    start = _first_of_month(start)  # the month list starts at the 1st of the start month (CAL-1)
    paths = {k: f"{root.rstrip('/')}/{k}" for k in ("bronze_loan_daily", "silver_loan_daily", "gold_label_store")}
    rows = {"bronze_loan_daily": bronze(spark, source_csv, paths["bronze_loan_daily"], start, end)}
    rows["silver_loan_daily"] = silver(spark, paths["bronze_loan_daily"], paths["silver_loan_daily"], start, end)
    rows["gold_label_store"] = gold_labels(spark, paths["silver_loan_daily"], paths["gold_label_store"], start, end,
                                           dpd, mob)
    paths["rows"] = rows
    return paths


def _first_of_month(d):
    import datetime as _dt
    if d is None:
        return None
    d = d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d)[:10])
    return d.replace(day=1)


def bad_rate_report(spark: SparkSession, silver_root: str, cohort_before=None, dpd: int = 30) -> DataFrame:
    """LBL-3 over the silver store."""
    return bad_rate_curve(spark.read.parquet(silver_root), dpd, cohort_before=cohort_before)
