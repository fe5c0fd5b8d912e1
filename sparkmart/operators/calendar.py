"""Date spines and coverage (CAL-1..6), built from the data with no driver-side date lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.dates import day_spine_expr, month_spine_expr


def month_spine(df: DataFrame, date_col: str, inclusive: bool = True, out_col: str = "snapshot_date",
                start=None, end=None) -> DataFrame:
    """CAL-1 / CAL-3: first-of-month dates covering ``[min, max]`` of ``date_col``.

    ``start``/``end`` override the data bounds.  One tiny aggregate and an ``explode``; the
    spine has one row per month, so it is small by construction.
    """
    bounds = df.agg(F.min(F.col(date_col).cast("date")).alias("lo"), F.max(F.col(date_col).cast("date")).alias("hi"))
    lo = F.lit(start).cast("date") if start is not None else F.col("lo")
    hi = F.lit(end).cast("date") if end is not None else F.col("hi")
    return bounds.select(F.explode(month_spine_expr(lo, hi, inclusive)).alias(out_col))


def day_spine(df: DataFrame, date_col: str, out_col: str = "day") -> DataFrame:
    """CAL-2: every date in ``[min, max]`` of ``date_col``."""
    bounds = df.agg(F.min(F.col(date_col).cast("date")).alias("lo"), F.max(F.col(date_col).cast("date")).alias("hi"))
    return bounds.select(F.explode(day_spine_expr("lo", "hi")).alias(out_col))


def coverage(df: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """CAL-4: one row ``(first_date, last_date, snapshots, rows)``."""
    d = F.col(date_col).cast("date")
    return df.agg(F.min(d).alias("first_date"), F.max(d).alias("last_date"),
                  F.count_distinct(d).alias("snapshots"), F.count(F.lit(1)).alias("rows"))


def store_counts(spark: SparkSession, root: str, date_col: str = "snapshot_date") -> DataFrame:
    """AGG-1 of a snapshot-partitioned Parquet store from its footers: ``(date, rows)``, no data page read.

    Spark's Parquet source answers ``count(*)`` per partition value from file footers when it reads by
    its version 2 path; both settings hold for this one small aggregate, which is written with a
    reliable checkpoint, and are put back after.
    """
    from sparkmart.session import shared_dir

    shared_dir(spark)
    conf = {"spark.sql.sources.useV1SourceList": "avro,csv,json,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return footer_counts(spark, root, date_col).checkpoint(eager=True)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def footer_counts(spark: SparkSession, root: str, date_col: str) -> DataFrame:
    """The plan of ``store_counts``: pushed to the footers under its settings, a scan elsewhere."""
    counts = spark.read.parquet(root).groupBy(date_col).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(F.col(date_col).cast("date").alias(date_col), "rows")


def store_coverage(counts: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """CAL-4 from ``store_counts``: the row of ``coverage``."""
    return counts.agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
                      F.count(date_col).alias("snapshots"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def window_sufficient(run_date: Column, earliest: Column, days: int = 365) -> Column:
    """CAL-5: ``run_date - max(earliest, run_date - days) >= days``."""
    start = F.greatest(earliest, F.date_sub(run_date, days))
    return F.datediff(run_date, start) >= days


def sufficiency_by_run(df: DataFrame, run_dates: DataFrame, date_col: str = "snapshot_date",
                       run_col: str = "run_date", days: int = 365) -> DataFrame:
    """CAL-5 for many run dates: the store's earliest snapshot (one aggregate value) against each run."""
    earliest = df.agg(F.min(F.col(date_col).cast("date")).alias("earliest")).first()["earliest"]
    e = F.lit(earliest).cast("date")
    return run_dates.select(F.col(run_col), e.alias("earliest"),
                            window_sufficient(F.col(run_col), e, days).alias("sufficient"))


def split_window(date: Column, train_date, oot_months: int = 2, train_months: int = 12) -> Column:
    """CAL-6: which window a row's date falls in for a training run at ``train_date``.

    OOT = ``[D - oot_months, D - 1 day]``; train/test = ``[OOT start - train_months, OOT start - 1 day]``.
    """
    d = F.lit(train_date).cast("date")
    oot_start = F.add_months(d, -oot_months)
    tt_start = F.add_months(oot_start, -train_months)
    return (F.when(date.between(oot_start, F.date_sub(d, 1)), "oot")
             .when(date.between(tt_start, F.date_sub(oot_start, 1)), "train_test")
             .otherwise("outside"))


def window_bounds(train_date: Column, oot_months: int = 2, train_months: int = 12) -> dict[str, Column]:
    """First and last days of CAL-6's windows."""
    oot_start = F.add_months(train_date, -oot_months)
    return {"train_start": F.add_months(oot_start, -train_months), "train_end": F.date_sub(oot_start, 1),
            "oot_start": oot_start, "oot_end": F.date_sub(train_date, 1)}
