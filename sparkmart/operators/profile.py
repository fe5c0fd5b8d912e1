"""Aggregation, top-k and profiling (AGG-1..12, SRT, LIM)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.ordered import exact_quantiles


def snapshot_counts(df: DataFrame, date_col: str = "snapshot_date", spine: DataFrame | None = None) -> DataFrame:
    """AGG-1: rows per snapshot in one pass (not one ``count()`` action per date).

    With a ``spine`` the result has every spine date, with 0 for empty snapshots.
    """
    counts = df.groupBy(date_col).agg(F.count(F.lit(1)).alias("row_count"))
    if spine is None:
        return counts
    return (spine.join(counts, date_col, "left")
                 .select(date_col, F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """AGG-2."""
    return df.select(col).distinct()


def array_distinct_values(df: DataFrame, array_col: str, out_col: str = "value") -> DataFrame:
    """AGG-3: distinct elements over an array column (``explode`` + ``distinct``)."""
    return df.select(F.explode(F.col(array_col)).alias(out_col)).where(F.col(out_col).isNotNull()).distinct()


def group_count(df: DataFrame, *cols: str) -> DataFrame:
    """AGG-4 / AGG-10: value counts (partial aggregation before the shuffle)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def top_k(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """AGG-5: the ``k`` most frequent values, ties broken by value (``TakeOrderedAndProject``)."""
    return (group_count(df, col).orderBy(F.desc("count"), F.asc_nulls_last(col)).limit(k))


def global_stats(df: DataFrame, col: str) -> DataFrame:
    """AGG-6: mean, min, max in one pass."""
    c = F.col(col)
    return df.agg(F.avg(c).alias("mean"), F.min(c).alias("min"), F.max(c).alias("max"),
                  F.count(c).alias("count"))


def grouped_mean(df: DataFrame, key: str, value, out: str = "mean") -> DataFrame:
    """AGG-7."""
    return df.groupBy(key).agg(F.avg(value).alias(out))


def numeric_profile(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """AGG-8: count, mean, sample stddev, min, quartiles, max per column; one row per column.

    Quartiles are exact at any size (``exact_quantiles``: counts in value order, no sketch and no
    task that holds a column).
    """
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    rows = F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"{c}__count").alias("count"), F.col(f"{c}__mean").alias("mean"),
        F.col(f"{c}__stddev").alias("stddev"), F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")) for c in cols]))
    out = df.agg(*aggs).select(rows).join(exact_quantiles(df, cols), "column_name", "left")
    return out.select("column_name", "count", "mean", "stddev", "min",
                      *[F.get("q", i).alias(p) for i, p in enumerate(("p25", "p50", "p75"))], "max")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """AGG-9: equal-width histogram over ``[min, max]`` (nulls dropped, max in the last bin).

    The bounds come from one aggregate row, collected (two numbers); binning is then a
    projection plus a grouped count.  Empty bins are there with count 0.
    """
    x = F.col(col).cast("double")
    b = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = b["lo"], b["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, count bigint")
    width = (hi - lo) if hi > lo else 1.0
    binned = F.least(F.floor((x - F.lit(lo)) / F.lit(width) * F.lit(bins)).cast("int") + 1, F.lit(bins))
    counts = df.where(x.isNotNull()).groupBy(binned.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (spine.join(counts, "bin", "left").withColumn("count", F.coalesce("n", F.lit(0)).cast("bigint"))
              .select("bin",
                      (F.lit(lo) + (F.col("bin") - 1) * F.lit(width) / F.lit(bins)).alias("lower"),
                      (F.lit(lo) + F.col("bin") * F.lit(width) / F.lit(bins)).alias("upper"),
                      "count"))


def class_balance(df: DataFrame, split_col: str = "split", label_col: str = "label") -> DataFrame:
    """AGG-11: rows and positive rate per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"),
                                     F.avg(F.col(label_col).cast("double")).alias("positive_rate"))


def metrics_summary(metrics: DataFrame, group_col: str | None = "model_name", time_col: str = "created_at",
                    value_cols: Iterable[str] = ("auc_score", "f1_score", "accuracy")) -> DataFrame:
    """AGG-12: mean of each metric and the latest run (``max_by`` on time) per model; one row over all
    models with ``group_col=None``."""
    value_cols = list(value_cols)
    keys = [] if group_col is None else [group_col]
    latest = F.max_by(F.struct(time_col, *value_cols), F.col(time_col))
    aggs = [F.count(F.lit(1)).alias("runs")]
    aggs += [F.avg(c).alias(f"mean_{c}") for c in value_cols]
    aggs.append(latest.alias("latest"))
    out = metrics.groupBy(*keys).agg(*aggs)
    return out.select(*keys, "runs", *[f"mean_{c}" for c in value_cols],
                      F.col(f"latest.{time_col}").alias(f"latest_{time_col}"),
                      *[F.col(f"latest.{c}").alias(f"latest_{c}") for c in value_cols])
