"""Calendar queries (CAL-1..6, FLT-4) on ``orders`` and ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators.calendar import (
    coverage, day_spine, month_spine, split_window, store_counts, store_coverage, sufficiency_by_run,
)
from sparkmart.operators.filters import range_with_fallback
from sparkmart.queries.registry import query
from sparkmart.session import scratch_path
from sparkmart.sources.tables import table
from sparkmart.sources.writers import write_snapshots

ORDER_MONTHS = "(SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, * FROM orders)"
TRAIN_DATE = "2000-09-01"


def order_months(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.withColumn("snapshot_date", F.trunc(F.col("o_orderdate").cast("date"), "MM"))


@query("month_spine", sql="""
WITH b AS (SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders)
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS snapshot_date FROM b
""")
def q_month_spine(spark, sf_dir):
    """CAL-1: first-of-month dates from the first to the last order date, inclusive."""
    return month_spine(table(spark, sf_dir, "orders"), "o_orderdate")


@query("month_walk", sql="""
WITH b AS (SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders)
SELECT CAST(d AS DATE) AS snapshot_date
FROM b, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) t(d) WHERE CAST(d AS DATE) < hi
""")
def q_month_walk(spark, sf_dir):
    """CAL-3: the half-open month walk ``[trunc(first), last)``."""
    return month_spine(table(spark, sf_dir, "orders"), "o_orderdate", inclusive=False)


@query("day_spine", sql="""
WITH b AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events)
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b
""")
def q_day_spine(spark, sf_dir):
    """CAL-2: every day covered by the event stream."""
    return day_spine(table(spark, sf_dir, "events"), "ts")


@query("coverage", sql=f"""
SELECT min(snapshot_date) AS first_date, max(snapshot_date) AS last_date,
       CAST(count(DISTINCT snapshot_date) AS BIGINT) AS snapshots, CAST(count(*) AS BIGINT) AS rows
FROM {ORDER_MONTHS}
""")
def q_coverage(spark, sf_dir):
    """CAL-4: snapshot coverage of the monthly order store."""
    return coverage(order_months(spark, sf_dir))


def _month_store(spark, sf_dir):
    """The monthly order store: its row counts come from file footers."""
    root = scratch_path(spark, "order-months")
    write_snapshots(order_months(spark, sf_dir), root)
    return store_counts(spark, root)


@query("store_coverage", sql=f"""
SELECT min(snapshot_date) AS first_date, max(snapshot_date) AS last_date,
       CAST(count(DISTINCT snapshot_date) AS BIGINT) AS snapshots, CAST(count(*) AS BIGINT) AS rows
FROM {ORDER_MONTHS}
""")
def q_store_coverage(spark, sf_dir):
    """CAL-4 of a stored snapshot table, from its footers."""
    return store_coverage(_month_store(spark, sf_dir))


@query("store_snapshot_counts", sql=f"""
SELECT snapshot_date, CAST(count(*) AS BIGINT) AS rows FROM {ORDER_MONTHS} GROUP BY snapshot_date
""")
def q_store_snapshot_counts(spark, sf_dir):
    """AGG-1 of a stored snapshot table, from its footers."""
    return _month_store(spark, sf_dir)


@query("window_sufficiency", sql=f"""
WITH m AS {ORDER_MONTHS},
e AS (SELECT min(snapshot_date) AS earliest FROM m),
runs AS (SELECT DISTINCT snapshot_date AS run_date FROM m)
SELECT run_date, earliest,
       date_diff('day', greatest(earliest, CAST(run_date - INTERVAL 365 DAY AS DATE)), run_date) >= 365 AS sufficient
FROM runs, e
""")
def q_window_sufficiency(spark, sf_dir):
    """CAL-5: for every snapshot as a run date, is there a full year of history before it?"""
    m = order_months(spark, sf_dir)
    runs = m.select(F.col("snapshot_date").alias("run_date")).distinct()
    return sufficiency_by_run(m, runs, run_col="run_date")


@query("split_windows", sql=f"""
WITH m AS {ORDER_MONTHS},
w AS (
  SELECT CASE
    WHEN snapshot_date BETWEEN CAST(DATE '{TRAIN_DATE}' - INTERVAL 2 MONTH AS DATE) AND DATE '{TRAIN_DATE}' - 1 THEN 'oot'
    WHEN snapshot_date BETWEEN CAST(DATE '{TRAIN_DATE}' - INTERVAL 14 MONTH AS DATE)
                           AND CAST(DATE '{TRAIN_DATE}' - INTERVAL 2 MONTH AS DATE) - 1 THEN 'train_test'
    ELSE 'outside' END AS window_name, snapshot_date
  FROM m)
SELECT window_name, CAST(count(*) AS BIGINT) AS rows, min(snapshot_date) AS first_date, max(snapshot_date) AS last_date
FROM w GROUP BY window_name
""")
def q_split_windows(spark, sf_dir):
    """CAL-6: train/test and out-of-time windows for a training run at ``TRAIN_DATE``."""
    m = order_months(spark, sf_dir).withColumn("window_name", split_window(F.col("snapshot_date"), TRAIN_DATE))
    return m.groupBy("window_name").agg(F.count(F.lit(1)).alias("rows"), F.min("snapshot_date").alias("first_date"),
                                        F.max("snapshot_date").alias("last_date"))


@query("window_fallback", sql=f"""
SELECT snapshot_date, CAST(count(*) AS BIGINT) AS rows
FROM {ORDER_MONTHS} WHERE snapshot_date >= DATE '2001-01-01' AND snapshot_date < DATE '2003-01-01'
GROUP BY snapshot_date
""")
def q_window_fallback(spark, sf_dir):
    """FLT-4: a training range that runs past the end of the store."""
    m = range_with_fallback(order_months(spark, sf_dir), "snapshot_date", "2001-01-01", "2003-01-01")
    return m.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows"))
