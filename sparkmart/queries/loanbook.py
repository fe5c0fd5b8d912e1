"""The provided tables re-read as a loan book.

``lineitem JOIN orders`` stands in for the loan-management system: one loan per order, one
installment row per line item.  Fixed mapping (shared with the oracle SQL):

    loan_id         = l_orderkey
    Customer_ID     = o_custkey
    loan_start_date = date(o_orderdate)
    installment_num = l_linenumber
    due_amt         = 10.0
    overdue_amt     = greatest(l_quantity - 25, 0)
    snapshot_date   = first of the month of l_shipdate
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.sources.tables import table

DUE = 10.0
OVERDUE_FLOOR = 25.0

BOOK_SQL = """
  SELECT l.l_orderkey AS loan_id, o.o_custkey AS Customer_ID,
         CAST(o.o_orderdate AS DATE) AS loan_start_date, l.l_linenumber AS installment_num,
         CAST(10.0 AS DOUBLE) AS due_amt, greatest(l.l_quantity - 25.0, 0.0) AS overdue_amt,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS snapshot_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

# days-past-due columns on top of BOOK_SQL (FEA-1..4), DuckDB dialect
SILVER_SQL = f"""
  WITH book AS ({BOOK_SQL}),
  m AS (
    SELECT *, CAST(installment_num AS INTEGER) AS mob,
           coalesce(CAST(ceil(overdue_amt / nullif(due_amt, 0.0)) AS INTEGER), 0) AS installments_missed
    FROM book),
  f AS (
    SELECT *, CASE WHEN installments_missed > 0
                   THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
    FROM m)
  SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date)
                      ELSE 0 END AS INTEGER) AS dpd
  FROM f
"""


def loan_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan-book rows from ``lineitem JOIN orders`` (a shuffle join on the order key)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .select(F.col("l_orderkey").alias("loan_id"),
                      F.col("o_custkey").alias("Customer_ID"),
                      F.col("o_orderdate").cast("date").alias("loan_start_date"),
                      F.col("l_linenumber").alias("installment_num"),
                      F.lit(DUE).alias("due_amt"),
                      F.greatest(F.col("l_quantity") - F.lit(OVERDUE_FLOOR), F.lit(0.0)).alias("overdue_amt"),
                      F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("snapshot_date")))
