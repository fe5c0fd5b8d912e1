"""Label-mart queries: days past due, label store, bad-rate curve, snapshot counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators.features import days_past_due
from sparkmart.operators.labels import bad_rate_curve, default_label
from sparkmart.operators.profile import snapshot_counts
from sparkmart.operators.calendar import month_spine
from sparkmart.queries.loanbook import BOOK_SQL, SILVER_SQL, loan_book
from sparkmart.queries.registry import query
from sparkmart.sources.tables import table

COHORT_CUT = "2000-01-01"


def silver_loans(spark, sf_dir):
    return days_past_due(loan_book(spark, sf_dir))


@query("bad_rate_curve", sql=f"""
WITH s AS ({SILVER_SQL})
SELECT mob, avg(CASE WHEN dpd >= 30 THEN 1.0 ELSE 0.0 END) AS bad_rate, count(*) AS loans
FROM s WHERE loan_start_date < DATE '{COHORT_CUT}'
GROUP BY mob ORDER BY mob
""")
def q_bad_rate_curve(spark, sf_dir):
    """LBL-3 / AGG-7 / FLT-9: the flagship."""
    return bad_rate_curve(silver_loans(spark, sf_dir), dpd=30, cohort_before=COHORT_CUT)


@query("label_store", sql=f"""
WITH s AS ({SILVER_SQL})
SELECT loan_id, Customer_ID, loan_start_date,
       CAST(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS INTEGER) AS label,
       '30dpd_6mob' AS label_def, snapshot_date
FROM s WHERE mob = 6
""")
def q_label_store(spark, sf_dir):
    """LBL-1 / FLT-7 (variant that keeps ``loan_start_date``)."""
    return default_label(silver_loans(spark, sf_dir), dpd=30, mob=6, keep_start=True)


@query("days_past_due", sql=f"""
WITH s AS ({SILVER_SQL})
SELECT loan_id, installment_num, snapshot_date, mob, installments_missed, first_missed_date, dpd
FROM s
""")
def q_days_past_due(spark, sf_dir):
    """FEA-1..4, FN-10/11/14."""
    return silver_loans(spark, sf_dir).select(
        "loan_id", "installment_num", "snapshot_date", "mob", "installments_missed",
        "first_missed_date", "dpd")


@query("snapshot_counts", sql="""
WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date FROM orders),
b AS (SELECT min(snapshot_date) AS lo, max(snapshot_date) AS hi FROM o),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS snapshot_date FROM b),
c AS (SELECT snapshot_date, count(*) AS n FROM o GROUP BY snapshot_date)
SELECT spine.snapshot_date, CAST(coalesce(c.n, 0) AS BIGINT) AS row_count
FROM spine LEFT JOIN c ON spine.snapshot_date = c.snapshot_date
""")
def q_snapshot_counts(spark, sf_dir):
    """AGG-1 + CAL-1: orders per monthly snapshot on a complete month spine (zeros kept)."""
    o = table(spark, sf_dir, "orders").select(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("snapshot_date"))
    return snapshot_counts(o, spine=month_spine(o, "snapshot_date"))


@query("label_mart_backfill", sql=f"""
WITH s AS ({SILVER_SQL})
SELECT snapshot_date, CAST(count(*) AS BIGINT) AS loans, CAST(sum(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS BIGINT) AS bad,
       '30dpd_6mob' AS label_def
FROM s WHERE mob = 6
GROUP BY snapshot_date
""")
def q_label_mart_backfill(spark, sf_dir):
    """PIP-1/2/7/13: the loan book landed as a raw CSV extract, then bronze -> silver -> gold label
    store for every month of the book in one job per layer; labels counted per snapshot."""
    from sparkmart.plans import label_mart
    from sparkmart.session import scratch_path

    book = loan_book(spark, sf_dir).select(
        F.col("loan_id").cast("string").alias("loan_id"), F.col("Customer_ID").cast("string").alias("Customer_ID"),
        F.col("loan_start_date").cast("string").alias("loan_start_date"), F.lit("12").alias("tenure"),
        F.col("installment_num").cast("string").alias("installment_num"), F.lit("1000").alias("loan_amt"),
        F.col("due_amt").cast("string").alias("due_amt"), F.lit("").alias("paid_amt"),
        F.col("overdue_amt").cast("string").alias("overdue_amt"), F.lit(None).cast("string").alias("balance"),
        F.col("snapshot_date").cast("string").alias("snapshot_date"))
    root = scratch_path(spark, "label_mart")
    source = f"{root}/source_lms_loan_daily"
    book.write.mode("overwrite").option("header", True).csv(source)
    span = book.agg(F.min("snapshot_date").alias("lo"), F.max("snapshot_date").alias("hi")).first()
    paths = label_mart.backfill(spark, source, root, span["lo"], span["hi"])
    gold = spark.read.parquet(paths["gold_label_store"])
    return gold.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("label").cast("bigint").alias("bad"), F.max("label_def").alias("label_def"))


@query("incremental_label_store", sql=f"""
WITH s AS ({SILVER_SQL})
SELECT snapshot_date, CAST(count(*) AS BIGINT) AS loans, CAST(sum(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS BIGINT) AS bad
FROM s WHERE mob = 6 GROUP BY snapshot_date
""")
def q_incremental_label_store(spark, sf_dir):
    """PIP-13 incrementally: bronze lands in two drops; each run streams only the new files
    through silver (FEA-1..4) and gold (LBL-1).  The second run must see only the second drop."""
    from pyspark.sql import types as T

    from sparkmart.operators.clean import fill_all_numeric
    from sparkmart.session import scratch_path
    from sparkmart.streaming import run_layer

    book = loan_book(spark, sf_dir)
    root = scratch_path(spark, "incremental")
    bronze, silver, gold = f"{root}/bronze", f"{root}/silver", f"{root}/gold"
    cut = F.lit("1998-07-01").cast("date")
    bronze_schema = T.StructType([f for f in book.schema.fields if f.name != "snapshot_date"]).add(
        "snapshot_date", T.DateType())
    silver_schema = (T.StructType([f for f in bronze_schema.fields if f.name != "snapshot_date"])
                     .add("mob", T.IntegerType()).add("installments_missed", T.IntegerType())
                     .add("first_missed_date", T.DateType()).add("dpd", T.IntegerType())
                     .add("snapshot_date", T.DateType()))

    def silver_fn(df):
        return days_past_due(fill_all_numeric(df, 0, exclude=["loan_id", "Customer_ID"]))

    def gold_fn(df):
        return default_label(df, 30, 6, keep_start=True)

    seen = []
    for part in (book.where(F.col("snapshot_date") < cut), book.where(F.col("snapshot_date") >= cut)):
        part.write.mode("append").partitionBy("snapshot_date").parquet(bronze)
        s = run_layer(spark, bronze, bronze_schema, silver_fn, silver, f"{root}/_ckpt_silver")
        run_layer(spark, silver, silver_schema, gold_fn, gold, f"{root}/_ckpt_gold")
        seen.append(s["input_rows"])
    total = book.count()
    if sum(seen) != total:
        raise AssertionError(f"streamed {seen} rows in two runs, bronze holds {total}")
    out = spark.read.parquet(gold)
    return out.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("loans"), F.sum("label").cast("bigint").alias("bad"))


@query("redelivered_snapshots", sql=f"""
WITH b AS ({BOOK_SQL}),
n AS (SELECT * REPLACE (CASE WHEN snapshot_date < DATE '1995-01-01' THEN overdue_amt + 10.0 ELSE overdue_amt END AS overdue_amt) FROM b
      WHERE snapshot_date >= DATE '1995-01-01' OR loan_id % 2 = 0)
SELECT snapshot_date, CAST(CASE WHEN snapshot_date < DATE '1995-01-01' THEN 3 WHEN snapshot_date < DATE '1998-07-01' THEN 1 ELSE 2 END AS INTEGER) AS delivery,
       count(*) AS loans, CAST(sum(CASE WHEN overdue_amt > 0 THEN 1 ELSE 0 END) AS BIGINT) AS late
FROM n GROUP BY snapshot_date
""")
def q_redelivered_snapshots(spark, sf_dir):
    """PIP-13 with corrections: two drops, then a third that delivers the snapshots before 1995 again (half the
    loans, other amounts); each snapshot of the streamed store holds its newest delivery alone."""
    from pyspark.sql import types as T

    from sparkmart.session import scratch_path
    from sparkmart.streaming import run_replacing

    book, root = loan_book(spark, sf_dir), scratch_path(spark, "redelivered")
    cut, early = F.lit("1998-07-01").cast("date"), F.col("snapshot_date") < F.lit("1995-01-01").cast("date")
    again = book.where(early & (F.col("loan_id") % 2 == 0)).withColumn("overdue_amt", F.col("overdue_amt") + 10.0)
    schema = T.StructType([*book.schema.fields, T.StructField("delivery", T.IntegerType())])
    for n, part in enumerate((book.where(F.col("snapshot_date") < cut), book.where(F.col("snapshot_date") >= cut), again), 1):
        part.write.parquet(f"{root}/bronze/delivery={n}")
        run_replacing(spark, f"{root}/bronze", schema, days_past_due, f"{root}/silver", f"{root}/_ckpt")
    out = spark.read.parquet(f"{root}/silver")
    return (out.groupBy("snapshot_date").agg(F.max("delivery").alias("delivery"), F.count(F.lit(1)).alias("loans"),
                                             F.sum((F.col("overdue_amt") > 0).cast("int")).alias("late")))


@query("final_installments", sql=f"""
WITH s AS ({SILVER_SQL})
SELECT snapshot_date, CAST(count(*) AS BIGINT) AS loans, round(avg(CAST(dpd AS DOUBLE)), 9) AS mean_dpd
FROM s WHERE installment_num = 7 AND loan_start_date < DATE '{COHORT_CUT}'
GROUP BY snapshot_date
""")
def q_final_installments(spark, sf_dir):
    """FLT-9: final-installment rows (``installment_num == 7``, the last line number) of the cohort
    started before the cut; loans and mean dpd per snapshot."""
    s = silver_loans(spark, sf_dir).where(
        (F.col("installment_num") == 7) & (F.col("loan_start_date") < F.lit(COHORT_CUT).cast("date")))
    return s.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("loans"),
                                          F.round(F.avg(F.col("dpd").cast("double")), 9).alias("mean_dpd"))
