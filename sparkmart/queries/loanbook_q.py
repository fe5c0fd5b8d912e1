"""The daily loan-book mart (PIP-8..12) run on extracts built from the provided tables.

Members are customers, snapshots are order months (every month of the tables, no window),
and four raw category extracts are derived per ``(member_id, snapshot_date)``; categories
cover different subsets of keys so the full-outer feature store has gaps.  The result is a
profile of every feature-store column (non-null count, sum, min, max), the joined row count,
and the grade label store's counts - all recomputed independently by the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.plans import loanbook_mart as lm
from sparkmart.queries.registry import query
from sparkmart.sources.tables import table
from sparkmart.sources.writers import land

KEYS = ["member_id", "snapshot_date"]


def _base(spark, sf_dir):
    """A row per member and month, joined and grouped once for all extracts, fits and windows that read it."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    om = o.groupBy("o_custkey", month.alias("snapshot_date")).agg(
        F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n_orders"),
        F.max("o_orderstatus").alias("status"), F.min("o_orderpriority").alias("prio"),
        F.min("o_orderkey").alias("first_key"))
    ln = (li.join(o.select("o_orderkey", "o_custkey", "o_orderdate"), li.l_orderkey == o.o_orderkey)
            .groupBy("o_custkey", month.alias("snapshot_date"))
            .agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("l_quantity") > 25).alias("n_late"),
                 F.sum("l_quantity").alias("qty")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    b = (om.join(ln, ["o_custkey", "snapshot_date"], "left")
           .join(c, om.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey))
    b = b.select(F.col("o_custkey").cast("string").alias("member_id"), "snapshot_date", "total", "n_orders",
                 "status", "prio", "first_key", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                 F.coalesce("n_late", F.lit(0)).alias("n_late"), F.coalesce("qty", F.lit(0.0)).alias("qty"),
                 "c_acctbal", "c_nationkey", "c_mktsegment", "n_name")
    return land(b, "loanbook_extracts")


def raw_extracts(spark, sf_dir, b=None):
    b = _base(spark, sf_dir) if b is None else b
    st, pr = F.col("status"), F.col("prio")
    credit = b.where(st != "O").select(
        "member_id", F.col("snapshot_date").cast("string").alias("snapshot_date"),
        F.when(pr == "5-LOW", F.lit("n/a")).otherwise(
            F.date_format(F.add_months("snapshot_date", -(F.col("c_nationkey") * 7 + 13)), "MMM-yyyy"))
         .alias("earliest_cr_line"),
        F.when(st == "P", F.lit(None)).otherwise(F.col("n_orders")).alias("mort_acc"),
        F.when(pr == "1-URGENT", F.lit(None)).otherwise(F.col("n_late")).alias("pub_rec"),
        F.when(pr == "2-HIGH", F.lit(None)).otherwise(F.col("n_lines") - F.col("n_late")).alias("delinq_2yrs"),
        F.when(st == "P", F.lit(None)).otherwise(F.col("n_lines")).alias("inq_fi"),
        F.lit("x").alias("last_credit_pull_d"))
    demo = b.where(st != "P").select(
        "member_id", F.col("snapshot_date").cast("string").alias("snapshot_date"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
         .otherwise(F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "), F.col("n_name"), F.lit(" ")))
         .alias("emp_title"),
        F.when(pr == "1-URGENT", "10+ years").when(pr == "2-HIGH", "< 1 year")
         .when(pr == "3-MEDIUM", F.concat(F.col("n_lines").cast("string"), F.lit(" years")))
         .when(pr == "4-NOT SPECIFIED", F.lit(None)).otherwise("n/a").alias("emp_length"),
        F.when(F.col("n_orders") > 1, "MORTGAGE").when(st == "F", "RENT").otherwise(F.lit(None)).alias("home_ownership"),
        F.when(F.col("c_acctbal") > 5000, "Verified").when(F.col("c_acctbal") > 0, "Source Verified")
         .otherwise("Not Verified").alias("verification_status"),
        F.lit("123xx").alias("zip_code"), F.col("n_name").alias("addr_state"),
        F.when(F.col("n_orders") > 1, "Joint App").otherwise("Individual").alias("application_type"),
        F.col("total").alias("annual_inc"), F.lit("x").alias("annual_inc_joint"))
    fin = b.select(
        "member_id", F.col("snapshot_date").cast("string").alias("snapshot_date"),
        F.when(st == "P", F.lit(None)).otherwise(F.col("total") / 10000.0).alias("dti"),
        F.when(pr == "5-LOW", F.lit(None)).otherwise(F.col("n_late") * 10.0).alias("all_util"),
        F.when(pr == "4-NOT SPECIFIED", F.lit(None)).otherwise(F.col("qty")).alias("il_util"),
        (F.col("n_lines") * 1.5).alias("bc_util"), F.col("c_acctbal").alias("revol_bal"),
        F.when(st == "O", F.lit(None)).otherwise(F.col("n_orders")).alias("open_acc"),
        F.lit("x").alias("dti_joint"))
    terms = b.select(
        F.col("first_key").cast("string").alias("id"), "member_id",
        F.col("snapshot_date").cast("string").alias("snapshot_date"),
        F.concat(F.lit(" "), F.when(F.col("n_lines") > 4, "60").otherwise("36"), F.lit(" months")).alias("term"),
        F.when(pr == "1-URGENT", "A").when(pr == "2-HIGH", "B").when(pr == "3-MEDIUM", "C")
         .when(pr == "4-NOT SPECIFIED", "H").otherwise(F.lit(None)).alias("grade"),
        F.when(st == "F", "Fully Paid").when(st == "O", "Current").otherwise("Charged Off").alias("loan_status"),
        F.when(F.col("n_late") > 2, "y").otherwise("n").alias("pymnt_plan"),
        F.lower("c_mktsegment").alias("purpose"),
        F.when(F.col("n_orders") > 1, "w").otherwise("f").alias("initial_list_status"),
        F.when(F.col("c_acctbal") > 0, "Cash").otherwise("DirectPay").alias("disbursement_method"),
        F.when(st == "P", "Y").otherwise("N").alias("debt_settlement_flag"),
        F.col("total").alias("loan_amnt"), (F.col("n_lines") * 1.25).alias("int_rate"),
        (F.col("total") / 36.0).alias("installment"), F.lit("u").alias("url"))
    return {"credit_history": credit, "demographic": demo, "financial": fin, "loan_terms": terms}


def _profile(df, table_name):
    feats = [c for c in df.columns if c not in KEYS]
    long = df.select(*KEYS, *[F.col(c).cast("double").alias(c) for c in feats]).unpivot(
        KEYS, feats, "feature", "value")
    return long.groupBy("feature").agg(
        F.count("value").alias("n"), F.round(F.sum("value"), 3).alias("total"),
        F.min("value").alias("lo"), F.max("value").alias("hi")).select(F.lit(table_name).alias("table_name"), "*")


def _sql():
    from sparkmart.queries import loanbook_sql
    return loanbook_sql.SQL


@query("loanbook_mart", sql=_sql())
def q_loanbook_mart(spark, sf_dir):
    """PIP-8/9 (four silver processors, stored), PIP-11 (grade label store), PIP-12 (feature store)."""
    from sparkmart.session import scratch_path

    root = scratch_path(spark, "loanbook")
    lm.silver_processing(raw_extracts(spark, sf_dir), f"{root}/silver")
    lm.gold_label_store(spark, f"{root}/silver", f"{root}/label_store")
    fs = lm.feature_store(spark, f"{root}/silver")
    rows = fs.agg(F.count(F.lit(1)).cast("double").alias("n")).select(
        F.lit("feature_store").alias("table_name"), F.lit("__rows").alias("feature"), F.col("n").cast("bigint").alias("n"),
        F.lit(None).cast("double").alias("total"), F.lit(None).cast("double").alias("lo"),
        F.lit(None).cast("double").alias("hi"))
    labels = (spark.read.parquet(f"{root}/label_store")
              .groupBy(F.concat(F.lit("grade_"), F.col("grade")).alias("feature"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit("label_store").alias("table_name"), "feature", "n",
                      F.lit(None).cast("double").alias("total"), F.lit(None).cast("double").alias("lo"),
                      F.lit(None).cast("double").alias("hi")))
    return _profile(fs, "feature_store").unionByName(rows).unionByName(labels)
