"""The monthly feature mart (PIP-3..6) run on extracts built from the provided tables.

Raw subject tables, one row per ``(Customer_ID, snapshot_date)`` (customer x order month), with
dirty text made by concatenation - the same expressions appear in the oracle SQL:

* attributes: Age text with ``_`` suffixes, minus signs, empties and out-of-range values;
  Occupation from the market segment with the ``_______`` sentinel for one segment;
* financials: income as ``"1234.56_"``, loan counts with ``_`` and values above the cap,
  ``Credit_Mix`` / ``Payment_of_Min_Amount`` / ``Payment_Behaviour`` codes with sentinels,
  ``"N Years and M Months"`` history text, and a comma list of loan types;
* clickstream: ``fe_1..fe_20`` line counts per customer and ship month, by flag, line number and quantity.

The base is every installment row of the loan book, and every column of the gold store is returned.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators.features import days_past_due
from sparkmart.plans import feature_mart as fm
from sparkmart.queries.loanbook import SILVER_SQL, loan_book
from sparkmart.queries.registry import query
from sparkmart.sources.tables import table
from sparkmart.sources.writers import land

# fixed values: loan-type names given to the return flags
LOAN_TYPES = {"A": "Auto Loan", "N": "Home Loan", "R": "Payday Loan"}

OCC = ["AUTOMOBILE-Lead", "BUILDING-Lead", "FURNITURE-Lead", "MACHINERY-Lead", "Unknown"]
BEH = ["High_spent_Large", "Low_spent Small"]
TYPES = ["Auto Loan", "Home Loan", "Payday Loan", "and Auto Loan", "and Home Loan", "and Payday Loan"]


def _slug(v):
    return v.strip().replace(" ", "_").replace("-", "_").lower()


def _month(c):
    return F.trunc(F.col(c).cast("date"), "MM")


def raw_extracts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    li = table(spark, sf_dir, "lineitem")
    name = F.when(F.col("l_returnflag") == "A", LOAN_TYPES["A"]).when(F.col("l_returnflag") == "N", LOAN_TYPES["N"]) \
            .otherwise(LOAN_TYPES["R"])
    item = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("and "), name)).otherwise(name)
    lines = (li.join(o.select("o_orderkey", "o_custkey", "o_orderdate"), li.l_orderkey == o.o_orderkey)
               .groupBy("o_custkey", _month("o_orderdate").alias("snapshot_date"))
               .agg(F.count(F.lit(1)).alias("n_lines"),
                    F.count_if(F.col("l_quantity") > 25).alias("n_late"),
                    F.sum("l_extendedprice").alias("debt"),
                    F.concat_ws(", ", F.array_sort(F.collect_set(item))).alias("types")))
    om = (o.groupBy("o_custkey", _month("o_orderdate").alias("snapshot_date"))
            .agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n_orders"),
                 F.max("o_orderstatus").alias("status"), F.min("o_orderpriority").alias("prio")))
    base = om.join(lines, ["o_custkey", "snapshot_date"], "left").join(
        c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), om.o_custkey == c.c_custkey)
    base = land(base, "feature_extracts")  # both extracts read it: joined and grouped once
    nk = F.col("c_nationkey")
    attrs = base.select(
        F.col("o_custkey").cast("string").alias("Customer_ID"), F.col("c_name").alias("Name"),
        F.concat(F.lit("SSN-"), F.col("c_custkey").cast("string")).alias("SSN"),
        F.when(F.col("prio") == "1-URGENT", F.concat((nk + 18).cast("string"), F.lit("_")))
         .when(F.col("prio") == "2-HIGH", F.concat(F.lit("-"), (nk + 20).cast("string")))
         .when(F.col("prio") == "3-MEDIUM", (nk + 17).cast("string"))
         .when(F.col("prio") == "4-NOT SPECIFIED", F.lit(""))
         .otherwise((nk * 5).cast("string")).alias("Age"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("_______"))
         .otherwise(F.concat(F.col("c_mktsegment"), F.lit("-Lead"))).alias("Occupation"),
        F.col("snapshot_date").cast("string").alias("snapshot_date"))
    st = F.col("status")
    fin = base.select(
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        F.concat(F.format_string("%.2f", F.col("total")), F.lit("_")).alias("Annual_Income"),
        F.floor(F.col("total") / 12).cast("bigint").cast("string").alias("Monthly_Inhand_Salary"),
        F.concat(F.col("n_orders").cast("string"), F.lit(".0")).alias("Num_Bank_Accounts"),
        (nk % 10).cast("string").alias("Num_Credit_Card"),
        F.when(st != "P", (nk + F.col("n_orders")).cast("string")).alias("Interest_Rate"),
        (F.coalesce("n_late", F.lit(0)) * 5 - 10).cast("string").alias("Delay_from_due_date"),
        F.coalesce("n_lines", F.lit(0)).cast("string").alias("Num_Credit_Inquiries"),
        F.floor(F.col("total") / 1000).cast("bigint").cast("string").alias("Credit_Utilization_Ratio"),
        F.floor(F.col("total") / 36).cast("bigint").cast("string").alias("Monthly_Balance"),
        F.concat(F.lit("__"), F.floor(F.col("total") / 100).cast("bigint").cast("string"), F.lit("__"))
         .alias("Amount_invested_monthly"),
        F.concat((F.coalesce(F.col("n_lines"), F.lit(0)) * 4).cast("string"),
                 F.when(st == "P", F.lit("_")).otherwise(F.lit(""))).alias("Num_of_Loan"),
        F.col("n_late").cast("string").alias("Num_of_Delayed_Payment"),
        F.lit("_").alias("Changed_Credit_Limit"),
        F.when(F.col("prio") == "1-URGENT", "Good").when(F.col("prio") == "2-HIGH", "Standard")
         .when(F.col("prio") == "3-MEDIUM", "Bad").when(F.col("prio") == "4-NOT SPECIFIED", "_")
         .otherwise("Other").alias("Credit_Mix"),
        F.when(st == "F", "Yes").when(st == "O", "No").otherwise("NM").alias("Payment_of_Min_Amount"),
        F.when(st == "P", "!@9#%8").when(st == "F", "High_spent_Large").otherwise("Low_spent Small")
         .alias("Payment_Behaviour"),
        F.concat(F.col("n_orders").cast("string"), F.lit(" Years and "),
                 F.coalesce(F.col("n_late"), F.lit(0)).cast("string"), F.lit(" Months")).alias("Credit_History_Age"),
        F.format_string("%.2f", F.coalesce(F.col("debt"), F.lit(0.0))).alias("Outstanding_Debt"),
        F.floor(F.col("total") / 24).cast("bigint").cast("string").alias("Total_EMI_per_month"),
        F.col("types").alias("Type_of_Loan"),
        F.col("snapshot_date").cast("string").alias("snapshot_date"))
    click = (li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
               .groupBy(F.col("o_custkey").cast("string").alias("Customer_ID"),
                        _month("l_shipdate").cast("string").alias("snapshot_date"))
               .agg(F.count(F.lit(1)).alias("fe_1"), F.count_if(F.col("l_returnflag") == "R").alias("fe_2"),
                    F.count_if(F.col("l_returnflag") == "A").alias("fe_3"),
                    F.count_if(F.col("l_returnflag") == "N").alias("fe_4"),
                    F.count_if(F.col("l_linestatus") == "F").alias("fe_5"),
                    *[F.count_if(F.col("l_linenumber") == i).alias(f"fe_{5 + i}") for i in range(1, 8)],
                    *[F.count_if(F.col("l_quantity") > 5 * i).alias(f"fe_{12 + i}") for i in range(1, 9)]))
    return attrs, fin, click


FIN_COLS = ["Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan",
            "Num_of_Loan_Overcap_Flag", "Delay_from_due_date", "Num_of_Delayed_Payment", "Num_Credit_Inquiries", "Credit_Mix",
            "Outstanding_Debt", "Credit_Utilization_Ratio", "Payment_of_Min_Amount", "Total_EMI_per_month",
            "Amount_invested_monthly", "Monthly_Balance", "credit_history_yrs", "credit_history_mths",
            "Credit_History_in_Months"]
OUT_COLS = (["loan_id", "installment_num", "Customer_ID", "snapshot_date", "dpd", "Age", "Has_Valid_Age"]
            + [f"Occupation_{_slug(v)}" for v in OCC] + FIN_COLS
            + ["Debt_to_income", "Loan_to_income", "Delayed_payment_ratio", "Investment_rate"]
            + [f"payment_behaviour_{_slug(v)}" for v in BEH]
            + [f"loan_type_{_slug(v)}" for v in TYPES]
            + [f"fe_{i}" for i in range(1, 21)])


def _sql():
    occ = ", ".join(f"CASE WHEN Occupation = '{v}' THEN 1 ELSE 0 END AS Occupation_{_slug(v)}" for v in OCC)
    beh = ", ".join(f"CASE WHEN Payment_Behaviour = '{v}' THEN 1 ELSE 0 END AS payment_behaviour_{_slug(v)}"
                    for v in BEH)
    typ = ", ".join(
        f"CASE WHEN coalesce(list_contains(string_split_regex(Type_of_Loan, ',\\s*'), '{v}'), false) THEN 1 ELSE 0 END"
        f" AS loan_type_{_slug(v)}" for v in TYPES)
    occ_cols = ", ".join(f"a.Occupation_{_slug(v)}" for v in OCC)
    beh_cols = ", ".join(f"f.payment_behaviour_{_slug(v)}" for v in BEH)
    fin_cols = ", ".join(f"f.{c}" for c in FIN_COLS)
    click = ", ".join([f"count(*) FILTER (WHERE l.l_linenumber = {i}) AS fe_{5 + i}" for i in range(1, 8)]
                      + [f"count(*) FILTER (WHERE l.l_quantity > {5 * i}) AS fe_{12 + i}" for i in range(1, 9)])
    click_cols = ", ".join(f"CAST(k.fe_{i} AS INTEGER) AS fe_{i}" for i in range(1, 21))
    typ_cols = ", ".join(f"f.loan_type_{_slug(v)}" for v in TYPES)
    return f"""
WITH s AS ({SILVER_SQL}),
loans AS (SELECT CAST(loan_id AS BIGINT) AS loan_id, installment_num, CAST(Customer_ID AS VARCHAR) AS Customer_ID, snapshot_date,
                 dpd FROM s),
items AS (SELECT o.o_custkey, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS snapshot_date, l.l_quantity,
                 l.l_extendedprice,
                 CASE WHEN l.l_linestatus = 'F' THEN 'and ' ELSE '' END ||
                 CASE l.l_returnflag WHEN 'A' THEN 'Auto Loan' WHEN 'N' THEN 'Home Loan' ELSE 'Payday Loan' END AS item
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
lines AS (SELECT o_custkey, snapshot_date, count(*) AS n_lines, count(*) FILTER (WHERE l_quantity > 25) AS n_late,
                 sum(l_extendedprice) AS debt, string_agg(DISTINCT item, ', ' ORDER BY item) AS types
          FROM items GROUP BY ALL),
om AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, sum(o_totalprice) AS total,
              count(*) AS n_orders, max(o_orderstatus) AS status, min(o_orderpriority) AS prio
       FROM orders GROUP BY ALL),
base AS (SELECT om.*, lines.n_lines, lines.n_late, lines.debt, lines.types, c.c_name, c.c_nationkey, c.c_mktsegment
         FROM om LEFT JOIN lines USING (o_custkey, snapshot_date) JOIN customer c ON om.o_custkey = c.c_custkey),
a0 AS (SELECT CAST(o_custkey AS VARCHAR) AS Customer_ID, snapshot_date,
              TRY_CAST(regexp_replace(CASE prio WHEN '1-URGENT' THEN CAST(c_nationkey + 18 AS VARCHAR) || '_'
                                               WHEN '2-HIGH' THEN '-' || CAST(c_nationkey + 20 AS VARCHAR)
                                               WHEN '3-MEDIUM' THEN CAST(c_nationkey + 17 AS VARCHAR)
                                               WHEN '4-NOT SPECIFIED' THEN ''
                                               ELSE CAST(c_nationkey * 5 AS VARCHAR) END, '[^0-9]', '', 'g') AS INTEGER) AS Age,
              CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Unknown' ELSE c_mktsegment || '-Lead' END AS Occupation
       FROM base),
a AS (SELECT *, CASE WHEN Age IS NOT NULL THEN 1 ELSE 0 END AS Has_Valid_Age, {occ}
      FROM a0 WHERE Age BETWEEN 18 AND 100),
f0 AS (SELECT CAST(o_custkey AS VARCHAR) AS Customer_ID, snapshot_date,
              TRY_CAST(regexp_replace(printf('%.2f', total) || '_', '[^0-9.]', '', 'g') AS DOUBLE) AS Annual_Income,
              CAST(floor(total / 12) AS DOUBLE) AS Monthly_Inhand_Salary,
              CAST(floor(total / 100) AS DOUBLE) AS Amount_invested_monthly,
              coalesce(n_lines, 0) * 4 AS loans_raw,
              CAST(n_late AS INTEGER) AS Num_of_Delayed_Payment,
              CAST(n_orders AS INTEGER) AS Num_Bank_Accounts, CAST(c_nationkey % 10 AS INTEGER) AS Num_Credit_Card,
              CAST(CASE WHEN status <> 'P' THEN c_nationkey + n_orders END AS INTEGER) AS Interest_Rate,
              CAST(coalesce(n_late, 0) * 5 - 10 AS INTEGER) AS Delay_from_due_date,
              CAST(coalesce(n_lines, 0) AS DOUBLE) AS Num_Credit_Inquiries,
              floor(total / 1000) AS Credit_Utilization_Ratio, floor(total / 24) AS Total_EMI_per_month,
              floor(total / 36) AS Monthly_Balance,
              CAST(n_orders AS INTEGER) AS credit_history_yrs, CAST(coalesce(n_late, 0) AS INTEGER) AS credit_history_mths,
              CASE prio WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 0 END AS Credit_Mix,
              CASE status WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS Payment_of_Min_Amount,
              CASE status WHEN 'P' THEN NULL WHEN 'F' THEN 'High_spent_Large' ELSE 'Low_spent Small' END AS Payment_Behaviour,
              CAST(n_orders * 12 + coalesce(n_late, 0) AS INTEGER) AS Credit_History_in_Months,
              CAST(printf('%.2f', coalesce(debt, 0.0)) AS DOUBLE) AS Outstanding_Debt,
              types AS Type_of_Loan
       FROM base),
f AS (SELECT *, CAST(CASE WHEN loans_raw > 20 THEN 20 ELSE loans_raw END AS INTEGER) AS Num_of_Loan,
             CASE WHEN loans_raw > 20 THEN 1 ELSE 0 END AS Num_of_Loan_Overcap_Flag, {beh}, {typ} FROM f0),
k AS (SELECT CAST(o.o_custkey AS VARCHAR) AS Customer_ID, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS snapshot_date,
             count(*) AS fe_1, count(*) FILTER (WHERE l.l_returnflag = 'R') AS fe_2,
             count(*) FILTER (WHERE l.l_returnflag = 'A') AS fe_3, count(*) FILTER (WHERE l.l_returnflag = 'N') AS fe_4,
             count(*) FILTER (WHERE l.l_linestatus = 'F') AS fe_5,
             {click}
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY ALL)
SELECT loans.loan_id, loans.installment_num, loans.Customer_ID, loans.snapshot_date, loans.dpd, a.Age, a.Has_Valid_Age, {occ_cols},
       {fin_cols},
       f.Total_EMI_per_month / (f.Monthly_Inhand_Salary + 1) AS Loan_to_income,
       f.Outstanding_Debt / (f.Annual_Income + 1) AS Debt_to_income,
       f.Num_of_Delayed_Payment / (f.Num_of_Loan + 1) AS Delayed_payment_ratio,
       f.Amount_invested_monthly / (f.Monthly_Inhand_Salary + 1) AS Investment_rate,
       {beh_cols}, {typ_cols},
       {click_cols}
FROM loans LEFT JOIN a ON loans.Customer_ID = a.Customer_ID AND loans.snapshot_date = a.snapshot_date
           LEFT JOIN f ON loans.Customer_ID = f.Customer_ID AND loans.snapshot_date = f.snapshot_date
           LEFT JOIN k ON loans.Customer_ID = k.Customer_ID AND loans.snapshot_date = k.snapshot_date
"""


@query("feature_mart_gold", sql=_sql())
def q_feature_mart_gold(spark, sf_dir):
    """PIP-3..6: silver attributes / financials / clickstream from raw extracts, then the gold
    feature store (one-hot, multi-hot, valid-age flag) left-joined onto every loan row."""
    from sparkmart.session import scratch_path
    from sparkmart.sources.readers import read_store
    from sparkmart.sources.writers import write_snapshots

    attrs_raw, fin_raw, click_raw = raw_extracts(spark, sf_dir)
    root = scratch_path(spark, "feature_mart")
    silver = {"attributes": fm.silver_attributes(attrs_raw), "financials": fm.silver_financials(fin_raw),
              "clickstream": fm.silver_clickstream(click_raw)}
    for name, df in silver.items():  # the silver layer is a stored table; gold reads it back
        write_snapshots(df, f"{root}/silver_{name}", sort_by=("Customer_ID",))
    attrs, fin, click = (read_store(spark, f"{root}/silver_{n}") for n in silver)
    loans = days_past_due(loan_book(spark, sf_dir)).select(
        "loan_id", "installment_num", F.col("Customer_ID").cast("string").alias("Customer_ID"), "snapshot_date", "dpd")
    gold = fm.gold_features(loans, attrs, fin, click)
    if set(OUT_COLS) != set(gold.columns):
        raise AssertionError(f"gold feature store has other columns: {sorted(set(OUT_COLS) ^ set(gold.columns))}")
    return gold.select(*OUT_COLS)
