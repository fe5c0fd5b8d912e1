"""Feature-store join queries (JON-1..4, MLD-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators.features import days_past_due
from sparkmart.operators.joins import attach_features, heavy_left_join, inner_with_suffixes, left_chain, outer_chain
from sparkmart.operators.labels import default_label
from sparkmart.queries.loanbook import SILVER_SQL, loan_book
from sparkmart.queries.registry import query
from sparkmart.sources.tables import table

WINDOW = ("1997-01-01", "1998-12-01")


def _month(c):
    return F.trunc(F.col(c).cast("date"), "MM")


def customer_months(spark, sf_dir):
    """Customer x month features from orders: counts and spend."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").alias("Customer_ID"), _month("o_orderdate").alias("snapshot_date"))
             .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spend")))


@query("feature_store_left", sql="""
WITH base AS (SELECT o_orderkey, o_custkey AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
                     o_totalprice FROM orders),
attrs AS (SELECT c_custkey AS Customer_ID, c_acctbal, c_mktsegment FROM customer),
lines AS (SELECT o.o_custkey AS Customer_ID, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS snapshot_date,
                 sum(l.l_quantity) AS line_qty, sum(l.l_extendedprice * (1 - l.l_discount)) AS line_revenue
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
ev AS (SELECT user_id AS Customer_ID, CAST(count(*) AS BIGINT) AS event_count, sum(value) AS event_value
       FROM events GROUP BY user_id)
SELECT b.o_orderkey, b.Customer_ID, b.snapshot_date, b.o_totalprice, a.c_acctbal, a.c_mktsegment,
       round(li.line_qty, 6) AS line_qty, round(li.line_revenue, 6) AS line_revenue,
       e.event_count, round(e.event_value, 6) AS event_value
FROM base b LEFT JOIN attrs a USING (Customer_ID)
            LEFT JOIN lines li USING (Customer_ID, snapshot_date)
            LEFT JOIN ev e USING (Customer_ID)
""")
def q_feature_store_left(spark, sf_dir):
    """JON-1: orders LEFT JOIN customer LEFT JOIN line-month aggregates LEFT JOIN event aggregates."""
    o = table(spark, sf_dir, "orders")
    base = o.select("o_orderkey", F.col("o_custkey").alias("Customer_ID"),
                    _month("o_orderdate").alias("snapshot_date"), "o_totalprice")
    attrs = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer_ID"), "c_acctbal", "c_mktsegment")
    li = table(spark, sf_dir, "lineitem")
    lines = (li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
               .groupBy(F.col("o_custkey").alias("Customer_ID"), _month("l_shipdate").alias("snapshot_date"))
               .agg(F.sum("l_quantity").alias("line_qty"),
                    F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("line_revenue")))
    ev = (table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("Customer_ID"))
          .agg(F.count(F.lit(1)).alias("event_count"), F.sum("value").alias("event_value")))
    out = left_chain(base, [(attrs, ["Customer_ID"]), (lines, ["Customer_ID", "snapshot_date"], True),
                            (ev, ["Customer_ID"], True)])
    return out.select("o_orderkey", "Customer_ID", "snapshot_date", "o_totalprice", "c_acctbal", "c_mktsegment",
                      F.round("line_qty", 6).alias("line_qty"), F.round("line_revenue", 6).alias("line_revenue"),
                      "event_count", F.round("event_value", 6).alias("event_value"))


@query("feature_store_outer", sql="""
WITH o AS (SELECT o_custkey AS member_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
                  CAST(count(*) AS BIGINT) AS n_orders, round(sum(o_totalprice), 6) AS order_value
           FROM orders GROUP BY 1, 2),
l AS (SELECT l_partkey AS member_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
             CAST(count(*) AS BIGINT) AS n_lines, round(sum(l_quantity), 6) AS line_qty
      FROM lineitem GROUP BY 1, 2),
e AS (SELECT user_id AS member_id, CAST(date_trunc('month', ts) AS DATE) AS snapshot_date,
             CAST(count(*) AS BIGINT) AS n_events, round(sum(value), 6) AS event_value
      FROM events GROUP BY 1, 2)
SELECT coalesce(o.member_id, l.member_id, e.member_id) AS member_id,
       coalesce(o.snapshot_date, l.snapshot_date, e.snapshot_date) AS snapshot_date,
       n_orders, order_value, n_lines, line_qty, n_events, event_value
FROM o FULL OUTER JOIN l ON o.member_id = l.member_id AND o.snapshot_date = l.snapshot_date
       FULL OUTER JOIN e ON coalesce(o.member_id, l.member_id) = e.member_id
                        AND coalesce(o.snapshot_date, l.snapshot_date) = e.snapshot_date
""")
def q_feature_store_outer(spark, sf_dir):
    """JON-2: three monthly category tables, full outer on ``(member_id, snapshot_date)``, keys kept."""
    o = (table(spark, sf_dir, "orders")
         .groupBy(F.col("o_custkey").alias("member_id"), _month("o_orderdate").alias("snapshot_date"))
         .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 6).alias("order_value")))
    li = (table(spark, sf_dir, "lineitem")
          .groupBy(F.col("l_partkey").alias("member_id"), _month("l_shipdate").alias("snapshot_date"))
          .agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 6).alias("line_qty")))
    ev = (table(spark, sf_dir, "events")
          .groupBy(F.col("user_id").alias("member_id"), _month("ts").alias("snapshot_date"))
          .agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 6).alias("event_value")))
    return outer_chain([(o, True), (li, True), (ev, True)], ["member_id", "snapshot_date"])


_TRAIN_SQL = f"""
WITH s AS ({SILVER_SQL}),
lab AS (SELECT loan_id, Customer_ID, loan_start_date, CAST(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS INTEGER) AS label,
               '30dpd_6mob' AS label_def, snapshot_date FROM s WHERE mob = 6),
feat AS (SELECT o_custkey AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
                CAST(count(*) AS BIGINT) AS n_orders, round(sum(o_totalprice), 6) AS spend
         FROM orders GROUP BY 1, 2)
"""


@query("training_set", sql=_TRAIN_SQL + f"""
SELECT lab.loan_id, lab.Customer_ID, lab.snapshot_date, lab.label, feat.n_orders, feat.spend
FROM lab LEFT JOIN feat ON lab.Customer_ID = feat.Customer_ID AND lab.snapshot_date = feat.snapshot_date
WHERE lab.snapshot_date BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'
""")
def q_training_set(spark, sf_dir):
    """MLD-1 / JON-3: windowed labels LEFT JOIN windowed customer-month features."""
    lo, hi = WINDOW
    labels = default_label(days_past_due(loan_book(spark, sf_dir)), 30, 6)
    labels = labels.where(F.col("snapshot_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
    feats = customer_months(spark, sf_dir).withColumn("spend", F.round("spend", 6))
    feats = feats.where(F.col("snapshot_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
    out = attach_features(labels, feats, ["Customer_ID", "snapshot_date"], unique=True)
    return out.select("loan_id", "Customer_ID", "snapshot_date", "label", "n_orders", "spend")


@query("feature_label_inner", sql=_TRAIN_SQL + """
, latest AS (
  SELECT Customer_ID, arg_max(snapshot_date, snapshot_date) AS snapshot_date,
         arg_max(n_orders, snapshot_date) AS n_orders, arg_max(spend, snapshot_date) AS spend
  FROM (SELECT f.*, CAST(date_trunc('month', f.snapshot_date) AS DATE) AS m FROM feat f) GROUP BY Customer_ID)
SELECT lab.loan_id, lab.Customer_ID, lab.loan_start_date, lab.label, lab.snapshot_date AS snapshot_date_x,
       latest.snapshot_date AS snapshot_date_y, latest.n_orders, latest.spend
FROM lab JOIN latest ON lab.Customer_ID = latest.Customer_ID
""")
def q_feature_label_inner(spark, sf_dir):
    """JON-4: labels INNER JOIN features on the customer, duplicate columns suffixed ``_x``/``_y``.

    The feature side is first reduced to each customer's latest month, so the join is 1:N.
    """
    labels = default_label(days_past_due(loan_book(spark, sf_dir)), 30, 6, keep_start=True)
    feats = customer_months(spark, sf_dir).withColumn("spend", F.round("spend", 6))
    out = inner_with_suffixes(labels, feats, ["Customer_ID"], latest_by="snapshot_date")
    return out.select("loan_id", "Customer_ID", "loan_start_date", "label", "snapshot_date_x",
                      "snapshot_date_y", "n_orders", "spend")


@query("feature_label_all", sql=f"""
WITH s AS ({SILVER_SQL}),
lab AS (SELECT Customer_ID, loan_start_date, loan_id, CAST(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS INTEGER) AS label, snapshot_date
        FROM s WHERE mob = 6),
one AS (SELECT * FROM lab QUALIFY row_number() OVER (PARTITION BY Customer_ID, loan_start_date ORDER BY loan_id, label, snapshot_date) = 1)
SELECT f.loan_id AS loan_id_x, one.loan_id AS loan_id_y, f.Customer_ID, f.loan_start_date, f.installment_num, f.overdue_amt,
       f.snapshot_date AS snapshot_date_x, one.snapshot_date AS snapshot_date_y, one.label
FROM s f JOIN one ON f.Customer_ID = one.Customer_ID AND f.loan_start_date = one.loan_start_date
""")
def q_feature_label_all(spark, sf_dir):
    """JON-4: every feature row INNER JOIN its label on (customer, loan start); the labels are the
    unique side (of several for a key the least row), so the join is N:1."""
    book = loan_book(spark, sf_dir)
    labels = default_label(days_past_due(book), 30, 6, keep_start=True).drop("label_def")
    feats = book.drop("due_amt")
    out = inner_with_suffixes(feats, labels, ["Customer_ID", "loan_start_date"])
    return out.select("loan_id_x", "loan_id_y", "Customer_ID", "loan_start_date", "installment_num", "overdue_amt",
                      "snapshot_date_x", "snapshot_date_y", "label")


@query("heavy_key_join", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.supplier, s.s_name, s.s_acctbal
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS supplier FROM lineitem) l
LEFT JOIN supplier s ON l.supplier = s.s_suppkey
""")
def q_heavy_key_join(spark, sf_dir):
    """JON-1 with a third of the base on one key: all line items LEFT JOIN supplier attributes."""
    li = table(spark, sf_dir, "lineitem")
    base = li.select("l_orderkey", "l_linenumber",
                     F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_suppkey")).alias("supplier"))
    side = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("supplier"), "s_name", "s_acctbal")
    return heavy_left_join(base, side, ["supplier"])
