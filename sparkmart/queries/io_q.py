"""Source/sink queries (SRC-1..9, SNK-1..9): write to the shared folder, read back.

Every write goes under ``spark.checkpoint.dir`` (the cluster's shared folder), into a fresh
path per run.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.queries.model_q import _metric_runs, _order_scores, loan_labels
from sparkmart.queries.registry import query
from sparkmart.session import scratch_path
from sparkmart.sources.readers import (
    read_csv, read_csv_checked, read_metrics, read_predictions, read_snapshot, read_store, read_window,
)
from sparkmart.sources.tables import table
from sparkmart.sources.writers import append_rows, write_bucketed, write_predictions, write_snapshots

CUSTOMER_CSV = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()),
])


@query("csv_landing", sql="""
SELECT c_mktsegment, count(*) AS rows, round(sum(c_acctbal), 2) AS total_acctbal, CAST(sum(c_nationkey) AS BIGINT) AS nation_sum
FROM customer GROUP BY c_mktsegment
""")
def q_csv_landing(spark, sf_dir):
    """SNK-1 / SRC-1/2: land ``customer`` as partitioned CSV, read back with an explicit schema."""
    path = scratch_path(spark, "bronze_customer")
    write_snapshots(table(spark, sf_dir, "customer"), path, partition_cols=("c_mktsegment",), fmt="csv")
    schema = CUSTOMER_CSV.add("c_mktsegment", T.StringType())
    back = read_csv(spark, path, schema)
    return back.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("c_acctbal"), 2).alias("total_acctbal"),
        F.sum("c_nationkey").alias("nation_sum"))


_MONTHLY = "(SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date FROM orders)"


@query("write_read_roundtrip", sql=f"""
SELECT snapshot_date, count(*) AS rows FROM {_MONTHLY}
WHERE snapshot_date <> DATE '1998-07-01' OR o_orderstatus = 'F'
GROUP BY snapshot_date
""")
def q_write_read_roundtrip(spark, sf_dir):
    """SNK-2/4/5 + SRC-3..7: write every monthly snapshot, rewrite one (dynamic overwrite), read back.

    Also exercises a one-snapshot read (partition pruning) and a window read; their counts
    must agree with the full read, or the query fails.
    """
    o = table(spark, sf_dir, "orders").withColumn("snapshot_date", F.trunc(F.col("o_orderdate").cast("date"), "MM"))
    root = scratch_path(spark, "silver_orders")
    write_snapshots(o, root, sort_by=("o_orderkey",))
    month = o.where(F.col("snapshot_date") == F.lit("1998-07-01").cast("date"))
    write_snapshots(month.where(F.col("o_orderstatus") == "F"), root)
    write_snapshots(month.limit(0), root)  # empty rewrite: removes nothing (D1)
    one = read_snapshot(spark, root, "1998-07-01").count()
    win = read_window(spark, root, "1998-07-01", "1998-07-01").count()
    lst = read_window(spark, root, dates=["1998-07-01"]).count()
    if not (one == win == lst):
        raise AssertionError(f"snapshot reads disagree: {one} {win} {lst}")
    return read_store(spark, root).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows"))


@query("metrics_append", sql="""
SELECT 'model_' || o_orderpriority AS model_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS created_at,
       round(avg(o_totalprice) / 600000.0, 6) AS auc_score,
       round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS f1_score,
       round(avg(CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS accuracy
FROM orders GROUP BY ALL
""")
def q_metrics_append(spark, sf_dir):
    """SNK-8 / SRC-8: two appends of run rows to the metrics log, read back newest first."""
    runs = _metric_runs(spark, sf_dir)
    root = scratch_path(spark, "metrics")
    append_rows(runs.where(F.col("created_at") < F.lit("1998-01-01").cast("date")), root)
    append_rows(runs.where(F.col("created_at") >= F.lit("1998-01-01").cast("date")), root)
    return read_metrics(spark, root).withColumns({c: F.round(c, 6) for c in ("auc_score", "f1_score", "accuracy")})


@query("prediction_store", sql="""
WITH s AS (SELECT l.l_orderkey AS loan_id, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS snapshot_date
           FROM lineitem l WHERE l.l_linenumber = 6),
p AS (SELECT s.loan_id, s.snapshot_date, o.o_totalprice / (o.o_totalprice + 150000.0) AS score
      FROM s JOIN orders o ON s.loan_id = o.o_orderkey)
SELECT snapshot_date, count(*) AS rows, round(avg(score), 9) AS mean_score FROM p GROUP BY snapshot_date
""")
def q_prediction_store(spark, sf_dir):
    """SNK-7 / SRC-9: predictions written by ``(model_name, snapshot_date)``, one model read back."""
    labels = loan_labels(spark, sf_dir).select("loan_id", "snapshot_date")
    preds = labels.join(_order_scores(spark, sf_dir), "loan_id")
    root = scratch_path(spark, "predictions")
    write_predictions(preds, root)
    back = read_predictions(spark, root, model_name="price_model")
    return back.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows"),
                                             F.round(F.avg("score"), 9).alias("mean_score"))


@query("csv_quarantine", sql="""
SELECT CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN 'rejected' ELSE 'landed' END AS kind, count(*) AS rows,
       CAST(sum(CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 THEN c_nationkey END) AS BIGINT) AS nation_sum
FROM customer GROUP BY 1
""")
def q_csv_quarantine(spark, sf_dir):
    """SRC-1: malformed numbers and short lines go to the reject table; every line is landed or rejected."""
    path, key = scratch_path(spark, "quarantine"), F.col("c_custkey")
    bad = F.when(key % 7 == 0, F.lit("12x")).otherwise(F.col("c_nationkey").cast("string"))
    line = F.concat_ws(",", key.cast("string"), F.col("c_acctbal").cast("string"), F.when(key % 11 != 0, bad))
    c = table(spark, sf_dir, "customer").select(line.alias("line")).repartition(3)
    c.sparkSession.createDataFrame([("c_custkey,c_acctbal,c_nationkey",)], "line string").write.text(f"{path}/header")
    c.write.text(f"{path}/body")
    lines = spark.read.text([f"{path}/header", f"{path}/body"])
    # one file with one header line, as an extract has
    lines.orderBy(F.when(F.col("value").startswith("c_custkey"), 0).otherwise(1)).coalesce(1).write.text(f"{path}/extract")
    rows, rejects = read_csv_checked(spark, f"{path}/extract", "c_custkey long, c_acctbal double, c_nationkey int")
    landed = rows.agg(F.lit("landed").alias("kind"), F.count(F.lit(1)).alias("rows"), F.sum("c_nationkey").alias("nation_sum"))
    return landed.unionByName(rejects.agg(F.lit("rejected").alias("kind"), F.count(F.lit(1)).alias("rows"), F.lit(None).cast("long").alias("nation_sum")))


def bucketed_stores(spark, sf_dir, buckets=16):
    """Customer-month orders and customer-month lines as two co-located stores."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    month = lambda c: F.trunc(F.col(c).cast("date"), "MM").alias("snapshot_date")
    spend = o.groupBy(F.col("o_custkey").alias("Customer_ID"), month("o_orderdate")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spend"))
    lines = (li.join(o, li.l_orderkey == o.o_orderkey).groupBy(F.col("o_custkey").alias("Customer_ID"), month("l_shipdate"))
             .agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")))
    out = []
    for name, df in (("spend", spend), ("lines", lines)):
        path = scratch_path(spark, f"bucketed_{name}")
        out.append(write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), path, ["Customer_ID", "snapshot_date"], buckets))
    return out


@query("bucketed_join", sql="""
WITH s AS (SELECT o_custkey AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, count(*) AS n_orders,
                  round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY 1, 2),
l AS (SELECT o_custkey AS Customer_ID, CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date, count(*) AS n_lines,
             round(sum(l_quantity), 2) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT Customer_ID, snapshot_date, n_orders, spend, n_lines, quantity FROM s FULL JOIN l USING (Customer_ID, snapshot_date)
""")
def q_bucketed_join(spark, sf_dir):
    """SNK-2..6, JON-1/2: two stores bucketed by (Customer_ID, snapshot_date), joined without an exchange."""
    spend, lines = bucketed_stores(spark, sf_dir)
    return spend.join(lines, ["Customer_ID", "snapshot_date"], "full")
