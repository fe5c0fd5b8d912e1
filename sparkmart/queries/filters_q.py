"""Filter queries (FLT-1/2/3/5/6/8, LBL-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators.filters import (
    in_month, in_month_half_open, in_month_range, in_months, not_null, plausible,
)
from sparkmart.operators.labels import grade_labels
from sparkmart.queries.registry import query
from sparkmart.sources.tables import table

OUT = "o_orderkey, o_custkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("snapshot_date"))


def _out(df):
    return df.select("o_orderkey", "o_custkey", "o_totalprice", "snapshot_date")


@query("snapshot_eq", sql=f"""
SELECT {OUT} FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-07-01' AND o_orderdate < TIMESTAMP '1998-08-01'
""")
def q_snapshot_eq(spark, sf_dir):
    """FLT-1: one monthly snapshot, as a range on the stored timestamp (pushed to the scan)."""
    return _out(_orders(spark, sf_dir).where(in_month("o_orderdate", "1998-07-01")))


@query("closed_range", sql=f"""
SELECT * FROM (SELECT {OUT} FROM orders) WHERE snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1997-06-01'
""")
def q_closed_range(spark, sf_dir):
    """FLT-2."""
    return _out(_orders(spark, sf_dir).where(in_month_range("o_orderdate", "1997-01-01", "1997-06-01")))


@query("half_open_range", sql=f"""
SELECT * FROM (SELECT {OUT} FROM orders) WHERE snapshot_date >= DATE '1997-01-01' AND snapshot_date < DATE '1997-06-01'
""")
def q_half_open_range(spark, sf_dir):
    """FLT-3."""
    return _out(_orders(spark, sf_dir).where(in_month_half_open("o_orderdate", "1997-01-01", "1997-06-01")))


@query("date_in_list", sql=f"""
SELECT * FROM (SELECT {OUT} FROM orders)
WHERE snapshot_date IN (DATE '1996-02-01', DATE '1998-12-01', DATE '2000-02-01')
""")
def q_date_in_list(spark, sf_dir):
    """FLT-5."""
    return _out(_orders(spark, sf_dir).where(in_months("o_orderdate", ["1996-02-01", "1998-12-01", "2000-02-01"])))


@query("range_filter", sql="""
SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 18 AND 40
""")
def q_range_filter(spark, sf_dir):
    """FLT-6: plausibility range (as the 18..100 age rule), on ``p_size``."""
    return plausible(table(spark, sf_dir, "part"), "p_size", 18, 40).select("p_partkey", "p_name", "p_size")


@query("not_null_filter", sql="""
SELECT d.doc_id AS id, DATE '2024-01-01' AS snapshot_date, CAST(l.quality AS VARCHAR) AS grade
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL
""")
def q_not_null_filter(spark, sf_dir):
    """FLT-8 / LBL-2: grade label store from documents with a (nullable) quality grade."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("id"), F.lit("2024-01-01").alias("snapshot_date"),
        F.col("quality").cast("string").alias("grade"))
    return not_null(grade_labels(j, "id", "grade"), "grade")
