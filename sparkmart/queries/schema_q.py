"""Projection and schema queries (PRJ-1..11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators.schema import (
    cast_to_double, enforce_schema, schema_audit, select_numeric, select_prefix,
)
from sparkmart.queries.registry import query
from sparkmart.sources.tables import table


@query("enforce_schema", sql="""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, o_orderstatus,
       CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_code
FROM orders
""")
def q_enforce_schema(spark, sf_dir):
    """PRJ-6: a ``{column: type}`` map applied as one projection of ``try_cast``."""
    o = table(spark, sf_dir, "orders").withColumn("priority_code", F.substring("o_orderpriority", 1, 1))
    return enforce_schema(o, {"o_orderkey": "string", "o_totalprice": "double", "o_orderdate": "date",
                              "o_orderpriority": "int", "priority_code": "int"})


@query("enforce_schema_lenient", sql="""
SELECT c_custkey, c_name, TRY_CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def q_enforce_schema_lenient(spark, sf_dir):
    """PRJ-7: the same, skipping schema entries whose column is absent."""
    return enforce_schema(table(spark, sf_dir, "customer"),
                          {"c_nationkey": "bigint", "annual_inc": "double", "emp_title": "string"}, strict=False)


@query("cast_numeric", sql="""
SELECT c_custkey, TRY_CAST(c_name AS DOUBLE) AS c_name, CAST(c_nationkey AS DOUBLE) AS c_nationkey,
       c_acctbal, TRY_CAST(c_mktsegment AS DOUBLE) AS c_mktsegment
FROM customer
""")
def q_cast_numeric(spark, sf_dir):
    """PRJ-8: every non-key column to double."""
    return cast_to_double(table(spark, sf_dir, "customer"), ["c_custkey"])


@query("schema_audit", sql="""
SELECT 'c_name' AS column_name, 'string' AS data_type, count(c_name) AS non_null,
       count(*) FILTER (WHERE c_name IS NOT NULL AND TRY_CAST(c_name AS DOUBLE) IS NULL) AS not_numeric FROM customer
UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey),
       count(*) FILTER (WHERE c_nationkey IS NOT NULL AND TRY_CAST(c_nationkey AS DOUBLE) IS NULL) FROM customer
UNION ALL SELECT 'c_acctbal', 'double', count(c_acctbal),
       count(*) FILTER (WHERE c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DOUBLE) IS NULL) FROM customer
UNION ALL SELECT 'c_mktsegment', 'string', count(c_mktsegment),
       count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND TRY_CAST(c_mktsegment AS DOUBLE) IS NULL) FROM customer
UNION ALL SELECT 'code', 'string', count(code),
       count(*) FILTER (WHERE code IS NOT NULL AND TRY_CAST(code AS DOUBLE) IS NULL)
  FROM (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_nationkey AS VARCHAR) || '_' ELSE CAST(c_nationkey AS VARCHAR) END AS code FROM customer)
""")
def q_schema_audit(spark, sf_dir):
    """PRJ-11: per column, values present that do not read as numbers."""
    c = table(spark, sf_dir, "customer").withColumn(
        "code", F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.col("c_nationkey").cast("string"), F.lit("_")))
                 .otherwise(F.col("c_nationkey").cast("string")))
    return schema_audit(c, keys=["c_custkey"])


@query("select_by_type", sql="""
SELECT p_partkey, p_size, p_retailprice FROM part
""")
def q_select_by_type(spark, sf_dir):
    """PRJ-9: keep the numeric columns."""
    return select_numeric(table(spark, sf_dir, "part"), keep=["p_partkey"])


@query("select_by_prefix", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount FROM lineitem
""")
def q_select_by_prefix(spark, sf_dir):
    """PRJ-10: keys plus columns with a name prefix (here the renamed ``fe_`` price features)."""
    li = table(spark, sf_dir, "lineitem").withColumnsRenamed(
        {"l_extendedprice": "fe_extendedprice", "l_discount": "fe_discount"})
    out = select_prefix(li, "fe_", keep=["l_orderkey", "l_linenumber"])
    return out.withColumnsRenamed({"fe_extendedprice": "l_extendedprice", "fe_discount": "l_discount"})


@query("select_drop_rename", sql="""
SELECT c_custkey AS Customer_ID, c_nationkey, c_acctbal AS balance, c_mktsegment AS segment,
       'customer_v1' AS source_tag, 'segment_model_' || c_mktsegment AS model_name
FROM customer
""")
def q_select_drop_rename(spark, sf_dir):
    """PRJ-1..5: drop PII (``c_name``), rename, add literal and formatted tag columns."""
    c = table(spark, sf_dir, "customer").drop("c_name", "not_a_column")
    c = c.withColumnsRenamed({"c_custkey": "Customer_ID", "c_acctbal": "balance", "c_mktsegment": "segment"})
    return c.select("Customer_ID", "c_nationkey", "balance", "segment",
                    F.lit("customer_v1").alias("source_tag"),
                    F.format_string("segment_model_%s", F.col("segment")).alias("model_name"))
