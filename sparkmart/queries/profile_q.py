"""Aggregation and profiling queries (AGG-2/4/5/6/8/9/10, SRT-1/2, LIM-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators.profile import (
    distinct_values, global_stats, group_count, histogram, numeric_profile, top_k,
)
from sparkmart.queries.registry import query
from sparkmart.sources.tables import table


@query("profile", sql="""
SELECT 'c_acctbal' AS column_name, count(c_acctbal) AS count, avg(c_acctbal) AS mean, stddev_samp(c_acctbal) AS stddev,
       min(c_acctbal) AS min, quantile_disc(c_acctbal, 0.25) AS p25, quantile_disc(c_acctbal, 0.5) AS p50,
       quantile_disc(c_acctbal, 0.75) AS p75, max(c_acctbal) AS max FROM customer
UNION ALL
SELECT 'c_nationkey', count(c_nationkey), avg(c_nationkey), stddev_samp(c_nationkey), min(c_nationkey),
       quantile_disc(CAST(c_nationkey AS DOUBLE), 0.25), quantile_disc(CAST(c_nationkey AS DOUBLE), 0.5),
       quantile_disc(CAST(c_nationkey AS DOUBLE), 0.75), max(c_nationkey) FROM customer
""")
def q_profile(spark, sf_dir):
    """AGG-8: count, mean, stddev, min, quartiles, max per numeric column."""
    return numeric_profile(table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"])


@query("histogram", sql="""
WITH b AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer),
x AS (SELECT least(CAST(floor((c_acctbal - lo) / (hi - lo) * 30) AS INTEGER) + 1, 30) AS bin, lo, hi
      FROM customer, b WHERE c_acctbal IS NOT NULL)
SELECT g.bin, b.lo + (g.bin - 1) * (b.hi - b.lo) / 30 AS lower, b.lo + g.bin * (b.hi - b.lo) / 30 AS upper, count(x.bin) AS count
FROM (SELECT CAST(unnest(generate_series(1, 30)) AS INTEGER) AS bin) g CROSS JOIN b LEFT JOIN x ON g.bin = x.bin
GROUP BY g.bin, b.lo, b.hi
""")
def q_histogram(spark, sf_dir):
    """AGG-9: 30 equal-width bins of ``c_acctbal``."""
    return histogram(table(spark, sf_dir, "customer"), "c_acctbal", 30)


@query("value_counts", sql="""
SELECT p_size, count(*) AS count FROM part GROUP BY p_size
""")
def q_value_counts(spark, sf_dir):
    """AGG-10 / AGG-4."""
    return group_count(table(spark, sf_dir, "part"), "p_size")


@query("top_k", sql="""
SELECT p_name, count(*) AS count FROM part GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT 10
""")
def q_top_k(spark, sf_dir):
    """AGG-5: the ten most frequent part names (ties by name)."""
    return top_k(table(spark, sf_dir, "part"), "p_name", 10)


@query("distinct_values", sql="""
SELECT DISTINCT c_mktsegment FROM customer
""")
def q_distinct_values(spark, sf_dir):
    """AGG-2."""
    return distinct_values(table(spark, sf_dir, "customer"), "c_mktsegment")


@query("global_agg", sql="""
SELECT avg(c_acctbal) AS mean, min(c_acctbal) AS min, max(c_acctbal) AS max, count(c_acctbal) AS count FROM customer
""")
def q_global_agg(spark, sf_dir):
    """AGG-6."""
    return global_stats(table(spark, sf_dir, "customer"), "c_acctbal")


@query("sorted_limit", sql="""
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20
""")
def q_sorted_limit(spark, sf_dir):
    """SRT-2 / LIM-1: ordered top 20 with a key tie-break (``TakeOrderedAndProject``)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return c.orderBy(F.desc("c_acctbal"), F.asc("c_custkey")).limit(20)
