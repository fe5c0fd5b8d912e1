"""Derived-feature queries (FEA-5..10, ENC-1/2, FN-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.functions.dates import to_date_col
from sparkmart.operators.encode import binary_flag, ordinal_map
from sparkmart.operators.features import (
    guarded_ratio, history_months, months_since, tenure_years, term_number, valid_flag,
    whole_months_since,
)
from sparkmart.queries.registry import query
from sparkmart.sources.tables import table

# fixed values: order-priority grades and order-status codes used by ordinal_map
PRIORITY_CODES = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "5-LOW": 3}
STATUS_CODES = {"F": 0, "O": 1}


@query("ratios", sql="""
SELECT l_orderkey, l_linenumber,
       l_tax / (l_discount + 1.0) AS tax_ratio,
       l_extendedprice / (l_quantity + 1.0) AS price_per_unit,
       l_tax / nullif(l_discount, 0.0) AS tax_to_discount
FROM lineitem
""")
def q_ratios(spark, sf_dir):
    """FEA-6 / FN-15: guarded ratios, and an unguarded one where 0 -> null (D8)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     guarded_ratio("l_tax", "l_discount").alias("tax_ratio"),
                     guarded_ratio("l_extendedprice", "l_quantity").alias("price_per_unit"),
                     guarded_ratio("l_tax", "l_discount", guard=None).alias("tax_to_discount"))


# months_between(a, b) as Spark defines it: whole months when the days of month match or
# both are month ends, else month difference plus day difference / 31, rounded to 8 places
_MB = """
  CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL
       WHEN day({a}) = day({b}) OR ({a} = last_day({a}) AND {b} = last_day({b}))
       THEN CAST((year({a}) - year({b})) * 12 + month({a}) - month({b}) AS DOUBLE)
       ELSE round((year({a}) - year({b})) * 12 + month({a}) - month({b}) + (day({a}) - day({b})) / 31.0, 8) END
"""


@query("months_since", sql=f"""
WITH t AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship,
         CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE strftime(o_orderdate, '%b-%Y') END AS earliest_cr_line
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
p AS (SELECT *, CAST(try_strptime(earliest_cr_line, '%b-%Y') AS DATE) AS cr_date FROM t)
SELECT l_orderkey, l_linenumber, earliest_cr_line,
       coalesce({_MB.format(a="ship", b="cr_date")}, 999.0) AS months_since_earliest,
       CAST(date_diff('month', date_trunc('month', cr_date), date_trunc('month', ship)) AS INTEGER)
         AS whole_months_since_earliest
FROM p
""")
def q_months_since(spark, sf_dir):
    """FEA-7 / FN-9/12/13: ``MMM-yyyy`` text parsed back, fractional and whole months since."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    t = li.join(od, li.l_orderkey == od.o_orderkey).select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
         .otherwise(F.date_format("o_orderdate", "MMM-yyyy")).alias("earliest_cr_line"))
    cr = to_date_col("earliest_cr_line", "MMM-yyyy")
    return t.select("l_orderkey", "l_linenumber", "earliest_cr_line",
                    months_since(cr, F.col("ship")).alias("months_since_earliest"),
                    whole_months_since(cr, F.col("ship")).alias("whole_months_since_earliest"))


_DURATION = """CASE WHEN p_size % 5 = 0 THEN 'NA'
                    WHEN p_size < 12 THEN CAST(p_size AS VARCHAR) || ' Months'
                    WHEN p_size % 12 = 0 THEN CAST(p_size // 12 AS VARCHAR) || ' Year'
                    ELSE CAST(p_size // 12 AS VARCHAR) || ' Years and ' || CAST(p_size % 12 AS VARCHAR) || ' Months' END"""


def _duration_text():
    s = F.col("p_size")
    return (F.when(s % 5 == 0, F.lit("NA"))
             .when(s < 12, F.concat(s.cast("string"), F.lit(" Months")))
             .when(s % 12 == 0, F.concat((s / 12).cast("int").cast("string"), F.lit(" Year")))
             .otherwise(F.concat((s / 12).cast("int").cast("string"), F.lit(" Years and "),
                                 (s % 12).cast("string"), F.lit(" Months"))))


@query("duration_text", sql=f"""
WITH t AS (SELECT p_partkey, {_DURATION} AS credit_history_age FROM part)
SELECT p_partkey, credit_history_age,
       CAST(coalesce(TRY_CAST(nullif(regexp_extract(credit_history_age, '(\\d+)\\s+Years?', 1), '') AS INTEGER), 0) * 12
          + coalesce(TRY_CAST(nullif(regexp_extract(credit_history_age, '(\\d+)\\s+Months?', 1), '') AS INTEGER), 0)
         AS INTEGER) AS credit_history_months
FROM t
""")
def q_duration_text(spark, sf_dir):
    """FEA-5: ``"2 Years and 3 Months"`` -> 27, ``"1 Year"`` -> 12, ``"NA"`` -> 0."""
    p = table(spark, sf_dir, "part").select("p_partkey", _duration_text().alias("credit_history_age"))
    return p.select("p_partkey", "credit_history_age",
                    history_months("credit_history_age").alias("credit_history_months"))


@query("term_number", sql="""
SELECT p_partkey, ' ' || CAST(p_size AS VARCHAR) || ' months' AS term,
       TRY_CAST(nullif(regexp_extract(' ' || CAST(p_size AS VARCHAR) || ' months', '(\\d+)', 1), '') AS INTEGER) AS term_months
FROM part
""")
def q_term_number(spark, sf_dir):
    """FEA-9: ``" 36 months"`` -> 36."""
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" months")).alias("term"))
    return p.select("p_partkey", "term", term_number("term").alias("term_months"))


_TENURE = """CASE p_size % 7 WHEN 0 THEN '10+ years' WHEN 1 THEN '< 1 year' WHEN 2 THEN 'MISSING'
                             WHEN 3 THEN 'n/a' WHEN 4 THEN NULL WHEN 5 THEN '1 year'
                             ELSE CAST(p_size % 10 AS VARCHAR) || ' years' END"""


@query("tenure_text", sql=f"""
WITH t AS (SELECT p_partkey, {_TENURE} AS emp_length FROM part),
n AS (SELECT *, lower(trim(emp_length)) AS v FROM t)
SELECT p_partkey, emp_length,
       CAST(CASE WHEN v IS NULL THEN NULL WHEN v = '10+ years' THEN 10 WHEN v = '< 1 year' THEN 0
                 WHEN v = 'missing' THEN -1
                 WHEN contains(v, 'year') THEN coalesce(TRY_CAST(split_part(v, ' ', 1) AS INTEGER), -1)
                 ELSE -1 END AS INTEGER) AS emp_years
FROM n
""")
def q_tenure_text(spark, sf_dir):
    """FEA-10: employment-length text -> int with expressions (no Python UDF)."""
    s = F.col("p_size") % 7
    text = (F.when(s == 0, "10+ years").when(s == 1, "< 1 year").when(s == 2, "MISSING").when(s == 3, "n/a")
             .when(s == 4, F.lit(None).cast("string")).when(s == 5, "1 year")
             .otherwise(F.concat((F.col("p_size") % 10).cast("string"), F.lit(" years"))))
    p = table(spark, sf_dir, "part").select("p_partkey", text.alias("emp_length"))
    return p.select("p_partkey", "emp_length", tenure_years("emp_length").alias("emp_years"))


@query("ordinal_map", sql="""
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 3 END
         AS priority_code,
       CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS status_code
FROM orders
""")
def q_ordinal_map(spark, sf_dir):
    """ENC-1: fixed text -> code maps, unknown -> null."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", ordinal_map("o_orderpriority", PRIORITY_CODES).alias("priority_code"),
                    ordinal_map("o_orderstatus", STATUS_CODES).alias("status_code"))


@query("binary_flag", sql="""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_final,
       CASE WHEN CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END = 'R' THEN 1 ELSE 0 END AS is_returned
FROM lineitem
""")
def q_binary_flag(spark, sf_dir):
    """ENC-2: two-valued text -> 0/1, null -> 0."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("rf"))
    return li.select("l_orderkey", "l_linenumber", binary_flag("l_linestatus", "F").alias("is_final"),
                     binary_flag("rf", "R").alias("is_returned"))


@query("valid_flag", sql="""
SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL THEN 1 ELSE 0 END AS has_valid_quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_valid_flag(spark, sf_dir):
    """FEA-8: present-and-not-NaN flag."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    j = d.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return j.select("doc_id", valid_flag("quality").alias("has_valid_quality"))
