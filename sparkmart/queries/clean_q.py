"""Cleaning and imputation queries (CLN-1..11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators.clean import (
    cap_with_flag, dedupe_keys, fill_constant, fill_mean, fill_mode, missing_flags,
    normalise_text_cols, null_sentinels, strip_numeric,
)
from sparkmart.queries.registry import query
from sparkmart.sources.tables import table

DOCS_LABELS = """(SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
                  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def docs_labels(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")


@query("null_sentinel", sql="""
SELECT o_orderkey, coalesce(CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '_______') THEN NULL
                                 ELSE o_orderpriority END, 'Unknown') AS o_orderpriority
FROM orders
""")
def q_null_sentinel(spark, sf_dir):
    """CLN-1 + CLN-5: sentinel text -> null -> ``Unknown``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    o = null_sentinels(o, {"o_orderpriority": ["4-NOT SPECIFIED", "_______"]})
    return fill_constant(o, {"o_orderpriority": "Unknown"})


@query("strip_to_int", sql="""
SELECT c_custkey,
       TRY_CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS INTEGER) AS name_number,
       TRY_CAST(regexp_replace(CAST(c_nationkey AS VARCHAR) || '_', '[^0-9]', '', 'g') AS INTEGER) AS nation_code,
       TRY_CAST(regexp_replace('-' || CAST(c_nationkey AS VARCHAR), '[^0-9]', '', 'g') AS INTEGER) AS signed_code
FROM customer
""")
def q_strip_to_int(spark, sf_dir):
    """CLN-2: dirty integer text (``"Customer#000000042"``, ``"7_"``, ``"-7"``) -> int."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("name_number"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("_")).alias("nation_code"),
        F.concat(F.lit("-"), F.col("c_nationkey").cast("string")).alias("signed_code"))
    return strip_numeric(c, int_cols=["name_number", "nation_code", "signed_code"])


_EXPONENT_SQL = "substr(o_orderkey::VARCHAR, 1, 1) || '.' || substr(o_orderkey::VARCHAR, 2) || '5E' || (length(o_orderkey::VARCHAR) - 1)::VARCHAR"


@query("strip_exponent", sql=f"""
SELECT o_orderkey, {_EXPONENT_SQL} AS raw, o_orderkey::INTEGER AS whole, CAST(o_orderkey + 0.5 AS DOUBLE) AS real,
       CAST(o_orderkey AS INTEGER) * 10 AS marked
FROM orders
""")
def q_strip_exponent(spark, sf_dir):
    """CLN-2/3: numbers written with an exponent (``"1.2345E3"``, ``"$1.234e4_"``), as doubles of 1e7 and more are."""
    key = F.col("o_orderkey").cast("string")
    digits = F.concat(F.substring(key, 1, 1), F.lit("."), F.substring(key, 2, 30))
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(digits, F.lit("5E"), (F.length(key) - 1).cast("string")).alias("raw"),
        F.concat(F.lit("$"), digits, F.lit("0e"), F.length(key).cast("string"), F.lit("_")).alias("marked"))
    o = o.withColumns({"whole": F.col("raw"), "real": F.col("raw")})
    return strip_numeric(o, int_cols=["whole", "marked"], decimal_cols=["real"])


@query("strip_to_decimal", sql="""
SELECT c_custkey,
       TRY_CAST(regexp_replace('$' || printf('%.2f', c_acctbal) || '_', '[^0-9.]', '', 'g') AS DOUBLE) AS balance,
       TRY_CAST(regexp_replace('__' || CAST(c_nationkey AS VARCHAR) || '00__', '[^0-9.]', '', 'g') AS DOUBLE) AS invested
FROM customer
""")
def q_strip_to_decimal(spark, sf_dir):
    """CLN-3: ``"$1863.84_"`` -> 1863.84, ``"__700__"`` -> 700.0 (sign dropped, as D5)."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("$"), F.format_string("%.2f", F.col("c_acctbal")), F.lit("_")).alias("balance"),
        F.concat(F.lit("__"), F.col("c_nationkey").cast("string"), F.lit("00__")).alias("invested"))
    return strip_numeric(c, decimal_cols=["balance", "invested"])


@query("cap_with_flag", sql="""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity > 20 THEN 20.0 ELSE l_quantity END AS l_quantity,
       CASE WHEN l_quantity > 20 THEN 1 ELSE 0 END AS l_quantity_Overcap_Flag
FROM lineitem
""")
def q_cap_with_flag(spark, sf_dir):
    """CLN-4: cap at 20 with an over-cap flag."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return cap_with_flag(li, "l_quantity", 20)


@query("fill_constant", sql=f"""
SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic,
       coalesce(CASE WHEN quality IS NULL THEN NULL ELSE lang END, 'MISSING') AS labelled_lang
FROM {DOCS_LABELS}
""")
def q_fill_constant(spark, sf_dir):
    """CLN-5: constants per column on the nulls a left join leaves."""
    df = docs_labels(spark, sf_dir).select(
        "doc_id", "quality", "toxic", F.when(F.col("quality").isNotNull(), F.col("lang")).alias("labelled_lang"))
    return fill_constant(df, {"quality": -1, "toxic": 0, "labelled_lang": "MISSING"})


_WIDE = "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 9007199254740993 + 2 * (o_custkey % 3) END"
_EXACT = "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey % 7 AS DECIMAL(20, 6)) + CAST('12345678901234.000001' AS DECIMAL(20, 6)) END"


@query("fill_mode_exact", sql=f"""
WITH t AS (SELECT o_orderkey, {_WIDE} AS wide, {_EXACT} AS amount FROM orders)
SELECT o_orderkey, coalesce(wide, (SELECT wide FROM t WHERE wide IS NOT NULL GROUP BY wide ORDER BY count(*) DESC, wide LIMIT 1)) AS wide,
       CAST(coalesce(amount, (SELECT amount FROM t WHERE amount IS NOT NULL GROUP BY amount ORDER BY count(*) DESC, amount LIMIT 1)) AS VARCHAR) AS amount
FROM t
""")
def q_fill_mode_exact(spark, sf_dir):
    """CLN-8: modes of whole numbers beyond 2**53 and of decimals keep every digit."""
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_WIDE).alias("wide"), F.expr(_EXACT).cast("decimal(20,6)").alias("amount"))
    return fill_mode(t, ["wide", "amount"]).withColumn("amount", F.col("amount").cast("string"))


@query("fill_all_numeric", sql=f"""
SELECT doc_id, lang, coalesce(n_chars, 0) AS n_chars, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
FROM {DOCS_LABELS}
""")
def q_fill_all_numeric(spark, sf_dir):
    """CLN-6: ``fillna(0)`` over every numeric column."""
    from sparkmart.operators.clean import fill_all_numeric
    return fill_all_numeric(docs_labels(spark, sf_dir).select("doc_id", "lang", "n_chars", "quality", "toxic"),
                            0, exclude=["doc_id"])


@query("fill_mean", sql=f"""
SELECT doc_id, coalesce(CAST(quality AS DOUBLE), (SELECT avg(quality) FROM {DOCS_LABELS})) AS quality,
       coalesce(CAST(toxic AS DOUBLE), (SELECT avg(toxic) FROM {DOCS_LABELS})) AS toxic
FROM {DOCS_LABELS}
""")
def q_fill_mean(spark, sf_dir):
    """CLN-7: null -> column mean, widened to double (D11)."""
    df = docs_labels(spark, sf_dir).select("doc_id", "quality", "toxic")
    return fill_mean(df, ["quality", "toxic"])


@query("fill_mode", sql=f"""
WITH t AS {DOCS_LABELS},
mq AS (SELECT quality AS v FROM t WHERE quality IS NOT NULL GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1),
mt AS (SELECT toxic AS v FROM t WHERE toxic IS NOT NULL GROUP BY toxic ORDER BY count(*) DESC, toxic LIMIT 1),
ml AS (SELECT lab_lang AS v FROM (SELECT CASE WHEN quality IS NOT NULL THEN lang END AS lab_lang FROM t)
       WHERE lab_lang IS NOT NULL GROUP BY lab_lang ORDER BY count(*) DESC, lab_lang LIMIT 1)
SELECT doc_id, coalesce(quality, (SELECT v FROM mq)) AS quality, coalesce(toxic, (SELECT v FROM mt)) AS toxic,
       coalesce(CASE WHEN quality IS NOT NULL THEN lang END, (SELECT v FROM ml)) AS labelled_lang
FROM t
""")
def q_fill_mode(spark, sf_dir):
    """CLN-8: null -> most frequent non-null value, smallest on ties (D9)."""
    df = docs_labels(spark, sf_dir).select(
        "doc_id", "quality", "toxic", F.when(F.col("quality").isNotNull(), F.col("lang")).alias("labelled_lang"))
    return fill_mode(df, ["quality", "toxic", "labelled_lang"])


@query("missing_flag", sql=f"""
SELECT doc_id, CAST(quality IS NULL AS INTEGER) AS quality_missing, CAST(toxic IS NULL AS INTEGER) AS toxic_missing,
       coalesce(quality, 0) AS quality
FROM {DOCS_LABELS}
""")
def q_missing_flag(spark, sf_dir):
    """CLN-9: indicator columns, then the fill."""
    df = missing_flags(docs_labels(spark, sf_dir).select("doc_id", "quality", "toxic"), ["quality", "toxic"])
    return fill_constant(df, {"quality": 0}).select("doc_id", "quality_missing", "toxic_missing", "quality")


@query("normalise_text", sql="""
SELECT p_partkey, upper(trim(coalesce('  ' || p_name || ' ', 'MISSING'))) AS p_name,
       upper(trim(coalesce(CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE lower(p_type) END, 'MISSING'))) AS p_type
FROM part
""")
def q_normalise_text(spark, sf_dir):
    """CLN-10: ``upper(trim(coalesce(x, 'MISSING')))``."""
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("p_name"),
        F.when(F.col("p_type") != "ECONOMY", F.lower("p_type")).alias("p_type"))
    return normalise_text_cols(p, ["p_name", "p_type"])


@query("dedupe_keys", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
FROM (SELECT *,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                         l_returnflag, l_linestatus, l_shipdate) AS rn
      FROM lineitem)
WHERE rn = 1
""")
def q_dedupe_keys(spark, sf_dir):
    """CLN-11: one row per ``(l_orderkey, l_linenumber)``, smallest remaining tuple survives."""
    out = dedupe_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
