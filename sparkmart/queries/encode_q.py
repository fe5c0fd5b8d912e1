"""Encoder queries (ENC-3..7, AGG-3/4/5, FN-6/7/16/17).

Encoded frames are wide and data-dependent in width; the queries return them unpivoted to
``(key, feature, value)`` so the oracle can be written without knowing the width.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators.clean import normalise_text_cols
from sparkmart.operators.encode import (
    expand_indexed, fit_indexed_one_hot, fit_list_vocabulary, fit_vocabulary, multi_hot, one_hot,
    top_k_bucket, wide_to_long,
)
from sparkmart.operators.profile import array_distinct_values
from sparkmart.queries.registry import query
from sparkmart.sources.tables import table


def _encoded(df, keys, prefix):
    cols = [c for c in df.columns if c.startswith(prefix)]
    return wide_to_long(df.select(*keys, *cols), keys, cols)


@query("one_hot", sql="""
WITH v AS (SELECT DISTINCT c_mktsegment AS seg FROM customer WHERE c_mktsegment IS NOT NULL AND trim(c_mktsegment) <> '')
SELECT c.c_custkey, 'c_mktsegment_' || lower(replace(replace(trim(v.seg), ' ', '_'), '-', '_')) AS feature,
       CASE WHEN c.c_mktsegment = v.seg THEN 1 ELSE 0 END AS value
FROM customer c CROSS JOIN v
""")
def q_one_hot(spark, sf_dir):
    """ENC-3: one 0/1 column per market segment (vocabulary fitted once, size-checked)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    vocab = fit_vocabulary(c, "c_mktsegment")
    return _encoded(one_hot(c, "c_mktsegment", vocab), ["c_custkey"], "c_mktsegment_")


_FLAG_LISTS = """(SELECT l_orderkey AS o_orderkey,
                         string_agg(DISTINCT CASE WHEN l_linestatus = 'F' THEN 'and ' || l_returnflag ELSE l_returnflag END,
                                    ', ' ORDER BY CASE WHEN l_linestatus = 'F' THEN 'and ' || l_returnflag ELSE l_returnflag END)
                           AS flags
                  FROM lineitem GROUP BY l_orderkey)"""


def _flag_lists(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    item = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("and "), F.col("l_returnflag"))).otherwise(F.col("l_returnflag"))
    return (li.groupBy(F.col("l_orderkey").alias("o_orderkey"))
              .agg(F.concat_ws(", ", F.array_sort(F.collect_set(item))).alias("flags")))


@query("multi_hot", sql=f"""
WITH t AS {_FLAG_LISTS},
v AS (SELECT DISTINCT item FROM (SELECT unnest(string_split_regex(flags, ',\\s*')) AS item FROM t)
      WHERE item IS NOT NULL AND trim(item) <> '')
SELECT t.o_orderkey, 'loan_type_' || lower(replace(replace(trim(v.item), ' ', '_'), '-', '_')) AS feature,
       CASE WHEN list_contains(string_split_regex(t.flags, ',\\s*'), v.item) THEN 1 ELSE 0 END AS value
FROM t CROSS JOIN v
""")
def q_multi_hot(spark, sf_dir):
    """ENC-4: multi-hot of a comma list (each order's return flags; ``"and X"`` kept as its own item, D13)."""
    t = _flag_lists(spark, sf_dir)
    vocab = fit_list_vocabulary(t, "flags")
    return _encoded(multi_hot(t, "flags", vocab, prefix="loan_type"), ["o_orderkey"], "loan_type_")


@query("list_items", sql=f"""
SELECT DISTINCT item AS value FROM (SELECT unnest(string_split_regex(flags, ',\\s*')) AS item FROM {_FLAG_LISTS})
WHERE item IS NOT NULL
""")
def q_list_items(spark, sf_dir):
    """AGG-3 / FN-6: distinct elements across a split list column."""
    t = _flag_lists(spark, sf_dir).select(F.split("flags", r",\s*").alias("arr"))
    return array_distinct_values(t, "arr")


_INDEX = """(SELECT {c} AS val, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER) AS idx
             FROM {t} WHERE {c} IS NOT NULL GROUP BY {c})"""


@query("indexed_one_hot", sql=f"""
WITH v AS {_INDEX.format(c="p_brand", t="part")},
slots AS (SELECT unnest(range(0, (SELECT count(*) FROM v))) AS slot)
SELECT p.p_partkey, 'p_brand_' || CAST(slots.slot AS VARCHAR) AS feature,
       CAST(CASE WHEN v.idx = slots.slot THEN 1 ELSE 0 END AS DOUBLE) AS value
FROM part p LEFT JOIN v ON p.p_brand = v.val CROSS JOIN slots
""")
def q_indexed_one_hot(spark, sf_dir):
    """ENC-5: StringIndexer(keep) + OneHotEncoder(dropLast) on ``p_brand``; width from the fitted model."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    model, widths = fit_indexed_one_hot(p, ["p_brand"], drop_last=True)
    return _encoded(expand_indexed(model, widths, p), ["p_partkey"], "p_brand_")


@query("indexed_one_hot_full", sql=f"""
WITH p AS (SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_type END AS p_type FROM part),
v AS {_INDEX.format(c="p_type", t="p")},
n AS (SELECT count(*) AS k FROM v),
slots AS (SELECT unnest(range(0, (SELECT k FROM n) + 1)) AS slot)
SELECT p.p_partkey, 'p_type_' || CAST(slots.slot AS VARCHAR) AS feature,
       CAST(CASE WHEN coalesce(v.idx, (SELECT k FROM n)) = slots.slot THEN 1 ELSE 0 END AS DOUBLE) AS value
FROM p LEFT JOIN v ON p.p_type = v.val CROSS JOIN slots
""")
def q_indexed_one_hot_full(spark, sf_dir):
    """ENC-6: ``dropLast=False``: nulls land in the extra last slot."""
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("p_type"))
    model, widths = fit_indexed_one_hot(p, ["p_type"], drop_last=False)
    return _encoded(expand_indexed(model, widths, p), ["p_partkey"], "p_type_")


@query("topk_bucket", sql="""
WITH p AS (SELECT p_partkey, upper(trim(coalesce(p_name, 'MISSING'))) AS p_name FROM part),
top AS (SELECT p_name FROM p GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT 10),
l AS (SELECT p_partkey, CASE WHEN p_name IN (SELECT p_name FROM top) THEN p_name ELSE 'OTHER' END AS lim FROM p),
v AS (SELECT lim AS val, CAST(row_number() OVER (ORDER BY count(*) DESC, lim) - 1 AS INTEGER) AS idx FROM l GROUP BY lim),
slots AS (SELECT unnest(range(0, (SELECT count(*) FROM v))) AS slot)
SELECT l.p_partkey, 'p_name_limited_' || CAST(slots.slot AS VARCHAR) AS feature,
       CAST(CASE WHEN v.idx = slots.slot THEN 1 ELSE 0 END AS DOUBLE) AS value
FROM l JOIN v ON l.lim = v.val CROSS JOIN slots
""")
def q_topk_bucket(spark, sf_dir):
    """ENC-7 / AGG-4/5: normalise, keep the top 10 names, rest ``OTHER``, then indexed one-hot (11 columns)."""
    p = normalise_text_cols(table(spark, sf_dir, "part").select("p_partkey", "p_name"), ["p_name"])
    p = top_k_bucket(p, "p_name", k=10).select("p_partkey", "p_name_limited")
    model, widths = fit_indexed_one_hot(p, ["p_name_limited"], drop_last=True)
    return _encoded(expand_indexed(model, widths, p), ["p_partkey"], "p_name_limited_")
