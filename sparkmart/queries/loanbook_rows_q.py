"""Loan-book mart, row by row: silver of every column from a directory of CSV extracts (PIP-8, PIP-9), gold
processors (PIP-10), and a second window encoded by the first window's saved stages (PIP-12).

One-hot columns are compared by their slot: the number of the column that is 1, null if none is.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators.joins import outer_chain
from sparkmart.plans import loanbook_mart as lm
from sparkmart.queries.loanbook_q import KEYS, _base, raw_extracts
from sparkmart.queries.loanbook_sql import _PROLOGUE
from sparkmart.queries.registry import query
from sparkmart.session import scratch_path

SECOND = "1996-01-01"  # first month of the second window

# Every imputed or cast column of the credit and financial extracts, by one rule from its place in the list.
CREDIT = [*lm.CREDIT_FILL_MODE, *lm.CREDIT_FILL_NEG1, *lm.CREDIT_FILL_ZERO]
FINANCIAL = [c for c in [*lm.FIN_DOUBLES, *lm.FIN_INTS] if not c.endswith("_missing")]


def _rule(i: int, whole: bool) -> str:
    """A value with nulls; written so that both engines read it alike."""
    value = f"((first_key * {i + 2} + n_lines + {i}) % {5 + i % 19})"
    return f"CASE WHEN (first_key + {3 * i}) % 7 = {i % 7} THEN NULL ELSE {value if whole else value + ' / 4.0'} END"


def _slot(df, col, names=None):
    """The number of the hot column among ``{col}_0, {col}_1, ...``."""
    hot = [c for c in df.columns if c.startswith(names or f"{col}_") and c[len(names or f"{col}_"):].isdigit()]
    hot.sort(key=lambda c: int(c.rsplit("_", 1)[1]))
    at = F.array_position(F.array(*[F.col(c) for c in hot]), F.lit(1.0))
    return F.when(at > 0, at - 1).alias(f"{col}_slot")


def _silver_sql() -> str:
    def mode(t, c):
        return f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"

    raw_c = ", ".join(f"{_rule(i, True)} AS {c}" for i, c in enumerate(CREDIT))
    raw_f = ", ".join(f"{_rule(i, c in lm.FIN_INTS)} AS {c}" for i, c in enumerate(FINANCIAL))
    cols = [f"CAST(coalesce(c.{c}, {mode('rc', c)}) AS INTEGER) AS {c}" for c in lm.CREDIT_FILL_MODE]
    cols += [f"CAST(coalesce(c.{c}, -1) AS INTEGER) AS {c}" for c in lm.CREDIT_FILL_NEG1]
    cols += [f"CAST(coalesce(c.{c}, 0) AS INTEGER) AS {c}" for c in lm.CREDIT_FILL_ZERO]
    cols += ["CAST(c.mort_acc IS NULL AS INTEGER) AS mort_acc_missing"]
    for c in FINANCIAL:
        t = "INTEGER" if c in lm.FIN_INTS else "DOUBLE"
        fill = "-1" if c in lm.FIN_FILL_NEG1 and c not in lm.FIN_FILL_ZERO else "0" if c in lm.FIN_FILL_ZERO else None
        x = f"round(coalesce(f.{c}, (SELECT avg({c}) FROM rf)), 9)" if c == "dti" else f"coalesce(f.{c}, {fill})" if fill else f"f.{c}"
        cols.append(f"CAST({x} AS {t}) AS {c}")
        if c in lm.FIN_FLAG:
            cols.append(f"CAST(f.{c} IS NULL AS INTEGER) AS {c}_missing")
    return _PROLOGUE + f""",
rc AS (SELECT member_id, snapshot_date, {raw_c} FROM b),
rf AS (SELECT member_id, snapshot_date, {raw_f} FROM b)
SELECT member_id, snapshot_date, {', '.join(cols)}
FROM rc c JOIN rf f USING (member_id, snapshot_date)
"""


@query("loanbook_silver_csv", sql=_silver_sql())
def q_loanbook_silver_csv(spark, sf_dir):
    """PIP-8/9: four CSV extracts in a directory -> silver stores; every credit and financial column of every row."""
    root = scratch_path(spark, "loanbook_csv")
    b = _base(spark, sf_dir)
    keys = ["member_id", F.col("snapshot_date").cast("string").alias("snapshot_date")]
    raw = raw_extracts(spark, sf_dir, b)
    raw["credit_history"] = b.select(*keys, F.date_format("snapshot_date", "MMM-yyyy").alias("earliest_cr_line"), F.lit("x").alias("last_credit_pull_d"),
                                     *[F.expr(_rule(i, True)).alias(c) for i, c in enumerate(CREDIT)])
    raw["financial"] = b.select(*keys, F.lit("x").alias("dti_joint"), *[F.expr(_rule(i, c in lm.FIN_INTS)).alias(c) for i, c in enumerate(FINANCIAL)])
    for category, df in raw.items():
        df.write.option("header", True).csv(f"{root}/raw/features_{category}.csv")
    lm.silver_from_directory(spark, f"{root}/raw", f"{root}/silver")
    credit, fin = (spark.read.parquet(f"{root}/silver/{c}") for c in ("credit_history", "financial"))
    out = credit.drop("earliest_cr_line", "months_since_earliest_cr_line").join(fin.withColumn("dti", F.round("dti", 9)), KEYS)
    return out.select(*KEYS, *[c for c in out.columns if c not in KEYS])


def _slot_sql(frame: str, col: str, where: str = "true", keep: bool = False) -> str:
    """Per row of ``frame``: the slot of ``col`` by its counts in the rows of ``where``."""
    labels = f"(SELECT {col} AS v, row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS i FROM {frame} WHERE {where} AND {col} IS NOT NULL GROUP BY {col})"
    found = f"(SELECT i FROM {labels} x WHERE x.v = t.{col})"
    return f"coalesce({found}, (SELECT count(*) FROM {labels}))" if keep else found


@query("loanbook_gold", sql=_PROLOGUE + f""",
d AS (SELECT member_id, snapshot_date, annual_inc, {', '.join(f"{_slot_sql('dm', c)} AS {c}_slot" for c in lm.GOLD_DEMO_OHE)} FROM dm t),
l AS (SELECT member_id, snapshot_date, CAST(trim(replace(term, 'months', '')) AS INTEGER) AS term,
             CASE grade WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 END AS grade, loan_amnt,
             {', '.join(f"{_slot_sql('lt', c)} AS {c}_slot" for c in lm.GOLD_TERMS_OHE)} FROM lt t)
SELECT member_id, snapshot_date, annual_inc, home_ownership_slot, verification_status_slot, application_type_slot, term, grade, loan_amnt,
       purpose_slot, loan_status_slot, round(dti, 9) AS dti, CAST(open_acc AS DOUBLE) AS open_acc, pub_rec, mort_acc,
       (SELECT count(*) FROM cr) AS audited
FROM keys LEFT JOIN d USING (member_id, snapshot_date) LEFT JOIN l USING (member_id, snapshot_date)
          LEFT JOIN fi USING (member_id, snapshot_date) LEFT JOIN cr USING (member_id, snapshot_date)
""")
def q_loanbook_gold(spark, sf_dir):
    """PIP-10: the four gold processors over the stored silver, every row of their stores."""
    root = scratch_path(spark, "loanbook_gold")
    lm.silver_processing(raw_extracts(spark, sf_dir), f"{root}/silver")
    audit = lm.gold_processing(spark, f"{root}/silver", f"{root}/gold", stages_root=f"{root}/stages")
    demo, terms, fin, credit = (spark.read.parquet(f"{root}/gold/{c}") for c in ("demographic", "loan_terms", "financial", "credit_history"))
    frames = [terms.select(*KEYS, "term", "grade", "loan_amnt", *[_slot(terms, c) for c in lm.GOLD_TERMS_OHE]),
              demo.select(*KEYS, "annual_inc", *[_slot(demo, c) for c in lm.GOLD_DEMO_OHE]),
              fin.select(*KEYS, F.round("dti", 9).alias("dti"), "open_acc"), credit.select(*KEYS, "pub_rec", "mort_acc")]
    audited = audit.where("column_name = 'pub_rec'").first()["non_null"]
    return outer_chain(frames, KEYS).withColumn("audited", F.lit(audited).cast("long"))


_FIRST = f"snapshot_date < DATE '{SECOND}'"


@query("loanbook_second_window", sql=_PROLOGUE + f""",
m AS (SELECT (SELECT pub_raw FROM cr0 WHERE {_FIRST} AND pub_raw IS NOT NULL GROUP BY pub_raw ORDER BY count(*) DESC, pub_raw LIMIT 1) AS pub,
             (SELECT delinq_raw FROM cr0 WHERE {_FIRST} AND delinq_raw IS NOT NULL GROUP BY delinq_raw ORDER BY count(*) DESC, delinq_raw LIMIT 1) AS delinq,
             (SELECT avg(dti_raw) FROM fi0 WHERE {_FIRST}) AS dti),
t1 AS (SELECT emp_title FROM dm0 WHERE {_FIRST} GROUP BY emp_title ORDER BY count(*) DESC, emp_title LIMIT 10),
d2 AS (SELECT *, CASE WHEN emp_title IN (SELECT emp_title FROM t1) THEN emp_title ELSE 'OTHER' END AS title FROM dm0),
d AS (SELECT member_id, snapshot_date, {_slot_sql('d2', 'title', _FIRST)} AS emp_title_slot,
             {', '.join(f"{_slot_sql('d2', c, _FIRST)} AS {c}_slot" for c in lm.DEMO_OHE)} FROM d2 t),
l AS (SELECT member_id, snapshot_date, {', '.join(f"{_slot_sql('lt', c, _FIRST, keep=True)} AS {c}_slot" for c in lm.TERMS_OHE)} FROM lt t)
SELECT member_id, snapshot_date, CAST(CASE WHEN cr0.member_id IS NOT NULL THEN coalesce(pub_raw, m.pub) END AS INTEGER) AS pub_rec,
       CAST(CASE WHEN cr0.member_id IS NOT NULL THEN coalesce(delinq_raw, m.delinq) END AS INTEGER) AS delinq_2yrs, round(coalesce(dti_raw, m.dti), 9) AS dti,
       emp_title_slot, {', '.join(f'{c}_slot' for c in [*lm.DEMO_OHE, *lm.TERMS_OHE])}
FROM keys LEFT JOIN cr0 USING (member_id, snapshot_date) LEFT JOIN fi0 USING (member_id, snapshot_date)
          LEFT JOIN d USING (member_id, snapshot_date) LEFT JOIN l USING (member_id, snapshot_date), m
WHERE snapshot_date >= DATE '{SECOND}'
""")
def q_loanbook_second_window(spark, sf_dir):
    """PIP-8/12: the months from ``SECOND`` on, imputed and encoded by the stages saved for the months before."""
    root = scratch_path(spark, "loanbook_windows")
    raw, day = raw_extracts(spark, sf_dir), F.lit(SECOND).cast("date")
    for name, month in (("first", F.col("snapshot_date").cast("date") < day), ("second", F.col("snapshot_date").cast("date") >= day)):
        lm.silver_processing({c: df.where(month) for c, df in raw.items()}, f"{root}/{name}", stages_root=f"{root}/stages")
        lm.feature_store(spark, f"{root}/{name}", f"{root}/store", stages_root=f"{root}/stages")
    store = spark.read.parquet(f"{root}/store").where(F.col("snapshot_date") >= day)
    return store.select(*KEYS, "pub_rec", "delinq_2yrs", F.round("dti", 9).alias("dti"),
                        *[_slot(store, c, f"{c}_ohe_") for c in ["emp_title", *lm.DEMO_OHE]], *[_slot(store, c) for c in lm.TERMS_OHE])
