"""Oracle SQL (DuckDB) for the ``loanbook_mart`` query: every feature column recomputed."""

from __future__ import annotations


def _num(frame: str, col: str, expr: str | None = None) -> str:
    x = expr or col
    return (f"SELECT 'feature_store' AS table_name, '{col}' AS feature, count({x}) AS n, "
            f"round(sum(CAST({x} AS DOUBLE)), 3) AS total, min(CAST({x} AS DOUBLE)) AS lo, "
            f"max(CAST({x} AS DOUBLE)) AS hi FROM {frame}")


def _onehot(frame: str, col: str, prefix: str, drop_last: bool) -> str:
    """StringIndexer(frequencyDesc, ties alphabetical, keep) + OneHotEncoder profile per slot."""
    extra = "" if drop_last else " + 1"
    return f"""SELECT 'feature_store', '{prefix}' || CAST(slot AS VARCHAR), count(*),
       round(sum(CASE WHEN coalesce(ix.idx, (SELECT count(*) FROM (SELECT DISTINCT {col} FROM {frame} WHERE {col} IS NOT NULL))) = slot
                      THEN 1.0 ELSE 0.0 END), 3),
       min(CASE WHEN coalesce(ix.idx, (SELECT count(*) FROM (SELECT DISTINCT {col} FROM {frame} WHERE {col} IS NOT NULL))) = slot
                THEN 1.0 ELSE 0.0 END),
       max(CASE WHEN coalesce(ix.idx, (SELECT count(*) FROM (SELECT DISTINCT {col} FROM {frame} WHERE {col} IS NOT NULL))) = slot
                THEN 1.0 ELSE 0.0 END)
FROM {frame} t
LEFT JOIN (SELECT {col} AS val, row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS idx
           FROM {frame} WHERE {col} IS NOT NULL GROUP BY {col}) ix ON t.{col} = ix.val
CROSS JOIN (SELECT unnest(range(0, (SELECT count(DISTINCT {col}) FROM {frame}){extra})) AS slot) s
GROUP BY slot"""


DEMO_OHE = ["home_ownership", "verification_status", "addr_state", "application_type"]
TERMS_OHE = ["term", "loan_status", "pymnt_plan", "purpose", "initial_list_status", "disbursement_method",
             "debt_settlement_flag"]

_PROLOGUE = """
WITH om AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, sum(o_totalprice) AS total,
                   count(*) AS n_orders, max(o_orderstatus) AS status, min(o_orderpriority) AS prio,
                   min(o_orderkey) AS first_key
            FROM orders GROUP BY ALL),
ln AS (SELECT o.o_custkey, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS snapshot_date, count(*) AS n_lines,
              count(*) FILTER (WHERE l.l_quantity > 25) AS n_late, sum(l.l_quantity) AS qty
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY ALL),
b AS (SELECT CAST(om.o_custkey AS VARCHAR) AS member_id, om.snapshot_date, om.total, om.n_orders, om.status, om.prio,
             om.first_key, coalesce(ln.n_lines, 0) AS n_lines, coalesce(ln.n_late, 0) AS n_late,
             coalesce(ln.qty, 0.0) AS qty, c.c_acctbal, c.c_nationkey, c.c_mktsegment, n.n_name
      FROM om LEFT JOIN ln USING (o_custkey, snapshot_date)
      JOIN customer c ON om.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
cr0 AS (SELECT member_id, snapshot_date,
               CASE WHEN prio = '5-LOW' THEN NULL
                    ELSE CAST(snapshot_date - to_months(CAST(c_nationkey * 7 + 13 AS INTEGER)) AS DATE) END AS cr,
               CASE WHEN status = 'P' THEN NULL ELSE n_orders END AS mort_raw,
               CASE WHEN prio = '1-URGENT' THEN NULL ELSE n_late END AS pub_raw,
               CASE WHEN prio = '2-HIGH' THEN NULL ELSE n_lines - n_late END AS delinq_raw,
               CASE WHEN status = 'P' THEN NULL ELSE n_lines END AS inq_raw
        FROM b WHERE status <> 'O'),
cr AS (SELECT member_id, snapshot_date,
              CAST(coalesce(mort_raw, 0) AS INTEGER) AS mort_acc,
              CAST(mort_raw IS NULL AS INTEGER) AS mort_acc_missing,
              CAST(coalesce(pub_raw, (SELECT pub_raw FROM cr0 WHERE pub_raw IS NOT NULL GROUP BY pub_raw
                                      ORDER BY count(*) DESC, pub_raw LIMIT 1)) AS INTEGER) AS pub_rec,
              CAST(coalesce(delinq_raw, (SELECT delinq_raw FROM cr0 WHERE delinq_raw IS NOT NULL GROUP BY delinq_raw
                                         ORDER BY count(*) DESC, delinq_raw LIMIT 1)) AS INTEGER) AS delinq_2yrs,
              CAST(coalesce(inq_raw, -1) AS INTEGER) AS inq_fi,
              coalesce(CAST(date_diff('month', cr, snapshot_date) AS DOUBLE), 999.0) AS months_since_earliest_cr_line,
              CAST(date_diff('month', cr, snapshot_date) AS INTEGER) AS months_since_earliest_cr
       FROM cr0),
dm0 AS (SELECT member_id, snapshot_date,
               upper(trim(coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
                                        ELSE '  ' || lower(c_mktsegment) || ' ' || n_name || ' ' END, 'MISSING'))) AS emp_title,
               lower(trim(coalesce(CASE prio WHEN '1-URGENT' THEN '10+ years' WHEN '2-HIGH' THEN '< 1 year'
                                             WHEN '3-MEDIUM' THEN CAST(n_lines AS VARCHAR) || ' years'
                                             WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'n/a' END, 'MISSING'))) AS emp_len_txt,
               coalesce(CASE WHEN n_orders > 1 THEN 'MORTGAGE' WHEN status = 'F' THEN 'RENT' END, 'MISSING') AS home_ownership,
               CASE WHEN c_acctbal > 5000 THEN 'Verified' WHEN c_acctbal > 0 THEN 'Source Verified'
                    ELSE 'Not Verified' END AS verification_status,
               n_name AS addr_state,
               CASE WHEN n_orders > 1 THEN 'Joint App' ELSE 'Individual' END AS application_type,
               total AS annual_inc
        FROM b WHERE status <> 'P'),
top AS (SELECT emp_title FROM dm0 GROUP BY emp_title ORDER BY count(*) DESC, emp_title LIMIT 10),
dm AS (SELECT *, CASE WHEN emp_title IN (SELECT emp_title FROM top) THEN emp_title ELSE 'OTHER' END AS emp_title_limited,
              CASE WHEN emp_len_txt = '10+ years' THEN 10 WHEN emp_len_txt = '< 1 year' THEN 0
                   WHEN emp_len_txt = 'missing' THEN -1
                   WHEN contains(emp_len_txt, 'year') THEN coalesce(TRY_CAST(split_part(emp_len_txt, ' ', 1) AS INTEGER), -1)
                   ELSE -1 END AS emp_length
       FROM dm0),
fi0 AS (SELECT member_id, snapshot_date,
               CASE WHEN status = 'P' THEN NULL ELSE total / 10000.0 END AS dti_raw,
               CASE WHEN prio = '5-LOW' THEN NULL ELSE n_late * 10.0 END AS all_raw,
               CASE WHEN prio = '4-NOT SPECIFIED' THEN NULL ELSE qty END AS il_raw,
               n_lines * 1.5 AS bc_util, c_acctbal AS revol_bal,
               CASE WHEN status = 'O' THEN NULL ELSE n_orders END AS open_raw
        FROM b),
fi AS (SELECT member_id, snapshot_date,
              coalesce(dti_raw, (SELECT avg(dti_raw) FROM fi0)) AS dti,
              coalesce(all_raw, 0.0) AS all_util, CAST(all_raw IS NULL AS INTEGER) AS all_util_missing,
              coalesce(il_raw, -1.0) AS il_util, CAST(il_raw IS NULL AS INTEGER) AS il_util_missing,
              bc_util, 0 AS bc_util_missing, revol_bal, CAST(coalesce(open_raw, 0) AS INTEGER) AS open_acc
       FROM fi0),
lt AS (SELECT member_id, snapshot_date, CAST(first_key AS VARCHAR) AS id,
              ' ' || CASE WHEN n_lines > 4 THEN '60' ELSE '36' END || ' months' AS term,
              CASE prio WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'B' WHEN '3-MEDIUM' THEN 'C'
                        WHEN '4-NOT SPECIFIED' THEN 'H' END AS grade,
              CASE status WHEN 'F' THEN 'Fully Paid' WHEN 'O' THEN 'Current' ELSE 'Charged Off' END AS loan_status,
              CASE WHEN n_late > 2 THEN '1' ELSE '0' END AS pymnt_plan,
              lower(c_mktsegment) AS purpose,
              CASE WHEN n_orders > 1 THEN '1' ELSE '0' END AS initial_list_status,
              CASE WHEN c_acctbal > 0 THEN '1' ELSE '0' END AS disbursement_method,
              CASE WHEN status = 'P' THEN '1' ELSE '0' END AS debt_settlement_flag,
              total AS loan_amnt, n_lines * 1.25 AS int_rate, total / 36.0 AS installment
       FROM b),
keys AS (SELECT member_id, snapshot_date FROM cr UNION SELECT member_id, snapshot_date FROM dm
         UNION SELECT member_id, snapshot_date FROM fi UNION SELECT member_id, snapshot_date FROM lt)
"""


def build() -> str:
    parts = []
    for c in ("mort_acc", "mort_acc_missing", "pub_rec", "delinq_2yrs", "inq_fi", "months_since_earliest_cr_line",
              "months_since_earliest_cr"):
        parts.append(_num("cr", c))
    for c in ("emp_length", "annual_inc"):
        parts.append(_num("dm", c))
    parts.append(_onehot("dm", "emp_title_limited", "emp_title_ohe_", True))
    for c in DEMO_OHE:
        parts.append(_onehot("dm", c, f"{c}_ohe_", True))
    for c in ("dti", "all_util", "all_util_missing", "il_util", "il_util_missing", "bc_util", "bc_util_missing",
              "revol_bal", "open_acc"):
        parts.append(_num("fi", c))
    for c in ("loan_amnt", "int_rate", "installment"):
        parts.append(_num("lt", c))
    for c in TERMS_OHE:
        parts.append(_onehot("lt", c, f"{c}_", False))
    parts.append("SELECT 'feature_store', '__rows', count(*), NULL, NULL, NULL FROM keys")
    parts.append("SELECT 'label_store', 'grade_' || grade, count(*), NULL, NULL, NULL FROM lt "
                 "WHERE grade IS NOT NULL GROUP BY grade")
    body = "\nUNION ALL\n".join(f"({p})" for p in parts)
    return _PROLOGUE + "SELECT * FROM (\n" + body + "\n)"


SQL = build()
