"""Model-job queries (MLD-*, AGG-11/12, SRC-8, SRT-2).

Labelled loans (30 dpd at mob 6) from the loan book, with customer and customer-month
features; document quality labels for the metric checks.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.functions.hashing import unit_hash
from sparkmart.models import boosting
from sparkmart.models.late_labels import add_labels, known_metrics
from sparkmart.models.metrics import f1_accuracy, log_loss, roc_auc
from sparkmart.models.monitor import monitor
from sparkmart.models.scale import apply_scaler, fit_scaler
from sparkmart.models.score import score
from sparkmart.models.split import assign_windows, stratified_split
from sparkmart.models.train import random_search, train_gbt
from sparkmart.operators.clean import missing_flags
from sparkmart.operators.features import days_past_due
from sparkmart.operators.joins import left_chain
from sparkmart.operators.labels import default_label
from sparkmart.operators.profile import class_balance, metrics_summary
from sparkmart.queries.joins_q import customer_months
from sparkmart.queries.loanbook import SILVER_SQL, loan_book
from sparkmart.queries.registry import query
from sparkmart.session import scratch_path
from sparkmart.sources.tables import table
from sparkmart.sources.writers import load_model, save_model

TRAIN_DATE = "2000-09-01"
FEATURES = ["c_acctbal", "c_nationkey", "n_orders", "spend", "spend_missing"]

_U = "(('0x' || substr(md5(CAST({k} AS VARCHAR) || '|{s}'), 1, 8))::BIGINT / 4294967296.0)"

_LABELS_SQL = f"""
WITH s AS ({SILVER_SQL}),
lab AS (SELECT loan_id, Customer_ID, loan_start_date, CAST(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS INTEGER) AS label,
               snapshot_date FROM s WHERE mob = 6)
"""

_WINDOWS_SQL = _LABELS_SQL.rstrip() + f""",
w AS (SELECT *, CASE
    WHEN snapshot_date BETWEEN CAST(DATE '{TRAIN_DATE}' - INTERVAL 2 MONTH AS DATE) AND DATE '{TRAIN_DATE}' - 1 THEN 'oot'
    WHEN snapshot_date BETWEEN CAST(DATE '{TRAIN_DATE}' - INTERVAL 14 MONTH AS DATE)
                           AND CAST(DATE '{TRAIN_DATE}' - INTERVAL 2 MONTH AS DATE) - 1 THEN 'train_test'
    ELSE 'outside' END AS window_name FROM lab),
f AS (SELECT DISTINCT o_custkey AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date FROM orders)
"""

_DOC_SCORES = """(SELECT d.doc_id, d.n_chars / (d.n_chars + 2000.0) AS score, l.quality AS label
                  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def loan_labels(spark, sf_dir):
    return default_label(days_past_due(loan_book(spark, sf_dir)), 30, 6)


def model_frame(spark, sf_dir):
    """Labels LEFT JOIN customer attributes LEFT JOIN customer-month features, with windows."""
    attrs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Customer_ID"), "c_acctbal", "c_nationkey")
    df = left_chain(loan_labels(spark, sf_dir), [(attrs, ["Customer_ID"]),
                                                 (customer_months(spark, sf_dir), ["Customer_ID", "snapshot_date"], True)])
    df = missing_flags(df, ["spend"])
    return assign_windows(df, TRAIN_DATE)


def doc_scores(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return d.join(lab, "doc_id").select("doc_id", (F.col("n_chars") / (F.col("n_chars") + 2000.0)).alias("score"), "label")


@query("oot_split", sql=_LABELS_SQL + f"""
SELECT loan_id, snapshot_date, CASE
    WHEN snapshot_date BETWEEN CAST(DATE '{TRAIN_DATE}' - INTERVAL 2 MONTH AS DATE) AND DATE '{TRAIN_DATE}' - 1 THEN 'oot'
    WHEN snapshot_date BETWEEN CAST(DATE '{TRAIN_DATE}' - INTERVAL 14 MONTH AS DATE)
                           AND CAST(DATE '{TRAIN_DATE}' - INTERVAL 2 MONTH AS DATE) - 1 THEN 'train_test'
    ELSE 'outside' END AS window_name
FROM lab
""")
def q_oot_split(spark, sf_dir):
    """MLD-2: out-of-time / train-test windows for a run at ``TRAIN_DATE``."""
    return assign_windows(loan_labels(spark, sf_dir), TRAIN_DATE).select("loan_id", "snapshot_date", "window_name")


_STRAT = f"""
WITH t AS (SELECT doc_id, quality, {_U.format(k="doc_id", s=88)} AS u FROM labels),
c AS (SELECT quality, quantile_disc(u, 0.8) AS cut FROM t GROUP BY quality),
sp AS (SELECT t.doc_id, t.quality, CASE WHEN t.u <= c.cut THEN 'train' ELSE 'test' END AS split
       FROM t JOIN c ON t.quality = c.quality)
"""


@query("stratified_split", sql=_STRAT + "SELECT doc_id, quality, split FROM sp")
def q_stratified_split(spark, sf_dir):
    """MLD-3: seeded 80/20 split stratified by ``quality`` (md5 draw, per-class quantile cut)."""
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return stratified_split(lab, "doc_id", "quality", 0.8, seed=88)


@query("class_balance", sql=_STRAT + """
SELECT split, count(*) AS rows, avg(CAST(quality AS DOUBLE)) AS positive_rate FROM sp GROUP BY split
""")
def q_class_balance(spark, sf_dir):
    """AGG-11: rows and positive rate per split."""
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return class_balance(stratified_split(lab, "doc_id", "quality", 0.8, seed=88), "split", "quality")


@query("standard_scale", sql=f"""
WITH t AS (SELECT c_custkey, c_acctbal, c_nationkey, {_U.format(k="c_custkey", s=88)} AS u FROM customer),
st AS (SELECT avg(c_acctbal) AS m1, stddev_pop(c_acctbal) AS s1, avg(CAST(c_nationkey AS DOUBLE)) AS m2,
              stddev_pop(CAST(c_nationkey AS DOUBLE)) AS s2 FROM t WHERE u < 0.8)
SELECT c_custkey, round((c_acctbal - m1) / s1, 9) AS c_acctbal, round((c_nationkey - m2) / s2, 9) AS c_nationkey
FROM t, st
""")
def q_standard_scale(spark, sf_dir):
    """MLD-4: mean / population-std scaling fitted on the training draw only."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    stats = fit_scaler(c.where(unit_hash("c_custkey", 88) < 0.8), ["c_acctbal", "c_nationkey"])
    out = apply_scaler(c, stats)
    return out.select("c_custkey", F.round("c_acctbal", 9).alias("c_acctbal"),
                      F.round("c_nationkey", 9).alias("c_nationkey"))


@query("roc_auc", sql=f"""
WITH t AS {_DOC_SCORES},
d AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM t GROUP BY score),
w AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM d),
a AS (SELECT sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc, sum(pos) AS p, sum(neg) AS n FROM w)
SELECT auc, round(2 * auc - 1, 3) AS gini, CAST(p AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n_neg FROM a
""")
def q_roc_auc(spark, sf_dir):
    """MLD-7: exact AUC (ties half) and Gini of a length-based score against document quality."""
    return roc_auc(doc_scores(spark, sf_dir), "score", "label")


@query("log_loss", sql=f"""
WITH t AS {_DOC_SCORES}, c AS (SELECT *, least(greatest(score, 1e-15), 1 - 1e-15) AS p FROM t)
SELECT count(*) AS rows, round(avg(score), 9) AS mean_score, round(avg(CAST(label AS DOUBLE)), 9) AS positive_rate,
       round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 9) AS logloss
FROM c
""")
def q_log_loss(spark, sf_dir):
    """MLD-9: log loss, mean score and row count."""
    out = log_loss(doc_scores(spark, sf_dir), "score", "label")
    return out.select("rows", *[F.round(c, 9).alias(c) for c in ("mean_score", "positive_rate", "logloss")])


@query("f1_accuracy", sql=f"""
WITH t AS {_DOC_SCORES},
c AS (SELECT count(*) FILTER (WHERE score > 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE score > 0.5 AND label <> 1) AS fp,
             count(*) FILTER (WHERE score <= 0.5 AND label = 1) AS fn, count(*) FILTER (WHERE score <= 0.5 AND label <> 1) AS tn
      FROM t)
SELECT tp, fp, fn, tn, coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0.0) AS f1_score,
       CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy
FROM c
""")
def q_f1_accuracy(spark, sf_dir):
    """MLD-8: F1 and accuracy at threshold 0.5."""
    return f1_accuracy(doc_scores(spark, sf_dir), "score", "label", 0.5)


def _order_scores(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("loan_id"), F.lit("price_model").alias("model_name"),
                    (F.col("o_totalprice") / (F.col("o_totalprice") + 150000.0)).alias("score"))


_MONITOR_SQL = _LABELS_SQL + """,
p AS (SELECT o_orderkey AS loan_id, 'price_model' AS model_name, o_totalprice / (o_totalprice + 150000.0) AS score FROM orders),
j AS (SELECT p.model_name, lab.snapshot_date, p.score, lab.label FROM p JOIN lab ON p.loan_id = lab.loan_id),
d AS (SELECT model_name, snapshot_date, score, sum(label) AS pos, sum(1 - label) AS neg FROM j GROUP BY ALL),
w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model_name, snapshot_date ORDER BY score
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM d),
a AS (SELECT model_name, snapshot_date,
             CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)) END AS auc
      FROM w GROUP BY ALL),
m AS (SELECT model_name, snapshot_date, count(*) AS inference_count, avg(CAST(label AS DOUBLE)) AS positive_rate,
             avg(score) AS mean_score,
             avg(-(label * ln(least(greatest(score, 1e-15), 1 - 1e-15))
                   + (1 - label) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)))) AS logloss
      FROM j GROUP BY ALL)
SELECT m.model_name, m.snapshot_date, m.inference_count, round(m.positive_rate, 9) AS positive_rate,
       round(m.mean_score, 9) AS mean_score, round(a.auc, 9) AS auc_score, round(m.logloss, 9) AS logloss
FROM m LEFT JOIN a USING (model_name, snapshot_date)
"""


@query("monitor_by_snapshot", sql=_MONITOR_SQL)
def q_monitor_by_snapshot(spark, sf_dir):
    """MLD-12: scores joined to realised labels; count, positive rate, mean score, AUC, log loss per snapshot."""
    out = monitor(_order_scores(spark, sf_dir), loan_labels(spark, sf_dir), ["loan_id"])
    return _monitor_columns(out)


def _monitor_columns(df):
    return df.select("model_name", "snapshot_date", "inference_count",
                     *[F.round(c, 9).alias(c) for c in ("positive_rate", "mean_score", "auc_score", "logloss")])


# labels are one per loan here: the least (label, snapshot) of a loan that has several
@query("monitor_late_labels", sql=_MONITOR_SQL.replace("FROM p JOIN lab ON", """FROM p JOIN (
    SELECT loan_id, min((label, snapshot_date)) AS l, l[1] AS label, l[2] AS snapshot_date FROM lab GROUP BY loan_id) lab ON"""))
def q_monitor_late_labels(spark, sf_dir):
    """MLD-12 / PIP-16 with labels in three drops: a third of the loans, wrong for every fifth of them; the
    other loans; the corrections.  The stored counts give the metrics of all labels at once."""
    root, scores, labels = scratch_path(spark, "late-labels"), _order_scores(spark, sf_dir), loan_labels(spark, sf_dir)
    early, wrong = F.col("loan_id") % 3 == 0, F.col("loan_id") % 5 == 0
    first = labels.where(early).withColumn("label", F.when(wrong, 1 - F.col("label")).otherwise(F.col("label")))
    for drop, part in enumerate([first, labels.where(~early), labels.where(early & wrong)]):
        add_labels(scores, part, ["loan_id"], root, drop)
    return _monitor_columns(known_metrics(spark, root))


def _metric_runs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.concat(F.lit("model_"), F.col("o_orderpriority")).alias("model_name"),
                      F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("created_at"))
             .agg((F.avg("o_totalprice") / 600000.0).alias("auc_score"),
                  F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("f1_score"),
                  F.avg(F.when(F.col("o_orderstatus") == "O", 1.0).otherwise(0.0)).alias("accuracy")))


_RUNS_SQL = """
WITH r AS (SELECT 'model_' || o_orderpriority AS model_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS created_at,
                  avg(o_totalprice) / 600000.0 AS auc_score,
                  avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0 END) AS f1_score,
                  avg(CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0.0 END) AS accuracy
           FROM orders GROUP BY ALL)
"""
_METRICS = ("auc_score", "f1_score", "accuracy")


def _rounded(summary, *keys):
    return summary.select(*keys, "runs", "latest_created_at",
                          *[F.round(f"{k}_{m}", 6).alias(f"{k}_{m}") for k in ("mean", "latest") for m in _METRICS])


@query("metrics_summary", sql=_RUNS_SQL + """
SELECT model_name, count(*) AS runs, max(created_at) AS latest_created_at,
       round(avg(auc_score), 6) AS mean_auc_score, round(avg(f1_score), 6) AS mean_f1_score, round(avg(accuracy), 6) AS mean_accuracy,
       round(arg_max(auc_score, created_at), 6) AS latest_auc_score, round(arg_max(f1_score, created_at), 6) AS latest_f1_score,
       round(arg_max(accuracy, created_at), 6) AS latest_accuracy
FROM r GROUP BY model_name
""")
def q_metrics_summary(spark, sf_dir):
    """AGG-12 / SRC-8: per model, mean metrics over runs and the latest run's values."""
    return _rounded(metrics_summary(_metric_runs(spark, sf_dir)), "model_name")


@query("metrics_overall", sql=_RUNS_SQL + """
SELECT count(*) AS runs, max(created_at) AS latest_created_at, round(avg(auc_score), 6) AS mean_auc_score,
       round(avg(f1_score), 6) AS mean_f1_score, round(avg(accuracy), 6) AS mean_accuracy
FROM r
""")
def q_metrics_overall(spark, sf_dir):
    """AGG-12: mean metrics over the runs of all models (which model ran last is a tie, so not returned)."""
    out = _rounded(metrics_summary(_metric_runs(spark, sf_dir), group_col=None))
    return out.drop(*[f"latest_{m}" for m in _METRICS])


def _train_scaled(spark, sf_dir):
    df = model_frame(spark, sf_dir)
    train = df.where(F.col("window_name") == "train_test")
    stats = fit_scaler(train, FEATURES)
    return apply_scaler(df, stats), stats


@query("gbt_score")
def q_gbt_score(spark, sf_dir):
    """MLD-5/10/11: GBT (100 trees, depth 5) fitted on the train/test window, scoring every labelled snapshot."""
    df, _ = _train_scaled(spark, sf_dir)
    model = train_gbt(df.where(F.col("window_name") == "train_test"), FEATURES, "label")
    return score(model, df, ["loan_id", "Customer_ID", "snapshot_date", "window_name"], "gbt_30dpd_6mob")


@query("cv_search")
def q_cv_search(spark, sf_dir):
    """MLD-6: random search (100 draws of the whole space) x 3-fold CV; one row per draw."""
    df, _ = _train_scaled(spark, sf_dir)
    train = stratified_split(df.where(F.col("window_name") == "train_test"), "loan_id", "label", 0.8, seed=88)
    _, results = random_search(train.where(F.col("split") == "train"), FEATURES, "label", n_iter=100, folds=3)
    return results


STUMP = {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.1, "reg_alpha": 0.1, "reg_lambda": 1.5, "min_child_weight": 3}


@query("boosted_stump", sql=_WINDOWS_SQL .rstrip() + """,
t AS (SELECT loan_id, label, coalesce(c_nationkey, -1)::DOUBLE AS c_nationkey, CASE WHEN f.Customer_ID IS NULL THEN 1 ELSE 0 END::DOUBLE AS spend_missing
      FROM w LEFT JOIN customer ON c_custkey = w.Customer_ID LEFT JOIN f ON f.Customer_ID = w.Customer_ID AND f.snapshot_date = w.snapshot_date
      WHERE window_name = 'train_test'),
p AS (SELECT avg(label::DOUBLE) AS p FROM t),
x AS (SELECT 0 AS k, 'c_nationkey' AS feature, c_nationkey AS v, p - label AS g, p * (1 - p) AS h FROM t, p
      UNION ALL SELECT 1, 'spend_missing', spend_missing, p - label, p * (1 - p) FROM t, p),
b AS (SELECT k, feature, v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM x GROUP BY ALL),
c AS (SELECT *, sum(g) OVER e AS gl, sum(h) OVER e AS hl, sum(n) OVER e AS nl, sum(g) OVER d AS gt, sum(h) OVER d AS ht, sum(n) OVER d AS nt
      FROM b WINDOW d AS (PARTITION BY k), e AS (PARTITION BY k ORDER BY v)),
z AS (SELECT *, pow(greatest(abs(gl) - 0.1, 0), 2) / (hl + 1.5) + pow(greatest(abs(gt - gl) - 0.1, 0), 2) / (ht - hl + 1.5)
                - pow(greatest(abs(gt) - 0.1, 0), 2) / (ht + 1.5) AS gain FROM c WHERE nl < nt AND least(hl, ht - hl) >= 3),
r AS (SELECT * FROM z WHERE gain > 1e-6 ORDER BY round(gain, 9) DESC, k, v LIMIT 1)
SELECT 1 AS node, feature, v AS threshold, nl::BIGINT AS rows, round(-sign(gl) * greatest(abs(gl) - 0.1, 0) / (hl + 1.5) * 0.1, 6) AS weight FROM r
UNION ALL
SELECT 2, feature, v, (nt - nl)::BIGINT, round(-sign(gt - gl) * greatest(abs(gt - gl) - 0.1, 0) / (ht - hl + 1.5) * 0.1, 6) FROM r
""")
def q_boosted_stump(spark, sf_dir):
    """MLD-5/6: both leaves of a penalised one-level tree over all training rows, by grouped gradients and hessians."""
    names = ["c_nationkey", "spend_missing"]
    rows = (model_frame(spark, sf_dir).where(F.col("window_name") == "train_test")
            .select("loan_id", "label", *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in names]))
    grown = boosting.grow(rows, names, "label", [STUMP], "loan_id")
    tree = grown.models[0].trees[0]
    if tree.feature[0] < 0:
        return spark.createDataFrame([], "node int, feature string, threshold double, rows long, weight double")
    name, cut = names[tree.feature[0]], float(grown.edges[tree.feature[0]][tree.bin[0]])
    weight = F.create_map(*[F.lit(x) for i in (1, 2) for x in (i, round(float(tree.weight[i]), 6))])
    return (rows.groupBy(F.when(F.col(name) <= cut, 1).otherwise(2).alias("node")).agg(F.count(F.lit(1)).alias("rows"))
            .select("node", F.lit(name).alias("feature"), F.lit(cut).alias("threshold"), "rows", weight[F.col("node")].alias("weight")))


@query("model_save_load", sql=_WINDOWS_SQL + """
SELECT window_name, count(*) AS rows, count(*) AS same, count(*) AS in_range FROM w GROUP BY window_name
""")
def q_model_save_load(spark, sf_dir):
    """SNK-9: the fixed model fitted, saved to the shared folder and loaded; every labelled row scored by both.

    Per window: rows, rows with equal scores, and rows whose score is a probability."""
    df, _ = _train_scaled(spark, sf_dir)
    df = df.select("loan_id", "window_name", "label", *FEATURES)
    model = train_gbt(df.where(F.col("window_name") == "train_test"), FEATURES, "label")
    path = scratch_path(spark, "model")
    save_model(model, path)
    before = score(model, df, ["window_name", *FEATURES], "m").withColumnRenamed("score", "before").drop("model_name")
    both = score(load_model(path), before, ["window_name", "before"], "m")
    return both.groupBy("window_name").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("score") == F.col("before")).alias("same"),
                                           F.count_if(F.col("score").between(0, 1)).alias("in_range"))


@query("model_lifecycle", sql=_WINDOWS_SQL + f"""
SELECT 'gbt_30dpd_6mob' AS model_name, DATE '{TRAIN_DATE}' AS snapshot_date, 'train' AS kind, count(*) AS rows, true AS valid
FROM w WHERE window_name <> 'outside'
UNION ALL
SELECT 'gbt_30dpd_6mob', snapshot_date, 'monitor', count(*), true
FROM w JOIN f USING (Customer_ID, snapshot_date) WHERE window_name = 'oot' GROUP BY snapshot_date
""")
def q_model_lifecycle(spark, sf_dir):
    """PIP-14/15/16: train job (search of 100 settings, scaler inside the saved pipeline, run record) ->
    scoring of the out-of-time snapshots into the prediction store -> monitoring against the
    realised labels; from the metrics log one training row and one row per monitored snapshot: its
    rows, and whether all its metrics are in their range."""
    from sparkmart.plans.model_jobs import monitor_job, score_job, train_job

    attrs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Customer_ID"), "c_acctbal", "c_nationkey")
    feats = missing_flags(left_chain(customer_months(spark, sf_dir), [(attrs, ["Customer_ID"])]), ["spend"])
    labels = loan_labels(spark, sf_dir)
    root = scratch_path(spark, "model_lifecycle")
    keys = ["Customer_ID", "snapshot_date"]
    train_job(spark, labels, feats, FEATURES, TRAIN_DATE, f"{root}/model", f"{root}/metrics", keys=keys, model_name="gbt_30dpd_6mob")
    oot = assign_windows(feats, TRAIN_DATE).where(F.col("window_name") == "oot")
    score_job(spark, f"{root}/model", oot, keys, "gbt_30dpd_6mob", f"{root}/predictions")
    monitor_job(spark, f"{root}/predictions", labels, keys, f"{root}/metrics", model_name="gbt_30dpd_6mob")
    log = spark.read.option("mergeSchema", True).parquet(f"{root}/metrics")
    train = F.col("inference_count").isNull()
    unit = ["auc_train", "auc_test", "auc_oot", "accuracy", "f1_score", "auc_score", "mean_score", "positive_rate"]
    valid = (F.coalesce("auc_train", "mean_score").isNotNull() & (F.coalesce("logloss", F.lit(0.0)) >= 0)
             & F.forall(F.array(*unit), lambda v: v.isNull() | v.between(0, 1)))
    return log.select("model_name", F.coalesce("snapshot_date", "train_date").alias("snapshot_date"),
                      F.when(train, "train").otherwise("monitor").alias("kind"),
                      F.when(train, F.col("rows_train") + F.col("rows_test") + F.col("rows_oot")).otherwise(F.col("inference_count")).alias("rows"),
                      valid.alias("valid"))


SIMPLE = ("1999-07-01", "2000-07-01")


@query("simple_training", sql=_WINDOWS_SQL + f""",
t AS (SELECT w.loan_id, label, {_U.format(k="w.loan_id", s=42)} AS u FROM w JOIN f USING (Customer_ID, snapshot_date)
      WHERE snapshot_date >= DATE '{SIMPLE[0]}' AND snapshot_date < DATE '{SIMPLE[1]}'),
c AS (SELECT label, quantile_disc(u, 0.75) AS cut FROM t GROUP BY label)
SELECT 'credit_model' AS model_name, DATE '{SIMPLE[0]}' AS start_date, DATE '{SIMPLE[1]}' AS end_date,
       count(*) FILTER (u <= cut) AS rows_train, count(*) FILTER (u > cut) AS rows_test, true AS valid
FROM t JOIN c USING (label)
""")
def q_simple_training(spark, sf_dir):
    """PIP-14, the simpler form: window, inner join, 75/25 split, fixed model; its metrics row read back from the log."""
    from sparkmart.plans.model_jobs import simple_train_job
    from sparkmart.sources.readers import read_metrics

    attrs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Customer_ID"), "c_acctbal", "c_nationkey")
    feats = missing_flags(left_chain(customer_months(spark, sf_dir), [(attrs, ["Customer_ID"])]), ["spend"])
    root = scratch_path(spark, "simple_training")
    simple_train_job(spark, loan_labels(spark, sf_dir), feats, FEATURES, *SIMPLE, f"{root}/model", f"{root}/metrics")
    valid = F.forall(F.array("auc_score", "f1_score", "accuracy"), lambda v: v.isNotNull() & v.between(0, 1))
    return read_metrics(spark, f"{root}/metrics").select("model_name", "start_date", "end_date", "rows_train", "rows_test", valid.alias("valid"))
