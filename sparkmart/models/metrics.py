"""Classification metrics as distributed aggregates (MLD-7, MLD-8, MLD-9).

``roc_auc`` is exact (ties counted half, as the Mann-Whitney statistic) without a global
sort: rows collapse to distinct ``(group, score)`` counts, which are range-sorted once into as many
ranges as the session has shuffle partitions; range totals are prefix-summed and the running
negative count is finished with a window *inside* each range (``operators.ordered``).

The range-sorted table is written once with a reliable ``checkpoint`` (the shared
``spark.checkpoint.dir``); ``score_metrics`` derives count, positive rate, mean score and log loss
from that same table, so monitoring needs one pass over the scored rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.ordered import range_order, running_before

EPS = 1e-15


def distinct_scores(df: DataFrame, score_col: str = "score", label_col: str = "label",
                    group_cols: Iterable[str] = ()) -> DataFrame:
    """``(group..., s, pos, neg)``: one row per distinct score per group (map-side combined)."""
    y = F.col(label_col).cast("double")
    return (df.where(F.col(score_col).isNotNull() & y.isNotNull())
              .groupBy(*list(group_cols), F.col(score_col).cast("double").alias("s"))
              .agg(F.sum(y).alias("pos"), F.sum(1.0 - y).alias("neg")))


def _auc(ranged: DataFrame, g: list[str]) -> DataFrame:
    """AUC per group from ``range_order`` rows (group, s, pos, neg)."""
    run = running_before(ranged, g, "s", "neg", "neg_before")
    out = run.groupBy(*g).agg(F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)).alias("u"),
                              F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    auc = F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("u") / (F.col("p") * F.col("n")))
    return out.select(*g, auc.alias("auc"), F.round(2 * auc - 1, 3).alias("gini"),
                      F.col("p").cast("bigint").alias("n_pos"), F.col("n").cast("bigint").alias("n_neg"))


def _grouped(df: DataFrame, group_cols: Iterable[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with a group to partition by: its own, or one group of all rows."""
    g = list(group_cols)
    return (df, g) if g else (df.withColumn("_all", F.lit(0)), ["_all"])


def roc_auc(df: DataFrame, score_col: str = "score", label_col: str = "label",
            group_cols: Iterable[str] = (), buckets: int | None = None) -> DataFrame:
    """Per group: ``auc``, ``gini = round(2 auc - 1, 3)``, ``n_pos``, ``n_neg``."""
    df, g = _grouped(df, group_cols)
    return _auc(range_order(distinct_scores(df, score_col, label_col, g), g, "s", buckets), g).drop("_all")


def score_metrics(df: DataFrame, score_col: str = "score", label_col: str = "label",
                  group_cols: Iterable[str] = (), buckets: int | None = None) -> DataFrame:
    """Per group: rows, positive rate, mean score, log loss and AUC from one distinct-score table."""
    df, g = _grouped(df, group_cols)
    return metrics_of_counts(distinct_scores(df, score_col, label_col, g), g, buckets).drop("_all")


def metrics_of_counts(counts: DataFrame, group_cols: Iterable[str], buckets: int | None = None) -> DataFrame:
    """``score_metrics`` from rows of ``distinct_scores``: one row per (group, s), groups not empty."""
    g = list(group_cols)
    dist = range_order(counts, g, "s", buckets)
    p = F.least(F.greatest(F.col("s"), F.lit(EPS)), F.lit(1 - EPS))
    n = F.col("pos") + F.col("neg")
    sums = dist.groupBy(*g).agg(
        F.sum(n).alias("_n"), F.sum("pos").alias("_pos"), F.sum(F.col("s") * n).alias("_s"),
        F.sum(-(F.col("pos") * F.ln(p) + F.col("neg") * F.ln(1 - p))).alias("_ll"))
    base = sums.select(*g, F.col("_n").cast("bigint").alias("rows"),
                       (F.col("_pos") / F.col("_n")).alias("positive_rate"),
                       (F.col("_s") / F.col("_n")).alias("mean_score"),
                       (F.col("_ll") / F.col("_n")).alias("logloss"))
    return base.join(_auc(dist, g).select(*g, "auc"), g, "left")


def log_loss(df: DataFrame, score_col: str = "score", label_col: str = "label",
             group_cols: Iterable[str] = ()) -> DataFrame:
    """MLD-9: rows, mean score, positive rate and log loss (p clipped to [1e-15, 1 - 1e-15])."""
    p = F.least(F.greatest(F.col(score_col).cast("double"), F.lit(EPS)), F.lit(1 - EPS))
    y = F.col(label_col).cast("double")
    ll = -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
    return df.groupBy(*list(group_cols)).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.col(score_col)).alias("mean_score"),
        F.avg(y).alias("positive_rate"), F.avg(ll).alias("logloss"))


def f1_accuracy(df: DataFrame, score_col: str = "score", label_col: str = "label", threshold: float = 0.5,
                group_cols: Iterable[str] = ()) -> DataFrame:
    """MLD-8: confusion counts in one ``agg``; predicted positive when ``score > threshold``."""
    pred = F.col(score_col) > F.lit(threshold)
    y = F.col(label_col) == 1
    c = df.groupBy(*list(group_cols)).agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))
    f1 = F.try_divide(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + F.col("fn"))
    acc = (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    return c.withColumns({"f1_score": F.coalesce(f1, F.lit(0.0)), "accuracy": acc})
