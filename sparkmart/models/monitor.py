"""Monitoring: scores against realised labels per model and snapshot (MLD-12, SNK-8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.models.metrics import score_metrics


def monitor(predictions: DataFrame, labels: DataFrame, keys: Sequence[str],
            group_cols: Sequence[str] = ("model_name", "snapshot_date"), score_col: str = "score",
            label_col: str = "label") -> DataFrame:
    """predictions JOIN labels on ``keys``; count, positive rate, mean score, AUC, log loss per group.

    The join runs once: every metric comes from the per-group distinct-score table.
    """
    g = list(group_cols)
    from_labels = [c for c in g if c in labels.columns and c not in predictions.columns and c not in keys]
    j = predictions.join(labels.select(*keys, label_col, *from_labels), list(keys), "inner")
    m = score_metrics(j, score_col, label_col, g)
    return m.select(*g, F.col("rows").alias("inference_count"), "positive_rate", "mean_score",
                    F.col("auc").alias("auc_score"), "logloss")
