"""Batch scoring (MLD-10, MLD-11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def score(model, df: DataFrame, keep_cols: Sequence[str], model_name: str) -> DataFrame:
    """``PipelineModel.transform`` -> ``(keep_cols..., model_name, score)``; score = P(label = 1).

    One transform over a whole window of snapshots (MLD-11): no per-date loop.
    """
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    return out.select(*keep_cols, F.lit(model_name).alias("model_name"),
                      vector_to_array(F.col("probability")).getItem(1).alias("score"))
