"""Monitoring with late labels (MLD-12, PIP-16): a mergeable store of exact score counts.

Labels become known in *drops*, numbered by the caller in order of arrival.  Each drop adds one
partition to two stores below ``root``: ``labels`` (the drop's labels by key) and ``counts``
((group, score, positives, negatives) that the drop changes).  Counts add up, so the metrics of all
labels known so far are the metrics of the summed counts; former labels are neither joined nor
scored again.  A key that was labelled before is a correction: its former label is subtracted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.models.metrics import metrics_of_counts
from sparkmart.operators.clean import dedupe_keys

GROUPS = ("model_name", "snapshot_date")


def stored_drops(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the drops whose counts are stored, in order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/counts")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(n.removeprefix("drop=")) for n in names if n.startswith("drop="))


def add_labels(predictions: DataFrame, labels: DataFrame, keys: Sequence[str], root: str, drop: int,
               group_cols: Sequence[str] = GROUPS, score_col: str = "score", label_col: str = "label") -> None:
    """Add one drop of labels.  Its labels are made unique per key; a null label takes a former one back.

    A drop that failed or is delivered again replaces its own partitions.  A drop before the last stored
    one would change what later corrections subtract, so it raises: replay the drops from it on.
    """
    spark, keys, g = predictions.sparkSession, list(keys), list(group_cols)
    before = [d for d in stored_drops(spark, root) if d != drop]
    if before and max(before) > drop:
        raise ValueError(f"drop {drop} comes before the stored drop {max(before)}")
    # a group column of the labels wins only where neither the keys nor the predictions have it
    own = [c for c in g if c in labels.columns and c not in predictions.columns and c not in keys]
    new = dedupe_keys(labels.select(*keys, F.col(label_col).cast("double").alias("_y"), *own), keys)
    new.write.mode("overwrite").parquet(f"{root}/labels/drop={drop}")
    new = spark.read.schema(new.schema).parquet(f"{root}/labels/drop={drop}")
    changes = new.withColumn("_sign", F.lit(1))
    if before:
        stored = spark.read.schema(_with_drop(new)).parquet(f"{root}/labels").where(F.col("drop") < drop)
        last = (stored.join(new.select(*keys), keys, "left_semi").groupBy(*keys)
                .agg(F.max_by(F.struct("_y", *own), "drop").alias("_l")).select(*keys, "_l.*"))
        changes = changes.unionByName(last.withColumn("_sign", F.lit(-1)))
    s, y, sign = F.col(score_col).cast("double"), F.col("_y"), F.col("_sign")
    rows = predictions.join(changes.where(y.isNotNull()), keys).where(s.isNotNull())
    counts = (rows.groupBy(*g, s.alias("s")).agg(F.sum(sign * y).alias("pos"), F.sum(sign * (1.0 - y)).alias("neg"))
              .where("pos <> 0 or neg <> 0"))
    counts.write.mode("overwrite").parquet(f"{root}/counts/drop={drop}")


def _with_drop(df: DataFrame):
    from pyspark.sql import types as T

    return T.StructType([*df.schema.fields, T.StructField("drop", T.LongType())])


def known_counts(spark: SparkSession, root: str, group_cols: Sequence[str] = GROUPS) -> DataFrame:
    """``(group..., s, pos, neg)`` of all drops, one row per group and score that has labels."""
    counts = spark.read.parquet(f"{root}/counts").groupBy(*group_cols, "s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return counts.where(F.col("pos") + F.col("neg") > 0)


def known_metrics(spark: SparkSession, root: str, group_cols: Sequence[str] = GROUPS) -> DataFrame:
    """``monitor``'s columns from the stored counts."""
    m = metrics_of_counts(known_counts(spark, root, group_cols), group_cols)
    return m.select(*group_cols, F.col("rows").alias("inference_count"), "positive_rate", "mean_score",
                    F.col("auc").alias("auc_score"), "logloss")
