"""Per-layer streams: new files in ``source_root`` -> transform -> partitioned sink.

``run_layer`` appends what arrives.  ``run_replacing`` is for sources that deliver a snapshot again: the
newest delivery of a snapshot replaces the earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.session import scratch_path


def run_layer(spark: SparkSession, source_root: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame],
              target_root: str, checkpoint: str, partition_cols: Iterable[str] = ("snapshot_date",),
              source_format: str = "parquet", max_files_per_trigger: int | None = None) -> dict:
    """Process every file that arrived since the last run, then stop (``availableNow``).

    ``transform`` must be row-wise (filters, projections, derived columns) - the silver and
    gold label layers are.  The file sink's commit log makes each micro-batch land once even
    if the run is retried; readers of ``target_root`` see only committed files.  Returns the
    number of input rows and micro-batches of this run.
    """
    # every batch's progress is kept: the default of 100 would lose the counts of longer runs
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1000000")
    reader = spark.readStream.schema(schema).format(source_format)
    if source_format == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = transform(reader.load(source_root))
    q = (stream.writeStream.format("parquet").outputMode("append")
               .option("checkpointLocation", checkpoint)
               .partitionBy(*partition_cols)
               .trigger(availableNow=True)
               .start(target_root))
    q.awaitTermination()
    progress = q.recentProgress
    return {"input_rows": sum(p.get("numInputRows", 0) for p in progress),
            "batches": sum(1 for p in progress if p.get("numInputRows", 0) > 0)}


def run_replacing(spark: SparkSession, source_root: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame],
                  target_root: str, checkpoint: str, date_col: str = "snapshot_date", delivery_col: str = "delivery",
                  max_files_per_trigger: int | None = None) -> dict:
    """Process the deliveries that arrived since the last run; a snapshot's newest delivery replaces it.

    ``source_root`` holds Parquet files with ``delivery_col`` (a number, often the folder
    ``delivery=7``); ``transform`` is row-wise and keeps both columns.  Each micro-batch rewrites just
    the snapshots it touches, by dynamic partition overwrite.  Files of one delivery may come in several
    batches: they add up; files of an older delivery than the stored one are left out.  A batch that is
    retried writes the same rows again, since the store knows each row's batch (``batch_id``).
    """
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1000000")
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def replace(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        try:
            stored = spark.read.schema(rows.schema).parquet(target_root)
        except Exception as error:  # nothing stored yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            stored = None
        if stored is not None:
            touched = rows.select(date_col).distinct()
            rows = rows.unionByName(stored.join(touched, date_col, "left_semi").where(F.col("batch_id") != batch_id))
        newest = rows.groupBy(date_col).agg(F.max(delivery_col).alias("_newest"))
        rows = rows.join(newest, date_col).where(F.col(delivery_col) == F.col("_newest")).drop("_newest")
        path = scratch_path(spark, "redelivery")  # the store is read and overwritten: land the rows in between
        rows.write.parquet(path)
        (spark.read.schema(rows.schema).parquet(path).hint("rebalance", date_col).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(target_root))

    q = (transform(reader.load(source_root)).writeStream.foreachBatch(replace)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    progress = q.recentProgress
    return {"input_rows": sum(p.get("numInputRows", 0) for p in progress),
            "batches": sum(1 for p in progress if p.get("numInputRows", 0) > 0)}
