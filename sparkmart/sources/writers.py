"""Writers (SNK-1..9).

All snapshot writes use dynamic partition overwrite (D1): rewriting one snapshot replaces
that partition only, and writing an empty frame removes nothing.  Rows are clustered by the
partition column first so each task writes few files per partition.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def write_snapshots(df: DataFrame, root: str, partition_cols: Iterable[str] = ("snapshot_date",),
                    sort_by: Iterable[str] = (), fmt: str = "parquet", header: bool = True) -> int:
    """SNK-1..5: one partitioned write for a whole window of snapshots.

    The ``rebalance`` hint clusters rows by the partition columns (few files per snapshot)
    while letting AQE split a large snapshot into advisory-sized tasks and merge small ones;
    a plain ``repartition(snapshot_date)`` would send a whole snapshot - terabytes at scale -
    through a single writer task.  Returns the number of rows written (an observed metric of
    the write job, not a second scan).
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    parts = list(partition_cols)
    seen = Observation()  # row count gathered by the write itself: no extra counting job
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    out = out.hint("rebalance", *parts) if parts else out
    if sort_by:
        out = out.sortWithinPartitions(*parts, *sort_by)
    w = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt))
    if fmt == "csv":
        w = w.option("header", header)
    if parts:
        w = w.partitionBy(*parts)
    w.save(root)
    return int(seen.get.get("rows", 0))


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK-6: whole-table overwrite."""
    df.write.mode("overwrite").format(fmt).save(path)


def land(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back, for frames that several jobs read."""
    from sparkmart.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Iterable[str], buckets: int) -> DataFrame:
    """SNK-2..6 as a co-located store: rows bucketed and sorted by ``keys``, kept at ``path``.

    Stores with the same keys and number of buckets join on these keys, or on keys of which they are a
    part, without an exchange.  The table is registered in the session's catalog, which is what tells
    the planner its buckets.
    """
    keys = list(keys)
    # one file per bucket: rows meet by the buckets' own hash before the write
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def write_predictions(df: DataFrame, root: str) -> None:
    """SNK-7: prediction store partitioned by model and snapshot."""
    write_snapshots(df, root, partition_cols=("model_name", "snapshot_date"))


def append_rows(df: DataFrame, root: str, fmt: str = "parquet", options: dict | None = None) -> None:
    """SNK-8: append-only log (metrics runs).

    ``fmt="jdbc"`` with ``options`` (``url``, ``dbtable``, credentials) appends to a database
    table instead; ``root`` is then ignored.
    """
    w = df.write.mode("append").format(fmt).options(**(options or {}))
    w.save() if fmt == "jdbc" else w.save(root)


def save_model(model, path: str) -> None:
    """SNK-9: ``PipelineModel`` persistence (distributed storage, no pickles)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
