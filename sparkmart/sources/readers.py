"""Readers (SRC-1..9).

The reference rebuilds file names from dates and re-reads whole CSVs per snapshot.  Here every
store is one partitioned table (``.../snapshot_date=YYYY-MM-DD/``), so a date predicate turns
into partition pruning (``PartitionFilters`` in the plan) and a window read is one scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.session import scratch_path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """SRC-1: CSV with a header and an explicit schema (no ``inferSchema`` pass over the data).

    Columns are taken by header name, whatever their order in the file; columns that the schema
    does not name are dropped and a missing one is an error.  ``enforceSchema=false`` makes Spark
    check every file's header against that order, so a file laid out otherwise fails loudly.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.option("header", True).csv(path).columns  # reads the first line only
    missing = [f.name for f in wanted.fields if f.name not in header]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    types = {f.name: f.dataType for f in wanted.fields}
    layout = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    df = (spark.read.schema(layout).option("header", True).option("enforceSchema", False)
          .option("mode", "PERMISSIVE").csv(path))
    return df.select(*[f.name for f in wanted.fields])


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """SRC-1 with a quarantine: ``(rows, rejects)``.

    A line with a value that does not fit its column's type, or with too few or too many fields, is
    rejected whole: ``rejects`` holds its text (``_line``) and its file (``_file``), so that rows in are
    rows landed plus rows rejected, and nothing turns into a null unseen.  An empty field is a null.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.option("header", True).csv(path).columns  # reads the first line only
    missing = [f.name for f in wanted.fields if f.name not in header]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    types = {f.name: f.dataType for f in wanted.fields}
    layout = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header] + [T.StructField("_line", T.StringType())])
    # Without column pruning every field of a line is parsed, whatever columns are read later.  The parsed
    # lines are landed once: both results come from them, and Spark refuses to read the rejects alone.
    df = (spark.read.schema(layout).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_line").option("columnPruning", False).csv(path).withColumn("_file", F.col("_metadata.file_path")))
    landed = scratch_path(spark, "csv")
    df.write.parquet(landed)
    df = spark.read.parquet(landed)
    return (df.where(F.col("_line").isNull()).select(*[f.name for f in wanted.fields]),
            df.where(F.col("_line").isNotNull()).select("_line", "_file"))


def read_store(spark: SparkSession, root: str, merge_schema: bool = False) -> DataFrame:
    """SRC-6: the whole partitioned store as one frame (all snapshots)."""
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.parquet(root)


def read_snapshot(spark: SparkSession, root: str, snapshot_date, col: str = "snapshot_date") -> DataFrame:
    """SRC-2/3/4/5: one snapshot, by a predicate the planner turns into partition pruning."""
    return read_store(spark, root).where(F.col(col) == F.lit(snapshot_date).cast("date"))


def read_window(spark: SparkSession, root: str, start=None, end=None, dates: Iterable | None = None,
                col: str = "snapshot_date", merge_schema: bool = False) -> DataFrame:
    """SRC-7: snapshots inside ``[start, end]`` or in ``dates``; empty frame when none match."""
    df = read_store(spark, root, merge_schema)
    if dates is not None:
        df = df.where(F.col(col).isin([F.lit(d).cast("date") for d in dates]))
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(end).cast("date"))
    return df


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """SRC-8: the metrics log, newest first."""
    return read_store(spark, root, merge_schema=True).orderBy(F.desc("created_at"))


def read_predictions(spark: SparkSession, root: str, model_name: str | None = None,
                     snapshot_date=None) -> DataFrame:
    """SRC-9: scored rows of one model / snapshot from the prediction store."""
    df = read_store(spark, root)
    if model_name is not None:
        df = df.where(F.col("model_name") == model_name)
    if snapshot_date is not None:
        df = df.where(F.col("snapshot_date") == F.lit(snapshot_date).cast("date"))
    return df
