"""Small helpers shared by the operators (no operator logic)."""

from __future__ import annotations

import io
import threading
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import sparkmart
from sparkmart.session import scratch_path, shared_dir

#: A word: a run of anything but space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


_OPEN = threading.local()


@contextmanager
def temporary_tables(spark: SparkSession):
    """Deletes, when the block ends, what it put into the shared folder without ``keep=True``: tables that a landed
    result has replaced.  No frame that reads one of them may leave the block."""
    outer, _OPEN.paths = getattr(_OPEN, "paths", None), []
    try:
        yield
    finally:
        paths, _OPEN.paths = _OPEN.paths, outer
        for p in paths:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path in the shared folder, known to the ``temporary_tables`` around it unless kept."""
    path = scratch_path(spark, name)
    if not keep and getattr(_OPEN, "paths", None) is not None:
        _OPEN.paths.append(path)
    return path


def land(df: DataFrame, name: str, keep: bool = False, **options: str) -> DataFrame:
    """Write a small intermediate table once to the cluster's shared folder and read it back.

    Cuts the lineage without ``localCheckpoint``: the files outlive any executor.
    """
    spark = df.sparkSession
    path = table_path(spark, name, keep)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_counted(left: DataFrame, counted: DataFrame, on: list[str], how: str = "inner", limit: int = 10_000) -> DataFrame:
    """``left`` joined with one row per key that knows its number ``n`` of rows in ``left``.

    Keys with more than a ``limit``-th of all these rows are fewer than ``limit``, so they are broadcast;
    the others are joined by a shuffle, where no key is hot.  ``counted`` is read several times: land it.
    """
    cut = (counted.agg(F.sum("n")).first()[0] or 0) // limit
    hot = counted.where(F.col("n") > cut)
    rest = left.join(F.broadcast(hot.select(*on)), on, "left_anti").join(counted.where(F.col("n") <= cut), on, how)
    return left.join(F.broadcast(hot), on).unionByName(rest)


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package: a zip of its modules, put in the shared folder
    and registered with ``addPyFile`` once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_sparkmart_shipped", False):
        return
    root, data = Path(sparkmart.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"sparkmart/{f.relative_to(root)}")
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "package") + "/sparkmart_workers.zip")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(fs.makeQualified(path).toString())
    sc._sparkmart_shipped = True


def read_documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def digest(text: Column) -> tuple[Column, Column]:
    """128-bit content address as two longs (null counts as the empty text)."""
    t = F.coalesce(text, F.lit(""))
    return F.xxhash64(t), F.xxhash64(F.lit(20250301), t)


def words_of(text: Column) -> Column:
    """All words of a text in order (see ``WORD``).  The five rarer separators become spaces first, so
    that the split runs on a single character, several times faster than a regular expression."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " ", -1), "")


def let(value: Column, body):
    """Bind ``value`` once inside an expression: ``body(bound)`` may use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_prefix(df: DataFrame, stem: str) -> str:
    """A prefix that no column of ``df`` begins with (case-insensitively), for working columns."""
    while any(c.lower().startswith(stem.lower()) for c in df.columns):
        stem += "_"
    return stem


def own_columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has (case-insensitively)."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


__all__ = ["WORD", "join_counted", "land", "ship_package", "table_path", "temporary_tables", "read_documents", "digest", "let", "words_of", "free_name", "free_prefix", "own_columns", "scratch_path", "shared_dir"]
