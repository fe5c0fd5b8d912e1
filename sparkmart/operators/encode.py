"""Encoders (ENC-1..7).

Fitting an encoder means fixing its vocabulary once (D12).  ``count_values`` counts the values of all
columns in one scan; ``number_values`` gives each value its slot; ``update_vocabularies`` keeps the
``(column, value, slot)`` table next to a store, where slots never move and later windows only add
values.  ``encode_slots`` applies such a table as a join, for vocabularies of any size.

The wide forms (one 0/1 column per value) need the column *names* on the driver, as every frame's
schema is; nothing else is collected.  They have no limit of their own: ``max_values`` is an optional
guard that fails before an unexpectedly wide frame is built.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.functions.text import slug
from sparkmart.functions.util import as_col
from sparkmart.session import scratch_path


class VocabularyTooLarge(ValueError):
    pass


def ordinal_map(c, mapping: Mapping[str, int]) -> Column:
    """ENC-1: text -> code from a fixed map; anything else (or null) -> null."""
    col = as_col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(None)).cast("int")


def binary_flag(c, true_value) -> Column:
    """ENC-2: 1 when equal to ``true_value``, else 0 (null -> 0)."""
    return F.when(as_col(c) == F.lit(true_value), 1).otherwise(0)


def count_values(df: DataFrame, cols: Iterable[str] = (), list_cols: Mapping[str, Column] | None = None,
                 keep_empty: bool = False) -> DataFrame:
    """``(column, value, n)`` of all columns in one scan, combined map-side; nulls are left out.

    ``cols`` are taken as text; ``list_cols`` maps a name to an array column whose items are counted.
    Blank values are left out too unless ``keep_empty`` (D14).
    """
    parts = [F.array(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))) for c in cols]
    for c, items in (list_cols or {}).items():
        name = F.lit(c).alias("column")
        rows = F.transform(items, lambda x: F.struct(name, x.cast("string").alias("value")))  # noqa: B023
        parts.append(F.coalesce(rows, F.array().cast("array<struct<column:string,value:string>>")))
    long = df.select(F.inline(F.concat(*parts))).where(F.col("value").isNotNull())
    if not keep_empty:
        long = long.where(F.trim("value") != "")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def number_values(counts: DataFrame) -> DataFrame:
    """``(column, value, slot)``: slots 0, 1, ... per column, by falling count, then by value.

    A range sort and the running sum of its partitions' sizes, so that no column's values meet in one
    task.  The sorted table is written once to the shared folder, which fixes the partitions.
    """
    spark = counts.sparkSession
    path = scratch_path(spark, "vocabulary")
    (counts.orderBy("column", F.desc("n"), "value").withColumn("at", F.monotonically_increasing_id())
           .write.parquet(path))
    placed = spark.read.parquet(path).withColumn("part", F.shiftright("at", 33))
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (placed.groupBy("column", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("m"))
             .withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0))))
    return (placed.join(parts, ["column", "part"])
            .select("column", "value", (F.col("before") + F.col("at") - F.col("first")).alias("slot")))


def _path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def update_vocabularies(counts: DataFrame, path: str) -> DataFrame:
    """The stored ``(column, value, slot)`` table after adding the values of ``counts`` that it lacks.

    Stored slots never move: new values get the slots after the last one of their column.
    """
    spark = counts.sparkSession
    if not _path_exists(spark, path):
        number_values(counts).write.mode("append").parquet(path)
        return spark.read.parquet(path)
    stored = spark.read.parquet(path)
    last = stored.groupBy("column").agg((F.max("slot") + 1).alias("next"))
    fresh = number_values(counts.join(stored.select("column", "value"), ["column", "value"], "left_anti"))
    (fresh.join(last, "column", "left")
          .select("column", "value", (F.col("slot") + F.coalesce("next", F.lit(0))).alias("slot"))
          .write.mode("append").parquet(path))
    return spark.read.schema(stored.schema).parquet(path)


def vocabulary_values(vocabulary: DataFrame, col: str, max_values: int | None = None) -> list:
    """The values of one column of a vocabulary table, sorted: the names of its wide columns."""
    return _collect_names(vocabulary.where(F.col("column") == col).select("value"), col, max_values)


def encode_slots(df: DataFrame, vocabulary: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``{c}_slot`` per column: the value's slot, null for null or unknown values.  Any vocabulary size;
    AQE broadcasts a small vocabulary and splits a hot value's rows otherwise."""
    out = df
    for c in cols:
        words = vocabulary.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("slot").alias(f"{c}_slot"))
        out = out.join(words, out[c].cast("string") == F.col("_value"), "left").drop("_value")
    return out


def encode_sparse(df: DataFrame, vocabulary: DataFrame, cols: Iterable[str], keys: Iterable[str],
                  out_col: str = "features") -> DataFrame:
    """ENC-5/6 for vocabularies of any size: ``keys`` and one sparse vector per row.

    The columns stand side by side in the vector, each with its slots and one more for null and unknown
    values.  The driver knows only how many slots each column has.  (column, value) pairs are joined
    with the vocabulary and gathered per row, ``len(cols)`` indices each; the rows are written once to the
    shared folder, which also gives them the vector type.  ``keys`` must tell the rows apart.
    """
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    spark, cols, keys = df.sparkSession, list(cols), list(keys)
    widths = {r["column"]: r["n"] for r in vocabulary.where(F.col("column").isin(cols)).groupBy("column")
              .agg((F.max("slot") + 1).alias("n")).collect()}  # a row per column
    offset, size = {}, 0
    for c in cols:
        offset[c], size = size, size + widths.get(c, 0) + 1
    pairs = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("string").alias("_value"), F.lit(offset[c]).alias("_at"),
                               F.lit(offset[c] + widths.get(c, 0)).alias("_unknown")) for c in cols])
    long = df.select(*keys, F.inline(pairs))
    words = vocabulary.select(F.col("column").alias("_column"), F.col("value").alias("_value"), "slot")
    index = F.coalesce(F.col("_at") + F.col("slot"), F.col("_unknown")).cast("int")
    rows = (long.join(words, ["_column", "_value"], "left").groupBy(*keys)
            .agg(F.sort_array(F.collect_list(index)).alias("indices")))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.col("indices"),
                      F.transform("indices", lambda _: F.lit(1.0)).alias("values"))
    path = scratch_path(spark, "sparse")
    rows.select(*keys, vector.alias(out_col)).write.parquet(path)
    schema = T.StructType([*[T.StructField(k, df.schema[k].dataType) for k in keys], T.StructField(out_col, VectorUDT())])
    return spark.read.schema(schema).parquet(path)


def _collect_names(values: DataFrame, col: str, max_values: int | None) -> list:
    rows = (values if max_values is None else values.limit(max_values + 1)).collect()
    if max_values is not None and len(rows) > max_values:
        raise VocabularyTooLarge(f"{col}: more than {max_values} distinct values")
    return sorted(r[0] for r in rows)


def fit_vocabulary(df: DataFrame, col: str, max_values: int | None = None) -> list:
    """Distinct non-null, non-empty values of ``col`` (D14), sorted."""
    c = F.col(col)
    vals = df.select(c).where(c.isNotNull() & (F.trim(c.cast("string")) != "")).distinct()
    return _collect_names(vals, col, max_values)


def fit_list_vocabulary(df: DataFrame, col: str, pattern: str = r",\s*", strip_and: bool = False,
                        max_values: int | None = None) -> list:
    """Distinct elements of a delimited text column (ENC-4 fit, AGG-3): ``split`` + ``explode``."""
    items = F.explode(split_list(F.col(col), pattern, strip_and)).alias("item")
    vals = df.select(items).where(F.col("item").isNotNull() & (F.trim("item") != "")).distinct()
    return _collect_names(vals, col, max_values)


def split_list(c: Column, pattern: str = r",\s*", strip_and: bool = False) -> Column:
    """FN-6: split on commas; ``strip_and`` also drops a leading ``and `` (D13, off by default)."""
    arr = F.split(c, pattern)
    if strip_and:
        arr = F.transform(arr, lambda x: F.regexp_replace(x, r"^and\s+", ""))
    return arr


def one_hot(df: DataFrame, col: str, vocabulary: Iterable, prefix: str | None = None,
            drop_source: bool = True) -> DataFrame:
    """ENC-3: one 0/1 column per vocabulary value, named ``{prefix}_{slug(value)}``."""
    prefix = prefix or col
    cols: dict[str, Column] = {}
    for v in vocabulary:
        name = f"{prefix}_{slug(v)}"
        hit = F.when(F.col(col) == F.lit(v), 1).otherwise(0)
        cols[name] = F.greatest(cols[name], hit) if name in cols else hit
    out = df.withColumns(cols)
    return out.drop(col) if drop_source else out


def multi_hot(df: DataFrame, col: str, vocabulary: Iterable, prefix: str | None = None,
              pattern: str = r",\s*", strip_and: bool = False, drop_source: bool = True) -> DataFrame:
    """ENC-4: 0/1 per vocabulary item present in a delimited list (FN-7 ``array_contains``)."""
    prefix = prefix or col
    arr = split_list(F.col(col), pattern, strip_and)
    cols: dict[str, Column] = {}
    for v in vocabulary:
        name = f"{prefix}_{slug(v)}"
        hit = F.when(F.coalesce(F.array_contains(arr, F.lit(v)), F.lit(False)), 1).otherwise(0)
        cols[name] = F.greatest(cols[name], hit) if name in cols else hit
    out = df.withColumns(cols)
    return out.drop(col) if drop_source else out


def fit_indexed_one_hot(df: DataFrame, cols: Iterable[str], drop_last: bool = True,
                        max_values: int | None = None):
    """ENC-5/6 fit: string indexer (invalid kept) + ``OneHotEncoder`` over all columns.

    One scan counts the values of every column; index order is frequency descending, then
    alphabetical; null and unseen values get the extra last index.  Returns the fitted
    ``PipelineModel`` and ``{column: width}`` taken from the labels (not from a sampled row).
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import OneHotEncoder, StringIndexerModel

    cols = list(cols)
    if not cols:
        return PipelineModel([]), {}
    counted: dict[str, list] = {c: [] for c in cols}
    counts = count_values(df, cols, keep_empty=True)
    if max_values is not None:
        counts = counts.limit(max_values * len(cols) + 1)
    for r in counts.collect():  # the labels become column names of the wide frame
        counted[r["column"]].append((-r["n"], r["value"]))
        if max_values is not None and len(counted[r["column"]]) > max_values:
            raise VocabularyTooLarge(f"{r['column']}: more than {max_values} distinct values")
    labels = [[v for _, v in sorted(counted[c])] for c in cols]
    # one model per column: the Python form for several columns pads shorter label lists with nulls
    indexer = PipelineModel([StringIndexerModel.from_labels(v, c, f"{c}__idx", handleInvalid="keep")
                             for c, v in zip(cols, labels)])
    encoder = OneHotEncoder(inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}__vec" for c in cols],
                            dropLast=drop_last, handleInvalid="keep").fit(indexer.transform(df))
    return PipelineModel([indexer, encoder]), {c: len(v) + (0 if drop_last else 1) for c, v in zip(cols, labels)}


def expand_indexed(model, widths: Mapping[str, int], df: DataFrame, drop_source: bool = True) -> DataFrame:
    """ENC-5/6 transform: vectors expanded to ``{c}_{i}`` double columns (FN-16/17); helpers dropped (D19)."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    exprs = {}
    for c, w in widths.items():
        arr = vector_to_array(F.col(f"{c}__vec"))
        for i in range(w):
            exprs[f"{c}_{i}"] = arr.getItem(i)
    out = out.withColumns(exprs)
    helpers = [f"{c}__idx" for c in widths] + [f"{c}__vec" for c in widths]
    out = out.drop(*helpers)
    return out.drop(*widths.keys()) if drop_source else out


def indexed_one_hot(df: DataFrame, cols: Iterable[str], drop_last: bool = True,
                    fit_df: DataFrame | None = None, drop_source: bool = True) -> DataFrame:
    model, widths = fit_indexed_one_hot(fit_df if fit_df is not None else df, cols, drop_last)
    return expand_indexed(model, widths, df, drop_source)


def fit_top_k(df: DataFrame, col: str, k: int = 10) -> list:
    """ENC-7 fit: the ``k`` most frequent values (ties by value), normalised first (D16)."""
    from sparkmart.operators.profile import top_k
    return [r[col] for r in top_k(df, col, k).collect()]  # k rows


def top_k_bucket(df: DataFrame, col: str, k: int = 10, other: str = "OTHER", out_col: str | None = None,
                 fit_df: DataFrame | None = None) -> DataFrame:
    """ENC-7: values outside the top ``k`` become ``other``."""
    keep = fit_top_k(fit_df if fit_df is not None else df, col, k)
    out_col = out_col or f"{col}_limited"
    return df.withColumn(out_col, F.when(F.col(col).isin(keep), F.col(col)).otherwise(F.lit(other)))


def wide_to_long(df: DataFrame, keys: Iterable[str], prefix_cols: Iterable[str],
                 name_col: str = "feature", value_col: str = "value") -> DataFrame:
    """Unpivot encoded columns to ``(keys..., feature, value)`` rows (for checks and profiling)."""
    return df.unpivot(list(keys), list(prefix_cols), name_col, value_col)
