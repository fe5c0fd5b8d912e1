"""Train/test/OOT splits (MLD-2, MLD-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.hashing import unit_hash
from sparkmart.operators.calendar import split_window


def assign_windows(df: DataFrame, train_date, date_col: str = "snapshot_date", oot_months: int = 2,
                   train_months: int = 12, out_col: str = "window_name") -> DataFrame:
    """MLD-2: tag rows ``oot`` / ``train_test`` / ``outside`` by date (CAL-6)."""
    return df.withColumn(out_col, split_window(F.col(date_col), train_date, oot_months, train_months))


def _cut(counts: DataFrame, cell: str, wanted) -> DataFrame:
    """Per class the first cell whose running count reaches ``wanted``, and the count before it.

    ``counts``: _class, cell, n - at most 65,536 rows per class.
    """
    up = Window.partitionBy("_class").orderBy(cell)
    run = counts.withColumn("upto", F.sum("n").over(up)).withColumn("want", wanted)
    return (run.where("upto >= want").groupBy("_class")
               .agg(F.min(F.struct(cell, (F.col("upto") - F.col("n")).alias("before"), "want")).alias("c"))
               .select("_class", f"c.{cell}", "c.before", "c.want"))


def stratified_split(df: DataFrame, key_col: str, label_col: str = "label", ratio: float = 0.8,
                     seed: int = 88, out_col: str = "split") -> DataFrame:
    """MLD-3: seeded stratified split, ``ratio`` of each class to ``train``.

    Each row draws ``u = unit_hash(key, seed)``, a 32-bit number - the same on every run and for
    any partitioning.  Per class the cut is the exact ``ratio`` quantile of the draws at any size,
    found by counting twice: the upper 16 bits of all draws, then the lower 16 bits of those in
    the cell that holds the quantile.  Both are map-side combined counts; no class is sorted or gathered,
    and the cuts are joined back, so the number of classes has no limit.
    """
    draw = F.round(unit_hash(key_col, seed) * F.lit(float(1 << 32))).cast("bigint")
    drawn = df.withColumn("_u", draw).withColumn("_class", F.col(label_col))
    cells = drawn.select("_class", F.shiftright("_u", 16).alias("hi"), F.col("_u").bitwiseAND(65535).alias("lo"))
    high = cells.groupBy("_class", "hi").agg(F.count(F.lit(1)).alias("n"))
    size = F.sum("n").over(Window.partitionBy("_class"))
    upper = _cut(high, "hi", F.greatest(size - F.floor(size - F.lit(ratio) * size), F.lit(1)))
    upper = upper.select(F.col("_class").alias("_k"), F.col("hi").alias("_hi"), "before", "want")
    inside = (cells.join(upper, cells["_class"].eqNullSafe(F.col("_k")) & (cells["hi"] == F.col("_hi")))
                   .groupBy("_class", "lo").agg(F.count(F.lit(1)).alias("n"), F.max("before").alias("before"), F.max("want").alias("want0")))
    lower = _cut(inside, "lo", F.col("want0") - F.col("before")).select(F.col("_class").alias("_l"), "lo")
    cut = (upper.join(lower, F.col("_k").eqNullSafe(F.col("_l")))
                .select("_k", (F.shiftleft("_hi", 16) + F.col("lo")).alias("_cut")))
    out = drawn.join(cut, F.col("_class").eqNullSafe(F.col("_k")), "left")
    return out.select(*df.columns, F.when(F.col("_u") <= F.col("_cut"), "train").otherwise("test").alias(out_col))
