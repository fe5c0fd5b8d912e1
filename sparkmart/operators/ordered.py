"""Exact running totals and quantiles of grouped, ordered rows without a global sort in one task."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def range_order(df: DataFrame, group_cols: Sequence[str], order_col: str, ranges: int | None = None) -> DataFrame:
    """``df`` range-partitioned by (group, order), with ``_range``, the number of the row's range.

    Written once with a reliable checkpoint, so the numbers stay as they are.  ``ranges`` defaults to
    the session's shuffle partitions and so grows with the cluster, not with a group.
    """
    from sparkmart.session import shared_dir

    shared_dir(df.sparkSession)  # make sure a reliable checkpoint folder is registered
    by = [*group_cols, order_col]
    ranged = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    return ranged.withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)


def running_before(ranged: DataFrame, group_cols: Sequence[str], order_col: str, value: str, out: str) -> DataFrame:
    """``out``: the exact sum of ``value`` over the rows of the group that come earlier in the order.

    ``ranged`` is from ``range_order`` and has one row per (group, order).  A window runs inside each
    (group, range); the totals of the ranges before are added by a join.  A group's window over its
    totals sees at most one row per range.  Groups may be null.
    """
    g = list(group_cols)
    inside = Window.partitionBy(*g, "_range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*[f"_g{i}" for i in range(len(g))]).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    totals = (ranged.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)], F.col("_range").alias("_r"))
                    .agg(F.sum(value).alias("_t")).withColumn("_start", F.coalesce(F.sum("_t").over(over), zero)).drop("_t"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(g)], F.col("_range") == F.col("_r"))
    return (ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), zero)).join(totals, same)
                  .withColumn(out, F.col("_start") + F.col("_inside"))
                  .select(*[c for c in ranged.columns if c != "_range"], out))


def exact_quantiles(df: DataFrame, cols: Iterable[str], ratios: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``(column_name, q: array<double>)``: exact discrete quantiles of numeric columns at any size.

    Values collapse to (column, value) counts map-side; the counts are range-sorted, and the value
    at rank ``ceil(ratio * n)`` is the one whose running count reaches it.  Nulls are left out; a
    column without values has no row.
    """
    cols = list(cols)
    pair = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols]))
    counts = df.select(pair).where("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    ranged = range_order(counts, ["column_name"], "value")
    size = ranged.groupBy(F.col("column_name").alias("_c")).agg(F.sum("n").alias("size"))
    ranks = running_before(ranged, ["column_name"], "value", "n", "before").join(size, F.col("column_name") == F.col("_c"))

    def at(ratio):
        rank = F.greatest(F.col("size") - F.floor(F.col("size") - F.lit(float(ratio)) * F.col("size")), F.lit(1))
        return F.max(F.when((F.col("before") < rank) & (rank <= F.col("before") + F.col("n")), F.col("value")))

    return ranks.groupBy("column_name").agg(F.array(*[at(r) for r in ratios]).alias("q"))
