"""Projection, casts and schema enforcement (PRJ-1..11).

Each function builds one ``select`` so the optimizer sees a single projection instead of a
chain of ``withColumn`` calls.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _type_name(t) -> str:
    return t.simpleString() if isinstance(t, T.DataType) else str(t)


_INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "long"}


def _cast(df: DataFrame, c: str, to: str):
    """``try_cast``; whole-number text with a decimal point (``"1.0"``) still becomes an integer."""
    col = F.col(c)
    if to in _INTEGRAL and isinstance(df.schema[c].dataType, T.StringType):
        # a cast that fails costs an exception inside, so text with a point is never tried as an integer first
        whole = F.when(~F.contains(col, F.lit(".")), col.try_cast(to))
        return F.coalesce(whole, col.try_cast("decimal(38,10)").try_cast(to))
    return col.try_cast(to)


def enforce_schema(df: DataFrame, types: Mapping[str, object], strict: bool = True) -> DataFrame:
    """Cast named columns with ``try_cast`` in one projection (PRJ-6 / PRJ-7).

    ``strict=True`` raises on a missing column (monthly mart); ``strict=False`` skips absent
    columns (daily mart).  Columns not named keep their type and position.
    """
    present = set(df.columns)
    missing = [c for c in types if c not in present]
    if strict and missing:
        raise ValueError(f"columns missing for schema enforcement: {missing}")
    exprs = []
    for c in df.columns:
        if c in types:
            exprs.append(_cast(df, c, _type_name(types[c])).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def cast_to_double(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Every non-key column to double (PRJ-8)."""
    keys = set(keys)
    return df.select(*[F.col(c) if c in keys else F.col(c).try_cast("double").alias(c)
                       for c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def select_numeric(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Keys plus the numeric columns (PRJ-9)."""
    keep = list(keep)
    return df.select(*keep, *[c for c in numeric_columns(df) if c not in keep])


def select_prefix(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Keys plus columns whose name starts with ``prefix`` (PRJ-10)."""
    keep = list(keep)
    return df.select(*keep, *[c for c in df.columns if c.startswith(prefix) and c not in keep])


def drop_if_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """PRJ-2/PRJ-3: ``drop`` already ignores names that are absent."""
    return df.drop(*cols)


def schema_audit(df: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """Per column: values that are present but do not cast to double (PRJ-11).

    One aggregation pass over the table, then an unpivot of that single row, giving
    ``(column_name, data_type, non_null, not_numeric)``.
    """
    keys = set(keys)
    cols = [f for f in df.schema.fields if f.name not in keys]
    aggs = []
    for f in cols:
        c = F.col(f.name)
        aggs.append(F.count(c).alias(f"nn__{f.name}"))
        aggs.append(F.count_if(c.isNotNull() & c.try_cast("double").isNull()).alias(f"bad__{f.name}"))
    wide = df.agg(*aggs)
    rows = F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"nn__{f.name}").alias("non_null"), F.col(f"bad__{f.name}").alias("not_numeric"))
        for f in cols]))
    return wide.select(rows)
