"""Cleaning and imputation (CLN-1..11).

Imputers follow the fit/transform split of ``pyspark.ml``: ``fit`` runs one distributed
aggregation and returns one value per column (a bounded, driver-sized result); ``transform``
applies those values as literals, so no join or broadcast of statistics is needed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.text import normalise_text, null_if_in, strip_to_decimal, strip_to_digits


def null_sentinels(df: DataFrame, sentinels: Mapping[str, Iterable]) -> DataFrame:
    """CLN-1: ``{column: [sentinel, ...]}`` -> those values become null."""
    return df.withColumns({c: null_if_in(c, v) for c, v in sentinels.items()})


def strip_numeric(df: DataFrame, int_cols: Iterable[str] = (), decimal_cols: Iterable[str] = (),
                  decimal_type: str = "double") -> DataFrame:
    """CLN-2/3: clean text first, then ``try_cast`` (the reference cast first and lost values).

    Columns that are numbers already have no text to clean: only their sign is dropped (D5).
    """
    def number(c, to, strip):
        return F.abs(F.col(c)).try_cast(to) if isinstance(df.schema[c].dataType, T.NumericType) else strip(c, to)

    exprs = {c: number(c, "int", strip_to_digits) for c in int_cols}
    exprs.update({c: number(c, decimal_type, strip_to_decimal) for c in decimal_cols})
    return df.withColumns(exprs)


def cap_with_flag(df: DataFrame, col: str, cap, flag_col: str | None = None) -> DataFrame:
    """CLN-4: values above ``cap`` become ``cap``; the flag says which rows were capped.

    Null stays null with flag 0.
    """
    c = F.col(col)
    flag_col = flag_col or f"{col}_Overcap_Flag"
    return df.withColumns({
        flag_col: F.when(c > F.lit(cap), 1).otherwise(0),
        col: F.when(c > F.lit(cap), F.lit(cap).cast(df.schema[col].dataType)).otherwise(c),
    })


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """CLN-5: per-column constants.

    Unlike ``fillna``, a fractional fill of an integral column widens the column to double
    instead of truncating the fill (D11).
    """
    exprs = {}
    for c, v in values.items():
        dt = df.schema[c].dataType
        col = F.col(c)
        if isinstance(dt, T.IntegralType) and isinstance(v, float) and not float(v).is_integer():
            col = col.cast("double")
        exprs[c] = F.coalesce(col, F.lit(v).cast(col_type(dt, v)))
    return df.withColumns(exprs)


def col_type(dt: T.DataType, value) -> str:
    if isinstance(dt, T.IntegralType) and isinstance(value, float) and not float(value).is_integer():
        return "double"
    return dt.simpleString()


def fill_all_numeric(df: DataFrame, value=0, exclude: Iterable[str] = ()) -> DataFrame:
    """CLN-6: ``fillna(value)`` over every numeric column, as the reference's loan silver does."""
    exclude = set(exclude)
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    return df.fillna(value, subset=cols) if cols else df


def fit_means(df: DataFrame, cols: Iterable[str]) -> dict[str, float]:
    """CLN-7 fit: one ``agg`` of ``avg`` per column; returns ``{column: mean}``."""
    cols = list(cols)
    if not cols:
        return {}
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fill_mean(df: DataFrame, cols: Iterable[str], fit_df: DataFrame | None = None) -> DataFrame:
    """CLN-7: null -> column mean, computed on ``fit_df`` (default: ``df``), as double (D10, D11)."""
    cols = list(cols)
    means = fit_means(fit_df if fit_df is not None else df, cols)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c]).cast("double"))
                           for c in cols})


def fit_modes(df: DataFrame, cols: Iterable[str]) -> dict[str, object]:
    """CLN-8 fit: the most frequent non-null value per column, smallest value on ties (D9).

    One scan: each row is unpivoted to ``(column, value)`` pairs, counted with a partial
    (map-side) aggregation - a value holding a third of all rows collapses before the
    shuffle - and reduced per column with ``min(struct(-count, value))``, which is also
    associative, so no column is ever gathered into one task.  A value travels in the field of its
    kind (whole numbers as long, so that none is rounded; fractions as double; the rest, and the exact
    digits of decimals, as text) and comes back as the column's own type.
    """
    cols = list(cols)
    if not cols:
        return {}
    fields = {f.name: f.dataType for f in df.schema.fields}
    pairs = []
    for i, c in enumerate(cols):
        dt = fields[c]
        kinds = {"whole": isinstance(dt, T.IntegralType), "real": isinstance(dt, (T.FractionalType)), "txt": not isinstance(dt, T.IntegralType)
                 and not isinstance(dt, (T.DoubleType, T.FloatType))}
        types = {"whole": "bigint", "real": "double", "txt": "string"}
        pairs.append(F.struct(F.lit(i).alias("i"), *[(F.col(c) if on else F.lit(None)).cast(types[k]).alias(k) for k, on in kinds.items()],
                              F.col(c).isNull().alias("is_null")))
    counted = (df.select(F.inline(F.array(*pairs)))
                 .where(~F.col("is_null"))
                 .groupBy("i", "whole", "real", "txt").count())
    best = (counted.groupBy("i")
                   .agg(F.min(F.struct((-F.col("count")).alias("neg"), "whole", "real", "txt")).alias("m"))
                   .select("i", "m.whole", "m.real", "m.txt"))
    out: dict[str, object] = {c: None for c in cols}
    for r in best.collect():  # at most len(cols) rows
        c = cols[r["i"]]
        out[c] = next(r[k] for k in ("whole", "txt", "real") if r[k] is not None)
    return out


def fill_mode(df: DataFrame, cols: Iterable[str], fit_df: DataFrame | None = None) -> DataFrame:
    """CLN-8: null -> column mode (see ``fit_modes``)."""
    cols = list(cols)
    modes = fit_modes(fit_df if fit_df is not None else df, cols)
    fields = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(modes[c]).cast(fields[c]))
                           for c in cols if modes[c] is not None})


def missing_flags(df: DataFrame, cols: Iterable[str], suffix: str = "_missing") -> DataFrame:
    """CLN-9: ``{c}_missing = 1`` where ``c`` is null (or NaN for floating columns)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for c in cols:
        cond = F.col(c).isNull()
        if isinstance(fields[c], (T.DoubleType, T.FloatType)):
            cond = cond | F.isnan(F.col(c))
        exprs[f"{c}{suffix}"] = cond.cast("int")
    return df.withColumns(exprs)


def normalise_text_cols(df: DataFrame, cols: Iterable[str], missing: str = "MISSING") -> DataFrame:
    """CLN-10: ``upper(trim(coalesce(c, 'MISSING')))``."""
    return df.withColumns({c: normalise_text(c, missing) for c in cols})


def dedupe_keys(df: DataFrame, keys: Iterable[str], order_by: Iterable[str] | None = None) -> DataFrame:
    """CLN-11: one row per key, chosen deterministically.

    The survivor is the row with the smallest ``order_by`` tuple (default: all non-key
    columns in order), found with ``min(struct(...))``.  That is an associative aggregate, so
    Spark combines map-side: a key holding a third of the table shrinks to one row per input
    partition before the shuffle, instead of sorting the whole group in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by is not None else []
    order += [c for c in rest if c not in order]
    picked = (df.groupBy(*keys)
                .agg(F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])).alias("_w")))
    return picked.select(*keys, *[F.col(f"_w._o{order.index(c)}").alias(c) for c in rest])
