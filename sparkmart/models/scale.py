"""Standard scaling fitted on the training rows only (MLD-4, D21)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_scaler(df: DataFrame, cols: Iterable[str]) -> dict[str, tuple[float, float]]:
    """One ``agg`` of ``avg`` and population ``stddev`` per column -> ``{col: (mean, std)}``.

    Nulls are skipped (as sklearn skips NaN); a zero or undefined std becomes 1.
    """
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m__{c}"), F.stddev_pop(x).alias(f"s__{c}")]
    row = df.agg(*aggs).first()
    out = {}
    for c in cols:
        mean, std = row[f"m__{c}"], row[f"s__{c}"]
        out[c] = (mean if mean is not None else 0.0, std if std else 1.0)
    return out


def apply_scaler(df: DataFrame, stats: Mapping[str, tuple[float, float]], fill_null: float | None = 0.0,
                 suffix: str = "") -> DataFrame:
    """``(x - mean) / std``; with ``fill_null`` set, a missing value becomes that (0 = the mean)."""
    exprs = {}
    for c, (mean, std) in stats.items():
        z = (F.col(c).cast("double") - F.lit(mean)) / F.lit(std)
        if fill_null is not None:
            z = F.coalesce(z, F.lit(float(fill_null)))
        exprs[f"{c}{suffix}"] = z
    return df.withColumns(exprs)
