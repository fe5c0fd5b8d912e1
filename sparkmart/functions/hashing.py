"""Deterministic per-key draws, independent of partitioning and of run order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.functions.util import as_col


def unit_hash(key, seed: int | str = 42) -> Column:
    """A number in [0, 1) from the first 32 bits of ``md5(key || '|' || seed)``.

    md5 is used (not ``hash``/xxhash64) because every SQL engine has it, so a split can be
    reproduced outside Spark bit for bit.
    """
    text = F.concat(as_col(key).cast("string"), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
