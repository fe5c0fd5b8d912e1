"""Access to the provided parquet tables (``{sf_dir}/{name}.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; column pruning and filters reach the scan through Catalyst."""
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
