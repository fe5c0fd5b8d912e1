"""Calendar spines, window fallback and schema-merging reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkmart.operators.calendar import day_spine, month_spine
from sparkmart.operators.filters import in_month, range_with_fallback
from sparkmart.sources.readers import read_store
from sparkmart.sources.writers import write_snapshots

D = dt.date


def _dates(spark, *ds):
    return spark.createDataFrame([(d,) for d in ds], "d date")


def test_month_spine_truncates_start_and_is_inclusive(spark):
    df = _dates(spark, D(2023, 1, 15), D(2023, 4, 1))
    assert [r[0] for r in month_spine(df, "d").collect()] == [D(2023, 1, 1), D(2023, 2, 1), D(2023, 3, 1), D(2023, 4, 1)]
    assert [r[0] for r in month_spine(df, "d", inclusive=False).collect()] == [D(2023, 1, 1), D(2023, 2, 1), D(2023, 3, 1)]
    got = month_spine(df, "d", start="2022-11-20", end="2023-01-01").collect()
    assert [r[0] for r in got] == [D(2022, 11, 1), D(2022, 12, 1), D(2023, 1, 1)]


def test_day_spine(spark):
    assert day_spine(_dates(spark, D(2022, 1, 1), D(2022, 1, 30)), "d").count() == 30


def test_window_fallback(spark):
    df = _dates(spark, D(2023, 1, 1), D(2023, 2, 1), D(2023, 3, 1)).withColumnRenamed("d", "snapshot_date")
    assert range_with_fallback(df, "snapshot_date", "2023-02-01", "2023-03-01").count() == 1
    assert range_with_fallback(df, "snapshot_date", "2023-03-01", "2024-01-01").count() == 1
    with pytest.raises(ValueError):
        range_with_fallback(df, "snapshot_date", "2025-01-01", "2025-06-01")


def test_in_month_is_pushed_to_the_scan(spark, tmp_root):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 31, 23, 0),), (dt.datetime(2023, 2, 1, 0, 0),)], "ts timestamp_ntz")
    df.write.parquet(tmp_root)
    q = spark.read.parquet(tmp_root).where(in_month("ts", "2023-01-01"))
    assert q.count() == 1
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_merge_schema_across_snapshots(spark, tmp_root):
    a = spark.createDataFrame([(D(2023, 1, 1), 1)], "snapshot_date date, Occupation_a int")
    b = spark.createDataFrame([(D(2023, 2, 1), 1)], "snapshot_date date, Occupation_b int")
    write_snapshots(a, tmp_root)
    write_snapshots(b, tmp_root)
    merged = read_store(spark, tmp_root, merge_schema=True)
    assert {"Occupation_a", "Occupation_b"} <= set(merged.columns) and merged.count() == 2
