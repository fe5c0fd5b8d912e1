"""Sinks and sources: dynamic partition overwrite, pruning, CSV landing."""

import datetime as dt

from pyspark.sql import functions as F

from sparkmart.sources.readers import read_snapshot, read_store, read_window
from sparkmart.sources.writers import write_snapshots


def _frame(spark, dates, tag):
    return spark.createDataFrame([(d, i, tag) for d in dates for i in range(3)], "snapshot_date date, k int, tag string")


def test_dynamic_overwrite(spark, tmp_root):
    d = [dt.date(2023, 1, 1), dt.date(2023, 2, 1), dt.date(2023, 3, 1)]
    write_snapshots(_frame(spark, d, "v1"), tmp_root)
    write_snapshots(_frame(spark, d[1:2], "v2"), tmp_root)
    write_snapshots(_frame(spark, d[1:2], "v3").limit(0), tmp_root)
    got = {(r["snapshot_date"], r["tag"]): r["n"] for r in
           read_store(spark, tmp_root).groupBy("snapshot_date", "tag").agg(F.count("*").alias("n")).collect()}
    assert got == {(d[0], "v1"): 3, (d[1], "v2"): 3, (d[2], "v1"): 3}


def test_partition_pruning_in_plan(spark, tmp_root):
    d = [dt.date(2023, 1, 1), dt.date(2023, 2, 1)]
    write_snapshots(_frame(spark, d, "v1"), tmp_root)
    for df in (read_snapshot(spark, tmp_root, "2023-02-01"), read_window(spark, tmp_root, "2023-02-01", "2023-03-01")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(snapshot_date" in plan
        assert df.count() == 3
