"""Values that used to be lost without an error, and limits that used to depend on size."""

import pytest
from pyspark.sql import functions as F

from sparkmart.models.split import stratified_split
from sparkmart.operators.clean import strip_numeric
from sparkmart.operators.features import days_past_due, whole_months_since
from sparkmart.operators.profile import histogram
from sparkmart.operators.schema import enforce_schema
from sparkmart.queries import REGISTRY
from sparkmart.sources.readers import read_csv
from tests.conftest import SF001


def test_csv_columns_by_header_name(spark, tmp_root):
    spark.createDataFrame([("2024-01-01", 7, 1.5, "x")], "snapshot_date string, Customer_ID long, fe_1 double, extra string") \
        .write.option("header", True).csv(tmp_root)
    row = read_csv(spark, tmp_root, "fe_1 double, Customer_ID long, snapshot_date string").first()
    assert tuple(row) == (1.5, 7, "2024-01-01")
    with pytest.raises(ValueError, match="fe_2"):
        read_csv(spark, tmp_root, "fe_1 double, fe_2 double")


def test_whole_number_text(spark):
    df = spark.createDataFrame([("1.0", "4.0", "12345678.5_", 12345678.5, -3.0)], "a string, b string, c string, d double, e double")
    assert enforce_schema(df.select("a"), {"a": "int"}).first()["a"] == 1
    row = strip_numeric(df, int_cols=["b", "e"], decimal_cols=["c", "d"]).first()
    assert (row["b"], row["c"], row["d"], row["e"]) == (4, 12345678.5, 12345678.5, 3)
    assert strip_numeric(spark.createDataFrame([("1.25E7",)], "x string"), decimal_cols=["x"]).first()["x"] == 1.25e7


def test_whole_months_keep_null(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert df.select(whole_months_since(F.col("d"), F.lit("2024-01-01")).alias("m")).first()["m"] is None


def test_overflowing_ratio_does_not_fail(spark):
    df = spark.createDataFrame([(1, 1e-300, 1e300)], "installment_num int, due_amt double, overdue_amt double").withColumn("snapshot_date", F.lit("2024-01-01").cast("date"))
    assert days_past_due(df).first()["installments_missed"] == 0


def test_histogram_has_all_bins(spark):
    rows = histogram(spark.createDataFrame([(0.0,), (10.0,)], "x double"), "x", 30).orderBy("bin").collect()
    assert len(rows) == 30 and [r["count"] for r in rows] == [1] + [0] * 28 + [1]


def test_split_is_exact_at_any_size_and_number_of_classes(spark):
    df = spark.range(150_000).select("id", F.when(F.col("id") < 120_000, 0).otherwise(F.col("id")).alias("y"))
    got = {r["k"]: r["n"] for r in stratified_split(df, "id", "y").groupBy((F.col("y") == 0).alias("k"), "split")
           .count().where("split = 'train'").select("k", F.col("count").alias("n")).collect()}
    assert got[True] == 96_000 and got[False] == 30_000  # a class of one row goes to train


@pytest.mark.parametrize("name", ["closed_range", "half_open_range", "date_in_list"])
def test_month_windows_reach_the_scan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = REGISTRY[name][0](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
