"""Saved imputers and encoders, sparse encoding, co-located stores, redelivery, quarantine, text and mode edge cases."""

import datetime as dt

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.text import strip_to_decimal, strip_to_digits
from sparkmart.models.stages import CategoryEncoder, MeanImputer, ModeImputer, StandardScalerStage, fit_or_load
from sparkmart.operators.clean import fit_modes
from sparkmart.operators.encode import count_values, encode_sparse, expand_indexed, fit_indexed_one_hot, number_values
from sparkmart.operators.filters import range_with_fallback
from sparkmart.plans import loanbook_mart as lm
from sparkmart.queries.io_q import bucketed_stores
from sparkmart.session import scratch_path
from sparkmart.sources.readers import read_csv_checked
from sparkmart.streaming import run_replacing
from tests.conftest import SF0001


def test_saved_stages_treat_a_second_window_alike(spark, tmp_root):
    first = spark.createDataFrame([(1, 2.0, 9007199254740993, "a"), (2, None, 9007199254740993, "b"), (3, 4.0, None, "a")], "k int, x double, n long, c string")
    second = spark.createDataFrame([(4, None, None, "new"), (5, 1.0, 7, "b"), (6, None, 8, None)], "k int, x double, n long, c string")
    stages = [MeanImputer(settings={"cols": ["x"]}), ModeImputer(settings={"cols": ["n"]}), CategoryEncoder.over(["c"], drop_last=False)]
    a = fit_or_load(spark, f"{tmp_root}/stages", stages, first).transform(second)
    b = fit_or_load(spark, f"{tmp_root}/stages", stages, second).transform(second)  # loads, does not fit
    assert a.columns == b.columns == ["k", "x", "n", "c_0", "c_1", "c_2"]
    want = [(4, 3.0, 9007199254740993, 0.0, 0.0, 1.0), (5, 1.0, 7, 0.0, 1.0, 0.0), (6, 3.0, 8, 0.0, 0.0, 1.0)]
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) == want


def test_scaler_stage(spark, tmp_root):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    PipelineModel(stages=[StandardScalerStage(settings={"cols": ["x"], "suffix": "_z"}).fit(df)]).write().save(f"{tmp_root}/scaler")
    assert [r["x_z"] for r in PipelineModel.load(f"{tmp_root}/scaler").transform(df).collect()] == [-1.0, 1.0, 0.0]


@pytest.mark.parametrize("drop_last", [True, False])
def test_category_encoder_equals_indexer_and_one_hot(spark, drop_last):
    rows = [("a", "x"), ("b", "x"), ("b", "y"), (None, "z"), ("c", None), ("d", "y"), ("b", "w")]
    df = spark.createDataFrame(rows, "p string, q string")
    model, widths = fit_indexed_one_hot(df, ["p", "q"], drop_last)
    want = expand_indexed(model, widths, df)
    got = CategoryEncoder.over(["p", "q"], drop_last).fit(df).transform(df)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())


def test_top_k_with_null_and_ties(spark):
    df = spark.createDataFrame([(v,) for v in ["a", "a", "b", "c", None, "d"]], "t string")
    model = CategoryEncoder.over(["t"], top={"t": 2}, names={"t": "t_ohe_{}"}).fit(df)
    assert model.get("values") == {"t": ["OTHER", "a", "b"]}  # c, d and the null are the rest
    assert sum(r["t_ohe_0"] for r in model.transform(df).collect()) == 3


def test_sparse_rows_equal_the_wide_form(spark):
    df = spark.createDataFrame([(i, v, w) for i, (v, w) in enumerate([("a", "x"), ("b", None), (None, "y"), ("new", "x"), ("a", "y")])], "k int, p string, q string")
    fit = df.where("k <> 3")
    got = encode_sparse(df, number_values(count_values(fit, ["p", "q"], keep_empty=True)), ["p", "q"], ["k"])
    model, widths = fit_indexed_one_hot(fit, ["p", "q"], drop_last=False)
    want = {r["k"]: list(r)[1:] for r in expand_indexed(model, widths, df).collect()}
    assert {r["k"]: r["features"].toArray().tolist() for r in got.collect()} == want


def test_sparse_rows_over_a_million_values(spark):
    df = spark.range(1_000_000).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("p"))
    got = encode_sparse(df, number_values(count_values(df, ["p"])), ["p"], ["k"])
    assert got.count() == 1_000_000 and got.first()["features"].size == 1_000_001
    assert got.limit(50).collect()[0]["features"].numNonzeros() == 1


def test_modes_keep_their_type(spark):
    df = spark.createDataFrame([(9007199254740993, dt.date(2024, 1, 1), True)] * 2 + [(1, None, False), (None, None, None)], "n long, d date, b boolean")
    df = df.withColumn("m", F.lit("12345678901234567.000001").cast("decimal(30,6)"))
    modes = fit_modes(df, ["n", "d", "b", "m"])
    assert modes["n"] == 9007199254740993 and str(modes["m"]) == "12345678901234567.000001"
    assert modes["d"] == "2024-01-01" and modes["b"] == "true"


def test_exponents(spark):
    df = spark.createDataFrame([("1.2345678E7",), ("2.5e3",), ("$1.5E2_",), ("4.0",), ("-25",), ("23_",), ("1e99",), ("E5",), (None,)], "t string")
    got = [tuple(r) for r in df.select(strip_to_digits("t"), strip_to_decimal("t")).collect()]
    assert got == [(12345678, 12345678.0), (2500, 2500.0), (150, 150.0), (4, 4.0), (25, 25.0), (23, 23.0), (None, 1e99), (5, 5.0), (None, None)]


def test_empty_range_is_refused(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2023, 5, 1),)], "snapshot_date date")
    with pytest.raises(ValueError, match="covers \\[2023-01-01, 2023-05-01\\]"):
        range_with_fallback(df, "snapshot_date", "2023-02-01", "2023-02-01")
    with pytest.raises(ValueError, match="the store is empty"):
        range_with_fallback(df.where("false"), "snapshot_date", "2023-01-01", "2024-01-01")


def test_bucketed_stores_join_without_an_exchange(spark):
    spend, lines = bucketed_stores(spark, SF0001, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spend.join(lines, ["Customer_ID", "snapshot_date"])
        by_date = lines.groupBy("Customer_ID", "snapshot_date").count()
        for df in (joined, spend.join(lines, ["Customer_ID", "snapshot_date"], "full"), by_date):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Bucketed: true" in plan
        plain = spend.select("*").repartition(3).join(lines.repartition(5), ["Customer_ID", "snapshot_date"])
        assert joined.count() == plain.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_redelivered_snapshots(spark, tmp_root):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("snapshot_date", T.DateType()), T.StructField("delivery", T.IntegerType())])
    jan, feb = dt.date(2024, 1, 1), dt.date(2024, 2, 1)

    def drop(n, rows):
        spark.createDataFrame(rows, "k int, snapshot_date date").repartition(2).write.parquet(f"{tmp_root}/in/delivery={n}")
        run_replacing(spark, f"{tmp_root}/in", schema, lambda d: d.withColumn("k2", F.col("k") * 2), f"{tmp_root}/out", f"{tmp_root}/ck", max_files_per_trigger=1)

    def held():
        return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_root}/out").select("k", "k2", "snapshot_date", "delivery").collect())

    drop(5, [(1, jan), (2, jan), (3, feb)])  # two files, a batch each: they add up
    assert held() == [(1, 2, jan, 5), (2, 4, jan, 5), (3, 6, feb, 5)]
    drop(7, [(9, jan)])
    assert held() == [(3, 6, feb, 5), (9, 18, jan, 7)]
    drop(6, [(4, jan), (5, feb)])  # late: older than January's, newer than February's
    assert held() == [(5, 10, feb, 6), (9, 18, jan, 7)]


def test_quarantine_keeps_every_line(spark, tmp_root):
    lines = ["a,b", "1,2.5", "x,1.0", "2,", "3", "4,5.0,6", '5,"6.5"', "6,y"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{tmp_root}/csv")
    rows, rejects = read_csv_checked(spark, f"{tmp_root}/csv", "b double, a int")
    assert sorted(map(tuple, rows.collect()), key=repr) == [(2.5, 1), (6.5, 5), (None, 2)]
    assert sorted(r["_line"] for r in rejects.collect()) == ["3", "4,5.0,6", "6,y", "x,1.0"]


def test_directory_of_extracts(spark):
    root = scratch_path(spark, "extracts")
    with pytest.raises(FileNotFoundError, match="credit_history"):
        lm.silver_from_directory(spark, root, f"{root}/silver")
