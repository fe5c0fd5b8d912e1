"""Extracts of the marts are joined and grouped once; text cleaning without failing casts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkmart.functions.text import strip_to_decimal, strip_to_digits
from sparkmart.operators.schema import enforce_schema
from sparkmart.queries import feature_mart_q, loanbook_q


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("extracts"))
    day = dt.datetime(1996, 5, 4)
    frames = {
        "orders": spark.createDataFrame([(i, i % 3, "FOP"[i % 3], 10.0 * i, day, "1-URGENT") for i in range(9)],
                                        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": spark.createDataFrame([(i % 9, 1 + i % 7, 30.0, 5.0, "A", "F", day) for i in range(20)],
                                          "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "customer": spark.createDataFrame([(i, f"C{i}", 1, 5.0, "BUILDING") for i in range(3)],
                                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": spark.createDataFrame([(1, "PERU")], "n_nationkey int, n_name string")}
    for name, df in frames.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return root


def joined(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "Join Inner" in plan or "Join Left" in plan


def test_loan_book_extracts_read_landed_rows(spark, tables):
    raw = loanbook_q.raw_extracts(spark, tables)
    assert not any(joined(df) for df in raw.values())
    assert raw["financial"].count() == 3 and raw["financial"].agg(F.sum("bc_util")).first()[0] == 30.0


def test_feature_extracts_read_landed_rows(spark, tables):
    attributes, financials, _ = feature_mart_q.raw_extracts(spark, tables)
    assert not joined(attributes) and not joined(financials)
    assert attributes.count() == 3 and {r["Type_of_Loan"] for r in financials.collect()} == {"and Auto Loan"}


def test_text_without_a_number_is_null(spark):
    texts = ["", "_", "23_", "-4.0", "2.5e3", "x1E2y", "1.2.3", "e", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", strip_to_digits("t").alias("whole"), strip_to_decimal("t").alias("real")).orderBy("i").collect()
    assert [r["whole"] for r in got] == [None, None, 23, 4, 2500, 100, 12, None, None]
    assert [r["real"] for r in got] == [None, None, 23.0, 4.0, 2500.0, 100.0, None, None, None]


def test_whole_numbers_with_a_point(spark):
    df = spark.createDataFrame([("3",), ("3.0",), (" 4 ",), ("5.",), ("1e2",), ("x",), ("",), (None,)], "c string")
    assert [r["c"] for r in enforce_schema(df, {"c": "int"}).collect()] == [3, 3, 4, 5, 100, None, None, None]
