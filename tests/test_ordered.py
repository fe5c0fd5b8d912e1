"""Exact quantiles and running totals over range-sorted rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from sparkmart.models.train import SEARCH_SPACE, mapped_space, sample_space
from sparkmart.operators.ordered import exact_quantiles, range_order, running_before


def test_quantiles_above_100000_rows(spark):
    path = "/root/testdata/sf0.1/lineitem.parquet"
    cols = ["l_extendedprice", "l_quantity"]
    got = {r["column_name"]: list(r["q"]) for r in exact_quantiles(spark.read.parquet(path), cols).collect()}
    sql = ", ".join(f"quantile_disc({c}, [0.25, 0.5, 0.75])" for c in cols)
    row = duckdb.connect().execute(f"SELECT count(*), {sql} FROM '{path}'").fetchone()
    assert row[0] > 100_000
    assert got == {c: [float(x) for x in v] for c, v in zip(cols, row[1:])}


def test_quantiles_of_ties_nulls_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (None, None), (9.0, None)], "a double, b double")
    assert [(r["column_name"], list(r["q"])) for r in exact_quantiles(df, ["a", "b"]).collect()] == [("a", [1.0, 1.0, 9.0])]


@pytest.mark.parametrize("ranges", [1, 7])
def test_running_totals_in_null_and_large_groups(spark, ranges):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("g"), F.col("id").alias("x"), (F.col("id") % 5).alias("v"))
    got = running_before(range_order(df, ["g"], "x", ranges), ["g"], "x", "v", "before").collect()
    run = {}
    for r in sorted(got, key=lambda r: r["x"]):
        assert r["before"] == run.get(r["g"], 0)
        run[r["g"]] = run.get(r["g"], 0) + r["v"]
    assert len(got) == 3000


def test_search_draws_only_settings_the_model_has():
    draws = sample_space(mapped_space(SEARCH_SPACE), 100)
    assert len({tuple(sorted(d.items())) for d in draws}) == 100
    assert not {"reg_alpha", "reg_lambda"} & set(draws[0])
