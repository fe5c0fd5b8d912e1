"""Every registered query against its DuckDB oracle at sf0.01, plus plan checks."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF0001, SF001
from tests.oracle_check import compare, duck

SLOW = {"gbt_score", "cv_search", "model_lifecycle"}
SQL = entry.oracle_sql()
QUERIES = entry.queries()
LLM = {n for n in QUERIES if n == "pipeline" or n.startswith("op")}  # tested in tests/llm, present if the subpackage is


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(set(SQL) - LLM))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF001).toPandas()
    want = con.sql(SQL[name]).to_arrow_table().to_pandas(date_as_object=True)
    res = compare(got, want)
    assert res["columns_match"], res
    assert res["exact"], res
    assert not res["dtype_mismatch"], res


def test_every_query_has_sql_or_is_model_job():
    assert set(QUERIES) - set(SQL) - LLM == {"gbt_score", "cv_search"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["mob", "bad_rate", "loans"]


def test_model_save_load_roundtrip(spark):
    rows = QUERIES["model_save_load"](spark, SF0001).collect()
    assert rows and all(r["same"] == r["rows"] == r["in_range"] for r in rows)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SLOW | LLM | {"model_save_load"}))
def test_no_python_udf_in_plans(spark, name):
    """Plans stay in the JVM: no row-at-a-time Python evaluation in any registered query."""
    plan = QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _nodes(plan):
    """All physical operators of a plan (through AQE wrappers and codegen stages)."""
    out, stack = [], [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        out.append(node)
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        kids = node.children()
        for i in range(kids.size()):
            stack.append(kids.apply(i))
    return out


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SLOW | LLM | {"model_save_load"}))
def test_no_cross_join_or_global_window(spark, name):
    """Scale guards: no cartesian / nested-loop joins, and every window is partitioned."""
    nodes = _nodes(QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan())
    names = {n.nodeName() for n in nodes}
    assert not names & {"CartesianProduct", "BroadcastNestedLoopJoin"}, names
    for n in nodes:
        if n.nodeName() == "Window":
            assert not n.partitionSpec().isEmpty(), f"{name}: global window"


def test_flagship_pushdown_and_pruning(spark):
    """The cohort cut reaches the orders scan; each scan reads only the columns it needs."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = QUERIES["bad_rate_curve"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate,2000-01-01T00:00)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_snapshot_filter_pushed_to_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = QUERIES["snapshot_eq"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-07-01T00:00)" in plan and "LessThan(o_orderdate,1998-08-01T00:00)" in plan
