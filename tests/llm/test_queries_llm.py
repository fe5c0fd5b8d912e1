"""Registered queries at sf0.01: DuckDB SQL where there is one, brute force over all rows elsewhere."""

import pytest

from sparkmart.llm import queries as Q
from sparkmart.llm.decontaminate import UNITS
from tests.conftest import SF001
from tests.llm import brute
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_oracle(spark, name):
    res = compare(Q.QUERIES[name](spark, SF001).toPandas(), duck(SF001).sql(Q.ORACLES[name]).to_arrow_table().to_pandas(date_as_object=True))
    assert res["columns_match"] and res["exact"], res


def test_substring_dedup_whole_table(spark, docs):
    got = sorted(map(tuple, Q.op5_substring_dedup(spark, SF001).collect()))
    assert got == sorted(brute.repeats([(i, r["text"]) for i, r in docs.items()]))


def test_secret_scan_whole_table(spark, docs):
    for r in Q.op2_secret_scan(spark, SF001).collect():
        found = brute.secrets(docs[r["doc_id"]]["text"])
        assert r["base_sha256"] == brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in found))


def test_quality_whole_table(spark, docs):
    for r in Q.op8_quality_rules(spark, SF001).collect():
        assert tuple(r)[1:7] == brute.quality(docs[r["doc_id"]]["text"])


def test_decontamination_against_every_item(spark, docs):
    """Every document of a third of sf0.01 against every item, by tuples of words."""
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    some = [(i, r["text"]) for i, r in docs.items() if i % 3 == 0]
    want = brute.leaked_items(some, items, UNITS)
    got = {r["doc_id"]: set(r["items"]) for r in Q.op7_decontamination(spark, SF001).collect()}
    assert {i: got[i] for i, _ in some} == want and any(want.values())


def test_near_dedup_whole_table(spark, docs):
    groups = {}
    for r in Q.op9_near_dedup(spark, SF001).collect():
        groups.setdefault(r["class_id"], []).append(r["doc_id"])
    assert sorted(map(sorted, groups.values())) == brute.near_classes([(i, r["text"]) for i, r in docs.items()])


def test_language_held_out_accuracy(spark, docs):
    held = [r for r in Q.op6_language_id(spark, SF001).collect() if r["held_out"]]
    assert sum(docs[r["doc_id"]]["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_native_operators_run_no_python(spark):
    for name in ("op2_secret_scan", "op3_line_dedup", "op4_mixing", "op8_quality_rules"):
        plan = Q.QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin")), name
