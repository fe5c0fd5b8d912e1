"""The corpus pipeline at sf0.001, each stage against plain Python on its own input."""

import corpus_pipeline
from sparkmart.llm import tokenizer
from sparkmart.llm.common import land, read_documents
from tests.conftest import SF0001
from tests.llm import brute


def test_stages(spark):
    docs = read_documents(spark, SF0001)
    columns, seen = docs.columns, {"documents": {r["doc_id"]: r for r in docs.collect()}}
    last = "documents"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = land(stage(spark, docs, SF0001), "test-" + name)
        assert docs.columns == columns
        rows = docs.collect()
        assert {r["doc_id"] for r in rows} <= set(seen[last])
        assert all(tuple(r) == tuple(seen[last][r["doc_id"]]) for r in rows)  # whole rows, unchanged
        seen[name], last = {r["doc_id"]: r for r in rows}, name
    assert all(not brute.quality(r["text"])[-1] for r in seen["quality"].values())
    groups = brute.near_classes([(i, r["text"]) for i, r in seen["quality"].items()])
    assert sorted(seen["near_dedup"]) == sorted(g[0] for g in groups)

    enc = tokenizer.Encoder(tokenizer.load_vocabulary())
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF0001).collect()
    want = sum(len(enc.ids(r["text"])) + 1 for r in docs.collect())
    assert sum(r["n_tokens"] for r in out) == want and sorted(r["slot"] for r in out) == list(range(len(out)))
    assert {i for r in out for i in r["doc_ids"]} == set(seen["mixing"])
