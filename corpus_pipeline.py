"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, token output.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a frame,
which ``run`` writes as Parquet to the shared folder and reads again as the next stage's ``docs``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from sparkmart.llm import decontaminate, mixing, near_dedup, quality_rules, training_order
from sparkmart.llm.common import land, read_documents
from sparkmart.session import apply_runtime_conf


def quality(spark, docs, sf_dir):
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of copies and near copies."""
    return near_dedup.deduplicate(docs)


def benchmark_leaks(spark, docs, sf_dir):
    """Documents without a leaked benchmark item."""
    return decontaminate.remove_leaks(docs, read_documents(spark, sf_dir, "benchmark"))


def source_mix(spark, docs, sf_dir):
    """Documents drawn to the target weights, a row per copy, in curriculum order."""
    return mixing.mix(docs)


def token_output(spark, docs, sf_dir):
    """Fixed-length token sequences in training order, read back from their shard files."""
    return training_order.materialise(docs)


def configured(stage):
    """The stage, after the session settings that the operators rely on."""
    def run_stage(spark, docs, sf_dir):
        apply_runtime_conf(spark)
        return stage(spark, docs, sf_dir)
    run_stage.__name__, run_stage.__doc__ = stage.__name__, stage.__doc__
    return run_stage


STAGES = [("quality", configured(quality)), ("near_dedup", configured(near_duplicates)),
          ("decontamination", configured(benchmark_leaks)), ("mixing", configured(source_mix)),
          ("token_output", configured(token_output))]

#: The stages hash, sign and tokenise texts, which SQL does not express; tests/llm/test_pipeline.py checks
#: them against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = land(docs, f"stage-{name}")
    return docs
