"""Registered queries of the training-data operators: ``opN_<name>(spark, sf_dir)`` over whole tables."""

from __future__ import annotations

from sparkmart.llm import (conversation_trie, decontaminate, language_id, line_dedup, mixing, near_dedup, quality_rules, secret_scan,
                           substring_dedup, suffix_dedup, token_alignment, token_counts, training_order)
from sparkmart.llm.common import read_documents, scratch_path
from sparkmart.llm.oracle import ORACLE_SQL


def op1_token_counts(spark, sf_dir):
    """Tokens of every line of every document (tokens go where they start)."""
    return token_counts.attribute(read_documents(spark, sf_dir))


def op2_secret_scan(spark, sf_dir):
    """Secrets of every document, through a new ledger."""
    return secret_scan.report(read_documents(spark, sf_dir), scratch_path(spark, "ledger"))


def op3_line_dedup(spark, sf_dir):
    """Lines that occur earlier, in the same document or another, removed."""
    return line_dedup.report(read_documents(spark, sf_dir))


def op4_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    return mixing.report(read_documents(spark, sf_dir))


def op5_substring_dedup(spark, sf_dir):
    """Words covered by 35-word windows that occur anywhere else, removed."""
    return substring_dedup.remove_repeats(read_documents(spark, sf_dir))


def op6_language_id(spark, sf_dir):
    """Language of every document."""
    return language_id.identify(read_documents(spark, sf_dir))


def op7_decontamination(spark, sf_dir):
    """Benchmark items leaked into every document."""
    return decontaminate.report(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "benchmark"))


def op8_quality_rules(spark, sf_dir):
    """Base counts and divergence verdict of every document."""
    return quality_rules.report(read_documents(spark, sf_dir))


def op9_near_dedup(spark, sf_dir):
    """Near-duplicate class of every document."""
    return near_dedup.classes(read_documents(spark, sf_dir))


def op10_training_order(spark, sf_dir):
    """All documents as fixed-length token sequences in training order, read back from their shard files."""
    return training_order.materialise(read_documents(spark, sf_dir))


def op11_token_alignment(spark, sf_dir):
    """Alignment of every document's tokens by two tokenizers, with corpus counts of the linked id pairs."""
    return token_alignment.align(read_documents(spark, sf_dir))


def op12_suffix_dedup(spark, sf_dir):
    """Bytes covered by 200-byte strings that occur anywhere else, removed."""
    return suffix_dedup.remove_repeats(read_documents(spark, sf_dir))


def op13_conversation_trie(spark, sf_dir):
    """Prefix trie of all rebuilt conversations."""
    return conversation_trie.trie(read_documents(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_secret_scan, op3_line_dedup, op4_mixing, op5_substring_dedup, op6_language_id,
    op7_decontamination, op8_quality_rules, op9_near_dedup, op10_training_order, op11_token_alignment,
    op12_suffix_dedup, op13_conversation_trie)}
ORACLES = {k: v for k, v in ORACLE_SQL.items() if k in QUERIES}
