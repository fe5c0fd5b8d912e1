"""op11 against whole-text encoding and plain loops."""

import random

import pytest

from sparkmart.llm import queries as Q
from sparkmart.llm import token_alignment as T
from tests.conftest import SF0001
from tests.llm import brute

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("hot", [T.HOT_PAIRS, 40, 0])
def test_edge_rows(spark, edge, edge_rows, hot):
    """A small number of hot pairs sends the others through the join."""
    assert rows_of(T.align(edge, hot_pairs=hot)) == sorted(brute.alignment([(r[0], r[1]) for r in edge_rows]), key=repr)


def strange_texts():
    rng = random.Random(5)
    parts = ["a", " ", "\n", "  ", "\t", "é", "漢", "\U0001F600", "▁", " ", "\x00", "\x01", "<|endoftext|>", "<s>", "<0x41>", "don't", "\r\n",
             " ", "1234", "é", "..", "zz", "\x1c", "　", "#x", "ﬁ", "﻿"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(600)] + ["\n", " ", "\n\nx", "x\n", "a\nb", "\na"]


def test_strange_texts(spark):
    rows = list(enumerate(strange_texts()))
    got = rows_of(T.align(spark.createDataFrame(rows, "doc_id long, text string")))
    want = sorted(brute.alignment(rows), key=repr)
    assert got == want
    assert sum(r[1] == 0 for r in want) > 20  # some have U+2581, which B turns into a space


def test_group_ends_and_texts(spark):
    df = spark.createDataFrame([(1, "Straße 漢\U0001F600 zzz"), (2, None)], "doc_id long, text string")
    r = {x["id"]: x for x in T.encode(df, with_groups=True).collect()}
    assert r[1]["ends"][-1] == len(" Straße 漢\U0001F600 zzz".encode()) and len(r[1]["ends"]) == r[1]["n_groups"]
    assert r[1]["groups"].count(";") == r[1]["n_groups"] - 1 and r[2]["ends"] == [] and r[2]["groups"] == ""


def test_held_units_are_bounded(monkeypatch):
    both = T.Aligner(T._read(T.A_VOCABULARY), T._read(T.B_VOCABULARY))
    monkeypatch.setattr(T, "HELD_UNITS", 3)
    first = [x[:4] for x in both.texts_of(["one two three four five"])]
    list(both.texts_of(["six seven"]))
    assert len(both.unit) == 2
    assert [x[:4] for x in both.texts_of(["one two three four five"])] == first


def test_empty(empty):
    assert T.align(empty).count() == 0


def test_query_whole_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(Q.op11_token_alignment(spark, SF0001)) == sorted(brute.alignment([tuple(r) for r in docs]), key=repr)
