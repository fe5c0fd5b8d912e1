"""op12 against a table of all 200-byte strings."""

import random

import numpy as np
import pytest

from sparkmart.llm import queries as Q
from sparkmart.llm import suffix_dedup as S
from sparkmart.llm.common import join_counted, land
from tests.conftest import SF0001, SF001
from tests.llm import brute


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def passages():
    """Shared passages in many frames, overlaps, periods, multibyte letters, hot copies, border lengths."""
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdé漢 \n") for _ in range(n))
    long_ = noise(700)
    out = [noise(rng.randrange(0, 90)) + long_[a:a + rng.randrange(150, 400)] + noise(rng.randrange(0, 90)) for a in range(0, 600, 7)]
    out += ["x" * n for n in (199, 200, 201, 650)] + ["ab" * 400, "abc" * 90, noise(200), long_, long_[::-1]]
    out += [noise(150) + long_[:230] + noise(40) + long_[:230]] + ["hot " + long_[100:500]] * 40
    same = noise(210)
    return out + [same, same, "", None]


@pytest.mark.parametrize("limit", [S.GROUP_LIMIT, 1])
def test_edge_rows(edge, edge_rows, limit):
    """limit 1 sends every gram with several contexts down the whole-window way."""
    assert rows_of(S.remove_repeats(edge, group_limit=limit)) == sorted(brute.byte_repeats([(r[0], r[1]) for r in edge_rows]), key=repr)


@pytest.mark.parametrize("limit", [S.GROUP_LIMIT, 3])
def test_passages(spark, limit):
    rows = list(enumerate(passages()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(S.remove_repeats(df, group_limit=limit)) == sorted(brute.byte_repeats(rows), key=repr)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    data[3000:3600] = data[100:700]
    off = np.array([0, 10, 10, 4000, 5000])
    whole = set(zip(*[x.tolist() for x in S.anchors_of(data, off, 200, 32)[1:2]]))
    monkeypatch.setattr(S, "PIECE", 300)
    row, anchor, lo, hi, _, _ = S.anchors_of(data, off, 200, 32)
    assert {(a,) for a in anchor.tolist()} == whole
    covered = sorted(s for a, b in zip(lo, hi) for s in range(a, b + 1))
    assert covered == [*range(10, 3801), *range(4000, 4801)]


def test_kept_bytes(spark):
    text = "head " + "é" * 150 + " tail"
    df = spark.createDataFrame([(1, text), (2, "other " + "é" * 150)], "doc_id long, text string")
    r = {x["doc_id"]: x for x in S.remove_repeats(df, with_text=True).collect()}
    assert r[1]["kept"] == b"head tail" and r[1]["n_spans"] == 1 and r[2]["kept"] == b"other"


def test_empty(empty):
    assert S.remove_repeats(empty).count() == 0


def test_join_counted(spark):
    left = spark.createDataFrame([(i % 7 if i % 3 else 1, i) for i in range(300)], "k long, v long")
    counted = land(left.groupBy("k").count().withColumnRenamed("count", "n").where("k < 5"), "counted")
    for how in ("inner", "left"):
        want = sorted(map(repr, left.join(counted, ["k"], how).collect()))
        assert sorted(map(repr, join_counted(left, counted, ["k"], how, limit=4).select("k", "v", "n").collect())) == want


@pytest.mark.parametrize("folder", [SF0001, SF001])
def test_query_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(Q.op12_suffix_dedup(spark, folder)) == sorted(brute.byte_repeats(rows), key=repr)
