"""op13 against plain Python (the registered query also has SQL)."""

import random

import pytest

from sparkmart.llm import conversation_trie as C
from sparkmart.llm import queries as Q
from tests.conftest import SF0001
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string, path string, skeleton int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def made_up(seed):
    """Copies (a third of all conversations), shared openings, null and repeated turns, nulls everywhere, negative and lone ids."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(150), -3, -25, 1000, 2**40]:
        hot = c % 3 == 0
        for t in range(0 if c == 77 else 3 if hot else rng.randrange(1, 9)):
            text = f"hot {t}" if hot else rng.choice(["a b", "c", "", None, "d e f"]) if t > 1 else rng.choice(["x y", "z"])
            rows.append((c, t if rng.random() < 0.95 or hot else None, None if hot and t == 1 else rng.choice(["user", "assistant"]), text))
    rows += [(None, 0, "user", "no id"), (None, None, None, None), (5, 0, "user", "again"), (5, 0, "user", "again"), (6, None, None, None)]
    rows += [(40, t, "user", "t" * (t % 7)) for t in range(300)] + [(41, t, "user", "t" * (t % 7)) for t in range(300)]
    return [r for r in rows if r[0] != 60]


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shards, run", [(None, C.RUN_IDS), (1, 1), (7, 2), (40, 3)])
def test_trie(spark, shards, run):
    """Many shards put most nodes into the skeleton; one shard leaves it at the root; short runs are streamed."""
    rows = made_up(shards or 3)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(4)
    assert got(C.trie(df, shards=shards, run_ids=run)) == sorted(brute.trie(rows), key=repr)


def test_empty(spark):
    assert C.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    turnless = spark.createDataFrame([(21, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    assert got(C.trie(turnless)) == sorted(brute.trie([(21, 0, "user", "x")]), key=repr)


def test_query_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(Q.op13_conversation_trie(spark, SF0001)) == sorted(brute.trie(rows), key=repr)
