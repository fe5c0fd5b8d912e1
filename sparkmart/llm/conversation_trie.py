"""Conversation prefix trie, finished in sorted shards around a splitter skeleton.

Every conversation ``c`` is rebuilt first: the opening turns of conversation ``c - c % 20`` (the first
``h = crc32(c) % 4`` of them), then its own turns after its first ``h``.  A trie node is a distinct
sequence of opening turns (role, text); its members are the conversations that start with it.

1. A turn becomes a 128-bit digest of (role, text) and its number of words; a conversation becomes one
   row: its *path*, the digests end to end.  Texts are not moved further than that.
2. A sample of paths (``SAMPLE`` per shard, chosen by a hash of the id) gives the splitters: keys (path,
   conv_id) that cut the sorted order into shards of about equal size.  The id is part of the key, so
   a group of equal conversations, however large, is cut too.
3. Members of a node are neighbours in that order.  A node with members in two shards is a prefix of
   the splitter between them, so all nodes but the splitters' prefixes lie within one shard.  The trie
   of the splitter paths, the *skeleton*, is broadcast; its size is that of the splitters.
4. A task sorts its shard and finishes all its other nodes with one pass over the neighbours' common
   prefixes.  For skeleton nodes it hands on partial aggregates (smallest member, members, children,
   leaves and savings below), which are reduced by node.
5. Ids that end at a skeleton node travel as packed sorted runs; a task streams a node's runs in order
   through the hash, holding one run at a time.  (A hash over a node's sorted ids is sequential by its
   definition; the runs have 2 to 3 bytes an id.)

Turns are ordered by (turn, role, text), null turns first; a null role or text counts as empty.  Rows
without a conv_id belong to no conversation and are left out.  Repeated rows are turns of their own.
An empty table has no nodes.  ``%`` has the sign of its left side, so the ids -19 to 19 share
conversation 0.  A task holds the digests of one conversation's turns (24 bytes each) at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import land, ship_package, words_of

#: Paths sampled per shard to place the splitters.
SAMPLE = 40
#: Conversations of a shard on average, above the session's number of shuffle partitions.
SHARD_ROWS = 100_000
BLOCK = 20
STEP = 16  # bytes of a turn's digest
RUN_IDS = 100_000  # ids of a packed run

_NODE = [("conv_id", "long"), ("depth", "long"), ("parent", "long"), ("skeleton", "int"), ("above", "int"), ("n_convs", "long"),
         ("n_children", "long"), ("n_leaves", "long"), ("saved_tokens", "long"), ("ends_sha256", "string"), ("first", "long"), ("run", "binary")]
_SCHEMA = ", ".join(f"{n} {t}" for n, t in _NODE)


def rebuild(conversations: DataFrame) -> DataFrame:
    """(conv_id, path binary, words array<int>): every conversation rebuilt, its turns as digests."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    halves = [F.lpad(F.hex(F.xxhash64(*seed, role, text)), STEP, "0") for seed in ([], [F.lit(20250301)])]
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    turns = (conversations.where("conv_id is not null")
             .select(F.col("conv_id").cast("long"), base.cast("long").alias("base"),
                     F.struct(F.col("turn").alias("turn"), role.alias("role"), F.unhex(F.concat(*halves)).alias("digest"),
                              F.size(words_of(text)).alias("words")).alias("t")))
    # Partitioned by block: the grouping and the join with the block's first conversation need no more exchanges.
    own = (turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
           .select("base", "conv_id", F.col("t.digest").alias("digest"), F.col("t.words").alias("words")))
    head = own.where("conv_id = base").select("base", F.slice("digest", 1, 3).alias("hd"), F.slice("words", 1, 3).alias("hw"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")

    both = own.join(head, "base", "left")

    def joined(opening, rest, kind):
        opening = F.coalesce(opening, F.array().cast(f"array<{kind}>"))
        return F.concat(F.slice(opening, F.lit(1), h), F.slice(rest, h + 1, F.greatest(F.size(rest), F.lit(1))))

    path = F.array_join(F.transform(joined(F.col("hd"), F.col("digest"), "binary"), F.hex), "")
    return both.select("conv_id", F.unhex(path).alias("path"), joined(F.col("hw"), F.col("words"), "int").alias("words"))


def splitters(paths: DataFrame, n: int, shards: int, sample: int = SAMPLE) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` keys (path, conv_id) that cut the ``n`` sorted paths into about equal
    shards, from about ``shards * sample`` of them."""
    every = max(1, n // (shards * sample))
    rows = paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0).select("path", "conv_id").toArrow()
    keys = sorted(zip(rows.column("path").to_pylist(), rows.column("conv_id").to_pylist()))
    return sorted({keys[i * len(keys) // shards] for i in range(1, shards)}) if keys else []


def skeleton_of(keys: list[tuple[bytes, int]]) -> dict[bytes, int]:
    """Number of each prefix of a splitter path; the root is 0 and parents come before children."""
    every = {path[:i] for path, _ in keys for i in range(0, len(path) + 1, STEP)} | {b""}
    return {p: i for i, p in enumerate(sorted(every, key=lambda p: (len(p), p)))}


class _Node:
    __slots__ = ("skeleton", "words", "least", "n", "children", "leaves", "saved", "ends", "done", "kids")

    def __init__(self, skeleton, words):
        self.skeleton, self.words, self.least, self.n, self.children, self.leaves, self.saved = skeleton, words, None, 0, 0, 0, 0
        self.ends = [] if skeleton is not None else hashlib.sha256()
        self.done, self.kids = False, []


class _Shard:
    """One pass over a sorted shard: the open nodes are the prefixes of the last path."""

    def __init__(self, skeleton: dict[bytes, int], run_ids: int = RUN_IDS):
        self.skeleton, self.run_ids, self.open, self.path, self.out = skeleton, run_ids, [], b"", []

    def add(self, conv: int, path: bytes, words: list[int]) -> None:
        if not self.open:
            self.open, self.path = [_Node(0, 0)], b""
        same, most = 0, min(len(path), len(self.path)) // STEP
        while same < most and path[same * STEP:(same + 1) * STEP] == self.path[same * STEP:(same + 1) * STEP]:
            same += 1
        while len(self.open) - 1 > same:
            self.close()
        for d in range(same, len(path) // STEP):
            mark = self.skeleton.get(path[:(d + 1) * STEP]) if self.open[-1].skeleton is not None else None
            self.open.append(_Node(mark, words[d]))
        node, self.path = self.open[-1], path
        node.n += 1
        node.least = conv if node.least is None else min(node.least, conv)
        if node.skeleton is None:
            node.ends.update((f",{conv}" if node.done else str(conv)).encode())
            node.done = True
        else:
            node.ends.append(conv)
            if len(node.ends) >= self.run_ids:
                self.run(node)

    def run(self, node: _Node) -> None:
        packed = zlib.compress(np.diff(np.array(node.ends, np.int64), prepend=0).astype("<i8").tobytes(), 1)
        self.out.append((None, None, None, node.skeleton, None, None, None, None, None, None, node.ends[0], packed))
        node.ends = []

    def close(self) -> None:
        node, depth = self.open.pop(), len(self.open) - 1
        above = self.open[-1] if self.open else None
        if above is not None:
            above.n += node.n
            above.least = node.least if above.least is None else min(above.least, node.least)
        if node.skeleton is not None:
            if node.ends:
                self.run(node)
            self.out.append((node.least, depth + 1, None, node.skeleton, None, node.n, node.children, node.leaves, node.saved, None, node.words, None))
            return
        leaves = node.leaves or 1
        saved = node.saved + (node.n - 1) * node.words
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        row = [node.least, depth + 1, None, None, above.skeleton, node.n, node.children, leaves, saved, node.ends.hexdigest(), None, None]
        for kid in node.kids:
            kid[2] = node.least
        self.out += map(tuple, node.kids)
        if above.skeleton is None:
            above.kids.append(row)  # waits for its parent's smallest member
        else:
            self.out.append(tuple(row))

    def finish(self) -> None:
        while self.open:
            self.close()


def shard_nodes(paths: DataFrame, keys: list[tuple[bytes, int]], skeleton: dict[bytes, int], run_ids: int = RUN_IDS) -> DataFrame:
    """Rows of all shards: finished nodes (``skeleton`` null; ``above`` is set if the parent is in the
    skeleton), partial skeleton nodes (their words in ``first``) and runs of ids that end there."""
    sc = paths.sparkSession.sparkContext
    shared = sc.broadcast((keys, skeleton))  # the splitters' size
    types = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in _NODE])

    def deal(batches):
        cuts = shared.value[0]
        for batch in batches:
            at = [bisect_right(cuts, k) for k in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(batch.column(c) for c in ("path", "conv_id", "words"))],
                                             names=["shard", "path", "conv_id", "words"])

    def finish(batches):
        state, shard = _Shard(shared.value[1], run_ids), None

        def rows():
            columns = [pa.array(x, t) for x, t in zip(zip(*state.out), types.types)]
            state.out = []
            return pa.RecordBatch.from_arrays(columns, schema=types)

        for batch in batches:
            for s, path, conv, words in zip(*(batch.column(c).to_pylist() for c in ("shard", "path", "conv_id", "words"))):
                if s != shard:
                    state.finish()
                    shard = s
                state.add(conv, path, words)
            if state.out:
                yield rows()
        state.finish()
        if state.out:
            yield rows()

    return (paths.mapInArrow(deal, "shard int, path binary, conv_id long, words array<int>")
            .repartition(len(keys) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(finish, _SCHEMA))


def _end_digests(runs: DataFrame) -> DataFrame:
    """(skeleton, ends_sha256): a node's runs in order through one hash."""
    def stream(batches):
        at = digest = None
        for batch in batches:
            out = []
            for node, run in zip(batch.column("skeleton").to_pylist(), batch.column("run").to_pylist()):
                ids = np.cumsum(np.frombuffer(zlib.decompress(run), "<i8"))
                text = ",".join(map(str, ids.tolist())).encode()
                if node != at:
                    if at is not None:
                        out.append((at, digest.hexdigest()))
                    at, digest = node, hashlib.sha256(text)
                else:
                    digest.update(b"," + text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out])], names=["skeleton", "ends"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([digest.hexdigest()])], names=["skeleton", "ends"])

    return runs.repartition("skeleton").sortWithinPartitions("skeleton", "first").mapInArrow(stream, "skeleton int, ends string")


def _roll_up(skeleton: dict[bytes, int], parts: dict) -> list[tuple]:
    """Whole skeleton nodes (number, conv_id, depth, parent, n_convs, n_children, n_leaves, saved) from
    the reduced partial aggregates, children before parents."""
    children, leaves, saved, out = Counter(), Counter(), Counter(), []
    for path, i in sorted(skeleton.items(), key=lambda x: -len(x[0])):
        p = parts[i]
        children[i] += p["n_children"]
        leaves[i] = (leaves[i] + p["n_leaves"]) or 1
        saved[i] += p["saved_tokens"] + (p["n_convs"] - 1) * p["words"]
        above = skeleton[path[:-STEP]] if path else None
        if path:
            children[above] += 1
            leaves[above] += leaves[i]
            saved[above] += saved[i]
        out.append((i, p["conv_id"], len(path) // STEP, parts[above]["conv_id"] if path else None, p["n_convs"], children[i], leaves[i], saved[i]))
    return out


def trie(conversations: DataFrame, shards: int | None = None, sample: int = SAMPLE, run_ids: int = RUN_IDS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 (see the module text; ``conversations`` has conv_id, turn, role, text)."""
    spark = conversations.sparkSession
    ship_package(spark)
    paths = land(rebuild(conversations), "trie-paths")
    n = paths.count()
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SHARD_ROWS))
    keys = splitters(paths, n, shards, sample)
    skeleton = skeleton_of(keys)
    rows = land(shard_nodes(paths, keys, skeleton, run_ids), "trie-shards")
    parts = {r["skeleton"]: r for r in rows.where("skeleton is not null and run is null").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("first").alias("words")).collect()}  # at most the skeleton
    whole = spark.createDataFrame(_roll_up(skeleton, parts) if n else [],
                                  "skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                  "n_leaves long, saved_tokens long")
    ends = _end_digests(rows.where("run is not null").select("skeleton", "first", "run"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    top = whole.join(ends, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())))
    above = F.broadcast(whole.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("above_id")))
    rest = (rows.where("skeleton is null").join(above, "above", "left")
            .withColumn("parent_conv_id", F.coalesce("parent", "above_id")))
    return top.select(*columns).union(rest.select(*columns))
