"""Substring dedup: prefix-partitioned suffix trees over words.

A *window* is ``WINDOW`` (35) consecutive words of one text.  Every word that is covered by a window
whose word sequence also starts anywhere else - in another row, or elsewhere in the same text - is
removed; all windows are judged on the input.

The suffix tree is sparse: it holds the suffixes that start at *anchors*, the positions at which an
eight-word prefix hash is the (leftmost) minimum of some window.  Equal windows pick the same anchor
at the same offset, so every repeated window shows up as two anchors with a common prefix of at
least eight words, and no window is missed.

1. One pass hashes every text and lands, per row, its words' digest and its anchors: ``g`` (the
   eight-word prefix), ``c`` (all words that the anchor's windows cover) and the window range.
2. Prefixes that occur once are leaves at the root and are pruned (counted with map-side partials).
3. Anchors with an equal (g, c) end in the same deep node: all their windows repeat.
4. For prefixes with several different ``c``, one representative of each goes to the subtree of its
   prefix.  A task takes the prefixes that hash to it, sorts their suffixes (35 words forward) and
   their left contexts (27 words backward), and reads node identities off the neighbours' common
   prefix lengths: two windows at offset ``o`` are equal if they share the forward node at depth
   ``35 - o`` and the backward node at depth ``o``.  These deep internal nodes are the repeats.
5. A prefix with more than ``group_limit`` suffixes would not fit a task: its prefix grows to the
   whole window, and the nodes are counted with map-side partials instead.
6. Ranges go back to the texts, which drop the covered words.

Only texts with an anchor of a shared prefix are moved again; the others are answered from step 1.
Nulls count as empty texts (no words); texts under 35 words have no window; repeated rows make all
windows of their text repeated.  Ids may be null or repeated; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import textkernel as K
from sparkmart.llm.common import digest, land, ship_package

WINDOW = 35
PREFIX = 8
#: Suffixes of one prefix that a task sorts in memory (about 300 bytes each).
GROUP_LIMIT = 100_000


def _anchors(g: np.ndarray, row_first: np.ndarray, window: int, prefix: int):
    """Anchors of all windows of a slice: (row, anchor, least start, greatest start) by word index.

    ``g[i]`` hashes the ``prefix`` words from word ``i``; windows are the runs of
    ``window - prefix + 1`` prefixes inside one row.
    """
    span = window - prefix + 1
    starts, row = K.gram_starts(row_first, window)
    if len(starts) == 0:
        return row, starts, starts, starts
    # Minimum over [s, s + span) by doubling; ties go to the left, as (hash, position) pairs do.
    rank = (g >> K.U64(1)).astype(np.int64)
    best, at = rank.copy(), np.arange(len(g))
    width = 1
    while width < span:
        step = min(width, span - width)
        other, where = best[step:], at[step:]
        less = other < best[:-step]
        best[:-step] = np.where(less, other, best[:-step])
        at[:-step] = np.where(less, where, at[:-step])
        width += step
    anchor = at[starts]
    cut = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))))
    last = np.concatenate((cut[1:], [len(anchor)])) - 1
    return row[cut], anchor[cut], starts[cut], starts[last]


def _words_of(data, starts, ends, first, i):
    raw = data.tobytes() if not isinstance(data, bytes) else data
    return [raw[s:e] for s, e in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])]


def scan(base: DataFrame, window: int, prefix: int) -> DataFrame:
    """Per row of (id, text, h1, h2): number of words, sha256 of the words, and the anchors."""
    def one_pass(batches):
        for batch in batches:
            for part in K.slices(batch, "text"):
                data, off = K.text_bytes(part.column("text"))
                starts, ends, first = K.find_words(data, off)
                grams = K.Grams(K.hash_words(data, starts, ends))
                at = np.arange(len(starts))
                g = grams(at, np.minimum(at + prefix, len(starts)))
                row, anchor, lo, hi = _anchors(g, first, window, prefix)
                c = grams(lo, hi + window) ^ K.mix(((anchor - lo) << 8 | (anchor - hi)).view(K.U64))
                packed = (anchor - first[row]) << 16 | (anchor - hi) << 8 | (anchor - lo)
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                raw = data.tobytes()
                sha = [hashlib.sha256(b" ".join(raw[off[i]:off[i + 1]].split())).hexdigest() for i in range(part.num_rows)]
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(v)) for v in (K.signed(g[anchor]), K.signed(c), packed)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("h1"), part.column("h2"), pa.array(np.diff(first)), pa.array(sha), *lists],
                    names=["id", "h1", "h2", "n_words", "sha", "g", "c", "packed"])

    return base.mapInArrow(one_pass, "id long, h1 long, h2 long, n_words long, sha string, "
                                     "g array<long>, c array<long>, packed array<long>")


# --- subtrees -------------------------------------------------------------------------------

def _nodes(sorted_rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each sorted row with the one above (-1 for the first)."""
    lcp = np.full(len(sorted_rows), -1, np.int64)
    if len(sorted_rows) > 1:
        same = sorted_rows[1:] == sorted_rows[:-1]
        lcp[1:] = np.where(same.all(axis=1), sorted_rows.shape[1], same.argmin(axis=1))
    return lcp


def _sort(rows: np.ndarray) -> np.ndarray:
    """Order of rows of big-endian words (bytewise, so row by row like the words)."""
    flat = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * rows.itemsize))).ravel()
    return np.argsort(flat, kind="stable")


def repeated_windows(forward: np.ndarray, backward: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which windows of each suffix repeat: bool matrix (suffix, offset), from the two sorted trees.

    ``forward`` holds the words from the anchor on, ``backward`` those before it, nearest first;
    windows of a suffix have the offsets ``least .. most``.
    """
    m, window = forward.shape
    out = np.zeros((m, backward.shape[1] + 1), dtype=bool)
    fo, bo = _sort(forward), _sort(backward)
    f_lcp, b_lcp = _nodes(forward[fo]), _nodes(backward[bo])
    f_node, b_node = np.empty(m, np.int64), np.empty(m, np.int64)
    for o in range(out.shape[1]):
        valid = np.flatnonzero((least <= o) & (o <= most))
        if len(valid) < 2:
            continue
        f_node[fo] = np.cumsum(f_lcp < window - o)
        b_node[bo] = np.cumsum(b_lcp < o)
        key = f_node[valid] * (m + 1) + b_node[valid]
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        out[valid, o] = count[inverse] > 1
    return out


def _contexts(reps: DataFrame, window: int, prefix: int) -> DataFrame:
    """Suffix and left context of each representative, or its windows' hashes if its prefix is hot.

    ``reps``: (node, text, want array<struct<g, packed, single, hot>>), one row per text.
    """
    back = window - prefix

    def cut(batches):
        for batch in batches:
            for part in K.slices(batch, "text"):
                data, off = K.text_bytes(part.column("text"))
                starts, ends, first = K.find_words(data, off)
                wh = K.hash_words(data, starts, ends)
                grams = K.Grams(wh)
                short = np.concatenate((np.maximum(wh >> K.U64(32), K.U64(1)).astype(">u4"), [0])).astype(">u4")
                want = part.column("want")
                lists = want.flatten() if isinstance(want, pa.ListArray) else want.combine_chunks().flatten()
                if len(lists) == 0:
                    continue
                per = np.asarray(pc.list_value_length(want)).astype(np.int64)
                row = np.repeat(np.arange(part.num_rows), per)
                g, packed = (np.asarray(lists.field(k)).astype(np.int64) for k in ("g", "packed"))
                single, hot = (np.asarray(lists.field(k).cast(pa.int8())).astype(bool) for k in ("single", "hot"))
                node = np.asarray(part.column("node")).astype(np.int64)[row]
                anchor, least, most = first[row] + (packed >> 16), (packed >> 8) & 255, packed & 255
                cold = np.flatnonzero(~hot)
                for i in range(0, len(cold), 20_000):
                    k = cold[i:i + 20_000]
                    f = anchor[k, None] + np.arange(window)
                    f = np.where(f < (anchor[k] - least[k] + window)[:, None], f, len(wh))
                    b = anchor[k, None] - 1 - np.arange(back)
                    b = np.where(b >= (anchor[k] - most[k])[:, None], b, len(wh))
                    rows = np.concatenate((short[f], short[b]), axis=1)
                    size = rows.shape[1] * 4
                    blob = rows.tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g[k]), pa.array([False] * len(k)), pa.array(node[k]), pa.array(packed[k]), pa.array(single[k]),
                         pa.array([blob[j * size:(j + 1) * size] for j in range(len(k))], pa.binary()), pa.array(np.zeros(len(k), np.int64)),
                         pa.array(np.zeros(len(k), np.int32))], names=["g", "hot", "node", "packed", "single", "words", "win", "offset"])
                for o in range(back + 1):
                    k = np.flatnonzero(hot & (least <= o) & (o <= most))
                    if len(k):
                        s = anchor[k] - o
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(g[k]), pa.array([True] * len(k)), pa.array(node[k]), pa.array(packed[k]), pa.array(single[k]),
                             pa.array([b""] * len(k), pa.binary()), pa.array(K.signed(grams(s, s + window))),
                             pa.array(np.full(len(k), o, np.int32))], names=["g", "hot", "node", "packed", "single", "words", "win", "offset"])

    return reps.mapInArrow(cut, "g long, hot boolean, node long, packed long, single boolean, words binary, win long, offset int")


def _subtrees(suffixes: DataFrame, window: int, prefix: int) -> DataFrame:
    """(node, start) of the repeated windows of single anchors; a task sorts all prefixes it holds.

    The number of tasks follows the number of suffixes, so that a task holds ``GROUP_LIMIT`` of them
    on average, whatever the input; one prefix has that many at most.
    """
    back = window - prefix

    def build(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        words = np.frombuffer(b"".join(table.column("words").to_pylist()), dtype=">u4").reshape(-1, window + back)
        packed = np.asarray(table.column("packed")).astype(np.int64)
        single = np.asarray(table.column("single").cast(pa.int8())).astype(bool)
        node = np.asarray(table.column("node")).astype(np.int64)
        found = repeated_windows(words[:, :window], words[:, window:], (packed >> 8) & 255, packed & 255)
        i, o = np.nonzero(found & single[:, None])
        yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array((packed[i] >> 16) - o)], names=["node", "start"])

    spark = suffixes.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-suffixes.count() // GROUP_LIMIT))
    return (suffixes.select("g", "node", "packed", "single", "words").repartition(tasks, "g")
            .select("node", "packed", "single", "words").mapInArrow(build, "node long, start long"))


def _apply(texts: DataFrame, window: int) -> DataFrame:
    """(h1, h2, n_removed, kept_sha256, kept) of (h1, h2, text, ranges array<struct<lo, hi>>)."""
    def drop(batches):
        for batch in batches:
            for part in K.slices(batch, "text"):
                data, off = K.text_bytes(part.column("text"))
                starts, ends, first = K.find_words(data, off)
                raw, removed, kept = data.tobytes(), [], []
                for i, ranges in enumerate(part.column("ranges").to_pylist()):
                    words = _words_of(raw, starts, ends, first, i)
                    edge = np.zeros(len(words) + 1, np.int64)
                    if ranges:
                        np.add.at(edge, [r["lo"] for r in ranges], 1)
                        np.add.at(edge, [r["hi"] for r in ranges], -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    removed.append(int(gone.sum()))
                    kept.append(b" ".join(w for w, x in zip(words, gone) if not x).decode())
                sha = [hashlib.sha256(k.encode()).hexdigest() for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [part.column("h1"), part.column("h2"), pa.array(removed, pa.int64()), pa.array(sha), pa.array(kept, pa.string())],
                    names=["h1", "h2", "n_removed", "kept_sha256", "kept"])

    return texts.mapInArrow(drop, "h1 long, h2 long, n_removed long, kept_sha256 string, kept string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   prefix: int = PREFIX, group_limit: int = GROUP_LIMIT, with_text: bool = False) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256 (and ``kept``, the words left, for
    rows that lost some; null for untouched rows) - see the module text."""
    spark = docs.sparkSession
    ship_package(spark)
    h1, h2 = digest(F.col(text_col))
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       h1.alias("h1"), h2.alias("h2"))
    rows = land(scan(base, window, prefix).withColumn("rid", F.monotonically_increasing_id()), "sub-rows")
    anchors = (rows.where(F.size("g") > 0).select("rid", F.explode(F.arrays_zip("g", "c", "packed")).alias("a"))
               .select("rid", "a.g", "a.c", "a.packed"))
    shared = (anchors.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"))
              .where("n > 1").select("g", (F.col("lo") != F.col("hi")).alias("mixed")))
    live = land(anchors.join(shared, "g"), "sub-live")

    deep = land(live.groupBy("g", "c", "mixed").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "packed")).alias("rep")), "sub-deep")
    position, least, most = F.shiftright("packed", 16), F.shiftright("packed", 8).bitwiseAND(255), F.col("packed").bitwiseAND(255)
    whole = (live.join(deep.where("n > 1").select("g", "c"), ["g", "c"])
             .select("rid", (position - most).alias("lo"), (position - least + window).alias("hi")))

    crowded = deep.where("mixed").groupBy("g").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > group_limit).select("g", F.lit(True).alias("hot"))
    reps = (deep.where("mixed").join(crowded, "g", "left")
            .select(F.col("rep.rid").alias("node"), F.struct("g", F.col("rep.packed").alias("packed"), (F.col("n") == 1).alias("single"),
                                                             F.coalesce("hot", F.lit(False)).alias("hot")).alias("w"))
            .groupBy("node").agg(F.collect_list("w").alias("want")))  # at most the anchors of one text

    touched = live.select("rid").distinct().join(rows.select("rid", "h1", "h2"), "rid").groupBy("h1", "h2").agg(F.min("rid").alias("node"))
    texts = land(base.select("text", "h1", "h2").join(touched, ["h1", "h2"]).dropDuplicates(["h1", "h2"]), "sub-texts")
    suffixes = land(_contexts(texts.select("node", "text").join(reps, "node"), window, prefix), "sub-suffixes")
    cold = _subtrees(suffixes.where("not hot"), window, prefix)
    hot = suffixes.where("hot")
    twice = hot.groupBy("g", "win").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g", "win")
    hot = hot.where("single").join(twice, ["g", "win"]).select("node", (F.shiftright("packed", 16) - F.col("offset")).alias("start"))
    ranges = whole.union(cold.union(hot).select(F.col("node").alias("rid"), F.col("start").alias("lo"), (F.col("start") + window).alias("hi")))
    merged = ranges.distinct().groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    cut = _apply(texts.select("h1", "h2", "node", "text").join(merged, F.col("node") == F.col("rid"))
                 .select("h1", "h2", "text", "ranges"), window)
    cut = cut if with_text else cut.drop("kept")
    return (rows.select("id", "h1", "h2", "n_words", "sha").join(cut, ["h1", "h2"], "left")
            .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("kept_sha256", "sha").alias("kept_sha256"), *(["kept"] if with_text else [])))
