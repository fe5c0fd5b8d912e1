"""Suffix-array dedup: column-wise construction over bytes.

Every byte that is covered by a ``WINDOW`` (200) byte string which also starts anywhere else - in
another row, or elsewhere in the same text - is removed; strings are judged on the input and do not
cross rows.

Texts are cut into *contexts* first, so that the construction splits into tasks.  The *anchor* of a
window is the leftmost minimum of its 32-byte gram hashes; equal windows pick the same gram at the same
offset.  A context is what the windows of one anchor cover (at most 368 bytes), with the anchor in a
fixed column.  So equal windows are found among contexts with the same gram, and start in the same
column there.

1. One pass hashes every text and lands, per row, the digest of its bytes and its anchors: ``g`` (the
   gram), ``c`` (the whole context) and the range of window starts.
2. Grams that occur once are dropped (counted with map-side partials).  Contexts that are equal repeat
   all their windows.  Different contexts with one gram form a collection, one representative each.
3. A task holds the collections of the grams that hash to it and builds their suffix order column by
   column, from the last to the first.  A round reads the order and the common prefixes of the column
   behind it in sequence, inserts one symbol per context (the transform's column), and writes the new
   order (a stable sort by the symbol) and the new common prefixes (one more than the least between two
   neighbours of the same symbol).  Suffixes of different columns are never compared: by the alignment
   they cannot hold equal windows, so the collection's transform is kept per column.  A window repeats
   if a neighbour's common prefix is ``WINDOW`` or more.
4. A gram with more than ``group_limit`` contexts would not fit a task: its windows are counted by the
   hash of all their bytes, with map-side partials.
5. Ranges go back to the texts.  Rows that lose everything or nothing need no text any more.

The external files of the method are Spark's tables in the shared folder: anchors, contexts and ranges
are landed there and read in sequence; a task keeps two arrays per collection, not the texts.  Joins on
grams, contexts and texts take the most frequent keys apart (``common.join_counted``).

Nulls count as empty texts; texts under 200 bytes lose nothing unless covered (never); repeated rows
lose all bytes if they have 200 or more.  Ids may be null or repeated; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import textkernel as K
from sparkmart.llm.common import digest, join_counted, land, ship_package

WINDOW = 200
GRAM = 32
#: Contexts of one gram that a task builds in memory (about 800 bytes each).
GROUP_LIMIT = 50_000
#: Bytes of a text hashed at a time.
PIECE = 1 << 21
PAD = 256
EMPTY_SHA = hashlib.sha256().hexdigest()


def anchors_of(data: np.ndarray, off: np.ndarray, window: int, gram: int):
    """(row, anchor, least start, greatest start, g, c) of all windows of a slice, by byte index."""
    parts = [_piece(data, off, p, min(p + PIECE, len(data)), window, gram) for p in range(0, max(len(data), 1), PIECE)]
    return [np.concatenate(x) for x in zip(*parts)]


def _piece(data, off, lo, hi, window, gram):
    """Anchors of the windows that start in [lo, hi)."""
    part = data[lo:hi + window - 1]
    rows = np.clip(off - lo, 0, len(part))
    starts, row = K.gram_starts(rows, window)
    inside = starts < hi - lo
    starts, row = starts[inside], row[inside]
    if len(starts) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.view(K.U64), none.view(K.U64)
    grams = K.Grams(K.byte_values(part))
    at = np.arange(len(part) - gram + 1)
    g = grams(at, at + gram)
    # Minimum over the gram positions of each window: least from a block's start and to its end.
    # The low byte holds the position in the block, so ties go to the left.
    span = window - gram + 1
    blocks = -(-len(g) // span) + 1
    rank = np.full(blocks * span, np.iinfo(np.uint64).max, K.U64)
    rank[:len(g)] = g & ~K.U64(255) | (at % span).astype(K.U64)
    rank = rank.reshape(blocks, span)
    left = np.minimum.accumulate(rank[:, ::-1], axis=1)[:, ::-1].ravel()[starts]
    right = np.minimum.accumulate(rank, axis=1).ravel()[starts + span - 1]
    first = left >> K.U64(8) <= right >> K.U64(8)
    block = np.where(first, starts, starts + span - 1) // span
    anchor = block * span + (np.where(first, left, right) & K.U64(255)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))))
    last = np.concatenate((cut[1:], [len(anchor)])) - 1
    row, anchor, least, most = row[cut], anchor[cut], starts[cut], starts[last]
    c = grams(least, most + window) ^ K.mix(((anchor - least) << 8 | (anchor - most)).view(K.U64))
    return row, anchor + lo, least + lo, most + lo, g[anchor], c


def scan(base: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row of (id, text, h1, h2): number of bytes, sha256, and the anchors (``packed``: position,
    then the least and the greatest offset of the anchor in its windows)."""
    def one_pass(batches):
        for batch in batches:
            for part in K.slices(batch, "text"):
                data, off = K.text_bytes(part.column("text"))
                row, anchor, lo, hi, g, c = anchors_of(data, off, window, gram)
                packed = (anchor - off[row]) << 16 | (anchor - hi) << 8 | (anchor - lo)
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                sha = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(off[:-1], off[1:])]
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(v)) for v in (K.signed(g), K.signed(c), packed)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("h1"), part.column("h2"), pa.array(np.diff(off)), pa.array(sha), *lists],
                    names=["id", "h1", "h2", "n_bytes", "sha", "g", "c", "packed"])

    return base.mapInArrow(one_pass, "id long, h1 long, h2 long, n_bytes long, sha string, "
                                     "g array<long>, c array<long>, packed array<long>")


# --- construction ----------------------------------------------------------------------------

def repeated_windows(symbols: np.ndarray, group: np.ndarray, window: int) -> np.ndarray:
    """Which windows repeat inside their group: bool matrix (context, column) for the columns at which
    a window can start.  ``symbols`` (context, column) holds bytes, ``PAD`` outside the context."""
    m, width = symbols.shape
    found = np.zeros((m, width - window + 1), bool)
    order = np.argsort(group, kind="stable")
    rank = np.cumsum(np.concatenate(([0], np.diff(group[order]) != 0))) * (PAD + 1)  # of the group, by place in the order
    common = np.zeros(m + 1, np.int64)  # common[i]: of the suffixes at places i - 1 and i
    columns = np.ascontiguousarray(symbols.T)
    for j in range(width - 1, -1, -1):
        key = rank + columns[j][order]
        at = np.argsort(key, kind="stable")  # places in the old order, by group and symbol; groups stay in place
        key, before = key[at], common
        same = np.flatnonzero((key[1:] == key[:-1]) & (key[1:] % (PAD + 1) != PAD)) + 1
        common = np.zeros(m + 1, np.int64)
        if len(same):
            bounds = np.stack((at[same - 1] + 1, at[same] + 1), 1).ravel()
            common[same] = np.minimum.reduceat(before, bounds)[::2] + 1
        order = order[at]
        if j < found.shape[1]:
            long_ = common >= window
            found[order, j] = long_[:-1] | long_[1:]
    return found


def _starts(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of columns [a, b] per context."""
    edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    i, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    return i, a, b - 1


_CONTEXT = "g long, node long, packed long, single boolean, context binary, hot boolean, win long, start long"


def contexts(wanted: DataFrame, window: int, gram: int) -> DataFrame:
    """The bytes of each representative context, or the hashes of its windows if its gram is hot.

    ``wanted``: (node, text, want array<struct<g, packed, single, hot>>), one row per text.
    """
    names = [c.split()[0] for c in _CONTEXT.split(", ")]

    def cut(batches):
        for batch in batches:
            for part in K.slices(batch, "text"):
                data, off = K.text_bytes(part.column("text"))
                raw, want = data.tobytes(), part.column("want")
                lists = want.flatten()
                row = np.repeat(np.arange(part.num_rows), np.asarray(pc.list_value_length(want)).astype(np.int64))
                g, packed = (np.asarray(lists.field(k)).astype(np.int64) for k in ("g", "packed"))
                single, hot = (np.asarray(lists.field(k).cast(pa.int8())).astype(bool) for k in ("single", "hot"))
                node = np.asarray(part.column("node")).astype(np.int64)[row]
                anchor = off[row] + (packed >> 16)
                lo, hi = anchor - (packed & 255), anchor - (packed >> 8 & 255)  # least and greatest start
                k = np.flatnonzero(~hot)
                if len(k):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g[k]), pa.array(node[k]), pa.array(packed[k]), pa.array(single[k]),
                         pa.array([raw[a:b + window] for a, b in zip(lo[k].tolist(), hi[k].tolist())], pa.binary()),
                         pa.array(np.zeros(len(k), bool)), pa.array(np.zeros(len(k), np.int64)), pa.array(np.zeros(len(k), np.int64))], names=names)
                for i in np.flatnonzero(hot).tolist():  # a context at a time: its own bytes are all it hashes
                    own = K.Grams(K.byte_values(data[lo[i]:hi[i] + window]))
                    s = np.arange(hi[i] - lo[i] + 1)
                    n = len(s)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g[i]] * n), pa.array([node[i]] * n), pa.array([packed[i]] * n), pa.array([bool(single[i])] * n),
                         pa.array([b""] * n, pa.binary()), pa.array([True] * n), pa.array(K.signed(own(s, s + window))),
                         pa.array(s + (lo[i] - off[row[i]]))], names=names)

    return wanted.mapInArrow(cut, _CONTEXT)


def _collections(cold: DataFrame, window: int, gram: int, group_limit: int) -> DataFrame:
    """(node, lo, hi): bytes that repeated windows of single contexts cover.

    The number of tasks follows the number of contexts, so that a task holds ``group_limit`` of them on
    average, whatever the input; one gram has that many at most.
    """
    back = window - gram

    def build(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        packed = np.asarray(table.column("packed")).astype(np.int64)
        single = np.asarray(table.column("single").cast(pa.int8())).astype(bool)
        group, node = (np.asarray(table.column(c)).astype(np.int64) for c in ("g", "node"))
        column = table.column("context").chunk(0).cast(pa.large_binary())
        data, size = np.frombuffer(b"".join(column.to_pylist()), np.uint8), np.asarray(pc.binary_length(column)).astype(np.int64)
        symbols = np.full((len(packed), back + window), PAD, np.uint16)
        row = np.repeat(np.arange(len(size)), size)
        symbols[row, np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size) + (back - (packed & 255))[row]] = data
        found = repeated_windows(symbols, group, window) & single[:, None]
        i, a, b = _starts(found)
        anchor = (packed >> 16)[i] - back
        yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(anchor + a), pa.array(anchor + b + window)], names=["rid", "lo", "hi"])

    tasks = max(int(cold.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-cold.count() // group_limit))
    return (cold.select("g", "node", "packed", "single", "context").repartition(tasks, "g")
            .mapInArrow(build, "rid long, lo long, hi long"))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the ranges [lo, hi)."""
    out = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(r) for r in out]


def _apply(texts: DataFrame) -> DataFrame:
    """(h1, h2, n, n_removed, n_spans, kept_sha256, kept) of (h1, h2, n, text, ranges)."""
    def drop(batches):
        for batch in batches:
            out = []
            for h1, h2, n, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("h1", "h2", "n", "text", "ranges"))):
                raw, runs, at, kept = text.encode(), merged([(r["lo"], r["hi"]) for r in ranges or []]), 0, []
                for lo, hi in runs:
                    kept.append(raw[at:lo])
                    at = hi
                left = b"".join([*kept, raw[at:]])
                out.append((h1, h2, n, len(raw) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left))
            types = [pa.int64()] * 5 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)],
                                             names=["h1", "h2", "n", "n_removed", "n_spans", "kept_sha256", "kept"])

    return texts.mapInArrow(drop, "h1 long, h2 long, n long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                   group_limit: int = GROUP_LIMIT, with_text: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the bytes left,
    for rows that lost some; null for untouched rows) - see the module text."""
    if not 0 < window - gram < 255:
        raise ValueError("a window may be up to 254 bytes longer than a gram")
    spark = docs.sparkSession
    ship_package(spark)
    h1, h2 = digest(F.col(text_col))
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), h1.alias("h1"), h2.alias("h2"))
    rows = land(scan(base, window, gram).withColumn("rid", F.monotonically_increasing_id()), "suffix-rows")
    anchors = (rows.where(F.size("g") > 0).select("rid", F.explode(F.arrays_zip("g", "c", "packed")).alias("a"))
               .select("rid", "a.g", "a.c", "a.packed"))
    shared = land(anchors.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"))
                  .where("n > 1").select("g", "n", (F.col("lo") != F.col("hi")).alias("mixed")), "suffix-shared")
    live = land(join_counted(anchors, shared, ["g"]).drop("n"), "suffix-live")

    deep = land(live.groupBy("g", "c", "mixed").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "packed")).alias("rep")), "suffix-deep")
    position, low, high = F.shiftright("packed", 16), F.shiftright("packed", 8).bitwiseAND(255), F.col("packed").bitwiseAND(255)
    whole = (join_counted(live.select("rid", "g", "c", "packed"), deep.where("n > 1").select("g", "c", "n"), ["g", "c"])
             .select("rid", (position - high).alias("lo"), (position - low + window).alias("hi")))

    # Texts that hold a shared gram, one row per text: its least row number and how many rows have it.
    touched = land(live.select("rid").distinct().join(rows.select("rid", "h1", "h2"), "rid").groupBy("h1", "h2")
                   .agg(F.min("rid").alias("node"), F.count(F.lit(1)).alias("n")), "suffix-touched")
    texts = land(join_counted(base.select("text", "h1", "h2"), touched, ["h1", "h2"])
                 .groupBy("h1", "h2").agg(F.first("text").alias("text"), F.first("node").alias("node"), F.first("n").alias("n")), "suffix-texts")
    crowded = deep.where("mixed").groupBy("g").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > group_limit).select("g", F.lit(True).alias("hot"))
    wanted = (deep.where("mixed").join(crowded, "g", "left")
              .select(F.col("rep.rid").alias("node"), F.struct("g", F.col("rep.packed").alias("packed"), (F.col("n") == 1).alias("single"),
                                                               F.coalesce("hot", F.lit(False)).alias("hot")).alias("w"))
              .groupBy("node").agg(F.collect_list("w").alias("want")))  # at most the anchors of one text
    cut = land(contexts(texts.select("node", "text").join(wanted, "node"), window, gram), "suffix-contexts")
    hot = cut.where("hot")
    twice = hot.groupBy("g", "win").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g", "win")
    hot = hot.where("single").join(twice, ["g", "win"]).select(F.col("node").alias("rid"), F.col("start").alias("lo"), (F.col("start") + window).alias("hi"))
    nodes = touched.select(F.col("node").alias("rid"))
    ranges = (whole.join(nodes, "rid", "left_semi").union(_collections(cut.where("not hot"), window, gram, group_limit)).union(hot)
              .groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")))  # of one text
    done = _apply(texts.join(ranges.withColumnRenamed("rid", "node"), "node").select("h1", "h2", "n", "text", "ranges"))
    done = land(done if with_text else done.drop("kept"), "suffix-done")
    zero = F.lit(0).cast("long")
    return (join_counted(rows.select("id", "h1", "h2", "n_bytes", "sha"), done, ["h1", "h2"], "left")
            .select(F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
                    F.coalesce("kept_sha256", "sha").alias("kept_sha256"), *(["kept"] if with_text else [])))
