"""MinHash near-dedup: improved consistent weighted sampling (ICWS) over TF-IDF word shingles.

1. Exact copies collapse to one *node* per distinct text (128-bit digest).
2. Document frequencies are counted exactly per 64-bit shingle: each *chunk* of rows sends its
   distinct shingles with partial counts to buckets of the hash range, a bucket adds them up and
   returns to every chunk the frequencies above 1 of its own shingles (all others are 1).  A
   shingle's weight is ``tf * ln(SMOOTH + n_docs / df)``.  The additive term
   keeps a very large group of near copies from erasing the weight of its own shared shingles.
3. Each node gets ``BANDS * ROWS`` ICWS samples (Ioffe 2010), banded into ``BANDS`` keys.
4. Nodes that share a band key are candidates.  They are not expanded into all pairs: every node is
   compared with the least node of each of its buckets, links give components, and only buckets that
   still hold several components go on - first against ``PROBES`` members of the bucket's leading
   component, then (the exact rest) in blocks: members outside the leading component meet all members
   in tasks of bounded size, which compute every similarity across components and return only
   the links that join components.  So each candidate pair is linked, or compared and found below the
   threshold, or already connected - and no list of all pairs is ever made.
5. A link needs weighted Jaccard >= ``threshold`` on the true shingle weights.

Shingles are five words; a text of one to four words is one shingle of all its words; empty and null
texts have none and only meet each other as exact copies.  Repeated rows share a class.
Every stage between Python passes is a DataFrame join or a partially aggregated group; intermediate
tables (texts, frequencies, signatures, bucket members, candidate shingles) are landed in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import textkernel as K
from sparkmart.llm.common import digest, land, ship_package, temporary_tables
from sparkmart.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
#: Rows of a chunk (a power of two, as bits of the row id), and shingles of a bucket of the hash range, about.
CHUNK_BITS = 6
BUCKET_SHINGLES = 2_000_000
SMOOTH = 1000.0
PROBES = 8
_TABLE = 1 << 14
_BLOCK = 4096
#: Total shingle weight of a block of texts that one task compares with another (about 300,000 shingles).
BLOCK_WEIGHT = 2_000_000.0


def row_shingles(batch: pa.RecordBatch, column: str):
    """Shingle hashes of a slice: (hashes, first) with row ``i`` owning ``hashes[first[i]:first[i+1]]``."""
    data, off = K.text_bytes(batch.column(column))
    starts, ends, first = K.find_words(data, off)
    grams = K.Grams(K.hash_words(data, starts, ends))
    n = np.diff(first)
    per_row = np.where(n == 0, 0, np.maximum(n - SHINGLE + 1, 1))
    at = np.concatenate(([0], np.cumsum(per_row)))
    begin = np.repeat(first[:-1] - at[:-1], per_row) + np.arange(at[-1])
    return grams(begin, np.minimum(begin + SHINGLE, np.repeat(first[1:], per_row))), at


# --- document frequencies -------------------------------------------------------------------

def _pack(u: np.ndarray) -> bytes:
    """Sorted shingles as compressed differences, byte plane by byte plane."""
    return pa.compress(np.diff(u, prepend=K.U64(0)).view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(K.U64).ravel(), dtype=K.U64)


def _chunk_parts(base: DataFrame, buckets: int) -> DataFrame:
    """(chunk, bucket, shingles, counts) of (rid, text): a chunk's distinct shingles, packed, with the number of its rows that have each."""
    def split(batches):
        for batch in batches:
            for part in K.slices(batch, "text"):
                h, first = row_shingles(part, "text")
                chunk = part.column("rid").to_numpy() >> CHUNK_BITS
                edges = np.concatenate(([0], np.flatnonzero(np.diff(chunk)) + 1, [len(chunk)]))
                cols = [], [], [], []
                for lo, hi in zip(edges[:-1], edges[1:]):
                    own = [np.unique(h[first[i]:first[i + 1]]) for i in range(lo, hi)]  # a row counts once
                    u, n = np.unique(np.concatenate(own), return_counts=True)
                    at = (u >> K.U64(32)) * K.U64(buckets) >> K.U64(32)  # grows with u
                    cut = np.searchsorted(at, np.arange(buckets + 1, dtype=K.U64))
                    for k in np.flatnonzero(np.diff(cut)).tolist():
                        x = slice(cut[k], cut[k + 1])
                        for col, value in zip(cols, (int(chunk[lo]), k, _pack(u[x]), n[x].astype(np.uint32).tobytes())):
                            col.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                                 names=["chunk", "bucket", "shingles", "counts"])

    return base.select("rid", "text").mapInArrow(split, "chunk long, bucket long, shingles binary, counts binary")


def count_frequencies(base: DataFrame) -> DataFrame:
    """(chunk, shingles, counts) of (rid, text): the shingles of a chunk that are in two rows or more of
    the whole table, with the number of these rows."""
    spark = base.sparkSession
    size = base.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), size // (5 * BUCKET_SHINGLES))

    def add(batches):
        names = ["chunk", "shingles", "counts"]
        current, held = None, []

        def close():
            u = np.concatenate([_unpack(x, len(n) // 4) for _, x, n in held])
            n = np.concatenate([np.frombuffer(x, np.uint32) for _, _, x in held]).astype(np.int64)
            order = np.argsort(u, kind="stable")
            runs = np.flatnonzero(np.concatenate(([True], u[order[1:]] != u[order[:-1]])))
            df = np.empty(len(u), np.int64)
            df[order] = np.repeat(np.add.reduceat(n[order], runs), np.diff(np.append(runs, len(u))))
            at, out = 0, []
            for chunk, _, x in held:
                stop = at + len(x) // 4
                often = df[at:stop] > 1
                if often.any():
                    out.append((chunk, _pack(u[at:stop][often]), np.minimum(df[at:stop][often], 0xFFFFFFFF).astype(np.uint32).tobytes()))
                at = stop
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=names)

        for batch in batches:
            for bucket, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", *names))):
                if bucket != current:
                    if held:
                        yield close()
                    current = bucket
                held.append(row)
        if held:
            yield close()

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = _chunk_parts(base, buckets).repartition(tasks, "bucket").sortWithinPartitions("bucket")
    return parts.mapInArrow(add, "chunk long, shingles binary, counts binary")


def with_frequencies(rows: DataFrame, often: DataFrame, give, schema: str) -> DataFrame:
    """``give(part, df)`` for slices of (rid, h1, h2, text): ``df(u)`` are the frequencies of sorted distinct
    shingles of the slice's chunk.  ``give`` yields batches of ``schema``."""
    text = rows.select(F.shiftright("rid", CHUNK_BITS).alias("chunk"), "rid", "id", "h1", "h2", "text",
                       F.lit(None).cast("binary").alias("shingles"), F.lit(None).cast("binary").alias("counts"))
    table = often.select("chunk", *[F.lit(None).cast("long").alias(c) for c in ("rid", "id", "h1", "h2")],
                         F.lit(None).cast("string").alias("text"), "shingles", "counts")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        current, tables, known = None, [], None

        def lookup(u):
            k, n = known
            out = np.ones(len(u), np.int64)
            if len(k) and len(u):
                at = np.minimum(np.searchsorted(k, u), len(k) - 1)
                hit = k[at] == u
                out[hit] = n[at[hit]]
            return out

        for batch in batches:
            chunk, is_text = batch.column("chunk").to_numpy(), np.asarray(batch.column("rid").is_valid())
            edges = np.concatenate(([0], np.flatnonzero((np.diff(chunk) != 0) | (np.diff(is_text) != 0)) + 1, [len(chunk)])) if len(chunk) else [0]
            for lo, hi in zip(edges[:-1], edges[1:]):
                if chunk[lo] != current:
                    current, tables, known = chunk[lo], [], None
                piece = batch.slice(lo, hi - lo)
                if not is_text[lo]:
                    tables += zip(piece.column("shingles").to_pylist(), piece.column("counts").to_pylist())
                    continue
                if known is None:  # the tables come first
                    u = np.concatenate([np.zeros(0, K.U64), *[_unpack(x, len(n) // 4) for x, n in tables]])
                    n = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x, np.uint32).astype(np.int64) for _, x in tables]])
                    u, first = np.unique(u, return_index=True)  # a chunk cut by slices names a shingle more than once
                    known = u, n[first]
                for part in K.slices(piece, "text"):
                    yield from give(part, lookup)

    return (text.union(table).repartition(tasks, "chunk").sortWithinPartitions("chunk", F.col("rid").isNotNull(), "rid")
            .mapInArrow(run, schema))


def idf_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.log(SMOOTH + max(n_docs, 1) / df)


# --- ICWS signatures ------------------------------------------------------------------------

_RANDOM: dict[int, tuple[np.ndarray, ...]] = {}


def _random_tables(n: int):
    """Gamma(2,1), ln Gamma(2,1) and uniform draws: ``_TABLE`` rows of ``n`` samples, seeded."""
    if n not in _RANDOM:
        rng = np.random.default_rng(20250301)
        r = rng.gamma(2.0, 1.0, (_TABLE, n)).astype(np.float32)
        c = np.log(rng.gamma(2.0, 1.0, (_TABLE, n))).astype(np.float32)
        beta = rng.random((_TABLE, n), dtype=np.float32)
        _RANDOM[n] = (r, (1 / r).astype(np.float32), c, beta)
    return _RANDOM[n]


def icws(u: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """``n`` consistent samples (element, t) of a weighted set, each as one 64-bit value."""
    r, inv, c, beta = _random_tables(n)
    best, elem, level = np.full(n, np.inf, np.float32), np.zeros(n, K.U64), np.zeros(n, np.int64)
    cols = np.arange(n)
    for i in range(0, len(u), _BLOCK):
        at = (u[i:i + _BLOCK] >> K.U64(40)).astype(np.int64) & (_TABLE - 1)
        b, rr = beta[at], r[at]
        t = np.floor(np.log(w[i:i + _BLOCK]).astype(np.float32)[:, None] * inv[at] + b)
        a = c[at] - rr * (t - b + 1)
        k = a.argmin(axis=0)
        low, better = a[k, cols], a[k, cols] < best
        best = np.where(better, low, best)
        elem = np.where(better, u[i:i + _BLOCK][k], elem)
        level = np.where(better, t[k, cols].astype(np.int64), level)
    return K.mix(elem ^ K.mix(level.view(K.U64) + K.U64(1)))


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.zeros(bands, K.U64)
    for j in range(rows):
        key = K.mix(key + samples.reshape(bands, rows)[:, j])
    return key


def signatures(base: DataFrame, often: DataFrame, n_docs: int, bands: int, rows: int) -> DataFrame:
    """(rid, id, h1, h2, total, bands) per row of (rid, id, text, h1, h2)."""
    def sign(part, df):
        h, first = row_shingles(part, "text")
        keys, totals = [], []
        for i in range(part.num_rows):
            u, tf = np.unique(h[first[i]:first[i + 1]], return_counts=True)
            w = tf * idf_weights(df(u), n_docs)
            keys.append(K.signed(band_keys(icws(u, w, bands * rows), bands, rows)) if len(u) else np.zeros(0, np.int64))
            totals.append(float(w.sum()))
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in ("rid", "id", "h1", "h2")), pa.array(totals, pa.float64()),
             pa.array(keys, pa.list_(pa.int64()))], names=["rid", "id", "h1", "h2", "total", "bands"])

    return with_frequencies(base, often, sign, "rid long, id long, h1 long, h2 long, total double, bands array<long>")


# --- verification ---------------------------------------------------------------------------

def _features(h: np.ndarray, df) -> tuple[np.ndarray, np.ndarray]:
    """A text's shingles as a plain set in order, and their frequencies: the k-th copy of a shingle is a
    feature of its own, so that the weight of the common features is the sum of minima."""
    u, tf = np.unique(h, return_counts=True)
    n = df(u)
    if tf.max(initial=1) > 1:
        nth = np.arange(tf.sum()) - np.repeat(np.cumsum(tf) - tf, tf)
        u, n = np.repeat(u, tf), np.repeat(n, tf)
        u = np.where(nth > 0, K.mix(u + nth.astype(K.U64) * K.U64(0x9E3779B97F4A7C15)), u)
        order = np.argsort(u)
        u, n = u[order], n[order]
    return u, n


def features(texts: DataFrame, often: DataFrame) -> DataFrame:
    """(node, features, counts) of (rid, id, text, h1, h2): see ``_features``, as bytes."""
    def give(part, df):
        h, first = row_shingles(part, "text")
        found = [_features(h[first[i]:first[i + 1]], df) for i in range(part.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [part.column("rid"), pa.array([u.tobytes() for u, _ in found], pa.binary()),
             pa.array([n.astype(np.uint32).tobytes() for _, n in found], pa.binary())], names=["node", "features", "counts"])

    return with_frequencies(texts, often, give, "node long, features binary, counts binary")


def _weighted(feats: bytes, counts: bytes, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(feats, K.U64), idf_weights(np.frombuffer(counts, np.uint32), n_docs)


def verify(pairs: DataFrame, feats: DataFrame, n_docs: int, threshold: float) -> DataFrame:
    """(a, b) of the pairs whose weighted Jaccard similarity reaches the threshold."""
    def check(batches):
        for batch in batches:
            keep, last, held = [], None, None
            for a, *x in zip(*(batch.column(c) for c in ("a", "fa", "na", "fb", "nb"))):
                fa, na, fb, nb = (v.as_buffer() for v in x)
                if a.as_py() != last:
                    last, held = a.as_py(), _weighted(fa, na, n_docs)
                (u, w), (v, y) = held, _weighted(fb, nb, n_docs)
                low = w[np.intersect1d(u, v, assume_unique=True, return_indices=True)[1]].sum()
                keep.append(bool(low >= (threshold - 1e-9) * (w.sum() + y.sum() - low)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    side = lambda n: feats.select(F.col("node").alias(n), F.col("features").alias("f" + n), F.col("counts").alias("n" + n))
    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "fa", "na", "fb", "nb")
            .mapInArrow(check, "a long, b long"))


@dataclass
class NearDuplicates:
    """``rows``: (rid, id, h1, h2, node), one per input row; ``classes``: (node, comp, n_links)."""
    rows: DataFrame
    classes: DataFrame


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
         bands: int = BANDS, rows: int = ROWS) -> NearDuplicates:
    """Group rows whose texts are copies or near copies (see the module text).

    Nulls: a null text counts as empty; a null id is kept.  Ids need not be unique.  Other columns
    of ``docs`` are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    h1, h2 = digest(F.col(text_col))
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       h1.alias("h1"), h2.alias("h2"))
    base = land(base.withColumn("rid", F.monotonically_increasing_id()), "near-base", compression="zstd")
    n_docs = base.count()
    often = land(count_frequencies(base), "near-often")

    sig = land(signatures(base, often, n_docs, bands, rows), "near-sig")
    node = sig.groupBy("h1", "h2").agg(F.min("rid").alias("node"))
    named = sig.join(node, ["h1", "h2"])
    nodes = land(named.where("rid = node").select("node", "h1", "h2", "total", "bands"), "near-nodes")

    keyed = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = (keyed.groupBy("band", "key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("m"))
              .where("m > 1").drop("m"))
    members = land(keyed.join(shared, ["band", "key"]), "near-members")

    wanted = members.select(F.col("node").alias("rid")).distinct()
    feats = land(features(base.join(wanted, "rid"), often), "near-features")

    done = land(members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "near-pairs")
    links = land(verify(done, feats, n_docs, threshold), "near-links")
    weight = nodes.select("node", "total")
    placed, main = _mixed_buckets(members, components(links, "near-comp"))
    pairs = land(_probe_pairs(placed, main, weight, threshold).join(done, ["a", "b"], "left_anti"), "near-pairs")
    links = land(links.union(verify(pairs, feats, n_docs, threshold)), "near-links")

    placed, main = _mixed_buckets(members, components(links, "near-comp"))
    links = land(links.union(_rest(land(placed, "near-placed"), main, weight, feats, n_docs, threshold)), "near-links")

    comp = components(links, "near-comp")
    degree = (links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count(F.lit(1)).alias("n_links")))
    classes = (nodes.select("node").join(comp, "node", "left").join(degree, "node", "left")
               .select("node", F.coalesce("comp", "node").alias("comp"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return NearDuplicates(named.select("rid", "id", "h1", "h2", "node"), land(classes, "near-classes"))


def _mixed_buckets(members: DataFrame, comp: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(band, key, node, comp) of the buckets that hold several components, and each one's leading
    component ``top`` (most members) with ``PROBES`` of its members, picked by hash."""
    bucket = ["band", "key"]
    placed = members.select(*bucket, "node").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = placed.groupBy(*bucket).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select(*bucket)
    placed = placed.join(mixed, bucket).select(*bucket, "node", "comp")
    sizes = placed.groupBy(*bucket, "comp").agg(
        F.count(F.lit(1)).alias("m"),
        *[F.min(F.struct(F.xxhash64("node", F.lit(i)), "node")).getField("node").alias(f"p{i}") for i in range(PROBES)])
    return placed, sizes.groupBy(*bucket).agg(F.max(F.struct("m", "comp", *[f"p{i}" for i in range(PROBES)])).alias("top"))


def _probe_pairs(placed: DataFrame, main: DataFrame, weight: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a < b) of each member outside its bucket's leading component with the probes of that one.

    The weight totals bound the similarity (min / max), so pairs that cannot reach the threshold
    are left out without a comparison.
    """
    open_ = (placed.join(main, ["band", "key"]).where("comp <> top.comp")
             .select("node", F.explode(F.array(*[F.col(f"top.p{i}") for i in range(PROBES)])).alias("other")))
    total = lambda name: weight.select(F.col("node").alias(name), F.col("total").alias("w_" + name))
    return (open_.where("node <> other")
            .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
            .join(total("a"), "a").join(total("b"), "b")
            .where(F.least("w_a", "w_b") >= (threshold - 1e-9) * F.greatest("w_a", "w_b")).select("a", "b"))


def block_links(left: list, right: list, threshold: float) -> list[tuple[int, int]]:
    """Links that join components, of all pairs (left, right); items are (node, comp, features, weights).

    Similarities are exact; pairs whose components are already joined are passed over.
    """
    feats, index = np.unique(np.concatenate([x[2] for x in right]), return_inverse=True)
    at = np.concatenate(([0], np.cumsum([len(x[2]) for x in right])))[:-1]
    totals = np.array([x[3].sum() for x in right])
    comps = np.array([x[1] for x in right])
    parent: dict[int, int] = {}

    def root(c):
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    out, step = [], max(1, 2_000_000 // len(index))
    for i in range(0, len(left), step):
        rows = left[i:i + step]
        dense = np.zeros((len(rows), len(feats)))
        for r, x in enumerate(rows):
            k = np.minimum(np.searchsorted(feats, x[2]), len(feats) - 1)
            hit = feats[k] == x[2]
            dense[r, k[hit]] = x[3][hit]
        common = np.add.reduceat(dense[:, index], at, axis=1)
        own = np.array([x[3].sum() for x in rows])[:, None]
        close = (common >= (threshold - 1e-9) * (own + totals - common)) & (comps != np.array([x[1] for x in rows])[:, None])
        for r, j in zip(*np.nonzero(close)):
            a, b = root(rows[r][1]), root(right[j][1])
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((min(rows[r][0], right[j][0]), max(rows[r][0], right[j][0])))
    return out


def _rest(placed: DataFrame, main: DataFrame, weight: DataFrame, feats: DataFrame, n_docs: int, threshold: float) -> DataFrame:
    """(a, b): the links across components within the mixed buckets, found in blocks.

    A block holds texts of about ``BLOCK_WEIGHT`` total weight (or one longer text); each task group
    compares one block of outside members with one block of all members of the same bucket.
    """
    bucket = ["band", "key"]
    rows = (placed.join(main.select(*bucket, F.col("top.comp").alias("lead")), bucket).join(weight, "node")
            .select(*bucket, "node", "comp", "total", (F.col("comp") != F.col("lead")).alias("outside")))
    blocks = rows.groupBy(*bucket).agg(F.ceil(F.sum("total") / BLOCK_WEIGHT).cast("int").alias("nb"),
                                       F.ceil(F.sum(F.when(F.col("outside"), F.col("total"))) / BLOCK_WEIGHT).cast("int").alias("na"))
    rows = rows.join(blocks, bucket)
    block = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    numbers = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    left = rows.where("outside").select(*bucket, block("na", 1).alias("i"), F.explode(numbers("nb")).alias("j"), F.lit(True).alias("left"), "node", "comp")
    right = rows.select(*bucket, F.explode(numbers("na")).alias("i"), block("nb", 2).alias("j"), F.lit(False).alias("left"), "node", "comp")
    work = (left.union(right).withColumn("group", F.xxhash64(*bucket, "i", "j")).join(feats, "node")
            .select("group", "left", "node", "comp", "features", "counts"))
    spark = placed.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def compare(batches):
        names = ["a", "b"]
        current, left, right, out = None, [], [], []

        def close():
            if left and right:
                out.extend(block_links(left, right, threshold))
            left.clear()
            right.clear()

        for batch in batches:
            for group, is_left, node, comp, f, n in zip(*(batch.column(c) for c in ("group", "left", "node", "comp", "features", "counts"))):
                if group.as_py() != current:
                    close()
                    current = group.as_py()
                (left if is_left.as_py() else right).append((node.as_py(), comp.as_py(), *_weighted(f.as_py(), n.as_py(), n_docs)))
        close()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=names)

    return (work.repartition(tasks, "group").sortWithinPartitions("group", "node").mapInArrow(compare, "a long, b long"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id, ``class_id`` (least non-null id of the class), ``class_rows``, ``n_links``."""
    found = find(docs, id_col, text_col, **options)
    placed = found.rows.join(found.classes, "node")
    label = placed.groupBy("comp").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_rows"))
    return placed.join(label, "comp").select(F.col("id").alias(id_col), "class_id", "class_rows", "n_links")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: its least (id, text digest); all columns kept unchanged."""
    # Plain equality on these names lets the join's partitioning serve the removal of repeated rows: texts move once.
    key = ["k_id", "k_null", "k_h1", "k_h2"]
    name = lambda i, a, b: [F.coalesce(i, F.lit(0).cast("long")).alias(key[0]), i.isNull().alias(key[1]), a.alias(key[2]), b.alias(key[3])]
    with temporary_tables(docs.sparkSession):
        found = find(docs, id_col, text_col, **options)
        keep = (found.rows.join(found.classes, "node").groupBy("comp")
                .agg(F.min(F.struct(F.col("id").isNull().alias("late"), "id", "h1", "h2")).alias("k")).select("k.id", "k.h1", "k.h2"))
        keep = land(keep.select(*name(F.col("id"), F.col("h1"), F.col("h2"))), "near-keep", keep=True)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = docs.select(row, *name(F.col(id_col).cast("long"), *digest(F.col(text_col))))
    return marked.join(keep, key).dropDuplicates(key).select("row.*")
