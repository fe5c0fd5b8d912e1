"""Token-ID output in training order: keyed Feistel permutation, fixed-stride shards.

1. Every text is encoded once; its token ids and an end-of-text id are landed as bytes, with the
   task's number and the running offset inside the task.  The landed table fixes the token stream:
   tasks in order, rows in order.  (A task's total is one small row; prefix sums over tasks give
   each row's place in the stream.)
2. The stream is cut into sequences of ``length`` tokens (the last one padded with the end id).
   Sequence ``i`` of ``n`` gets the slot ``P(i)``: a balanced Feistel network over the least even
   number of bits that holds ``n``, keyed by ``key``, cycle-walked until the value is below ``n`` -
   a bijection on ``0 .. n-1``, computed per row with no sort, no state and no coordination.
3. Pieces of sequences go to the range partition of their slot, are sorted there and joined.
   Slot ``s`` is in shard ``s // per_shard`` at byte ``(s % per_shard) * stride``: reading is
   sequential and may go on from any slot.  ``materialise`` writes each shard as one file from the
   task that sorts it, and reads the sequences back from the files.

Null and empty texts contribute the end id only; an empty table gives no sequence.  Ids may be null
or repeated (null ids are left out of ``doc_ids``); other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm import textkernel as K
from sparkmart.llm import tokenizer as T
from sparkmart.llm.common import land, scratch_path, ship_package, table_path, temporary_tables

LENGTH = 2048
PER_SHARD = 4096
KEY = 20250301
ROUNDS = 6
#: Largest number of encoding tasks whose prefix sums are broadcast (16 MB).
SMALL = 1_000_000


def feistel(i: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """The place of each of ``i`` in a keyed permutation of ``0 .. n-1`` (all at once)."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = K.U64((1 << half) - 1)
    x = np.asarray(i).astype(K.U64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> K.U64(half), x[todo] & mask
        for r in range(rounds):
            salt = K.U64(((key + r) * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
            left, right = right, left ^ (K.mix(right + salt) & mask)
        x[todo] = (left << K.U64(half)) | right
        todo = todo[x[todo] >= K.U64(n)]
    return x.astype(np.int64)


def encode(docs: DataFrame, id_col: str, text_col: str, vocabulary: str) -> DataFrame:
    """Landed token stream: (task, start, n, id, tokens)."""
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(T.load_vocabulary(vocabulary))

    def run(batches):
        enc, at, task = T.encoder(vocab), 0, TaskContext.get().partitionId()
        end = np.array([enc.eos], enc.dtype).tobytes()
        for batch in batches:
            for part in K.slices(batch, "text"):
                blobs = [enc.encode(t) + end for t in part.column("text").to_pylist()]
                n = np.array([len(b) // enc.dtype.itemsize for b in blobs], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), task, np.int64)), pa.array(at + np.cumsum(n) - n), pa.array(n), part.column("id"),
                     pa.array(blobs, pa.binary())], names=["task", "start", "n", "id", "tokens"])
                at += int(n.sum())

    path = table_path(spark, "tokens")
    (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
     .mapInArrow(run, schema := "task long, start long, n long, id long, tokens binary").write.option("compression", "zstd").parquet(path))
    return spark.read.schema(schema).parquet(path)


class _Shards:
    """Writes shard files below ``folder`` from one task, whose rows come in slot order.

    A file is written under a name of its own and renamed when complete, so a lost task leaves no half
    shard, and a later attempt or run replaces a shard whole."""

    def __init__(self, folder: str):
        from pyarrow import fs as pafs
        self.store, self.root = pafs.FileSystem.from_uri(folder)
        self.store.create_dir(self.root, recursive=True)
        self.shard, self.out = None, None

    def put(self, shard: int, tokens: bytes) -> None:
        import uuid
        if shard != self.shard:
            self.close()
            self.shard, self.temp = shard, f"{self.root}/.shard-{shard:08d}-{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.temp)
        self.out.write(tokens)

    def close(self) -> None:
        from pyarrow import fs as pafs
        if self.out is None:
            return
        self.out.close()
        self.out, path = None, f"{self.root}/shard-{self.shard:08d}.bin"
        if self.store.get_file_info(path).type != pafs.FileType.NotFound:  # not every store renames onto a file
            self.store.delete_file(path)
        self.store.move(self.temp, path)


def sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
              per_shard: int = PER_SHARD, key: int = KEY, vocabulary: str = T.VOCABULARY, folder: str | None = None) -> DataFrame:
    """One row per sequence, range-partitioned and sorted by slot: slot, shard, byte_offset, seq,
    n_tokens (without padding), doc_ids, tokens (``length`` little-endian ids).  With a ``folder`` (a URI
    that executors reach) the tokens go to its shard files as the rows are made, and ``tokens`` is null."""
    spark = docs.sparkSession
    ship_package(spark)
    stream = encode(docs, id_col, text_col, vocabulary)
    sums = stream.groupBy("task").agg(F.sum("n").alias("n"))  # one row per task of the encoding
    bases = sums.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("base"))
    total, n_tasks = sums.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    if n_tasks <= SMALL:  # 16 bytes a row; beyond that the join shuffles both sides
        bases = F.broadcast(bases)
    enc = T.Encoder(T.load_vocabulary(vocabulary))
    width, pad = enc.dtype.itemsize, np.array([enc.eos], enc.dtype).tobytes()
    n_seq = -(-total // length)
    n_shards = max(1, -(-n_seq // per_shard))
    tasks = min(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions")))

    @F.pandas_udf("long")
    def slot_of(seq):
        import pandas as pd
        return pd.Series(feistel(seq.to_numpy(), n_seq, key))

    place = F.col("base") + F.col("start")
    pieces = (stream.join(bases, "task").withColumn("place", place)
              .withColumn("seq", F.explode(F.sequence(F.floor(F.col("place") / length), F.floor((F.col("place") + F.col("n") - 1) / length))))
              .select("id", "seq", "tokens",
                      F.greatest(F.col("seq") * length - F.col("place"), F.lit(0)).alias("lo"),
                      F.least((F.col("seq") + 1) * length - F.col("place"), F.col("n")).alias("hi"),
                      F.greatest(F.col("place") - F.col("seq") * length, F.lit(0)).alias("at"))
              .withColumn("slot", slot_of("seq"))
              .select("slot", "seq", "at", "id", F.expr(f"substring(tokens, cast(lo * {width} + 1 as int), cast((hi - lo) * {width} as int))").alias("piece")))
    shard = F.floor(F.col("slot") / per_shard)
    ordered = (pieces.repartitionById(tasks, F.floor(shard * tasks / n_shards).cast("int")).sortWithinPartitions("slot", "at"))

    def join(batches):
        names = ["slot", "shard", "byte_offset", "seq", "n_tokens", "doc_ids", "tokens"]
        types = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.binary()]
        rows, current, seq, ids, parts = [], None, None, [], []
        shards = _Shards(folder) if folder else None

        def close():
            blob = b"".join(parts)
            n, blob = len(blob) // width, blob + pad * (length - len(blob) // width)
            if shards:
                shards.put(current // per_shard, blob)
            rows.append((current, current // per_shard, current % per_shard * length * width, seq, n,
                         [k for k in ids if k is not None], None if shards else blob))

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            rows.clear()
            return out

        for batch in batches:
            for slot, s, _, key_, piece in zip(*(batch.column(c).to_pylist() for c in ("slot", "seq", "at", "id", "piece"))):
                if slot != current:
                    if current is not None:
                        close()
                        if len(rows) == 512:
                            yield flush()
                    current, seq, ids, parts = slot, s, [], []
                ids.append(key_)
                parts.append(piece)
        if current is not None:
            close()
        if shards:
            shards.close()
        if rows:
            yield flush()

    return ordered.mapInArrow(join, "slot long, shard long, byte_offset long, seq long, n_tokens long, doc_ids array<long>, tokens binary")


def write_shards(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``shard-NNNNNNNN.bin`` files (fixed stride, slot order) of ``sequences`` below ``folder``, a URI
    that executors reach; returns (shard, n_sequences, n_bytes)."""
    def put(batches):
        shards, counts = _Shards(folder), {}
        for batch in batches:
            for shard, tokens in zip(batch.column("shard").to_pylist(), batch.column("tokens").to_pylist()):
                shards.put(shard, tokens)
                n, size = counts.get(shard, (0, 0))
                counts[shard] = (n + 1, size + len(tokens))
        shards.close()
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), *(pa.array(c, pa.int64()) for c in zip(*counts.values()))],
                                             names=["shard", "n_sequences", "n_bytes"])

    return rows.select("shard", "tokens").mapInArrow(put, "shard long, n_sequences long, n_bytes long")


def read_rows(rows: DataFrame, folder: str, stride: int) -> DataFrame:
    """``rows`` (slot order inside each partition) with ``tokens`` read from the shard files: a file is opened
    once per run of its rows, and rows that follow each other are read without a seek."""
    names = rows.columns

    def fetch(batches):
        from pyarrow import fs as pafs
        store, root = pafs.FileSystem.from_uri(folder)
        current, f, at = None, None, 0
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                tokens = []
                for shard, offset in zip(part.column("shard").to_pylist(), part.column("byte_offset").to_pylist()):
                    if shard != current:
                        if f is not None:
                            f.close()
                        current, f, at = shard, store.open_input_file(f"{root}/shard-{shard:08d}.bin"), 0
                    if offset != at:
                        f.seek(offset)
                    tokens.append(f.read(stride))
                    if len(tokens[-1]) != stride:
                        raise OSError(f"shard {shard} ends before byte {offset + stride}")
                    at = offset + stride
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()) if c == "tokens" else part.column(c) for c in names], names=names)
        if f is not None:
            f.close()

    return rows.mapInArrow(fetch, rows.schema)


def materialise(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                per_shard: int = PER_SHARD, key: int = KEY, vocabulary: str = T.VOCABULARY) -> DataFrame:
    """Write the shard files below ``folder`` (a new one in the shared folder if none is given) and return
    the rows of ``sequences`` with the tokens read back from the files."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "shards")
    with temporary_tables(spark):  # the shards replace the token stream
        rows = land(sequences(docs, id_col, text_col, length, per_shard, key, vocabulary, folder), "shard-index", keep=True)
    width = T.Encoder(T.load_vocabulary(vocabulary)).dtype.itemsize
    return read_rows(rows, folder, length * width)


def read_slots(folder: str, start: int, stop: int, length: int = LENGTH, per_shard: int = PER_SHARD, dtype: str = "<u2"):
    """Sequences ``start .. stop-1`` in order, from any place: a resumed training run reads on here."""
    from pyarrow import fs as pafs

    store, root = pafs.FileSystem.from_uri(folder)
    stride = length * np.dtype(dtype).itemsize
    for shard in range(start // per_shard, -(-stop // per_shard)):
        with store.open_input_file(f"{root}/shard-{shard:08d}.bin") as f:
            lo, hi = max(start, shard * per_shard), min(stop, (shard + 1) * per_shard)
            f.seek((lo - shard * per_shard) * stride)
            for _ in range(lo, hi):
                yield np.frombuffer(f.read(stride), dtype)
