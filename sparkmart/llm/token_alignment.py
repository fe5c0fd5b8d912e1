"""Cross-tokenizer alignment: the token spans of two tokenizers, cut into groups and counted as pairs.

A text with a space in front is encoded whole by a byte-level BPE (A, ``tokenizers``) and by a piece
model with byte fallback (B, ``sentencepiece``, which adds the space itself).  Both libraries give
character spans: A the character offsets of its encoding, B the spans that its (immutable) proto
carries.  Span ends at character borders are the coarse cuts.  Where a token ends inside a multibyte
character (A), or is a byte-fallback token (B), the cut is refined by the decoded bytes of the tokens
since the last coarse cut.  Positions at which an A and a B token both end cut the text into groups;
an A and a B token are linked if their byte ranges overlap.

Words after a single space or line end that stands between two non-space characters are encoded
apart and remembered (at most ``HELD_UNITS`` per worker): neither vocabulary has a token that spans
such a border, which is checked when the vocabulary is loaded (texts are encoded whole otherwise).

1. One pass encodes each text once and lands its counts, the digest of its groups, and its distinct
   id pairs with their number of links (packed, 8 + 4 bytes a pair).
2. Tasks count in how many rows each pair occurs (merged in the task, then a grouped sum), and each A
   id's highest count is joined to its pairs.
3. Pairs in more rows than a cut ``t`` go to all tasks; ``t`` is set from a histogram of the counts so
   that these are at most ``HOT_PAIRS`` (16 MB) whatever the input.  The others are joined on the pair,
   where by the choice of ``t`` no key has more than ``t`` rows.

Null and empty texts, and texts that either tokenizer's bytes do not give back, have no tokens: zeros
and an empty digest.  Special tokens' strings are plain text.  Every row counts as a document of its
own, also if rows or ids repeat or ids are null; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import textkernel as K
from sparkmart.llm.common import land, ship_package

A_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
B_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
HELD_UNITS = 1_000_000
HELD_CHARS = 32_000_000
HOT_PAIRS = 1 << 20
#: Distinct pairs that a task merges before it hands its partial counts on.
MERGED_PAIRS = 4_000_000

_BORDER = re.compile(r"(?<=\S)(?=[ \n]\S)")
_TWO_SPACES = re.compile(r"\s\s")
_MARK = "\x01"
_SPACE_PIECE = "▁"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_HELD: dict[int, "Aligner"] = {}


def byte_alphabet() -> dict[str, int]:
    """Characters by which a byte-level vocabulary writes bytes: printable Latin-1 bytes stand for
    themselves, the others take the characters from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and what they make of the units met so far."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            plain = all(c in alphabet for c in token)
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if plain else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_byte = np.array([self.b.is_byte(i) for i in range(len(pieces))])
        self.b_bytes = [bytes([int(_BYTE_PIECE.fullmatch(p)[1], 16)]) if byte else p.replace(_SPACE_PIECE, " ").encode()
                        for p, byte in zip(pieces, self.b_byte)]
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = ([str(i) for i in range(len(x))] for x in (self.a_bytes, self.b_bytes))
        self.in_words = not any(_SPACE_PIECE in p.lstrip(_SPACE_PIECE) or "\n" in p or " " in p for p in pieces)
        self.clear()

    def clear(self):
        self.unit, self.texts, self.chars = {}, [], 0
        self.n = np.zeros((0, 3), np.int64)  # tokens of A, tokens of B, groups; -1: bytes differ
        self.first, self.keys = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.cut_first, self.cuts = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def units(self, text: str) -> list[str]:
        """The text with a space in front, cut at the borders that no token spans."""
        text = " " + text
        if not self.in_words:
            return [text]
        if _MARK in text or text[-1].isspace() or _TWO_SPACES.search(text):
            return _BORDER.split(text)
        return text.replace(" ", _MARK + " ").replace("\n", _MARK + "\n").split(_MARK)[1:]

    # --- encoding of units not met yet ------------------------------------------------------

    def _encode(self, units):
        """Per tokenizer: flat ids, span starts and ends in characters of the unit, tokens per unit."""
        from itertools import chain

        flat = chain.from_iterable
        ea = self.a.encode_batch(units, add_special_tokens=False)
        a_ids = [e.ids for e in ea]
        a_spans = np.array(list(flat(e.offsets for e in ea)), np.int64).reshape(-1, 2)
        led = np.array([u[0] == " " for u in units])
        eb = self.b.encode([u[1:] if x else u for u, x in zip(units, led)], return_type="offset_mapping", num_threads=1)
        # A unit after a line end has no space in front: drop the one that B adds.
        b_ids = [e["ids"] if x else e["ids"][1:] for e, x in zip(eb, led)]
        b_spans = np.array(list(flat(e["offsets"] if x else e["offsets"][1:] for e, x in zip(eb, led))), np.int64).reshape(-1, 2)
        counts = [np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids)]
        b_spans += np.repeat(led, counts[1])[:, None]
        ids = [np.array(list(flat(x)), np.int64) for x in (a_ids, b_ids)]
        return (ids[0], a_spans, counts[0]), (ids[1], b_spans, counts[1])

    @staticmethod
    def _ends(rough: np.ndarray, inner: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Byte ends of tokens: the coarse cut, or inside a character the last coarse cut and the
        decoded bytes since."""
        total, at = np.cumsum(size), np.arange(len(rough))
        clean = np.maximum.accumulate(np.where(inner, -1, at)) if len(at) else at
        base, done = np.append(rough, 0)[clean], np.append(total, 0)[clean]
        return np.where(inner, base + total - done, rough)

    def learn(self, units: list[str]) -> None:
        """Encode and align units; the ones whose bytes either tokenizer does not give back are marked."""
        raw, encoded = [u.encode() for u in units], self._encode(units)
        made = [b"".join(map(table.__getitem__, ids.tolist())) for (ids, _, _), table in zip(encoded, (self.a_bytes, self.b_bytes))]
        stop = np.cumsum([len(r) for r in raw])
        whole = all(m == b"".join(raw) and np.array_equal(np.cumsum(size[ids])[np.cumsum(count) - 1], stop)
                    for m, (ids, _, count), size in zip(made, encoded, (self.a_size, self.b_size)))
        if whole:
            self._store(units, raw, encoded)
            return
        bad = {u for u, r in zip(units, raw) if not self._same(u, r)}
        for u in bad:
            self.unit[u] = len(self.texts)
            self.texts.append("")
        self.n = np.concatenate((self.n, np.full((len(bad), 3), -1)))
        self.size = np.append(self.size, np.zeros(len(bad), np.int64))
        self.first = np.append(self.first, np.full(len(bad), self.first[-1]))
        self.cut_first = np.append(self.cut_first, np.full(len(bad), self.cut_first[-1]))
        good = [u for u in units if u not in bad]
        if good:
            self._store(good, [u.encode() for u in good], self._encode(good))

    def _same(self, unit, raw):
        (a, _, _), (b, _, _) = self._encode([unit])
        return b"".join(self.a_bytes[i] for i in a) == raw == b"".join(self.b_bytes[i] for i in b)

    def _store(self, units, raw, encoded):
        sizes = np.array([len(r) for r in raw], np.int64)
        chars = np.frombuffer("".join(units).encode("utf-32-le"), "<u4")
        width = 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)
        byte_at = np.concatenate(([0], np.cumsum(width)))
        lengths = np.array([len(u) for u in units], np.int64)
        start = np.cumsum(lengths) - lengths
        ends = []
        for (ids, spans, count), size, byte in zip(encoded, (self.a_size, self.b_size), (None, self.b_byte)):
            rough = byte_at[spans[:, 1] + np.repeat(start, count)]
            if byte is None:  # the next token of the unit starts before this one's last character ends
                inner = np.zeros(len(ids), bool)
                inner[:-1] = spans[1:, 0] < spans[:-1, 1]
                inner[np.cumsum(count) - 1] = False
            else:  # byte-fallback tokens but the last of a character have an empty span
                inner = byte[ids] & (spans[:, 0] == spans[:, 1])
            ends.append(self._ends(rough, inner, size[ids]))
        (a, b), (a_ids, b_ids) = ends, (encoded[0][0], encoded[1][0])
        every = np.union1d(a, b)
        ia, ib = np.searchsorted(a, every), np.searchsorted(b, every)
        keys = a_ids[ia] << 32 | b_ids[ib]
        stop = np.cumsum(sizes)
        links = np.searchsorted(every, stop, "right")
        common = every[(a[ia] == every) & (b[ib] == every)]
        groups = np.searchsorted(common, stop, "right")
        ga, gb = (np.searchsorted(x, common, "right").tolist() for x in (a, b))
        at, bt = [self.a_text[i] for i in a_ids.tolist()], [self.b_text[i] for i in b_ids.tolist()]
        parts, i, j = [], 0, 0
        for x, y in zip(ga, gb):
            parts.append(",".join(at[i:x]) + "|" + ",".join(bt[j:y]))
            i, j = x, y
        lo = 0
        for u, hi in zip(units, groups.tolist()):
            self.unit[u] = len(self.texts)
            self.texts.append(";".join(parts[lo:hi]))
            lo = hi
        n_groups = np.diff(groups, prepend=0)
        self.n = np.concatenate((self.n, np.stack((encoded[0][2], encoded[1][2], n_groups), 1)))
        self.size = np.concatenate((self.size, sizes))
        self.first = np.concatenate((self.first, self.first[-1] + links))
        self.keys = np.concatenate((self.keys, keys))
        self.cut_first = np.concatenate((self.cut_first, self.cut_first[-1] + groups))
        self.cuts = np.concatenate((self.cuts, common - np.repeat(stop - sizes, n_groups)))
        self.chars += len(chars)

    # --- texts -------------------------------------------------------------------------------

    def texts_of(self, texts: list[str]):
        """Per text: (tokens of A, of B, groups, group text, keys of the links, numbers of its units)."""
        if len(self.unit) > HELD_UNITS or self.chars > HELD_CHARS:
            self.clear()
        cut = [self.units(t) if t else [] for t in texts]
        new = list(dict.fromkeys(u for units in cut for u in units if u not in self.unit))
        if new:
            self.learn(new)
        for units in cut:
            at = np.fromiter(map(self.unit.__getitem__, units), np.int64, len(units))
            n = self.n[at]
            if len(at) == 0 or (n[:, 0] < 0).any():
                yield 0, 0, 0, "", np.zeros(0, np.int64), at[:0]
                continue
            keys = self.keys[_ranges(self.first[at], self.first[at + 1])]
            a, b, groups = n.sum(axis=0).tolist()
            yield a, b, groups, ";".join([self.texts[i] for i in at.tolist()]), keys, at

    def group_ends(self, at: np.ndarray) -> np.ndarray:
        """Byte ends (in the text with its space) of the groups of a text's units."""
        lo, hi = self.cut_first[at], self.cut_first[at + 1]
        begin = np.cumsum(self.size[at]) - self.size[at]
        return self.cuts[_ranges(lo, hi)] + np.repeat(begin, hi - lo)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All indexes of the ranges [lo, hi), end to end."""
    n = hi - lo
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def aligner(a_file, b_file) -> Aligner:
    """The worker's aligner of two broadcast vocabularies (kept for the life of the worker)."""
    key = hash((a_file.value, b_file.value))
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Aligner(a_file.value, b_file.value)
    return _HELD[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_vocabulary: str = A_VOCABULARY,
           b_vocabulary: str = B_VOCABULARY, with_groups: bool = False) -> DataFrame:
    """One row per row: id, n_a, n_b, n_groups, n_links, groups_sha256, and the row's distinct id
    pairs packed as ``keys`` (``a << 32 | b``, int64) and ``times`` (links of the pair, int32).

    ``with_groups`` adds ``groups`` (``a1,a2|b1;a3|b2,b3``) and ``ends``, the byte end of each group in
    the text with a space in front.
    """
    spark = docs.sparkSession
    ship_package(spark)
    a_file, b_file = (spark.sparkContext.broadcast(_read(p)) for p in (a_vocabulary, b_vocabulary))

    def one_pass(batches):
        both = aligner(a_file, b_file)
        for batch in batches:
            for part in K.slices(batch, "text"):
                out = []
                for a, b, g, text, keys, at in both.texts_of(part.column("text").to_pylist()):
                    pairs, times = np.unique(keys, return_counts=True)
                    out.append((a, b, g, len(keys), hashlib.sha256(text.encode()).hexdigest() if text else "",
                                pairs.astype("<i8").tobytes(), times.astype("<i4").tobytes())
                               + ((text, both.group_ends(at)) if with_groups else ()))
                types = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary(), pa.string(), pa.list_(pa.int64())]
                columns = [pa.array(x, t) for x, t in zip(zip(*out), types)]
                names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "times", "groups", "ends"]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=["id", *names[:len(columns)]])

    schema = "id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys binary, times binary"
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return base.mapInArrow(one_pass, schema + (", groups string, ends array<long>" if with_groups else ""))


def pair_counts(rows: DataFrame) -> DataFrame:
    """(key, n, best): in how many rows each pair occurs, and whether that is its A id's highest count."""
    def partial(batches):
        keys, counts, loose, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def merged():
            every = np.concatenate([keys, *loose])
            out, where = np.unique(every, return_inverse=True)
            weight = np.concatenate((counts, np.ones(len(every) - len(keys), np.int64)))
            return out, np.bincount(where, weight, len(out)).astype(np.int64)

        for batch in batches:
            for packed in batch.column("keys").to_pylist():
                loose.append(np.frombuffer(packed, "<i8"))
                size += len(loose[-1])
                if size > MERGED_PAIRS:
                    keys, counts = merged()
                    loose, size = [], 0
                    if len(keys) > MERGED_PAIRS:
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])
                        keys, counts = keys[:0], counts[:0]
        keys, counts = merged()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])

    counts = land(rows.select("keys").mapInArrow(partial, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "align-counts")
    a = F.shiftright("key", 32)
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))
    return counts.join(top, a == F.col("a")).select("key", "n", (F.col("n") == F.col("top")).alias("best"))


def hot_cut(pairs: DataFrame, limit: int) -> int:
    """The least ``t`` from a fixed scale (steps of a sixteenth of a power of two) such that at most
    ``limit`` pairs have ``n > t``."""
    step = F.floor(F.log2("n") * 16).cast("int")
    above, t = 0, 0
    for r in pairs.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("top")).orderBy(F.desc("s")).collect():
        if above + r["k"] > limit:
            t = r["top"]
            break
        above += r["k"]
    return t


def score(rows: DataFrame, pairs: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """The rows with n_best and count_sum over their links (see the module text)."""
    spark = rows.sparkSession
    t = hot_cut(pairs, hot_pairs)
    hot = pairs.where(F.col("n") > t).orderBy("key").toArrow()  # at most hot_pairs rows
    table = spark.sparkContext.broadcast([np.asarray(hot.column(c)) for c in ("key", "n")]
                                         + [np.asarray(hot.column("best").cast(pa.int8()))])

    def answer(batches):
        keys, counts, best = table.value
        keys = np.append(keys, np.iinfo(np.int64).max)  # a key that no pair has
        for batch in batches:
            sums, bests, cold, cold_times = [], [], [], []
            for packed, packed_times in zip(batch.column("keys").to_pylist(), batch.column("times").to_pylist()):
                own, times = np.frombuffer(packed, "<i8"), np.frombuffer(packed_times, "<i4").astype(np.int64)
                at = np.searchsorted(keys, own)
                known = keys[at] == own
                at, seen = at[known], times[known]
                sums.append(int((counts[at] * seen).sum()))
                bests.append(int(seen[best[at] > 0].sum()))
                cold.append(own[~known])
                cold_times.append(times[~known])
            keep = [batch.column(c) for c in ("id", "rid", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield pa.RecordBatch.from_arrays(
                keep + [pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), pa.array(cold, pa.list_(pa.int64())),
                        pa.array(cold_times, pa.list_(pa.int64()))],
                names=["id", "rid", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "cold", "times"])

    out = land(rows.mapInArrow(answer, "id long, rid long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                       "n_best long, count_sum long, cold array<long>, times array<long>"), "align-rows")
    rest = (out.where(F.size("cold") > 0).select("rid", F.explode(F.arrays_zip("cold", "times")).alias("x"))
            .select("rid", F.col("x.cold").alias("key"), "x.times")
            .join(pairs.where(F.col("n") <= t), "key").groupBy("rid")
            .agg(F.sum(F.col("n") * F.col("times")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")))
    zero = F.lit(0).cast("long")
    return (out.join(rest, "rid", "left")
            .select("id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("more", zero)).alias("count_sum"), "groups_sha256"))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_vocabulary: str = A_VOCABULARY,
          b_vocabulary: str = B_VOCABULARY, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = land(encode(docs, id_col, text_col, a_vocabulary, b_vocabulary).withColumn("rid", F.monotonically_increasing_id()),
                "align-encoded", compression="zstd")
    pairs = land(pair_counts(rows), "align-pairs")
    return score(rows, pairs, hot_pairs).withColumnRenamed("id", id_col)
