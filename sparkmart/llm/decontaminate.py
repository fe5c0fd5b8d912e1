"""Benchmark decontamination by template canonicalisation.

A text's words are lower-cased and stripped of ASCII punctuation; numbers, names (one capital, not at
the start of a sentence) and units after a number become typed placeholders.  Windows of template words
of documents and benchmark items are joined on their hash; the words behind the placeholders (*slots*)
travel along.  A capitalised word that opens a sentence may be a name or not, so a window with such words
is hashed in both readings: all of them literal, or all of them names.  A window of which less than half
is literal is hashed by its plain words instead, so placeholders alone never match.  On each alignment
(document position minus item position) the slots must agree: one item value always stands for one
document value - the same one in a plain copy, another one in a re-parameterised question.  An item is
leaked into a document if at least ``MIN_COVER`` of its words lie in windows matched on consistent
alignments; an alignment that is not consistent in both readings counts by its literal one, if that is.

Windows have ``WINDOW`` words for items of ``LONG`` words or more and ``SHORTEST`` words below, so that one
changed word leaves at least half of an item of ten words or more.  An item of fewer than ``SHORTEST``
words is leaked where its plain words begin at the start of a line and stop at the end of one.

The document side keeps only windows whose hash hits a bitmap of the benchmark's window hashes
(``BITS`` bits, fixed size, so broadcast whatever the benchmark's size; false hits fall out in the
join, which is exact).  Null texts count as empty; an item without a word is never leaked; repeated rows
and items each get their result; ids may be null; other columns are not read.
"""

from __future__ import annotations

import string
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import textkernel as K
from sparkmart.llm.common import digest, free_name, land, own_columns, ship_package

WINDOW = 8
SHORTEST = 5
LONG = 24
MIN_COVER = 0.5
BITS = 1 << 23
#: Units that count as a slot after a number.
UNITS = ("mm cm m km in inch inches ft feet foot yard yards mile miles mg g kg t ton tons lb lbs oz ml l litre litres liter "
         "liters gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year "
         "years mph kmh percent degrees celsius dollar dollars euro euros cent cents usd eur").split()

_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[ord(c) for c in string.punctuation]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:\n"]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_NUM, _NAME, _UNIT, _PLAIN = (K.U64(x) for x in (0x1F2E3D4C5B6A7988, 0x2F2E3D4C5B6A7988, 0x3F2E3D4C5B6A7988, 0x4F2E3D4C5B6A7988))


class Templates(NamedTuple):
    """The words of a slice: in each reading their template hashes and whether they are slots."""

    words: list[np.ndarray]
    slots: list[np.ndarray]
    plain: np.ndarray
    opener: np.ndarray  # capitalised and opening a sentence
    line_first: np.ndarray
    line_last: np.ndarray
    first: np.ndarray  # first word of each row


def templates(column: pa.Array) -> Templates:
    data, off = K.text_bytes(column)
    lead = np.zeros(len(data), dtype=bool)
    lead[1:] = data[:-1] == 0xC3
    two = lead & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)  # À..Þ in UTF-8
    one = (data >= 65) & (data <= 90)
    low = data + np.uint8(32) * (one | two)
    capital = one.copy()
    capital[:-1] |= two[1:]
    keep = ~_PUNCT[data]
    origin = np.flatnonzero(keep)
    text, caps = low[keep], capital[keep]
    starts, ends, first = K.find_words(text, np.concatenate(([0], np.cumsum(keep)))[off])
    plain = K.hash_words(text, starts, ends)
    row_first = np.zeros(len(starts) + 1, dtype=bool)
    row_first[first] = True
    row_first[-1] = True
    opens = row_first[:-1] | _follows(_STOP[data], origin, starts, ends)
    line_first = row_first[:-1] | _follows(data == 10, origin, starts, ends)
    line_last = np.append(line_first[1:], True)[:len(starts)]
    digits, capitals = _counts(_DIGIT[text]), _counts(caps)
    number = digits[ends] - digits[starts] == ends - starts
    name = (capitals[ends] - capitals[starts] == 1) & (ends - starts > 1)
    if len(starts):
        name &= caps[starts]
    after = np.append(False, number[:-1])[:len(starts)] & ~row_first[:-1]
    unit = after & np.isin(plain, _unit_hashes())
    opener = name & opens & ~number & ~unit
    readings = [name & ~opens, name]
    return Templates([np.where(number, _NUM, np.where(unit, _UNIT, np.where(r, _NAME, plain))) for r in readings],
                     [number | unit | r for r in readings], plain, opener, line_first, line_last, first)


def _counts(mask: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(mask)))


def _follows(mark: np.ndarray, origin: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words with a marked byte between the word before and themselves."""
    out, marks = np.zeros(len(starts), dtype=bool), _counts(mark)
    if len(starts) > 1:
        out[1:] = marks[origin[starts[1:]]] > marks[origin[ends[:-1] - 1]]
    return out


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    starts, ends, _ = K.find_words(data, np.array([0, len(data)]))
    return K.hash_words(data, starts, ends)


def window_size(n_words: np.ndarray) -> np.ndarray:
    """Window length for items of so many words (0: no window)."""
    return np.where(n_words >= LONG, WINDOW, np.minimum(n_words, SHORTEST))


def _hashed(t: Templates, at: np.ndarray, size: int):
    """(index into ``at``, reading, hash, windows with slots) of every reading of the windows."""
    plain = K.Grams(t.plain)(at, at + size) ^ _PLAIN
    openers = _counts(t.opener)
    for reading, (words, slots) in enumerate(zip(t.words, t.slots)):
        slots = _counts(slots)
        literal = 2 * (slots[at + size] - slots[at]) <= size
        if size < SHORTEST:
            literal[:] = False
        if reading == 0:
            yield np.arange(len(at)), np.zeros(len(at), np.int64), np.where(literal, K.Grams(words)(at, at + size), plain), literal
        else:
            more = np.flatnonzero(literal & (openers[at + size] > openers[at]))
            yield more, np.ones(len(more), np.int64), K.Grams(words)(at[more], at[more] + size), literal[more]


def windows(df: DataFrame, sizes, bitmap=None) -> DataFrame:
    """(id, h1, h2, n_words, hits array<struct<pos, size, h, reading, slots>>) of (id, text, h1, h2): with
    ``bitmap`` (a Spark broadcast) the windows that hit it, without it each row's windows of its own size."""
    def run(batches):
        for batch in batches:
            for part in K.slices(batch, "text"):
                t = templates(part.column("text"))
                n_words, found = np.diff(t.first), []
                for size in sizes:
                    at, row = K.gram_starts(t.first, size)
                    if bitmap is None:
                        take = window_size(n_words)[row] == size
                    elif size < SHORTEST:
                        take = t.line_first[at] & t.line_last[at + size - 1]
                    else:
                        take = np.ones(len(at), dtype=bool)
                    at, row = at[take], row[take]
                    for i, reading, h, literal in _hashed(t, at, size):
                        if bitmap is not None:
                            bit = h & K.U64(BITS - 1)
                            hit = (bitmap.value[(bit >> K.U64(3)).astype(np.int64)] >> (bit & K.U64(7)).astype(np.uint8)) & 1 == 1
                            i, reading, h, literal = i[hit], reading[hit], h[hit], literal[hit]
                        found.append((row[i], at[i], np.full(len(i), size), reading, h, literal))
                row, at, size, reading, h, literal = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((reading, at, row))
                row, at, size, reading, h, literal = (x[order] for x in (row, at, size, reading, h, literal))
                values = [K.signed(t.plain[a:a + s][t.slots[r][a:a + s]]).tolist() if x else []
                          for a, s, r, x in zip(at, size, reading, literal)]
                hits = pa.StructArray.from_arrays(
                    [pa.array(at - t.first[row]), pa.array(size, pa.int64()), pa.array(K.signed(h)), pa.array(reading),
                     pa.array(values, pa.list_(pa.int64()))], names=["pos", "size", "h", "reading", "slots"])
                bounds = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("h1"), part.column("h2"), pa.array(n_words), pa.ListArray.from_arrays(bounds, hits)],
                    names=["id", "h1", "h2", "n_words", "hits"])

    return df.mapInArrow(run, "id long, h1 long, h2 long, n_words long, "
                              "hits array<struct<pos: long, size: long, h: long, reading: long, slots: array<long>>>")


def _base(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    h1, h2 = digest(F.col(text_col))
    return df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), h1.alias("h1"), h2.alias("h2"))


def _bitmap(spark, items: DataFrame):
    """Bits of all benchmark window hashes, set in tasks; at most ``BITS / 8`` bytes are gathered."""
    cells = (items.select(F.col("h").bitwiseAND(BITS - 1).alias("bit")).select((F.shiftright("bit", 3)).alias("byte"),
             F.expr("shiftleft(1, cast(bit & 7 as int))").alias("m")).groupBy("byte").agg(F.bit_or("m").alias("m")))
    table = np.zeros(BITS // 8, np.uint8)
    got = cells.toArrow()
    table[got.column("byte").to_numpy()] = got.column("m").to_numpy().astype(np.uint8)
    return spark.sparkContext.broadcast(table)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", min_cover: float = MIN_COVER):
    """(rows, leaks): ``rows`` is (rid, id, h1, h2, n_words), one per document; ``leaks`` is (rid, item,
    coverage, reparameterised), one per leaked item."""
    spark = docs.sparkSession
    ship_package(spark)
    items = land(windows(_base(benchmark, item_col, item_text), [*range(1, SHORTEST + 1), WINDOW])
                 .withColumn("item_row", F.monotonically_increasing_id())
                 .select("item_row", F.col("id").alias("item"), "n_words", F.explode("hits").alias("w"))
                 .select("item_row", "item", "n_words", "w.*"), "items")
    present = sorted(r[0] for r in items.select("size").distinct().collect())  # at most SHORTEST + 1
    bitmap = _bitmap(spark, items)
    rows = land(windows(_base(docs, id_col, text_col), present or [WINDOW], bitmap).withColumn("rid", F.monotonically_increasing_id()), "doc-windows")

    hits = (rows.where("size(hits) > 0").select("rid", F.explode("hits").alias("d")).select("rid", "d.*"))
    # an item with the same window in several places meets each of them: alignments sort them out
    joined = (hits.join(items.select("h", "size", "item_row", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"),
                                     F.col("reading").alias("item_reading")), ["h", "size"])
              .select("rid", "item_row", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"),
                      F.sequence("item_pos", F.col("item_pos") + F.col("size") - 1).alias("words"),
                      ((F.col("reading") == 0) & (F.col("item_reading") == 0)).alias("literal"),
                      F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")).alias("pairs")))
    # per alignment: an item has a bounded number of windows, and so of slot pairs
    union = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    plain = F.col("literal")
    aligned = joined.groupBy("rid", "item_row", "shift").agg(
        union("words").alias("words"), union("pairs").alias("pairs"),
        union(F.when(plain, F.col("words"))).alias("words0"), union(F.when(plain, F.col("pairs"))).alias("pairs0"))
    agrees = lambda c: F.size(c) == F.size(F.array_distinct(F.transform(c, lambda p: p["i"])))
    good = (aligned.select("rid", "item_row", F.when(agrees("pairs"), F.struct("words", "pairs"))
                           .when(agrees("pairs0"), F.struct(F.col("words0").alias("words"), F.col("pairs0").alias("pairs"))).alias("g"))
            .where("g is not null").select("rid", "item_row", "g.*")
            .withColumn("changed", F.exists("pairs", lambda p: p["i"] != p["d"])))
    totals = items.groupBy("item_row").agg(F.first("item").alias("item"), F.first("n_words").alias("n_words"))
    leaks = (good.groupBy("rid", "item_row").agg(F.size(union("words")).alias("matched"), F.max("changed").alias("reparameterised"))
             .join(totals, "item_row").withColumn("coverage", F.col("matched") / F.col("n_words"))
             .where(F.col("coverage") >= min_cover).select("rid", "item", "coverage", "reparameterised"))
    return rows.drop("hits"), leaks


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, n_words, contaminated, items (leaked item ids in order), coverage (the
    largest), reparameterised (some leaked item has changed slots)."""
    rows, leaks = find_leaks(docs, benchmark, id_col, **options)
    by = leaks.groupBy("rid").agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("coverage").alias("coverage"),
                                  F.max("reparameterised").alias("reparameterised"))
    return (rows.join(by, "rid", "left")
            .select(F.col("id").alias(id_col), "n_words", F.col("items").isNotNull().alias("contaminated"),
                    F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
                    F.coalesce("reparameterised", F.lit(False)).alias("reparameterised")))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns of the others unchanged."""
    rows, leaks = find_leaks(docs, benchmark, id_col, text_col, **options)
    h1, h2 = digest(F.col(text_col))
    a, b = free_name(docs, "h1"), free_name(docs, "h2")
    bad = rows.join(leaks.select("rid").distinct(), "rid").select(F.col("h1").alias(a), F.col("h2").alias(b)).distinct()
    return docs.withColumn(a, h1).withColumn(b, h2).join(land(bad, "leaks"), [a, b], "left_anti").select(*own_columns(docs))
