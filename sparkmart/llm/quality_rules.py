"""Quality rules: divergence of a document's histograms from language references.

Base rules (counts per document): word characters, symbols, lines that repeat an earlier line, words
in 8-word windows found twice or more.  A document fails them with under ``MIN_WORDS`` words or with
over ``MAX_REPEAT`` per cent of its words repeated.

The method: each document has a histogram of character classes and one of common words (a language's
``TOP_WORDS`` most frequent words, lower-cased and without trailing stops on both sides, and "other").  The references come from
all documents of a language: the median document's share of each character class (junk below half
of the documents does not move it) and the words' shares of all words.  A document is dropped if its smallest
Jensen-Shannon distance (base 2, 0..1) to any reference is above ``MAX_CHAR`` (texts of
``CHAR_GUARD`` characters or more) or ``MAX_WORD`` (texts of ``WORD_GUARD`` words or more): shorter
texts have too few counts for a verdict.

DataFrame functions only.  Every language has its reference: they are a landed table, of which one
block of about ``BLOCK_LANGUAGES`` languages at a time reaches the driver and becomes one literal of the plan,
whose size does not depend on the languages; more than one block is scored in as many passes, with the
least distance so far in each row.  Null texts
count as empty: no words, so they fail the base rules.  Null languages build no reference; without
any reference the base rules alone decide.  Ids may be null or repeated: nothing is keyed by them.
"""

from __future__ import annotations

import json
import math

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import WORD, free_prefix, land, let, own_columns, temporary_tables, words_of

SPAN = 8
MIN_WORDS = 20
MAX_REPEAT = 30
TOP_WORDS = 40
#: Common words are lower-cased and without trailing stops.
STOPS = ".,;:!?"
#: The stops at the end of a word, after its last other character.
TRAILING = rf"[{STOPS}](?<=[^\x20\x09-\x0D{STOPS}].)[{STOPS}]*(?=[\x20\x09-\x0D]|\z)"
#: Words of more bytes are named by their digest, so that references stay small.
NAMED = 256
#: Steps in which a document's share of a character class is counted for the median.
BINS = 2000
CHAR_GUARD, WORD_GUARD = 300, 50
MAX_CHAR, MAX_WORD = 0.20, 0.60
#: Languages (and, times TOP_WORDS, common words) that one pass takes, about.
BLOCK_LANGUAGES = 256
#: Character classes, counted in what is left of a text without PLAIN; "space" and "lower" are the rest.
PLAIN = r"[a-z\x20\n]+"
CLASSES = {
    "upper": r"[^\p{Lu}]+",
    "digit": r"[^0-9]+",
    "stops": r"""[^.,;:!?'"()-]+""",
    "symbol": r"[^#$%&*+/<=>@\[\]^_`{|}~\\]+",
    "far": r"[\x00-\x7F]+",
}


def _left(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def _class_counts(rare: Column, n_chars: Column, word_chars: Column) -> list[Column]:
    counts = [_left(rare, p) for p in CLASSES.values()]
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return [*counts, n_chars - word_chars, F.greatest(word_chars - total, F.lit(0))]


def _counted_words(text: Column) -> Column:
    """The words as they are counted, as many as ``words_of``: lower-cased, without the stops at their end (a word
    of stops only stays).  Both steps run on the whole text, much faster than word by word."""
    return words_of(F.regexp_replace(F.lower(text), TRAILING, ""))


def _named(word: Column) -> Column:
    return F.when(F.octet_length(word) > NAMED, F.md5(word)).otherwise(word)


def _repeat_words(words: Column, span: int = SPAN) -> Column:
    """Words of a document that lie in a window of ``span`` (a power of two) words found twice or more in it."""
    def doubled(h: Column, width: int) -> Column:
        """Hashes of [i, i + 2 width) from those of [i, i + width)."""
        return let(h, lambda x: F.zip_with(F.slice(x, 1, F.size(x) - width), F.slice(x, 1 + width, F.size(x) - width),
                                           lambda a, b: F.xxhash64(a, b)))

    hashes, width = F.transform(words, lambda w: F.xxhash64(w)), 1
    while width < span:
        hashes, width = doubled(hashes, width), 2 * width
    return F.when(F.size(words) > span, let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h, span))
                                            .otherwise(F.lit(0)))).otherwise(F.lit(0))


def _covered(hashes: Column, span: int) -> Column:
    pair = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.element_at(F.transform(F.array(pair), lambda s: F.filter(s, lambda x, k:
        F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)))), 1)
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    return F.element_at(F.transform(F.array(starts), lambda p: F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(span), F.coalesce(F.get(p, k + 1) - x, F.lit(span)))), F.lit(0), lambda a, x: a + x)), 1)


def _hits(text: Column, known: list[str]) -> Column:
    if not known:
        return F.array().cast("array<string>")
    some = F.filter(_counted_words(text), lambda w: w.isin(known) | (F.octet_length(w) > NAMED))
    return F.sort_array(F.filter(F.transform(some, _named), lambda w: w.isin(known)))


def _measure_all(docs: DataFrame, parts: list[int], known_of, prefix: str, text_col: str = "text") -> DataFrame:
    """``measure`` with the common words of all ``parts``, a pass for each part after the first."""
    df, hits = measure(docs, known_of(parts[0]) if parts else [], prefix, text_col), f"{prefix}hits"
    for k in parts[1:]:
        more = _hits(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), known_of(k))
        df = land(df.withColumn(hits, F.sort_array(F.concat(F.col(f"`{hits}`"), more))), "quality-hits")
    return df


def measure(docs: DataFrame, known: list[str], prefix: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus working columns named by ``prefix``: base counts, class counts ``c0..`` and the
    sorted common words.

    The columns are flat and used more than once further on, so that the optimizer leaves the
    regular expressions in their projection instead of copying them into later lambdas.
    """
    own, p = own_columns(docs), prefix
    text, words, rare, n_chars, chars = (F.col(f"`{p}{c}`") for c in ("text", "words", "rare", "n_chars", "word_chars"))
    df = docs.select(*own, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(f"{p}text"))
    df = df.select(*own, text, words_of(text).alias(f"{p}words"), F.regexp_replace(text, PLAIN, "").alias(f"{p}rare"))
    df = df.select(*own, text, words, rare, F.length(text).cast("long").alias(f"{p}n_chars"),
                   F.length(F.array_join(words, "")).cast("long").alias(f"{p}word_chars"))
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(WORD))
    dup = let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))
    hits = _hits(text, known)
    return df.select(
        *own, F.size(words).cast("long").alias(f"{p}n_words"), chars, n_chars, _left(rare, r"[^#*$%&|<>]+").cast("long").alias(f"{p}n_symbols"),
        dup.cast("long").alias(f"{p}n_dup_lines"), _repeat_words(words).cast("long").alias(f"{p}n_repeat_words"), hits.alias(f"{p}hits"),
        *[c.cast("double").alias(f"{p}c{i}") for i, c in enumerate(_class_counts(rare, n_chars, chars))])


# --- references -----------------------------------------------------------------------------

def common_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Landed (lang, word, k, n): for each language the ``TOP_WORDS`` most frequent words of all its
    documents with their counts, the count of all its words, and a row with the empty word."""
    base = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = (base.select("lang", F.explode(_counted_words(F.col("text"))).alias("w")).select("lang", _named(F.col("w")).alias("word"))
              .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("k")))
    with temporary_tables(docs.sparkSession):
        counts = land(counts, "common-words")
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("k"), "word"))
        top = counts.where("word <> ''").withColumn("rank", rank).where(F.col("rank") <= TOP_WORDS).select("lang", "word", "k")
        total = counts.groupBy("lang").agg(F.sum("k").alias("n"))
        rest = total.select("lang", F.lit("").alias("word"), F.lit(0).cast("long").alias("k"))
        return land(top.union(rest).join(total, "lang"), "common-top", keep=True)


class References:
    """All languages' references as a landed table (lang, bins, words), read in blocks.

    ``known_of(part)`` is one part of the distinct common words, ``block(i)`` the references of one block."""

    def __init__(self, common: DataFrame):
        self.common = common
        self.distinct = land(common.where("word <> ''").select("word").distinct(), "known-words")
        self.parts = list(range(max(1, math.ceil(self.distinct.count() / (BLOCK_LANGUAGES * TOP_WORDS)))))
        self.blocks: list[int] = []

    def known_of(self, part: int) -> list[str]:
        return sorted(r[0] for r in self.distinct.where(F.pmod(F.xxhash64("word"), F.lit(len(self.parts))) == part).collect())

    def add_classes(self, counts: DataFrame) -> References:
        words = (self.common.groupBy("lang").agg(F.collect_list(F.when(F.col("word") != "", F.struct("word", (F.col("k") / F.col("n")).alias("share")))).alias("words")))
        self.table = land(class_medians(counts).join(words, "lang"), "quality-references")
        self.blocks = list(range(math.ceil(self.table.count() / BLOCK_LANGUAGES)))
        return self

    def block(self, i: int) -> list[dict]:
        out = []
        for r in self.table.where(F.pmod(F.xxhash64("lang"), F.lit(len(self.blocks))) == i).collect():
            shares = [x / BINS for x in r["bins"]]
            if sum(shares):
                out.append({"lang": r["lang"], "classes": [x / sum(shares) for x in shares], "words": dict(sorted((w["word"], w["share"]) for w in r["words"]))})
        return sorted(out, key=lambda r: r["lang"])


def class_medians(counts: DataFrame) -> DataFrame:
    """(lang, bins): for each language the median share of each character class, in steps of ``BINS``.

    ``counts``: lang, n_chars, c0.. per document.  One histogram of ``BINS`` cells per language and
    class gives the medians at that step, whatever the size.
    """
    k = len(CLASSES) + 2
    bins = F.array(*[F.floor(F.col(f"c{i}") * BINS / F.col("n_chars")) for i in range(k)])
    cells = (counts.where("lang is not null and n_chars > 0").select("lang", F.posexplode(bins).alias("class", "bin"))
             .groupBy("lang", "class", "bin").agg(F.count(F.lit(1)).alias("docs")))
    own = Window.partitionBy("lang", "class")
    half = cells.select("lang", "class", "bin", F.sum("docs").over(own.orderBy("bin")).alias("upto"), F.sum("docs").over(own).alias("all"))
    median = half.where("upto * 2 >= all").groupBy("lang", "class").agg(F.min("bin").alias("bin"))
    return median.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("class", "bin"))), lambda x: x["bin"]).alias("bins"))


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> References:
    """Per language: ``classes`` (shares of the character classes) and ``words`` (shares of its common words)."""
    refs = References(common_words(docs, text_col, lang_col))
    text = F.col("text")
    counts = (docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
              .select("lang", F.length(text).alias("n_chars"), F.length(F.array_join(words_of(text), "")).alias("word_chars"),
                      F.regexp_replace(text, PLAIN, "").alias("rare")))
    counts = counts.select("lang", "n_chars", *[c.alias(f"c{i}") for i, c in enumerate(_class_counts(F.col("rare"), F.col("n_chars"), F.col("word_chars")))])
    return refs.add_classes(counts)


def _distance(twice_nats: Column) -> Column:
    return F.sqrt(F.greatest(twice_nats, F.lit(0.0)) / (2 * math.log(2)))


def _xlnx(x: Column) -> Column:
    return F.when(x > 0, x * F.log(x)).otherwise(F.lit(0.0))


def _constant(value, schema: str) -> Column:
    """A nested constant as one literal of the plan, whatever its size."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _cells(p: Column, q: Column) -> Column:
    """Parts of twice the Jensen-Shannon divergence, without the constant 2 ln 2 of all cells."""
    return _xlnx(p) + _xlnx(q) - _xlnx(p + q)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def char_distances(counts: list[Column], total: Column, refs: list[dict]) -> Column:
    """Array of distances of the character classes, one for each reference."""
    return let(F.array(*[c / total for c in counts]), lambda shares: F.transform(
        _constant([r["classes"] for r in refs], "array<array<double>>"),
        lambda ref: _distance(F.lit(2 * math.log(2)) + _sum(F.zip_with(shares, ref, _cells)))))


def word_distances(hits: Column, n_words: Column, refs: list[dict]) -> Column:
    """Array of distances of the common-word histogram, one for each reference.

    With x' = x ln x, twice the divergence is the sum of p' + q' - (p + q)' over all cells plus 2 ln 2;
    cells that document or reference lack add nothing, so only the document's own words are visited, and
    of each word only the references that have it.  Words are found in small maps dealt by their hash.
    """
    by_word: dict[str, list] = {}
    for j, r in enumerate(refs):
        for w, q in r["words"].items():
            by_word.setdefault(w, []).append([j, float(q)])
    n_maps = max(1, len(by_word) // 4)
    maps: list[dict] = [{} for _ in range(n_maps)]
    for w, of in by_word.items():
        maps[xxhash.xxh64_intdigest(w.encode(), 42) % n_maps][w] = [{"j": j, "q": q} for j, q in of]
    rests = [1.0 - min(1.0, math.fsum(r["words"].values())) for r in refs]
    lookup = _constant(maps, "array<map<string, array<struct<j: int, q: double>>>>")
    # the hash is read as unsigned: pmod of the high and the low half
    place = lambda w: F.pmod(F.pmod(F.shiftrightunsigned(F.xxhash64(w), 32), F.lit(n_maps)) * ((1 << 32) % n_maps)
                             + F.xxhash64(w).bitwiseAND(F.lit((1 << 32) - 1)), F.lit(n_maps)).cast("int")
    firsts = lambda h: F.filter(F.transform(h, lambda w, i: F.when((i == 0) | (F.get(h, i - 1) != w), i)), lambda i: i.isNotNull())

    def runs(h, starts, total):
        return F.transform(starts, lambda i, k: F.struct(F.get(h, i).alias("w"), ((F.coalesce(F.get(starts, k + 1), F.size(h)) - i) / total).alias("p")))

    def distances(found):
        cells = F.flatten(F.transform(found, lambda x: F.transform(
            F.coalesce(F.get(lookup, place(x["w"]))[x["w"]], F.array().cast("array<struct<j: int, q: double>>")),  # none: a word of other blocks
            lambda e: F.struct(e["j"].alias("j"), _cells(x["p"], e["q"]).alias("v")))))
        rest = F.greatest(1 - _sum(F.transform(found, lambda x: x["p"])), F.lit(0.0))
        return let(F.struct(cells.alias("cells"), rest.alias("rest")), lambda s: F.transform(
            _constant(rests, "array<double>"),
            lambda q, j: _distance(F.lit(2 * math.log(2)) + _cells(s["rest"], q)
                                   + F.aggregate(s["cells"], F.lit(0.0), lambda a, x: a + F.when(x["j"] == j, x["v"]).otherwise(F.lit(0.0))))))

    return let(hits, lambda h: let(F.greatest(n_words, F.lit(1)).cast("double"),
                                   lambda t: let(firsts(h), lambda s: let(runs(h, s, t), distances))))


def _least(measured: DataFrame, blocks: list[int], block_of, p: str) -> DataFrame:
    """``measured`` with the least distances ``char`` and ``word`` to the references of all blocks."""
    col = lambda c: F.col(f"`{p}{c}`")
    total = F.greatest(col("n_chars"), F.lit(1)).cast("double")
    counts = [col(f"c{i}") for i in range(len(CLASSES) + 2)]
    df, done = measured, False
    for i in blocks:
        refs = block_of(i)
        if not refs:
            continue
        char = F.array_min(char_distances(counts, total, refs))
        word = F.array_min(word_distances(col("hits"), col("n_words"), refs))
        if done:
            char, word, df = F.least(col("char"), char), F.least(col("word"), word), land(df, "quality-least")
        df, done = df.withColumns({f"{p}char": char, f"{p}word": word}), True
    return df if done else df.withColumns({f"{p}char": F.lit(0.0), f"{p}word": F.lit(0.0)})


def _verdict(measured: DataFrame, own: list[Column], blocks: list[int], block_of, p: str, max_char: float, max_word: float) -> DataFrame:
    col = lambda c: F.col(f"`{p}{c}`")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = (col("n_words") < MIN_WORDS) | (100 * col("n_repeat_words") > MAX_REPEAT * col("n_words"))
    df = _least(measured, blocks, block_of, p)
    df = df.select(*own, *[col(c) for c in base], col("n_chars"), failed.alias(f"{p}failed"), col("char"), col("word"))
    far = ((col("n_chars") >= CHAR_GUARD) & (col("char") > max_char)) | ((col("n_words") >= WORD_GUARD) & (col("word") > max_word))
    return df.select(*own, F.struct(*[col(c).alias(c) for c in base], col("failed").alias("base_failed"), col("char").alias("char_distance"),
                                    col("word").alias("word_distance"), (~col("failed") & ~far).alias("kept")).alias(f"{p}quality"))


def judge(docs: DataFrame, refs: References | list[dict], text_col: str = "text", max_char: float = MAX_CHAR, max_word: float = MAX_WORD) -> DataFrame:
    """``docs`` plus one struct column, the last: base counts, base_failed, char_distance, word_distance, kept."""
    p = free_prefix(docs, "q_")
    if isinstance(refs, References):
        measured, blocks, block_of = _measure_all(docs, refs.parts, refs.known_of, p, text_col), refs.blocks, refs.block
    else:
        measured, blocks, block_of = measure(docs, sorted({w for r in refs for w in r["words"]}), p, text_col), [0], lambda i: refs
    return _verdict(measured, own_columns(docs), blocks, block_of, p, max_char, max_word)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           max_char: float = MAX_CHAR, max_word: float = MAX_WORD) -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    char_distance, word_distance, kept.  The counts are landed once and serve references and verdicts."""
    refs = References(common_words(docs, text_col, lang_col))
    base = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = land(_measure_all(base, refs.parts, refs.known_of, "q_").drop("text"), "quality-counts")
    refs.add_classes(counts.where("lang is not null").select("lang", F.col("q_n_chars").alias("n_chars"), *[F.col(f"q_c{i}").alias(f"c{i}") for i in range(len(CLASSES) + 2)]))
    df = _verdict(counts, [F.col("id")], refs.blocks, refs.block, "q_", max_char, max_word)
    return df.select(F.col("id").alias(id_col), f"{df.columns[-1]}.*")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that pass, all columns unchanged."""
    df = judge(docs, references(docs, text_col, lang_col), text_col)
    return df.where(F.col(f"`{df.columns[-1]}`")["kept"]).select(*own_columns(docs))
