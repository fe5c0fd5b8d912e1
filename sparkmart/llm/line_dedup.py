"""Line dedup by winnowing over line hashes.

A text's lines with a word (trimmed of spaces and separators) form a sequence.  ``run`` is the guarantee
length of the winnowing: every run of that many equal lines is found.  At the default of one line each
window is one line, its minimum is the line itself and every line is a fingerprint, so nothing is left
to sampling.  The fingerprints' positions are joined over all documents with the first occurrence in the
order of (id, row, line); every other position is a later copy.  Later copies extend over the lines on
both sides as far as these are later copies too; these maximal repeated runs are deleted.

So a line goes if and only if it lies in a run of ``run`` or more lines that occurs earlier, in the same text
or in another.  With ``run`` above one a minimum alone does not tell which of its earlier places shares the
lines around it, so a fingerprint there is the hash of the whole window: exact, one row per window.

Only hashes are moved, 128 bits each; a hot line is met by its first occurrence (a map-side partial
minimum) and the joins of hot lines are broadcasts, never all pairs.  DataFrame functions only.  Lines
without a word are neither counted nor deleted.  Null texts count as empty; null ids come last; repeated
rows are later copies of the first one; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import WORD, join_counted, land, let

RUN = 1


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Landed (rid, id, text, at: numbers of the lines with a word, h: their hashes)."""
    number = F.filter(F.transform(F.col("lines"), lambda s, i: F.when(s.rlike(WORD), i)), lambda i: i.isNotNull())
    trim = lambda s: F.regexp_replace(s, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _lines(F.col(text_col)).alias("lines"))
    df = df.select("id", "text", "lines", number.alias("at"))
    line = lambda i: trim(F.get(F.col("lines"), i))
    df = df.select("id", "text", "at", F.transform("at", lambda i: F.xxhash64(line(i))).alias("h"),
                   F.transform("at", lambda i: F.xxhash64(F.lit(2), line(i))).alias("h2"))
    return land(df.withColumn("rid", F.monotonically_increasing_id()), "lines")


def _fingerprints(rows: DataFrame, run: int) -> DataFrame:
    """(rid, id, pos, r1, r2): the first line and the 128-bit hash of every window of ``run`` lines."""
    if run == 1:
        prints = F.arrays_zip(F.col("h").alias("r1"), F.col("h2").alias("r2"))
        return rows.select("rid", "id", F.posexplode(prints).alias("pos", "w")).select("rid", "id", "pos", "w.*")
    over = lambda c, i: F.xxhash64(F.slice(F.col(c), i + 1, run))
    prints = F.transform(F.sequence(F.lit(0), F.size("h") - run),
                         lambda i: F.struct(i.cast("int").alias("pos"), over("h", i).alias("r1"), over("h2", i).alias("r2")))
    return rows.where(F.size("h") >= run).select("rid", "id", F.explode(prints).alias("w")).select("rid", "id", "w.*")


def removed_lines(rows: DataFrame, run: int = RUN) -> DataFrame:
    """(rid, gone: sorted numbers, among the lines with a word, of the lines to delete)."""
    prints, key = _fingerprints(rows, run), ["r1", "r2"]
    order = F.struct(F.col("id").isNull().alias("late"), "id", "rid", "pos")
    first = land(prints.groupBy(*key).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
                 .select(*key, F.col("first.rid").alias("f_rid"), F.col("first.pos").alias("f_pos"), "n"), "first-lines")
    later = join_counted(prints.select("rid", "pos", *key), first, key).where("rid <> f_rid or pos <> f_pos")
    at = F.collect_list("pos") if run == 1 else F.array_distinct(F.flatten(F.collect_list(F.sequence("pos", F.col("pos") + run - 1))))
    return later.groupBy("rid").agg(F.sort_array(at).alias("gone"))  # at most run numbers per line of one text


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN) -> DataFrame:
    """One row per row of ``docs``: id, n_lines (with a word), n_removed, runs (deleted runs as
    first-last line numbers of the text, from 0), kept (the text without the deleted lines)."""
    rows = _line_table(docs, id_col, text_col)
    df = rows.select("rid", "id", "text", "at").join(removed_lines(rows, run), "rid", "left")
    df = df.select("id", "text", F.size("at").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
                   F.transform("gone", lambda g: F.get(F.col("at"), g)).alias("out"), "gone")
    edge = lambda d: F.filter(F.transform("gone", lambda g, i: F.when(F.coalesce(F.get(F.col("gone"), i + d) != g + d, F.lit(True)), F.get(F.col("out"), i))),
                              lambda x: x.isNotNull())
    spans = F.array_join(F.zip_with(edge(-1), edge(1), lambda a, b: F.concat_ws("-", a.cast("string"), b.cast("string"))), ",")
    # the lines between one deleted line and the next: every line is copied once
    kept = let(_lines(F.col("text")), lambda lines: F.array_join(F.flatten(F.zip_with(
        F.concat(F.array(F.lit(-1)), F.col("out")), F.concat(F.col("out"), F.array(F.size(lines))),
        lambda a, b: F.slice(lines, a + 2, b - a - 1))), "\n"))
    return df.select(F.col("id").alias(id_col), "n_lines", "n_removed", F.coalesce(spans, F.lit("")).alias("runs"),
                     F.when(F.col("n_removed") > 0, kept).otherwise(F.coalesce("text", F.lit(""))).alias("kept"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    df = deduplicate(docs, id_col, text_col)
    return df.select(id_col, "n_lines", "n_removed", "runs", F.sha2("kept", 256).alias("kept_sha256"))
