"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time t in 0..1.  Its integral, scaled to the source's
target, is the source's cumulative word demand D(t).  The documents of a source, in a seeded order,
supply words one after the other, once more from the start when a pass is used up; the copy that
begins at cumulative word c is needed when D(t) = c, so its training position is the inverse
t = D^-1(c).  Range-sorting all copies by position gives the curriculum.

Targets: sources sorted by code point (null last) weigh ``WEIGHTS`` in turn and share
``BUDGET`` times all words; no target is above ``MAX_PASSES`` times its source's words, and what is cut
off goes to the others by weight until none is above.  That fixed point has the closed form
min(cap, level * weight) with one level, found on the table of sources.

Orders and prefix sums never gather a source: the order key is a hash, cut into ``buckets`` ranges;
running sums inside (source, bucket) start from the sums of the buckets before.  DataFrame
functions only.  Null texts have size 0, a null source is a source, ids may be null or repeated (the
order key takes the text along); size-0 documents are never taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import free_prefix, land, own_columns, words_of

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MAX_PASSES = 2
SEED = "mix-1"
ROWS_PER_BUCKET = 2048
#: Slope of each weight class's schedule w(t) = 1 + slope * (2t - 1): heavy sources early, light ones late.
SLOPES = (-0.5, 0.0, 0.5)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, rank, weight, target) of a frame (source, source_size) with one row per source."""
    everything = Window.orderBy(F.col("source").isNull(), "source")  # one row per source
    ranked = sizes.withColumn("rank", F.row_number().over(everything) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    # water level: sources by cap / weight; the first k are cut if the rest can then stay below their caps
    cap = F.col("source_size") * passes
    by = Window.orderBy(cap / F.col("weight"), "rank")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    level = ((F.sum("source_size").over(total) * F.lit(budget) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
             / (F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    leveled = ranked.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= cap)
    common = F.min(F.when(F.col("fits"), F.struct(cap / F.col("weight"), "rank", "level"))).over(total)["level"]
    return leveled.select("source", "source_size", "rank", "weight",
                          F.round(F.least(cap.cast("double"), F.coalesce(common * F.col("weight"), cap.cast("double"))), 6).alias("target"))


def position(words: Column, target: Column, slope: Column) -> Column:
    """Training time at which a source's demand reaches ``words``: the inverse of target * (t + slope * (t*t - t))."""
    f = F.try_divide(words.cast("double"), target)
    b = 1 - slope
    return F.when(slope == 0, f).otherwise(2 * f / (b + F.sqrt(F.greatest(b * b + 4 * slope * f, F.lit(0.0)))))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED,
         landed: bool = False) -> tuple[DataFrame, str]:
    """``docs`` plus working columns under a fresh prefix (returned): size, source_size, target, rank, start
    (words of the source before this document), passes ``taken1`` and ``taken2`` (words), ``at1`` and ``at2``.  ``landed``
    writes the bucket sums first: their size is then known before the documents, text included, are joined
    with them, which a small table spares a shuffle."""
    p = free_prefix(docs, "mix_")
    own, col = own_columns(docs), lambda c: F.col(f"`{p}{c}`")
    n_rows = docs.count()
    buckets = max(1, -(-n_rows // ROWS_PER_BUCKET))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.md5(text)))
    keyed = docs.select(*own, F.size(words_of(text)).cast("long").alias(f"{p}size"),
                        F.conv(F.substring(key, 1, 12), 16, 10).cast("long").alias(f"{p}key"))
    keyed = keyed.select(*own, col("size"), col("key"), F.floor(col("key") * buckets / F.lit(1 << 48)).cast("long").alias(f"{p}bucket"))
    src = F.col(f"`{source_col}`")
    per = keyed.groupBy(src.alias("source"), col("bucket").alias("bucket")).agg(F.sum(col("size")).alias("words"))
    goal = targets(per.groupBy("source").agg(F.sum("words").alias("source_size")))
    up = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    start = per.withColumn("base", F.coalesce(F.sum("words").over(up), F.lit(0)))
    rename = lambda df: df.select(*[F.col(c).alias(f"{p}{c}") for c in df.columns])
    table = rename(start.join(goal, start.source.eqNullSafe(goal.source)).select(
        start.source.alias("s"), start.bucket.alias("b"), "base", "source_size", "target", "rank"))
    table = land(table, "bucket-sums") if landed else table
    inside = Window.partitionBy(src, col("bucket")).orderBy(col("key"), F.col(f"`{id_col}`"), col("size")).rowsBetween(Window.unboundedPreceding, -1)
    df = keyed.withColumn(f"{p}before", F.coalesce(F.sum(col("size")).over(inside), F.lit(0)))
    df = df.join(table, src.eqNullSafe(col("s")) & (col("bucket") == col("b"))).withColumn(f"{p}start", col("base") + col("before"))
    whole = F.floor(col("target") + 0.5)
    take = lambda done: F.greatest(F.least(whole - done, col("size")), F.lit(0)).cast("long")
    slope = F.element_at(F.array(*[F.lit(s) for s in SLOPES]), (col("rank") % len(SLOPES) + 1).cast("int"))
    again = col("source_size") + col("start")
    return df.select(*own, col("size"), col("source_size"), col("target"), col("start"), col("rank"),
                     take(col("start")).alias(f"{p}taken1"), take(again).alias(f"{p}taken2"),
                     position(col("start"), col("target"), slope).alias(f"{p}at1"),
                     position(again, col("target"), slope).alias(f"{p}at2")), p


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words, repeats counted; the document at the
    target's border gives its first words only), position (of its first copy; null if not taken)."""
    df, p = plan(docs.select(F.col(id_col), F.col(text_col), F.col(source_col)), id_col, text_col, source_col)
    col = lambda c: F.col(f"{p}{c}")
    return df.select(F.col(id_col), col("size").alias("size"), col("source_size").alias("source_size"), col("target").alias("target"),
                     (col("taken1") + col("taken2")).alias("taken"),
                     F.when(col("taken1") > 0, F.round(col("at1"), 9)).alias("position"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", sort: bool = True) -> DataFrame:
    """The mixed documents in training order: all columns of ``docs``, whole texts, one row per copy,
    range-sorted by position.  The document at the border of a target counts if half its words or more
    fit, so a source is off its target by at most half a document."""
    df, p = plan(docs, id_col, text_col, source_col, landed=True)
    own, col = own_columns(docs), lambda c: F.col(f"`{p}{c}`")
    copies = F.filter(F.array(F.when((col("taken1") * 2 >= col("size")) & (col("size") > 0), col("at1")),
                              F.when((col("taken2") * 2 >= col("size")) & (col("size") > 0), col("at2"))), lambda x: x.isNotNull())
    df = df.select(*own, col("start"), col("rank"), F.explode(copies).alias(f"{p}position"))
    if sort:
        by = [col("position"), col("start"), col("rank")]  # sources all start at position 0
        df = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return df.select(*own)
