"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed (a 128-bit digest of its whole text).  The *ledger*,
a table in the shared folder, holds for each blob the rule versions already run on it and what they
found.  A scan takes the distinct blobs, drops the (blob, rule version) pairs that the ledger has,
runs the remaining rules on the remaining blobs, appends the result (findings or none) and joins the
findings of the current rule versions back to all paths.  A second scan of the same corpus reads no
text beyond hashing it; a new rule version rescans with that rule alone.

DataFrame functions only.  A match's place comes from the pieces between the matches: the running
sum of piece and match lengths, in code points.  The base rules are found leftmost and
non-overlapping per kind, failing ones dropped after matching; the rules of ``EXTRA`` add spans.
Null texts count as empty; paths may be null or repeated; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import digest, land, let


@dataclass(frozen=True)
class Rule:
    """``value`` is the group whose length must reach ``least`` after matching (0: the whole match)."""
    kind: str
    pattern: str
    least: int = 0
    value: int = 0
    version: int = 1
    hint: str = ""  # cheap pattern without which the rule cannot match

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Rules of the contract (fixed patterns).  Runs of one class are matched whole, so the least length
#: of ``access`` and ``hex`` can stand in the pattern.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2,
         hint=r"(?i)passw|secret|token|api_?key"),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + EXTRA
_SPANS = "array<struct<start:int,kind_no:int,stop:int,kind:string>>"
LEDGER = f"h1 long, h2 long, rules array<string>, spans {_SPANS}"


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """All accepted matches of a rule as structs (start, kind_no, stop, kind), stop exclusive."""
    pattern = F.lit(rule.pattern)
    found = F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"),
                     (F.regexp_extract_all(text, pattern, F.lit(rule.value)) if rule.value else F.array().cast("array<string>")).alias("v"),
                     F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p)).alias("gap"))

    def place(f):
        size = F.transform(f["m"], lambda m: F.length(m))

        def spans(n):
            start = lambda i: F.aggregate(F.slice(f["gap"], 1, i + 1), F.lit(0), lambda a, x: a + x) + F.aggregate(
                F.slice(n, 1, i), F.lit(0), lambda a, x: a + x)
            keep = F.transform(f["m"], lambda m, i: F.when((F.length(F.get(f["v"], i)) >= rule.least) if rule.value else F.lit(True), i))
            return F.transform(F.filter(keep, lambda i: i.isNotNull()), lambda i: let(start(i), lambda s: F.struct(
                s.alias("start"), F.lit(number).alias("kind_no"), (s + F.get(n, i)).alias("stop"), F.lit(rule.kind).alias("kind"))))

        return let(size, spans)

    return let(found, place)


def _scan(text: Column, todo: Column, rules: tuple[Rule, ...]) -> Column:
    """Spans of the rules named in ``todo``; texts that no rule can match are passed over by cheap tests."""
    empty = F.array().cast(_SPANS)
    return F.flatten(F.array(*[F.when(F.array_contains(todo, r.key) & text.rlike(r.hint or r.pattern), _spans(text, r, i).cast(_SPANS)).otherwise(empty)
                               for i, r in enumerate(rules)]))


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger, empty before the first scan."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(LEDGER).parquet(folder) if fs.exists(path) else spark.createDataFrame([], LEDGER)


def unseen(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Distinct blobs (h1, h2, text) with ``todo``, the rule versions not yet run on them."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    seen = ledger.groupBy("h1", "h2").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    once = blobs.groupBy("h1", "h2").agg(F.first("text").alias("text"))  # equal texts; map-side partials collapse copies
    return (once.join(seen, ["h1", "h2"], "left").withColumn("todo", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))))
            .where(F.size("todo") > 0).select("h1", "h2", "text", "todo"))


def scan(docs: DataFrame, ledger: str, path_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to date and return one row per row of ``docs``: path, ``spans`` (sorted
    structs start, kind_no, stop, kind over all rules)."""
    spark = docs.sparkSession
    h1, h2 = digest(F.col(text_col))
    blobs = docs.select(h1.alias("h1"), h2.alias("h2"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    (unseen(blobs, read_ledger(spark, ledger), rules)
     .select("h1", "h2", F.col("todo").alias("rules"), _scan(F.col("text"), F.col("todo"), rules).alias("spans"))
     .write.mode("append").parquet(ledger))

    current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.key).alias("key"), F.lit(i).alias("no")) for i, r in enumerate(rules)])
    # one row per finding of a current rule version; blobs without findings need no row
    found = (read_ledger(spark, ledger).where(F.size("spans") > 0).select("h1", "h2", "rules", F.explode("spans").alias("s"))
             .select("h1", "h2", "s", F.get(F.filter(current, lambda c: c["kind"] == F.col("s.kind")), F.lit(0)).alias("c"), "rules")
             .where("c is not null and array_contains(rules, c.key)")
             .groupBy("h1", "h2").agg(F.sort_array(F.collect_set(F.struct(F.col("s.start").alias("start"), F.col("c.no").alias("kind_no"),
                                                                         F.col("s.stop").alias("stop"), F.col("s.kind").alias("kind")))).alias("spans")))
    found = land(found, "findings")
    paths = docs.select(F.col(path_col), h1.alias("h1"), h2.alias("h2"))
    return (paths.join(found, ["h1", "h2"], "left")
            .select(F.col(path_col), F.coalesce("spans", F.array().cast(_SPANS)).alias("spans")))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def report(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined)."""
    base = F.filter("spans", lambda s: s["kind_no"] < len(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return (scan(docs, ledger, id_col, text_col)
            .select(id_col, *[count(r.kind) for r in BASE], F.sha2(_text(base), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans")))
