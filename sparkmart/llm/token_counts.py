"""Token counts by offset-mapped attribution.

Every whole document is encoded once.  The bytes of its tokens end to end are the text, so the
running sum of token lengths gives each token's span, mapped to code points.  The spans are joined
with the document's sections (code-point intervals that may overlap or leave gaps) by binary search
in the sorted offsets, inside the task that encoded the document: nothing is exploded or shuffled.

A token that crosses a border is allocated by ``rule``:

* ``start``: to the sections that hold its first character;
* ``middle``: to the sections that hold the character at its middle;
* ``share``: to each section by the part of its characters that lie there (counts are fractions).

Sections that tile a text add up to its tokens under every rule.  Null texts count as empty; an empty
text has one empty section; null or repeated ids and extra columns do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import textkernel as K
from sparkmart.llm import tokenizer as T
from sparkmart.llm.common import ship_package

RULES = ("start", "middle", "share")


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines with their line end as sections [start, stop) in code points."""
    cuts = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 10) + 1
    if len(cuts) == 0 or cuts[-1] != len(text):
        cuts = np.append(cuts, len(text))
    return np.concatenate(([0], cuts[:-1])), cuts


def token_spans(text: str, enc: T.Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Code-point spans [start, stop) of the tokens; a character cut between tokens belongs to both."""
    raw = np.frombuffer(text.encode(), np.uint8)
    stop = np.cumsum(enc.lengths[enc.ids(text)])
    char = np.cumsum((raw & 0xC0) != 0x80) - 1  # the character that holds each byte
    start = np.concatenate(([0], stop[:-1])) if len(stop) else stop
    return char[start], char[stop - 1] + 1 if len(stop) else stop


def allocate(first: np.ndarray, last: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section [lo, hi), from token spans [first, last) in text order."""
    if rule == "share":
        size = np.maximum(last - first, 1)
        out = np.zeros(len(lo))
        for k, (a, b) in enumerate(zip(lo, hi)):
            i, j = np.searchsorted(last, a, "right"), np.searchsorted(first, b, "left")
            if i < j:
                out[k] = (np.maximum(np.minimum(last[i:j], b) - np.maximum(first[i:j], a), 0) / size[i:j]).sum()
        return out
    at = first if rule == "start" else (first + last - 1) // 2
    return np.maximum(np.searchsorted(at, hi) - np.searchsorted(at, lo), 0).astype(float)


def attribute(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sections: Column | None = None,
              rule: str = "start", vocabulary: str = T.VOCABULARY) -> DataFrame:
    """One row per document and section: id, section (number from 0), start, stop, n_tokens, doc_tokens.

    ``sections``: array<struct<start, stop>> in code points per document, clipped to the text;
    by default the lines of the text.  ``n_tokens`` is a double (whole unless the rule is ``share``).
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spark = docs.sparkSession
    ship_package(spark)
    vocab = spark.sparkContext.broadcast(T.load_vocabulary(vocabulary))
    own = sections is not None
    spans = F.transform(sections, lambda s: F.struct(s["start"].cast("long").alias("start"), s["stop"].cast("long").alias("stop"))) if own else F.lit(None).cast("array<struct<start:long,stop:long>>")

    def count(batches):
        enc = T.encoder(vocab)
        for batch in batches:
            for part in K.slices(batch, "text"):
                ids, number, starts, stops, tokens, totals = [], [], [], [], [], []
                for i, (key, text) in enumerate(zip(part.column("id").to_pylist(), part.column("text").to_pylist())):
                    first, last = token_spans(text, enc)
                    if own:
                        given = [(s["start"], s["stop"]) for s in (part.column("spans")[i].as_py() or []) if s and None not in s.values()]
                        lo, hi = np.clip(np.array(given, np.int64).reshape(-1, 2), 0, len(text)).T
                    else:
                        lo, hi = line_sections(text)
                    ids += [key] * len(lo)
                    totals += [len(first)] * len(lo)
                    number.append(np.arange(len(lo)))
                    starts.append(lo)
                    stops.append(hi)
                    tokens.append(allocate(first, last, lo, hi, rule))
                if ids:
                    cat = lambda x, t: pa.array(np.concatenate(x), t)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), cat(number, pa.int64()), cat(starts, pa.int64()), cat(stops, pa.int64()),
                         cat(tokens, pa.float64()), pa.array(totals, pa.int64())],
                        names=["id", "section", "start", "stop", "n_tokens", "doc_tokens"])

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), spans.alias("spans"))
    return (base.mapInArrow(count, "id long, section long, start long, stop long, n_tokens double, doc_tokens long")
            .withColumnRenamed("id", id_col))
