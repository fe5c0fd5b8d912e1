"""Language identification with hyperdimensional profiles.

Every letter (of any script) has a random vector of +1/-1 of its own; an n-gram's vector binds its letters' vectors by
elementwise product after rotating them by their place in the n-gram; a text's vector bundles (adds)
the vectors of all its trigrams; a language's prototype bundles those of all its training texts.
The prediction is the language whose prototype has the largest cosine with the text's vector; the
score is that cosine, cut to 0..1.

Letters are case-folded; runs of other characters act as one border symbol.  Learning sends one
vector per language and task; only the prototypes (languages x ``DIM`` numbers) reach the driver.
A text that is null or has no letter is ``und`` with score 0, as is every text when nothing can be
learned.  Ids may be null or repeated; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import textkernel as K
from sparkmart.llm.common import ship_package

DIM = 1024
N = 3
NEAR = 0x250  # letters below have their vectors in a table, those of others are drawn when met
_SHIFT, _POINT = 21, (1 << 21) - 1  # a code point fills 21 bits of a trigram's code
_TABLES: dict = {}


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """The random +1/-1 vectors of code points, one for each letter: the bits of ``DIM / 64`` hashes of
    the code point, so every task draws the same.  0 is the border."""
    seeds = np.asarray(points).astype(K.U64)[:, None] * K.U64(DIM // 64) + np.arange(DIM // 64, dtype=K.U64)
    words = K.mix((seeds + K.U64(1)) * K.U64(0x9E3779B97F4A7C15))
    return np.unpackbits(words.astype("<u8").view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def _tables():
    if not _TABLES:
        near = letter_vectors(np.arange(NEAR))
        _TABLES["places"] = [np.roll(near, N - 1 - k, axis=1) for k in range(N)]
        _TABLES["points"] = np.array([c if chr(c).isalpha() else 0 for c in range(NEAR)], dtype=np.int64)
    return _TABLES


def symbols(text: str) -> np.ndarray:
    """Code points of a text's letters, runs of other characters as one 0, with a 0 at both ends."""
    cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    out = _tables()["points"][np.minimum(cps, NEAR - 1)]
    if len(cps) and cps.max() >= NEAR:
        far = np.flatnonzero(cps >= NEAR)
        kinds, at = np.unique(cps[far], return_inverse=True)
        out[far] = np.array([int(c) if chr(c).isalpha() else 0 for c in kinds], np.int64)[at]
    out = np.concatenate(([0], out, [0]))
    return out[np.concatenate(([True], (out[1:] != 0) | (out[:-1] != 0)))]


def trigrams(text: str) -> np.ndarray:
    s = symbols(text)
    if len(s) < N or not s.any():
        return np.zeros(0, np.int64)
    return (s[:-2] << 2 * _SHIFT) | (s[1:-1] << _SHIFT) | s[2:]


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bound vectors of trigram codes, as float32 rows."""
    letters = [codes >> 2 * _SHIFT, codes >> _SHIFT & _POINT, codes & _POINT]
    places = _tables()["places"]
    if len(codes) and max(int(x.max()) for x in letters) >= NEAR:
        kinds, at = np.unique(np.concatenate(letters), return_inverse=True)
        drawn, letters = letter_vectors(kinds), np.split(at, N)
        places = [np.roll(drawn, N - 1 - k, axis=1) for k in range(N)]
    return (places[0][letters[0]] * places[1][letters[1]] * places[2][letters[2]]).astype(np.float32)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Unit prototype of every non-null language of ``docs`` (all rows are training rows)."""
    def bundle(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in K.slices(batch, "text"):
                by: dict[str, list] = {}
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                    by.setdefault(lang, []).append(trigrams(text))
                for lang, grams in by.items():
                    u, n = np.unique(np.concatenate(grams), return_counts=True)
                    if len(u):
                        for i in range(0, len(u), 4096):
                            step = n[i:i + 4096].astype(np.float32) @ gram_vectors(u[i:i + 4096])
                            total[lang] = total.get(lang, np.zeros(DIM)) + step
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                             names=["lang", "vector"])

    def add(key, pdf):
        import pandas as pd
        rows = sorted(pdf["vector"])  # a fixed order, so that reruns agree to the last bit
        return pd.DataFrame({"lang": [key[0]], "vector": [sum(np.frombuffer(v) for v in rows).tobytes()]})

    schema = "lang string, vector binary"
    rows = (docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
            .mapInArrow(bundle, schema).groupBy("lang").applyInPandas(add, schema).collect())
    vectors = {r["lang"]: np.frombuffer(r["vector"]) for r in rows}
    return {k: (v / np.linalg.norm(v)).astype(np.float32) for k, v in sorted(vectors.items()) if np.linalg.norm(v) > 0}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` plus lang_pred and score."""
    spark = docs.sparkSession
    names = list(prototypes)
    known = spark.sparkContext.broadcast(np.array([prototypes[k] for k in names], np.float32).reshape(-1, DIM))
    base = docs.select(*(keep or []), F.col(text_col).alias("_text_to_score"))
    kept = base.columns[:-1]

    def score(batches):
        protos = known.value.T
        for batch in batches:
            for part in K.slices(batch, "_text_to_score"):
                langs, scores = [], []
                grams = [trigrams(t or "") for t in part.column("_text_to_score").to_pylist()]
                every = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.int64)
                table = gram_vectors(every) if len(every) <= 20_000 else None
                for g in grams:
                    if len(g) == 0 or not names:
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    u, n = np.unique(g, return_counts=True)
                    vector = n.astype(np.float32) @ (table[np.searchsorted(every, u)] if table is not None else gram_vectors(u))
                    cosine = vector @ protos / max(float(np.linalg.norm(vector)), 1e-9)
                    best = int(cosine.argmax())
                    langs.append(names[best])
                    scores.append(float(min(max(cosine[best], 0.0), 1.0)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                                 names=[*kept, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    schema = StructType([*base.schema.fields[:-1], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return base.mapInArrow(score, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from rows whose crc32(id) mod 4 is not 2 and predict every row: id, held_out, lang_pred, score."""
    ship_package(docs.sparkSession)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
    prototypes = learn(docs.where(~held), text_col, lang_col)
    return predict(docs, prototypes, text_col, [F.col(id_col), held.alias("held_out")])
