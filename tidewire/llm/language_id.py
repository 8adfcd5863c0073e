"""Language identification by hyperdimensional profiles.

Each symbol has a random +-1 vector. A letter trigram binds (multiplies) its letters' vectors, rotated by
their position; a text bundles (adds) its trigrams' vectors; a language's prototype bundles the unit
vectors of its texts. A text gets the language whose prototype has the greatest cosine with it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import chosen_by_hash

DIMENSIONS = 512
#: 0 separates words, 1-26 are a-z, the others are shared by all other letters, by code point.
BITS = 6
SYMBOLS = 1 << BITS
#: Labelled texts that prototypes are fitted on, about; chosen by a hash of id and text.
LEARN_ROWS = 20_000
#: Trigrams of a text from which on they are counted in one array, not by sorting.
MANY = 20_000


@lru_cache(1)
def symbol_table() -> np.ndarray:
    """Symbol of every code point; 0 for what is no letter."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()[0]
            out[c] = ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % (SYMBOLS - 27)
    return out


class Encoder:
    def __init__(self, seed: int = 5):
        base = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))
        self.rolled = [np.roll(base, k, axis=1) for k in (2, 1, 0)]
        self.table = symbol_table()
        # Filled where a trigram is met, so only those take memory.
        self.grams = np.zeros((SYMBOLS**3, DIMENSIONS), np.int8)
        self.known = np.zeros(SYMBOLS**3, bool)

    def bound(self, g: np.ndarray) -> np.ndarray:
        new = g[~self.known[g]]
        if len(new):
            self.grams[new] = self.rolled[0][new >> 2 * BITS] * self.rolled[1][(new >> BITS) & (SYMBOLS - 1)] * self.rolled[2][new & (SYMBOLS - 1)]
            self.known[new] = True
        return self.grams[g]

    def vector(self, text: str | None) -> np.ndarray | None:
        """The bundle of a text's trigrams, each weighted by the root of its count; None without a letter."""
        if not text:
            return None
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        s = self.table[codes].astype(np.int32)
        s = s[(s > 0) | (np.concatenate([[1], s[:-1]]) > 0)]  # one separator between words
        if not s.any():
            return None
        s = np.concatenate([[0], s, [0]])
        grams = (s[:-2] << 2 * BITS) | (s[1:-1] << BITS) | s[2:]
        if len(grams) < MANY:
            g, counts = np.unique(grams, return_counts=True)
        else:
            whole = np.bincount(grams, minlength=SYMBOLS**3)
            g = np.flatnonzero(whole)
            counts = whole[g]
        return np.sqrt(counts).astype(np.float32) @ self.bound(g).astype(np.float32)


def fit(docs: DataFrame, learn_rows: int = LEARN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and unit prototypes from rows (doc_id, text, lang); rows without lang or letters don't count."""
    docs = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    chosen = docs.where(chosen_by_hash(F.xxhash64("doc_id", "lang", F.length("text")), learn_rows, docs.count()))

    def bundle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sums = Encoder(), {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = encoder.vector(text)
                if v is not None and (size := np.linalg.norm(v)):
                    sums[lang] = sums.get(lang, 0) + v / size
        # Fixed-point numbers add up to the same sum in any order.
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([np.round(v * 1e6).astype(np.int64).tolist() for v in sums.values()], pa.list_(pa.int64()))], ["lang", "v"])

    parts = chosen.select("text", "lang").mapInArrow(bundle, "lang string, v array<long>")
    sums: dict[str, np.ndarray] = {}
    for r in parts.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x")).collect():
        sums.setdefault(r.lang, np.zeros(DIMENSIONS))[r.k] = r.x
    langs = sorted(sums)
    protos = np.array([sums[k] for k in langs]).reshape(-1, DIMENSIONS)
    # What all languages have in common tells nothing: it is taken out of every prototype.
    if len(langs) > 1:
        unit = protos / np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-9)
        protos = unit - 0.9 * unit.mean(axis=0)
    return langs, (protos / np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def identify(docs: DataFrame, learn: Column, *, keep: list[str] | None = None, learn_rows: int = LEARN_ROWS) -> DataFrame:
    """Columns keep (doc_id) with lang_pred and score for each row of docs (doc_id, text, lang).

    learn: condition on doc_id for the rows that prototypes may be fitted on. lang_pred is und with score 0 for null
    texts and those without a letter, or if nothing could be learned; ties go to the first language by name.
    score: (1 + cosine) / 2. Texts of any length are read whole, repeated rows are judged alike. Columns of docs called lang_pred or score are replaced; empty tables give no rows.
    """
    keep = [c for c in (keep or ["doc_id"]) if c not in ("lang_pred", "score")]
    spark = docs.sparkSession
    langs, protos = fit(docs.where(learn), learn_rows)
    model = spark.sparkContext.broadcast((langs, protos))

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        langs, protos = model.value
        for batch in batches:
            names, scores = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                v = encoder.vector(text)
                if v is None or not langs or not v.any():
                    names.append("und")
                    scores.append(0.0)
                    continue
                cosine = protos @ v / np.linalg.norm(v)
                best = int(cosine.argmax())
                names.append(langs[best])
                scores.append(float(np.clip((1 + cosine[best]) / 2, 0, 1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(batch.num_columns - 1)), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*keep, "lang_pred", "score"])

    given = docs.select(*keep, F.col("text").alias("text_to_read"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return given.mapInArrow(predict, f"{kinds}, lang_pred string, score double")
