"""Exact top-k search by exhaustive term-at-a-time accumulation.

A component of a vector is a term with an integer weight. Rows are read in blocks; in a block each term's
postings (rows and weights) are scattered, weighted by the queries that hold the term, into a dense score
array of queries x rows. Partition selection keeps each query's best of a block; blocks and tasks are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import stored, written

#: Queries, and their weights, of one pass over the rows (they are broadcast: 16 MB), and the score array's sides.
QUERIES_A_PASS, WEIGHTS_A_PASS = 32_768, 1 << 21
QUERY_BLOCK, ROW_BLOCK = 256, 4_096
#: Vectors with greater weights are scored in whole numbers of any size, one by one.
LARGEST = 2.0**24
NONE = -(2**63) + 1


def weights(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, list[int]]]:
    """Of the vectors that are whole (not null, no null or non-finite component): their positions, a matrix of integer weights, their
    lengths, and by place in these the weights of vectors that are too large for the matrix, whose rows are zero there."""
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    values = vectors.values.to_numpy(zero_copy_only=False)  # nulls are nan
    at = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    keep = np.flatnonzero((at[offsets[1:]] == at[offsets[:-1]]) & vectors.is_valid().to_numpy(zero_copy_only=False))
    starts, sizes = offsets[keep], offsets[keep + 1] - offsets[keep]
    out = np.zeros((len(keep), int(sizes.max(initial=0))), np.int64)
    if not out.size:
        return keep, out, sizes, {}
    row, column = np.repeat(np.arange(len(keep)), sizes), np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    picked = values[np.repeat(starts, sizes) + column]
    with np.errstate(over="ignore"):
        w = np.floor(scale * picked)
    # So that sums over a vector's length stay exact in 64 bits.
    over = np.abs(w) > np.minimum(LARGEST, np.floor(np.sqrt(2.0**62 / np.maximum(sizes, 1))))[row]
    large = {int(r): [math.floor(Fraction(float(x)) * Fraction(scale)) for x in picked[row == r]] for r in np.unique(row[over])}
    fits = ~np.isin(row, list(large))
    out[row[fits], column[fits]] = w[fits].astype(np.int64)
    return keep, out, sizes, large


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, large: dict[int, list[int]] | None = None):
        """large: weights of queries whose rows of q don't hold them."""
        self.ids, self.q, self.k, self.large = ids, q, k, large or {}
        self.score = np.full((len(q), k), NONE)
        self.id = np.full((len(q), k), np.iinfo(np.int64).max)

    def add(self, ids: np.ndarray, w: np.ndarray, large: dict[int, list[int]]) -> None:
        """Rows with their weights; large: weights of rows that w doesn't hold."""
        plain = np.setdiff1d(np.arange(len(w)), list(large))
        for lo in range(0, len(self.q), QUERY_BLOCK):
            at = slice(lo, lo + QUERY_BLOCK)
            if len(plain):
                self._block(at, ids[plain], w[plain])
            if large:
                self._exactly(at, ids, large)
        for own, weights in self.large.items():
            n = min(len(weights), w.shape[1])
            scores = w[plain, :n].astype(object) @ np.array(weights[:n], object) if n else np.zeros(len(plain), object)
            more = [sum(a * b for a, b in zip(weights, row, strict=False)) for row in large.values()]
            self._offer(own, bounded([*scores, *more]), np.concatenate([ids[plain], ids[list(large)]]))

    def _exactly(self, at: slice, ids: np.ndarray, large: dict[int, list[int]]) -> None:
        """Large rows against the queries of a block, in Python's whole numbers."""
        q = self.q[at].astype(object)
        for k, row in large.items():
            n = min(len(row), q.shape[1])
            scores = bounded(q[:, :n] @ np.array(row[:n], object)) if n else np.zeros(len(q), np.int64)
            for own, s in zip(range(at.start, at.start + len(q)), scores, strict=True):
                if own not in self.large:
                    self._offer(own, np.array([s]), ids[k : k + 1])

    def _offer(self, own: int, scores: np.ndarray, ids: np.ndarray) -> None:
        hit = np.flatnonzero((scores >= self.score[own, -1]) & (ids != self.ids[own]))
        if len(hit) > 4 * self.k:
            cut = np.partition(scores[hit], len(hit) - self.k)[len(hit) - self.k]
            hit = hit[scores[hit] >= cut]
        if len(hit):
            s, i = np.concatenate([self.score[own], scores[hit]]), np.concatenate([self.id[own], ids[hit]])
            order = np.lexsort((i, -s))[: self.k]
            self.score[own], self.id[own] = s[order], i[order]

    def _block(self, at: slice, ids: np.ndarray, w: np.ndarray) -> None:
        q = self.q[at]
        n = min(q.shape[1], w.shape[1])  # what one of two vectors lacks is zero
        q, w = q[:, :n], w[:, :n]
        small = int(np.abs(q).max(initial=0)) * int(np.abs(w).max(initial=0)) * max(1, n) < 2**31
        kind = np.int32 if small else np.int64
        score = np.zeros((len(q), len(w)), kind)
        q, w = q.astype(kind), w.T.astype(kind)
        for term in range(n):
            holds, posts = np.flatnonzero(q[:, term]), np.flatnonzero(w[term])
            if 2 * len(holds) > len(q) and 2 * len(posts) > w.shape[1]:
                score += q[:, term, None] * w[term]
            elif len(holds) and len(posts):
                score[np.ix_(holds, posts)] += q[holds, term, None] * w[term, posts]
        for row, own in zip(score, range(at.start, at.start + len(q)), strict=True):
            if own not in self.large:
                self._offer(own, row, ids)


#: What a pass gives: the best of each task for each of its queries.
FOUND = "key long, query_id long, vec_id long, score long"


def bounded(scores: Iterable[int]) -> np.ndarray:
    """As longs; what is beyond them at their bounds."""
    return np.array([min(max(int(s), NONE + 1), 2**63 - 1) for s in scores], np.int64)


def search(rows: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query row.

    rows: vec_id long, embedding array<float or double>; is_query: condition on vec_id. Each component is
    floor(scale * component), of any size; a score beyond a long is the long's bound. Rows with a null id, a null vector, or a null
    or non-finite component take no part; of two vectors the shorter one lacks nothing but zeros. Ties go to the smaller vec_id. Further
    columns aren't read. A row is no candidate of queries with its id; ids on several rows are several candidates and queries
    give one ranking for each distinct (id, vector). Fewer candidates give fewer ranks; empty tables give no rows.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    asked = rows.where(is_query).distinct()
    count, size = asked.agg(F.count("*"), F.sum(F.size("embedding"))).first()
    passes = max(1, -(-count // QUERIES_A_PASS), -(-(size or 0) // WEIGHTS_A_PASS))
    spark, found = rows.sparkSession, None
    if passes > 1:
        asked = written(asked, "queries")
    paths: list[str] = []
    for p in range(passes):
        part = asked.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(passes)) == p).select(F.xxhash64("vec_id", "embedding").alias("key"), "vec_id", "embedding")
        got = part.toArrow()
        keep, w, _, large = weights(got.column("embedding").combine_chunks(), scale)
        queries = spark.sparkContext.broadcast((got.column("key").to_numpy()[keep], got.column("vec_id").to_numpy()[keep], w, large))

        def scan(batches: Iterable[pa.RecordBatch], queries=queries) -> Iterator[pa.RecordBatch]:
            keys, ids, q, large = queries.value
            best = Best(ids, q, k, large)
            for batch in batches:
                for lo in range(0, batch.num_rows, ROW_BLOCK):
                    block = batch.slice(lo, ROW_BLOCK)
                    keep, w, _, odd = weights(block.column(1), scale)
                    best.add(block.column(0).to_numpy()[keep], w, odd)
            found = best.score > NONE
            at = np.repeat(np.arange(len(ids)), found.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(ids[at]), pa.array(best.id[found]), pa.array(best.score[found])], ["key", "query_id", "vec_id", "score"])

        found = rows.mapInArrow(scan, FOUND)
        if passes > 1:
            # Written before the next pass, so that no more than one pass's queries are held anywhere.
            paths.append(stored(found, "top"))
            queries.destroy()
    if paths:
        found = spark.read.schema(FOUND).parquet(*paths)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
