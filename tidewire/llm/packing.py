"""Lexical retrieval packing: sharded BM25 indexes fill each window with neighbours of its seed.

Documents are tokenised once, where they are read. Document frequencies and the mean length are taken over all
documents. A weighted min-hash by these frequencies places documents that share rare terms next to each other, wherever
they lie in the file; shards of bounded size are cut from that order. In a shard, whole
windows of long documents stand alone; their tails and the short documents go into an inverted index with BM25
weights. The first unused one seeds a window, its best-scored unused neighbours fill it greedily, and
the last is cut to fit. What is left at a shard's end is cut into powers of two, so nothing is padded.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import written

WINDOW = 2048
#: A shard closes at so many documents or tokens.
SHARD_DOCS, SHARD_TOKENS = 512, 1_000_000
#: Bytes of tokens of a task, on average: documents are dealt out by number, and long ones lie close together in the order.
TASK_BYTES = 8 << 20
END = 1
#: The tokenizer's special token; its string in a text is that one id.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
K1, B = 1.2, 0.75


#: What is white space to the tokenizer's pattern, by its kinds (Unicode's White_Space), and a run of it.
SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
RUN = re.compile(f"[{SPACES}]{{2,}}")
#: The end of the tokenizer's pattern, which looks ahead for what stands behind a run of white space, and what is there instead.
AHEAD, WHOLE = r"|\s+(?!\S)|\s+", r"|\s+"


class Tokens:
    """Byte-level BPE ids as packed unsigned 16-bit numbers.

    The pattern's only lookahead leaves the last character of a run of white space to what follows. Texts are cut there first, so that a pattern without
    one finds the same matches, in less time: no match goes on behind another character into white space.
    """

    def __init__(self, vocabulary: str | None = None):
        import public_tokenizers
        import tiktoken

        path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
        if not public_tokenizers.PATTERN.endswith(AHEAD):
            raise ValueError("the tokenizer's pattern doesn't end as it should")
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        self.encoding = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN.removesuffix(AHEAD) + WHOLE, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})
        self.special = np.array([SPECIAL_ID], np.uint16).tobytes()

    def ids(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.uint16).tobytes()

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        if SPECIAL in text:
            return self.special.join(map(self.packed, text.split(SPECIAL)))
        kinds = [c for c in SPACES if c in text]
        if not any(a + b in text for a in kinds for b in kinds):
            return self.ids(text)
        out, at = [], 0
        for run in RUN.finditer(text):
            # A run at the end is one match.
            end = run.end() - (run.end() < len(text))
            out += [self.ids(text[at : run.start()]), self.ids(text[run.start() : end])]
            at = end
        return b"".join((*out, self.ids(text[at:])))


class Distinct:
    """Distinct terms of a document without sorting: a term counts at the last of its places."""

    def __init__(self) -> None:
        self.last = np.zeros(1 << 16, np.int32)

    def terms(self, ids: np.ndarray) -> np.ndarray:
        places = np.arange(len(ids), dtype=np.int32)
        self.last[ids] = places
        return ids[self.last[ids] == places]

    def counted(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct terms and how often they stand in the document."""
        terms = self.terms(ids)
        self.last[terms] = np.arange(len(terms), dtype=np.int32)
        return terms, np.bincount(self.last[ids], minlength=len(terms))


class Shard:
    """The token ids of some documents, whose remainders are packed by retrieval."""

    def __init__(self, docs: list[np.ndarray], df: np.ndarray, total: int, mean: float):
        self.docs = docs
        self.left = [len(d) % WINDOW for d in docs]
        terms, weights, owner = [], [], []
        distinct = Distinct()
        self.query: list[tuple[np.ndarray, np.ndarray]] = []
        for k, d in enumerate(docs):
            t, c = distinct.counted(d)
            idf = np.log1p((total - df[t] + 0.5) / (df[t] + 0.5))
            self.query.append(t)
            terms.append(t)
            weights.append(idf * c * (K1 + 1) / (c + K1 * (1 - B + B * len(d) / mean)))
            owner.append(np.full(len(t), k, np.int32))
        flat = np.concatenate(terms)
        order = np.argsort(flat, kind="stable")
        # In the types that np.bincount counts in.
        self.owner = np.concatenate(owner)[order].astype(np.intp)
        self.weight = np.concatenate(weights)[order].astype(np.float32).astype(np.float64)
        self.first = np.searchsorted(flat[order], np.arange(int(flat.max()) + 2))

    def neighbours(self, k: int) -> np.ndarray:
        """All documents of the shard, the best match with document k first; ties by position."""
        t = self.query[k].astype(np.int64)
        lo, n = self.first[t], self.first[t + 1] - self.first[t]
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
        score = np.bincount(self.owner[at], self.weight[at], len(self.docs))
        return np.argsort(-score, kind="stable")

    def pieces(self) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, start, length, sequence, offset)"""
        sequence = 0
        rest: list[int] = []
        start = [0] * len(self.docs)
        for k, d in enumerate(self.docs):
            for _ in range(len(d) // WINDOW):
                yield k, start[k], WINDOW, sequence, 0
                start[k] += WINDOW
                sequence += 1
            if self.left[k]:
                rest.append(k)
        unused = dict.fromkeys(rest)
        room = sum(self.left)
        while room:
            size = WINDOW if room >= WINDOW else 1 << (room.bit_length() - 1)
            offset, seed = 0, next(iter(unused))
            ranked = None
            while offset < size:
                if offset == 0:
                    k = seed
                else:
                    ranked = iter([x for x in self.neighbours(seed).tolist() if x in unused]) if ranked is None else ranked
                    k = next(ranked)
                n = min(self.left[k], size - offset)
                yield k, start[k], n, sequence, offset
                start[k] += n
                self.left[k] -= n
                offset += n
                if not self.left[k]:
                    del unused[k]
            room -= size
            sequence += 1


def priorities(df: np.ndarray, total: int) -> np.ndarray:
    """A random rank (from 1) of each term, low for rare shared ones: the least rank of a document is a min-hash weighted by squared
    inverse document frequency. Terms of one document rank last."""
    weight = np.log1p((total - df + 0.5) / (df + 0.5)) ** 2
    drawn = np.random.default_rng(17).exponential(size=len(df)) / np.maximum(weight, 1e-9)
    drawn[df < 2] = np.inf
    ranks = np.empty(len(df), np.int64)
    ranks[np.argsort(drawn, kind="stable")] = np.arange(len(df))
    return np.minimum(ranks + 1, 0xFFFF).astype(np.uint16)


def place(ranks: np.ndarray) -> int:
    """The three least ranks, each once, as one number that sorts by the first, then the next."""
    low = []
    while len(low) < 3:
        low.append(int(ranks.min(initial=0xFFFF)))
        ranks = ranks[ranks > low[-1]]
    return low[0] << 32 | low[1] << 16 | low[2]


def packed(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for each piece.

    docs: doc_id, text. Every document is its ids and then END; null and empty texts are END alone, the special token's string is its
    id. Rows with equal or null ids, and repeated rows, are packed row by row. Texts of any length are packed whole: their full
    windows alone, the rest like a short text. Neighbours of equal scores go by their place in the shard. Further columns aren't read;
    an empty table gives no rows. vocabulary: path of the ranks on every executor.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def tokenised(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(vocabulary)
        row = TaskContext.get().partitionId() << 40
        end = np.array([END], np.uint16).tobytes()
        seen, distinct = np.zeros(1 << 16, np.int64), Distinct()

        def out(ids: list, rows: list[bytes], sizes: list[int], terms: list, counts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + len(ids))), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(rows, pa.binary()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], ["row", "id", "size", "tokens", "terms", "seen"])

        for batch in batches:
            rows = [tokens.packed(text) + end for text in batch.column(1).to_pylist()]
            for r in rows:
                seen[distinct.terms(np.frombuffer(r, np.uint16))] += 1
            yield out(batch.column(0).to_pylist(), rows, [len(r) // 2 for r in rows], [None] * len(rows), [None] * len(rows))
            row += len(rows)
        # The last row of a task holds no document but its document frequencies.
        used = np.flatnonzero(seen)
        if len(used):
            yield out([None], [b""], [0], [used.tolist()], [seen[used].tolist()])

    kept = written(docs.mapInArrow(tokenised, "row long, id long, size long, tokens binary, terms array<int>, seen array<long>"), "tokens")
    counts = kept.where("size = 0").select(F.explode(F.arrays_zip("terms", "seen").alias("x")).alias("x")).groupBy("x.terms").agg(F.sum("x.seen").alias("n"))
    df = np.zeros(1 << 16, np.float64)  # at most one row for each entry of the vocabulary
    for r in counts.collect():
        df[r.terms] = r.n
    kept = kept.where("size > 0").drop("terms", "seen")
    total, size = kept.agg(F.count("*"), F.sum("size")).first()
    stats = docs.sparkSession.sparkContext.broadcast((df, total or 0, (size or 1) / (total or 1), priorities(df, total or 0)))

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = stats.value[3]
        for batch in batches:
            keys = [place(first[np.frombuffer(raw.as_buffer(), np.uint16)]) for raw in batch.column(3)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *batch.columns], ["place", "row", "id", "size", "tokens"])

    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * (size or 0) // TASK_BYTES))
    # Rows are told apart, so many documents of one place are split too. Spark reads the written tokens twice, to sample the order and to shuffle.
    placed = kept.mapInArrow(keyed, "place long, row long, id long, size long, tokens binary").repartitionByRange(tasks, "place", "row").sortWithinPartitions("place", "row")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        base, count = TaskContext.get().partitionId() << 40, 0
        ids: list[int | None] = []
        rows: list[np.ndarray] = []
        tokens = 0

        def close() -> pa.RecordBatch:
            out = []
            for k, start, n, sequence, offset in Shard(rows, *stats.value[:3]).pieces():
                crc = zlib.crc32(rows[k][start : start + n].astype("<u4").tobytes())
                out.append((ids[k], start, n, crc, len(rows[k]), base + (count << 20) + sequence, offset))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc)
                rows.append(np.frombuffer(raw, np.uint16))
                tokens += len(rows[-1])
                if len(rows) >= SHARD_DOCS or tokens >= SHARD_TOKENS:
                    yield close()
                    ids, rows, tokens, count = [], [], 0, count + 1
        if rows:
            yield close()

    return placed.select("id", "tokens").mapInArrow(pack, ", ".join(f"{c} long" for c in ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]))
