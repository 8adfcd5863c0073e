"""Shared plumbing: reading tables, sizes of what is broadcast, Arrow text access, group streaming, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tidewire.sources.scratch import removed, shared_root, stored, written

__all__ = ["removed", "shared_root", "stored", "written"]

#: Entries a worker keeps per memo before it starts afresh; bounds the memory of a Python worker.
MEMO_LIMIT = 200_000
#: Bytes of a side that may be broadcast, as `row_bytes` reckons them.
BROADCAST_BYTES = 48 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; unknown further columns are never read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def row_bytes(schema: StructType) -> Column:
    """What a row takes: 16 bytes a value, and what texts and nested values have as text."""
    total = F.lit(16 * len(schema.fields))
    for f in schema.fields:
        if isinstance(f.dataType, StringType | BinaryType):
            total += F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, ArrayType | MapType | StructType):
            total += F.coalesce(F.octet_length(F.to_json(f.name)), F.lit(0))
    return total


def small(df: DataFrame) -> DataFrame:
    """df, which must be written, marked to be broadcast if its rows have no more than BROADCAST_BYTES; joined by a shuffle beyond."""
    return F.broadcast(df) if (df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0) <= BROADCAST_BYTES else df


def chosen_by_hash(h: Column, rows: int, whole: int) -> Column:
    """Whether a row is among about `rows` of `whole`, by its 64-bit hash; even of more rows than there are hashes of 32 bits some are chosen."""
    share = rows / max(1, whole)
    return F.lit(True) if share >= 1 else h < F.lit(int(-(2**63) + share * 2.0**64))


def utf8(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column without decoding it."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


class WordHash(dict):
    """word bytes -> 64-bit hash, remembered up to MEMO_LIMIT words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (murmur3's constants)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n word hashes."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        out = mix(out + h[k : k + len(out)] + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64))
    return out


def streamed_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of adjacent rows with equal keys, from batches sorted by them; a group may span batches."""
    parts: list[pa.RecordBatch] = []
    now: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        rows = list(zip(*cols, strict=True))
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i] != rows[start]:
                if now is not None and rows[start] != now:
                    yield now, pa.Table.from_batches(parts)
                    parts = []
                now = rows[start]
                parts.append(batch.slice(start, i - start))
                start = i
    if now is not None:
        yield now, pa.Table.from_batches(parts)


#: Edges of one task of the small tables that components are made of.
EDGES_A_TASK = 100_000


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b: long): one row (id, root) per node, root its smallest node.

    Alternating large-star and small-star; every round is a written table, so nothing but a number and a yes or no
    of a round reaches the driver. Where the nodes are few enough, each node's least neighbour is sent to all tasks, and no node's edges meet
    in one; beyond, they are joined by a shuffle. No edges: no rows. Self loops and repeated edges are allowed.
    """

    def star(e: DataFrame, large: bool, few: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
        low = both.groupBy("a").agg(F.min("b").alias("m0")).select(F.col("a").alias("k"), F.least("a", "m0").alias("m"))
        joined = both.join(F.broadcast(low) if few else low, F.col("a") == F.col("k"))
        if large:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        # A neighbour goes to the least one, and so does the node itself.
        ends = F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b"))))
        return joined.select(ends.alias("e")).select("e.a", "e.b").where("a > b").distinct()

    def unfinished(e: DataFrame) -> bool:
        """Whether some node has two edges to lesser ones, or one and is itself the least of another: then it's no star yet."""
        seen = e.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
        return bool(seen.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").limit(1).count())

    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while size := now.count():
        if not unfinished(now):
            break
        few = 2 * size * 32 <= BROADCAST_BYTES  # an edge has two nodes, each with its least neighbour
        now = written(star(star(now, True, few), False, few).coalesce(max(8, size // EDGES_A_TASK)), "stars")
    return now.select(F.col("a").alias("id"), F.col("b").alias("root")).union(now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
