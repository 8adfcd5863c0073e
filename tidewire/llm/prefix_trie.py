"""The trie of conversations: each distinct sequence of first turns is a node, named by its depth and a chained digest.

A turn is told by the SHA-256 of its role and text. The digest of a prefix is chained from its turns; turns are chained in blocks of BLOCK, and
blocks among each other, so a conversation of any length is many tasks' work. Prefixes are grouped by (depth, digest) to nodes. The nodes that
one conversation is the smallest member of are one run down its chain, from some depth to its end: what they add to subtrees is
summed along the run first, and then sent to all ancestors above the run, one row a prefix. So ancestors take as many rows as there are turns.

Rows without conv_id have no conversation and are left out; a null role or text is an empty one. Turns are ordered by turn, null first; rows
of one turn by role and then by their digest, so that their order is the same at every run, and equal rows are turns each. No rows: no nodes.
Further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import small, written

#: Turns that are chained in one piece.
BLOCK = 1024
#: Conversations whose numbers are joined to one text at once.
ENDS = 200_000
NODE = ["depth", "digest"]


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 1), token (the turn's digest), bytes (of its text), from conv_id, turn, role, text.

    Rows are dealt by ranges of their order, so the turns of one conversation are numbered by many tasks: in each range, and after those before it.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    token = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", F.left(role, F.lit(64)).alias("_role"), token.alias("token"), F.octet_length(text).cast("long").alias("bytes"))
    turn = F.col("turn").asc_nulls_first()
    rows = written(rows.repartitionByRange("conv_id", turn, "_role", "token").withColumn("_part", F.spark_partition_id()), "turns")
    sizes = rows.groupBy("conv_id", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv_id", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("conv_id", "_part").orderBy(turn, "_role", "token")
    numbered = rows.withColumn("_n", F.row_number().over(inner)).join(offsets, ["conv_id", "_part"])
    return numbered.select("conv_id", (F.col("_n") + F.col("_before")).alias("position"), F.unhex("token").alias("token"), "bytes")


def grafted(turns: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """(turns, conv_id): each conversation starts with the first `head` turns of conversation `base` (fewer where it has fewer), then come
    its own after its first `head`. base, head: of conv_id. Conversations that lose all their turns are among the conv_ids."""
    turns = written(turns, "ordered")
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("_size"))
    convs = sizes.select("conv_id", base.alias("_base"), head.cast("long").alias("_head"))
    lengths = sizes.select(F.col("conv_id").alias("_base"), "_size")
    convs = written(convs.join(lengths, "_base", "left").withColumn("_cut", F.least("_head", F.coalesce("_size", F.lit(0)))).drop("_size"), "convs")
    most = convs.agg(F.max("_head")).first()[0] or 0
    first = turns.where(F.col("position") <= most).select(F.col("conv_id").alias("_base"), "position", "token", "bytes")
    heads = convs.join(first, "_base").where("position <= _head").select("conv_id", "position", "token", "bytes")
    own = turns.join(convs, "conv_id").where("position > _head").select("conv_id", (F.col("position") - F.col("_head") + F.col("_cut")).alias("position"), "token", "bytes")
    return heads.union(own), convs.select("conv_id")


def chained(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """df with token replaced by the digest of all tokens of its keys up to it, in order. Rows are streamed: a task holds one digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, b""
        for batch in batches:
            out = []
            for key, token in zip(zip(*(batch.column(k).to_pylist() for k in keys), strict=True), batch.column("token").to_pylist(), strict=True):
                if key != now:
                    now, digest = key, b""
                digest = hashlib.sha256(digest + token).digest()
                out.append(digest)
            yield batch.set_column(batch.schema.get_field_index("token"), "token", pa.array(out, pa.binary()))

    return df.repartition(*keys).sortWithinPartitions(*keys, order).mapInArrow(run, df.schema)


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, digest, bytes (of the last turn's text) for every prefix of every conversation, the empty one included."""
    blocks = turns.select("conv_id", F.floor((F.col("position") - 1) / BLOCK).alias("block"), "position", "token", "bytes")
    links = written(chained(blocks, ["conv_id", "block"], "position"), "links")
    whole = links.where(F.col("position") % BLOCK == 0).select("conv_id", (F.col("block") + 1).alias("block"), "token")
    heads = chained(whole, ["conv_id"], "block").withColumnRenamed("token", "_head")
    later = links.where("block > 0").join(heads, ["conv_id", "block"]).withColumn("token", F.unhex(F.sha2(F.concat("_head", "token"), 256)))
    rows = links.where("block = 0").select("conv_id", "position", "token", "bytes").union(later.select("conv_id", "position", "token", "bytes"))
    root = convs.select("conv_id", F.lit(0).cast("long"), F.lit(b""), F.lit(0).cast("long"))
    return written(rows.union(root).toDF("conv_id", "depth", "digest", "bytes"), "prefixes")


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """depth, digest, ends_sha256: of the comma-joined conv_ids of a node's rows, in ascending order.

    Conversations are dealt by ranges of conv_id; each range's numbers of a node are one text, and a node's texts are streamed through one hash.
    """
    ranges = max(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), ends.count() // ENDS)
    parts = written(ends.repartitionByRange(ranges, "conv_id").withColumn("part", F.spark_partition_id()), "ends")
    text = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    texts = parts.groupBy(*NODE, "part").agg(text.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for depth, key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
                if (depth, key) == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = (depth, key), hashlib.sha256(ids.encode())
            yield made(done)
        if now is not None:
            yield made([(*now, digest.hexdigest())])

    def made(rows: list[tuple[int, bytes, str]]) -> pa.RecordBatch:
        kinds = (("depth", pa.int64()), ("digest", pa.binary()), ("ends_sha256", pa.string()))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])

    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "part").mapInArrow(run, "depth long, digest binary, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node, from turns (conv_id, position from 1 without gaps, token, bytes) and all conv_ids, turnless ones included.

    conv_id: its smallest member; depth; digest; parent_conv_id: the parent's conv_id; n_convs: members; n_children; n_leaves: childless nodes of its
    subtree, itself included; saved_tokens: what storing each node once saves, (n_convs - 1) times the bytes of its last text, summed
    over the subtree; ends_sha256: of the members that end here.
    """
    rows = prefixes(turns, convs)
    nodes = written(rows.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes")), "nodes")
    # A conversation's own nodes are those from `first` on to its end.
    runs = written(nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.max("depth").alias("last")), "runs")
    forks = written(rows.join(runs.where("first > 0"), "conv_id").where("depth = first - 1").select(*NODE, "conv_id", "first"), "forks")
    children = forks.groupBy(*NODE).agg(F.count("*").alias("_forks"))
    counted = nodes.join(runs, "conv_id").join(children, NODE, "left")
    counted = counted.withColumn("n_children", F.coalesce("_forks", F.lit(0)) + (F.col("depth") < F.col("last")).cast("long"))
    own = counted.select(*NODE, "conv_id", "n_convs", "n_children", "first", F.floor(F.col("depth") / BLOCK).alias("_block"), (F.col("n_children") == 0).cast("long").alias("_leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("_saved"))
    own = written(own, "counted")
    # Along each run from its end: in blocks of depth, and what comes after them.
    sums = own.groupBy("conv_id", "_block").agg(F.sum("_leaf").alias("_leaves"), F.sum("_saved").alias("_saves"))
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    after = sums.select("conv_id", "_block", *(F.coalesce(F.sum(c).over(deeper), F.lit(0)).alias(c) for c in ("_leaves", "_saves")))
    inner = Window.partitionBy("conv_id", "_block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    along = own.withColumns({"_leaf": F.sum("_leaf").over(inner), "_saved": F.sum("_saved").over(inner)}).join(after, ["conv_id", "_block"])
    along = along.select(*NODE, (F.col("_leaf") + F.col("_leaves")).alias("leaves"), (F.col("_saved") + F.col("_saves")).alias("saved"))
    # The run's sum goes to every ancestor above it.
    totals = sums.groupBy("conv_id").agg(F.sum("_leaves").alias("leaves"), F.sum("_saves").alias("saved")).join(runs, "conv_id").where("first > 0")
    above = rows.select("conv_id", *NODE).join(totals, "conv_id").where("depth < first").select(*NODE, "leaves", "saved")
    subtree = along.union(above).groupBy(*NODE).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parents = forks.join(small(nodes.select(*NODE, F.col("conv_id").alias("parent_conv_id"))), NODE).select("conv_id", F.col("first").alias("depth"), "parent_conv_id")
    last = rows.groupBy("conv_id").agg(F.max_by("digest", "depth").alias("digest"), F.max("depth").alias("depth"))
    out = own.join(subtree, NODE).join(parents, ["conv_id", "depth"], "left").join(digests_of_ends(last), NODE, "left")
    parent = F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("parent_conv_id"))
    return out.select("conv_id", "depth", "digest", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
