"""N-gram Jaccard join by a prefix tree.

Every document is the set of its word n-grams, as 64-bit hashes in one global (ascending) order.
Texts with equal sets form a class. A pair of classes with Jaccard >= t differs in at most
d = |r| (1 - t) / t elements, r the smaller. The hash space is cut into d + 1 + spare ranges, so that
a linked pair has at least one range with exactly the same, not too small, content: documents meet by
the digest of a range, never by a single frequent n-gram. For thresholds so low that ranges
would hold two or three n-grams each, DIGESTS ranges of more n-grams find links with a high probability
instead (likely). Classes that meet (directly or in a chain) form a block; each block is stored in a trie of the ordered sets and joined by traversing it.
Blocks that are too large for one task are cut into chunks, each joined in itself and with a few pivots of the block. What
that leaves apart from the block's largest component, and only that, is then joined with all chunks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import WordHash, components, gram_hashes, mix, small, streamed_groups, utf8, written

#: A block is cut when it has more classes or more n-grams than this.
BLOCK_CLASSES, BLOCK_GRAMS = 500, 2_000_000
#: Classes of a cut block, about, that every chunk of it is joined with.
PIVOTS = 16
#: Likely digests: ranges a set is looked at by, n-grams a range holds on average at the least, n-grams below
#: which a range says nothing, and the set size below which the exact ranges are used all the same.
DIGESTS, RANGE_GRAMS, LEAST_GRAMS, LIKELY_FROM = 80, 6.5, 6, 36


def gram_set(text: bytes | None, n: int, words: WordHash) -> np.ndarray:
    """Sorted distinct n-gram hashes; the whole sequence as one n-gram when it is shorter; none without words."""
    split = text.lower().split() if text else []
    if not split:
        return np.empty(0, np.uint64)
    h = words.of(split)
    return np.unique(gram_hashes(h, n)) if len(h) >= n else gram_hashes(h, len(h)) ^ np.uint64(len(h))


def size_bins(percent: int, top: int) -> list[int]:
    """Lower bounds of the size bins up to one that holds top; each bin is a third wider than the last."""
    low = [max(1, -(-percent // (100 - percent)))]
    while low[-1] <= top * 2:
        low.append(max(low[-1] + 1, -(-low[-1] * 4 // 3), low[-1] * 100 // percent + 1))
    return low


def likely_digests(grams: np.ndarray, least: int, salt: int) -> np.ndarray:
    """Digests of DIGESTS ranges of a set of a size bin that starts at least, from as many hash orders as that takes.

    A range is alike in two sets if none of their unlike n-grams falls in it. At a Jaccard index of 0.8 that is so
    for one range in ten or more, independently, so a link that is just one is lost at most about once in 2,000
    times by reckoning (never in 24,000 made pairs) and one of 0.85 less than once in 100,000. A range of LEAST_GRAMS n-grams is hardly ever held by texts
    that merely share a passage.
    """
    m = max(2, int(least / RANGE_GRAMS))
    orders = np.arange(-(-DIGESTS // m), dtype=np.uint64)[:, None]
    hashed = mix(grams[None, :] + (orders + np.uint64(salt << 32)) * np.uint64(0x9E3779B97F4A7C15))
    of = (((hashed >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)) + orders * np.uint64(m)
    used = of < DIGESTS
    of, hashed = of[used], hashed[used]
    order = np.argsort(of, kind="stable")
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashed[order]))])
    ends = np.searchsorted(of[order], np.arange(DIGESTS + 1, dtype=np.uint64))
    digest = mix((sums[ends[1:]] - sums[ends[:-1]]) ^ mix(np.arange(DIGESTS, dtype=np.uint64) + np.uint64(salt << 32)))
    return digest[np.diff(ends) >= LEAST_GRAMS]


def signatures(grams: np.ndarray, percent: int, likely: bool = False) -> np.ndarray:
    """Digests of the ranges of a set, for its own size bin and, where a larger partner may be in it, the next.

    One more range than a linked partner can differ in is enough: the fullest ones are taken, with all that
    are as full as the last of them. Of two linked sets, the one with the higher limit has a range in common that it
    takes, and the other takes that one too; so light ranges, empty ones above all, join nothing.
    """
    n = len(grams)
    low = size_bins(percent, n)
    if n < low[0]:  # only an equal set can link
        return np.empty(0, np.uint64)
    own = int(np.searchsorted(low, n, side="right")) - 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams))])
    out = []
    for b in (own, own + 1) if n * 100 // percent >= low[own + 1] else (own,):
        if likely and low[b] >= LIKELY_FROM:
            out.append(likely_digests(grams, low[b], b + 1))
            continue
        differ = (low[b + 1] - 1) * (100 - percent) // percent
        spare = 3 + (differ + 1) // 16
        m = differ + 1 + spare
        of = ((grams >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        ends = np.searchsorted(of, np.arange(m + 1, dtype=np.uint64))
        digest = mix((sums[ends[1:]] - sums[ends[:-1]]) ^ mix(np.arange(m, dtype=np.uint64) + np.uint64(b << 32)))
        held = np.diff(ends)
        out.append(digest[held >= np.partition(held, spare)[spare]])
    return np.concatenate(out)


class Trie:
    """Path-compressed prefix tree of sets in lexicographic order, over which sets are joined.

    Nodes are (first, last, from, to): the sets first..last-1 share their elements from..to-1.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.size = np.array([len(s) for s in self.sets], np.int64)
        self.shared = [self._common(a, b) for a, b in zip(self.sets, self.sets[1:], strict=False)]
        self.kids: list[list[int]] = []
        self.node: list[tuple[int, int, int, int, int, int]] = []
        self.top = self._build()
        self.number()

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        m = min(len(a), len(b))
        unlike = a[:m] != b[:m]
        return int(unlike.argmax()) if unlike.any() else m

    def _add(self, first: int, last: int, start: int, end: int) -> int:
        sizes = self.size[first:last]
        self.node.append((first, last, start, end, int(sizes.min()), int(sizes.max())))
        self.kids.append([])
        return len(self.node) - 1

    def _build(self) -> list[int]:
        top: list[int] = []
        todo = [(0, len(self.sets), 0, top)]
        while todo:
            first, last, depth, into = todo.pop()
            cuts = [first, *(i + 1 for i in range(first, last - 1) if self.shared[i] <= depth), last]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                end = len(self.sets[lo]) if hi - lo == 1 else min(self.shared[lo : hi - 1])
                k = self._add(lo, hi, depth, end)
                into.append(k)
                if hi - lo > 1:
                    todo.append((lo, hi, end, self.kids[k]))
        return top

    def number(self) -> None:
        """Give every n-gram of the block its rank, so that a set is marked in one array over all of them."""
        flat = np.concatenate(self.sets) if self.sets else np.empty(0, np.uint64)
        grams, ranks = np.unique(flat, return_inverse=True)
        self.ranks = np.split(ranks.astype(np.int64), np.cumsum(self.size)[:-1])
        self.mark = np.zeros(len(grams) + 1, np.int32)

    def links(self, q: int, percent: int, root: np.ndarray) -> Iterator[int]:
        """Sets after set q that link with it, but for subtrees wholly in q's component (root, changed meanwhile)."""
        n = len(self.ranks[q])
        self.mark[self.ranks[q] + 1] = 1
        upto = np.cumsum(self.mark)  # elements of q below each rank
        todo = [(k, 0) for k in self.top]
        while todo:
            k, both = todo.pop()
            first, last, start, end, least, most = self.node[k]
            if last <= q + 1 or least * percent > n * 100 or n * percent > most * 100:
                continue
            leaf = last - first == 1
            if root[first] == root[q] and (leaf or (root[first:last] == root[q]).all()):
                continue
            at = 0
            if end > start:
                edge = self.ranks[first][start:end]
                both += int(self.mark[edge + 1].sum())
                at = int(upto[edge[-1] + 1])
            elif end:
                at = int(upto[self.ranks[first][end - 1] + 1])
            size = min(max(end + n - at, least), most)  # the length at which a partner below fits best
            if (both + min(size - end, n - at)) * (100 + percent) < percent * (n + size):
                continue
            if leaf:
                yield first
            else:
                todo += [(kid, both) for kid in self.kids[k]]
        self.mark[self.ranks[q] + 1] = 0


def joined(sets: list[np.ndarray], percent: int, known: list | None = None) -> np.ndarray:
    """For distinct sets: the position of a set of the same component, equal within a component. known: sets of equal values are in one."""
    trie = Trie(sets)
    root = np.arange(len(sets))
    if known is not None:
        first: dict = {}
        for k, i in enumerate(trie.order):
            root[k] = first.setdefault(known[i], k)
    for q in range(len(sets)):
        for other in trie.links(q, percent, root):
            if root[other] != root[q]:
                root[root == root[other]] = root[q]
    out = np.empty(len(sets), np.int64)
    order = np.array(trie.order)
    out[order] = order[root]
    return out


def placed_in_chunks(members: DataFrame) -> DataFrame:
    """root, class_id, chunks, chunk, pivot for each row (root, class_id, n) of a block's classes."""
    size = members.groupBy("root").agg(F.count("*").alias("c"), F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int").alias("chunks"))
    cut = written(size.where("chunks > 1"), "cuts")
    placed = members.join(small(cut), "root", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    pivot = F.coalesce(F.pmod(F.xxhash64("class_id", F.lit(7)), F.col("c")) < PIVOTS, F.lit(False))
    return written(placed.select("root", "class_id", "chunks", F.pmod(F.xxhash64("class_id"), F.col("chunks")).cast("int").alias("chunk"), pivot.alias("pivot")), "placed")


def first_rows(placed: DataFrame) -> DataFrame:
    """root, i, j, class_id: what is joined together first, a chunk each, with the pivots of its block."""
    own = F.array("chunk")
    every = F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(own)
    return placed.select("root", F.explode(every).alias("i"), F.lit(-1).alias("j"), "class_id", F.lit(None).cast("long").alias("comp"), "chunks")


def second_rows(placed: DataFrame, found: DataFrame) -> DataFrame:
    """What is joined then, for cut blocks: the classes apart from the largest component so far (found: id, root), in chunks j, with
    every chunk i. comp: the component that a class is known to be in."""
    cut = placed.where("chunks > 1").join(found.select(F.col("id").alias("class_id"), F.col("root").alias("comp")), "class_id", "left").withColumn("comp", F.coalesce("comp", "class_id"))
    cut = written(cut.select("root", "class_id", "chunks", "chunk", "comp"), "cut")
    largest = cut.groupBy("root", "comp").agg(F.count("*").alias("n")).groupBy("root").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
    largest = written(largest.where("most < all").select("root", "main", F.ceil((F.col("all") - F.col("most")) / BLOCK_CLASSES).cast("int").alias("parts")), "apart")
    cut = cut.join(small(largest), "root")
    apart = cut.where("comp <> main").select("root", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("i"), F.pmod(F.xxhash64("class_id", F.lit(11)), F.col("parts")).cast("int").alias("j"), "class_id", "comp", "chunks")
    return cut.select("root", F.col("chunk").alias("i"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"), "class_id", "comp", "chunks").union(apart)


def near_classes(docs: DataFrame, n: int = 3, percent: int = 90, likely: bool = False) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id with the same set), component_id for each row of docs.

    docs: doc_id long, text string. Two documents link when 100 |a & b| >= percent |a | b| over their
    distinct word n-grams (A-Z lower-cased, words split at ASCII white space). Null and empty texts have no
    n-grams and stay alone; a null doc_id keeps its row with null ids; rows with equal doc_ids count as
    separate texts of which both link; repeated rows are one class; empty tables give none. Texts of any length are read whole.
    Further columns aren't read. A block is held in memory in chunks of BLOCK_CLASSES classes; if many of a large block's classes stay
    apart from its largest component, as many chunks are joined as it has, times those that stay apart.
    likely finds candidates by likely_digests, for thresholds from 80 percent on; every link is verified either way.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHash()
        for batch in batches:
            sizes, high, low, sigs = [], [], [], []
            for text in utf8(batch.column(1)):
                grams = gram_set(text, n, words)
                sizes.append(len(grams))
                high.append(int(mix(grams).sum(dtype=np.uint64).view(np.int64)) if len(grams) else None)
                low.append(int(mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(grams) else None)
                sigs.append(signatures(grams, percent, likely).view(np.int64))
            ends = np.cumsum([0, *map(len, sigs)]).astype(np.int32)
            flat = np.concatenate(sigs) if sigs else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "n_shingles", "high", "low", "sigs"])

    digest = written(docs.mapInArrow(digests, "doc_id long, n_shingles long, high long, low long, sigs array<long>"), "digests")
    # Written, so that the joins with it can split a class that holds much of the rows.
    classes = written(digest.where("high is not null and doc_id is not null").groupBy("high", "low").agg(F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n")), "classes")

    # Meeting points: one row for each range of each distinct set.
    met = digest.where("size(sigs) > 0").groupBy("high").agg(F.first("sigs").alias("sigs")).select("high", F.explode("sigs").alias("sig"))
    shared = met.groupBy("sig").agg(F.min("high").alias("lead"), F.max("high").alias("top")).where("lead <> top").select("sig", "lead")
    edges = met.join(shared, "sig").where("high <> lead").select(F.col("high").alias("a"), F.col("lead").alias("b"))
    blocks = components(edges)

    members = written(blocks.join(classes, blocks.id == classes.high).select("root", "class_id", "n"), "members")
    placed = placed_in_chunks(members)

    def join_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHash()
        for _, rows in streamed_groups(batches, ["root", "i", "j"]):
            sets, ids, comp = {}, {}, {}
            for key, known, text in zip(rows["class_id"].to_pylist(), rows["comp"].to_pylist(), (x for c in rows["text"].chunks for x in utf8(c)), strict=True):
                grams = gram_set(text, n, words)
                name = grams.tobytes()
                sets.setdefault(name, grams)  # rows with equal ids may differ in text
                comp.setdefault(name, len(sets) if known is None else ("comp", known))
                ids.setdefault(name, []).append(key)
            group = list(sets)
            of = joined([sets[g] for g in group], percent, [comp[g] for g in group])
            least: dict[int, int] = {}
            for g, r in zip(group, of.tolist(), strict=True):
                least[r] = min(least.get(r, ids[g][0]), *ids[g])
            names = [(key, least[r]) for g, r in zip(group, of.tolist(), strict=True) for key in dict.fromkeys(ids[g])]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()), pa.array([rows["chunks"][0].as_py()] * len(names), pa.int32())], ["a", "b", "chunks"])

    def join_rows(rows: DataFrame, name: str) -> DataFrame:
        texts = docs.join(small(rows), F.col("doc_id") == F.col("class_id")).select("root", "i", "j", "class_id", "comp", "chunks", "text")
        ordered = texts.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
        return written(ordered.mapInArrow(join_blocks, "a long, b long, chunks int"), name)

    found = join_rows(first_rows(placed), "found")
    # A block in one piece is final; the pieces of a cut one are joined by their links. A doc_id on several rows has its least root.
    roots = found.where("chunks = 1").select(F.col("a").alias("id"), F.col("b").alias("root"))
    parts = found.where("chunks > 1").select("a", "b")
    if parts.limit(1).count():
        known = components(parts)
        more = join_rows(written(second_rows(placed, known), "rest"), "more")
        # What the second pass links are components of the first; only those that it links are joined anew.
        names = known.select("id", F.col("root").alias("to"))
        links = more.join(names.select(F.col("id").alias("a"), F.col("to").alias("ra")), "a", "left").join(names.select(F.col("id").alias("b"), F.col("to").alias("rb")), "b", "left")
        links = written(links.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b").distinct(), "links")
        above = components(links).select(F.col("id").alias("to"), F.col("root").alias("top")) if links.limit(1).count() else None
        mine = names if above is None else names.union(above.select(F.col("to").alias("id"), "to")).distinct().join(above, "to", "left").select("id", F.coalesce("top", "to").alias("to"))
        roots = roots.union(mine.select("id", F.col("to").alias("root")))
    root_of = roots.groupBy(F.col("id").alias("class_id")).agg(F.min("root").alias("root"))

    # Classes get their roots first, so rows are joined once, by tables that a class with many rows can be split against.
    rooted = written(classes.join(root_of, "class_id", "left").select("high", "low", "class_id", F.coalesce("root", "class_id").alias("root")), "rooted")
    linked = digest.select("doc_id", "n_shingles", "high", "low").join(rooted, ["high", "low"], "left")
    return linked.select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("root", "doc_id").alias("component_id"))
