"""Benchmark decontamination by CGK random walks, bit-sampling LSH and exact edit verification.

Texts and items are sequences of word hashes (A-Z lower-cased; words are runs of letters, digits and
non-ASCII bytes). A document leaks an item when some window of it is within floor(|item| * rate) word
edits of the item. An item is cut into that many pieces plus one, so a leak holds one piece untouched: where a text has the
first words of a piece, an item-sized window is aligned with the item. The window before and behind
that place is embedded by CGK walks, which map edit distance k to Hamming distance O(k^2), and meets the item if the walks
agree at all sampled positions of some LSH table. Tables are drawn along each part's own length, in enough
repetitions for the target recall at the full edit allowance. Windows that meet are verified by exact edit distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import WordHash, gram_hashes, mix, stored, utf8

#: Bytes that belong to a word; others separate words.
WORD = bytes(c if chr(c).isdigit() and c < 128 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Items and bytes of item texts of one index; what is more is searched in further passes, so an index stays small.
ITEMS_A_PASS, BYTES_A_PASS = 20_000, 8 << 20
ANCHOR = 4
#: Places of pieces whose windows are compared at once.
HITS = 2048
#: Pieces whose LSH keys a worker remembers.
REMEMBERED = 20_000
#: Walks, tables drawn from each, positions of a table, and the steps of a walk.
WALKS, TABLES, BITS, STEPS = 8, 8, 2, 40


def sequence(text: bytes | None, words: WordHash) -> np.ndarray:
    return words.of(text.translate(WORD).split()) if text else np.empty(0, np.uint64)


def walks(block: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CGK embedding of many sequences (rows of block) by WALKS walks of STEPS steps: walk x row x step; 0 past the end.

    A step emits the present element and moves on by a random bit that depends on walk, step and that element.
    """
    n, width = block.shape
    at = np.zeros((WALKS, n), np.int64)
    rows, seeds = np.arange(n), np.arange(WALKS, dtype=np.uint64)[:, None] * np.uint64(1_000_003)
    out = np.zeros((WALKS, n, STEPS), np.uint64)
    for j in range(STEPS):
        here = np.where(at < lengths, block[rows, np.minimum(at, width - 1)], np.uint64(0))
        out[:, :, j] = here
        at += (mix(here + seeds + np.uint64(j + 1)) & np.uint64(1)).astype(np.int64)
    return out


def tables() -> np.ndarray:
    """Sampled positions, table x position, as shares of a part's walk: one in each of as many equal stretches as a table has positions."""
    rng = np.random.default_rng(11)
    return (rng.random((TABLES, BITS)) + np.arange(BITS)) / BITS


def digests(parts: list[np.ndarray], spans: np.ndarray) -> np.ndarray:
    """part x (walk, table) keys of the walks' sampled positions. spans: for each part the words of the item's own part; a
    walk moves on by half a word a step, so positions lie in the first twice as many steps, and behind the anchor that all share."""
    lengths = np.array([len(p) for p in parts])
    block = np.zeros((len(parts), max(1, int(lengths.max()))), np.uint64)
    for row, p in zip(block, parts, strict=True):
        row[: len(p)] = p
    emitted = walks(block, lengths)
    first = 2 * ANCHOR + 2
    reach = np.minimum(2 * spans, STEPS) - first
    at = first + (tables()[None] * np.maximum(reach, 1)[:, None, None]).astype(np.int64)
    keys = np.zeros((WALKS, len(parts), TABLES), np.uint64)
    rows = np.arange(len(parts))[:, None]
    for b in range(BITS):
        keys = mix(keys + emitted[:, rows, np.minimum(at[:, :, b], STEPS - 1)])
    return keys.transpose(1, 0, 2).reshape(len(parts), -1)


def edit_window(item: np.ndarray, window: np.ndarray, most: int) -> tuple[int, int] | None:
    """Least edits from item to a substring of window, and the end of that substring; None if over most."""
    cost = np.arange(len(item) + 1)
    best = (most + 1, 0)
    steps = np.arange(len(item) + 1)
    for end, word in enumerate(window, 1):
        new = np.empty_like(cost)
        new[0] = 0
        new[1:] = np.minimum(cost[:-1] + (item != word), cost[1:] + 1)
        cost = np.minimum.accumulate(new - steps) + steps
        if cost[-1] < best[0]:
            best = (int(cost[-1]), end)
    return best if best[0] <= most else None


class Index:
    """Anchors of a bounded number of items; the LSH keys of what lies before and behind one are made when a text first has it."""

    def __init__(self, items: list[tuple[int, bytes | None]], rate: float, least: int):
        words = WordHash()
        seqs = [(i, sequence(t, words)) for i, t in items]
        self.items = [(i, s) for i, s in seqs if len(s) >= min(least, ANCHOR)]
        self.rate = rate
        # Shorter items have to stand as they are.
        self.edits = [int(len(s) * rate) if len(s) >= least else 0 for _, s in self.items]
        #: The pieces: item, and place in it.
        self.pieces: list[tuple[int, int]] = []
        self.anchors: dict[int, dict[int, list[int]]] = {}
        for k, (_, s) in enumerate(self.items):
            pieces = self.edits[k] + 1
            cuts = [len(s) * p // pieces for p in range(pieces + 1)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                n = min(ANCHOR, hi - lo)
                self.anchors.setdefault(n, {}).setdefault(int(gram_hashes(s[lo : lo + n], n)[0]), []).append(len(self.pieces))
                self.pieces.append((k, lo))
        self.bits = {n: self._bitmap(np.fromiter(a, np.uint64, len(a))) for n, a in self.anchors.items()}
        self.keys: dict[int, np.ndarray] = {}

    @staticmethod
    def _bitmap(keys: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << 20, bool)
        bits[(keys >> np.uint64(44)).astype(np.int64)] = True
        return bits

    def _keys(self, windows: list[tuple[np.ndarray, int, int, int]]) -> np.ndarray:
        """window x (behind, before) x table keys. A window: text, item, place in the item, place in the text."""
        parts, spans = [], []
        for s, k, lo, at in windows:
            size, e = len(self.items[k][1]), self.edits[k]
            n = min(ANCHOR, size - lo)
            parts += [s[at : at + size - lo + e], s[max(0, at - lo - e) : at + n][::-1]]
            spans += [size - lo, lo + n]
        return digests(parts, np.array(spans)).reshape(len(windows), 2, -1)

    def _item_keys(self, pieces: list[int]) -> np.ndarray:
        if len(self.keys) > REMEMBERED:
            self.keys.clear()
        if new := [p for p in dict.fromkeys(pieces) if p not in self.keys]:
            self.keys |= zip(new, self._keys([(self.items[k][1], k, lo, lo) for k, lo in map(self.pieces.__getitem__, new)]), strict=True)
        return np.stack([self.keys[p] for p in pieces])

    def _hits(self, s: np.ndarray) -> Iterator[tuple[int, int]]:
        """Places of pieces' first words, one by one: (piece, place in the text)."""
        for n, table in self.anchors.items():
            grams = gram_hashes(s, n)
            for at in np.flatnonzero(self.bits[n][(grams >> np.uint64(44)).astype(np.int64)]).tolist():
                for p in table.get(int(grams[at]), ()):
                    yield p, at

    def leaks(self, s: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """item position -> (edits, first word, words) of its best window in s."""
        hits = self._hits(s)
        starts: dict[int, set[int]] = {}
        while part := list(islice(hits, HITS)):
            same = (self._keys([(s, *self.pieces[p], place) for p, place in part]) == self._item_keys([p for p, _ in part])).any(axis=2)
            for (p, place), (behind, before) in zip(part, same.tolist(), strict=True):
                k, lo = self.pieces[p]
                # The longer of the two parts decides; a part that is hardly more than the anchor tells nothing.
                size = len(self.items[k][1])
                if behind and 2 * (size - lo) >= size or before and 2 * (lo + ANCHOR) >= size:
                    starts.setdefault(k, set()).add(place - lo)
        found: dict[int, tuple[int, int, int]] = {}
        for k, places in starts.items():
            item, e = self.items[k][1], self.edits[k]
            # Around an anchor the item may have shifted by up to its edits either way; what overlaps is one stretch.
            stretches: list[list[int]] = []
            for a in sorted(places):
                lo, hi = max(0, a - e), a + len(item) + 2 * e
                if stretches and lo <= stretches[-1][1]:
                    stretches[-1][1] = hi
                else:
                    stretches.append([lo, hi])
            for lo, hi in stretches:
                got = edit_window(item, s[lo:hi], e)
                if got and (k not in found or got[0] < found[k][0]):
                    end = lo + got[1]
                    back = edit_window(item[::-1], s[lo:end][::-1], e)
                    words = back[1] if back else got[1]
                    found[k] = (got[0], end - words, words)
        return found


LEAK = "doc_id long, item_id long, edits long, first_word long, n_words long"


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.2, least: int = 8) -> DataFrame:
    """doc_id, item_id, edits, first_word, n_words: the best window of each item that a document leaks.

    docs: doc_id, text; benchmark: item_id, text. rate: word edits allowed per word of the item; items of fewer than
    `least` words leak where they stand as they are. Items of fewer than ANCHOR words, which stand everywhere, and null texts leak nothing; empty tables give no rows; repeated items and documents
    each have their rows, and of windows of equally many edits the first is given. Texts of any length are searched whole; further
    columns aren't read. The benchmark is searched in passes of about ITEMS_A_PASS items or BYTES_A_PASS bytes, which bounds the index.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    count, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    passes = max(1, -(-count // ITEMS_A_PASS), -(-(size or 0) // BYTES_A_PASS))
    paths: list[str] = []
    for p in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p)
        index = spark.sparkContext.broadcast(Index([(r.item_id, r.text.encode("utf-8", "surrogatepass")) for r in part.collect()], rate, least))

        def scan(batches: Iterable[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            words = WordHash()
            for batch in batches:
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                    for k, hit in index.value.leaks(sequence(text, words)).items():
                        rows.append((doc, index.value.items[k][0], *hit))
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "edits", "first_word", "n_words"])

        found = docs.mapInArrow(scan, LEAK)
        if passes > 1:
            # Written before the next pass, so that no more than one index is held anywhere.
            paths.append(stored(found, "leaks"))
            index.destroy()
    return spark.read.schema(LEAK).parquet(*paths) if paths else found
