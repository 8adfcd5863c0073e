"""Spelling variants: words that differ by one edit, found by two-dimensional range reporting.

Words of one length M, in forward order and in the order of their reversed letters, are points (place in the one, place in the other). For an edit at
position i, what may stand on the other side begins with the i letters before and ends with the M - 1 - i letters behind: an interval of the
forward order and one of the reverse order. The points in both are read off a wavelet tree over the reverse places in forward order. A word of M letters
asks so for replacements, one of M - 1 letters for insertions, and deletions are insertions seen from the other side; an insertion in a run of
equal letters is told at its first position only, so each pair is found once.

Tasks get words by windows of positions: all that agree outside a window [a, b) of positions meet in one task, which asks for the edits
inside it. At first there are two windows a length, its halves; those in which more than GROUP words meet are halved again, down to single
positions, where no more words meet than there are letters. So no task holds more than a block, and no pair is lost.

Null texts are empty; a null doc_id is written as nothing. Texts and words are treated whole, whatever their length. Equal rows count each. Of near words
with equal counts the first in code-point order is the form. No words: no rows. Further columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import small, utf8, written

#: Entries that a task counts before it hands them on.
COUNTED = 200_000
#: Words that may meet in a window before it is halved; rows and bytes of a block, which a task holds at once.
GROUP, BLOCK_ROWS, BLOCK_BYTES = 20_000, 100_000, 16 << 20
#: Rectangles that are asked for at once.
ASKED = 200_000


def counted(docs: DataFrame, letters: int, least: int, every: int = 0) -> DataFrame:
    """word, n: maximal runs of A-Z, a-z and U+00C0 to U+00FF in small letters (A-Z alone are made small), of at least `letters` letters and `least` occurrences.

    every: a run loses its letter h % length where this number divides h, the CRC-32 of `<doc_id>:<run>`; 0: none does.
    """
    # A shorter run can't become longer.
    runs = re.compile(f"[a-zÀ-ÿ]{{{letters},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text")), strict=True):
                if not raw:
                    continue
                # Of bytes, lower() changes A-Z only.
                found = Counter(runs.findall(raw.lower().decode(errors="replace")))
                if every:
                    start = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                    for w in [w for w in found if zlib.crc32(w.encode(), start) % every == 0]:
                        n, cut = found.pop(w), zlib.crc32(w.encode(), start) % len(w)
                        if len(w) > letters:
                            total[w[:cut] + w[cut + 1 :]] += n
                total.update(found)
                if len(total) > COUNTED:
                    yield made(total)
                    total = Counter()
        yield made(total)

    def made(total: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    words = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Wavelet:
    """A wavelet tree over a permutation of 0 .. n - 1, level by level: bits of the values from the highest on, zeros sorted before ones in each level."""

    def __init__(self, values: np.ndarray):
        self.levels = max(1, (len(values) - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        for k in range(self.levels - 1, -1, -1):
            one = (values >> k & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]))
            values = np.concatenate([values[~one], values[one]])

    def report(self, low: np.ndarray, high: np.ndarray, least: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rectangle, value) of all places in [low, high) with values in [least, end), for many rectangles at once."""
        asked, value = np.arange(len(low)), np.zeros(len(low), np.int64)
        for level, zeros in enumerate(self.zeros):
            rest = self.levels - level - 1
            zl, zh, before = zeros[low], zeros[high], zeros[-1]
            asked, value = np.tile(asked, 2), np.concatenate([2 * value, 2 * value + 1])
            low, high = np.concatenate([zl, before + low - zl]), np.concatenate([zh, before + high - zh])
            alive = (low < high) & (value << rest < end[asked]) & (value + 1 << rest > least[asked])
            asked, value, low, high = asked[alive], value[alive], low[alive], high[alive]
        return asked, value


def _intervals(matrix: np.ndarray) -> np.ndarray:
    """Letters that each row of a sorted matrix has in common with the one before, -1 for the first."""
    same = matrix[1:] == matrix[:-1]
    return np.concatenate([[-1], np.argmin(same, axis=1)]) if len(matrix) > 1 else np.array([-1])


def _interval(common: np.ndarray, n: int, row: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that agree with each of `row` in their first n letters, as an interval of those that `counts` counts."""
    starts = np.flatnonzero(common < n)
    at = np.searchsorted(starts, row, side="right") - 1
    return counts[starts[at]], counts[np.append(starts, len(common))[at + 1]]


def near_pairs(words: np.ndarray, size: int, row: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(x, y): places of near words among `words` (sorted, distinct, of size or size - 1 letters), as asked by row k, word row[k], for edits at a[k] <= i < b[k]."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    matrix = words.view(np.uint8).reshape(len(words), size)
    long = matrix[:, -1] != 0
    if len(words) < 2 or not long.any():
        return nothing
    back = np.zeros_like(matrix)
    back[long] = matrix[long, ::-1]
    back[~long, : size - 1] = matrix[~long, : size - 1][:, ::-1]
    order = np.argsort(back.view(words.dtype).ravel(), kind="stable")
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    forward, reverse = np.concatenate([[0], np.cumsum(long)]), np.concatenate([[0], np.cumsum(long[order])])
    tree = Wavelet(reverse[place[long]])
    of_value = order[long[order]]
    common, common_back = _intervals(matrix), _intervals(back[order])
    asked: list[list[np.ndarray]] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def ask() -> None:
        if not asked:
            return
        word, at, low, high, least, end = (np.concatenate(c) for c in zip(*asked, strict=True))
        asked.clear()
        q, value = tree.report(low, high, least, end)
        x, y, i = word[q], of_value[value], at[q]
        # Not itself, and an inserted letter not behind one like it.
        good = np.where(long[x], x != y, (i == 0) | (matrix[y, i] != matrix[x, i - 1]))
        x, y = x[good], y[good]
        found.append((x, y))
        found.append((y[~long[x]], x[~long[x]]))

    waiting = 0
    for i in range(int(a.min()), int(b.max())):
        x = row[(a <= i) & (i < b)]
        if not len(x):
            continue
        low, high = _interval(common, i, x, forward)
        some = high - low > long[x]
        x, low, high = x[some], low[some], high[some]
        if not len(x):
            continue
        least, end = _interval(common_back, size - 1 - i, place[x], reverse)
        some = end - least > long[x]
        if not some.any():
            continue
        asked.append([x[some], np.full(int(some.sum()), i), low[some], high[some], least[some], end[some]])
        waiting += int(some.sum())
        if waiting >= ASKED:
            ask()
            waiting = 0
    ask()
    return (np.concatenate([p[0] for p in found]), np.concatenate([p[1] for p in found])) if found else nothing


def _windows(words: DataFrame) -> DataFrame:
    """word, n, size, a, b, key: the halves of a word's own length, and of the next, whose words it may be less a letter of."""
    size = F.length("word")
    halves = lambda m: [F.struct(m.alias("size"), F.lit(0).alias("a"), F.floor(m / 2).cast("int").alias("b")), F.struct(m.alias("size"), F.floor(m / 2).cast("int").alias("a"), m.alias("b"))]
    return _keyed(words.select("word", "n", F.explode(F.array(*halves(size), *halves(size + 1))).alias("w")).select("word", "n", "w.*"))


def _keyed(rows: DataFrame) -> DataFrame:
    """key: what stands outside the window, and the window itself."""
    outside = F.struct("size", "a", "b", F.left("word", F.col("a")).alias("head"), F.right("word", F.col("size") - F.col("b")).alias("tail"))
    return rows.withColumn("key", F.xxhash64(outside))


def _halved(rows: DataFrame) -> DataFrame:
    mid = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    parts = F.explode(F.array(F.struct("a", mid.alias("b")), F.struct(mid.alias("a"), "b")))
    return _keyed(rows.select("word", "n", "size", parts.alias("w")).select("word", "n", "size", "w.*"))


def near(words: DataFrame, group: int = GROUP) -> DataFrame:
    """word, n_near, form, form_n: how many words differ from it by one inserted, deleted or replaced letter, and which of them is the most frequent; words without any are left out.

    words (word, n): distinct, of letters up to U+00FF, one at least.
    """
    ready, rows = [], written(_windows(words), "windows")
    while True:
        # Single positions need no halving: no more words meet there than there are letters.
        sizes = rows.where("b - a > 1").groupBy("key").agg(F.count("*").alias("c"))
        large = written(sizes.where(F.col("c") > group).select("key"), "large")
        if not large.limit(1).count():
            ready.append(rows)
            break
        large = small(large)
        ready.append(rows.join(large, "key", "left_anti"))
        rows = written(_halved(rows.join(large, "key", "left_semi")), "windows")
    all_rows = ready[0]
    for more in ready[1:]:
        all_rows = all_rows.unionByName(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bytes_held, last = [], 0, None
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("key", "word", "n", "size", "a", "b")), strict=True):
                if (len(held) >= BLOCK_ROWS or bytes_held >= BLOCK_BYTES) and r[0] != last:
                    yield block(held)
                    held, bytes_held = [], 0
                last = r[0]
                held.append(r[1:])
                bytes_held += len(r[1])
        yield block(held)

    def block(held: list[tuple]) -> pa.RecordBatch:
        by_size: dict[int, list[tuple]] = {}
        for r in held:
            by_size.setdefault(r[2], []).append(r)
        out: list[list] = [[], [], [], []]
        for size, rows in by_size.items():
            if len(rows) < 2:
                continue
            words, first, row = np.unique(np.array([r[0].encode("latin-1") for r in rows], f"S{size}"), return_index=True, return_inverse=True)
            n = np.array([r[1] for r in rows], np.int64)[first]
            x, y = near_pairs(words, size, row, np.array([r[3] for r in rows]), np.array([r[4] for r in rows]))
            if not len(x):
                continue
            order = np.lexsort((y, -n[y], x))
            x, y = x[order], y[order]
            heads = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            out[0] += [words[k].decode("latin-1") for k in x[heads]]
            out[1] += np.diff(np.append(heads, len(x))).tolist()
            out[2] += [words[k].decode("latin-1") for k in y[heads]]
            out[3] += n[y[heads]].tolist()
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["word", "near", "best", "best_n"])

    found = all_rows.repartition("key").sortWithinPartitions("size", "key").mapInArrow(run, "word string, near long, best string, best_n long")
    # The least of (-n, word) is the most frequent, the first of equals.
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.best").alias("form"), (-F.col("b.less")).alias("form_n"))


def rooted(links: DataFrame) -> DataFrame:
    """word, root: the last word that the links (word, form) lead to. They must not lead in circles; each round doubles their reach."""
    now = written(links.select("word", F.col("form").alias("root")), "links")
    while True:
        nexts = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = written(now.join(nexts, "root", "left"), "links")
        if not step.where("_next is not null").limit(1).count():
            return now
        now = step.select("word", F.coalesce("_next", "root").alias("root"))


def variants(words: DataFrame, times: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word (word, n). form: its most frequent near word, if that is at least `times` as frequent."""
    words = written(words, "words")
    more = words.join(near(words), "word", "left").withColumn("_form", F.col("form_n") >= times * F.col("n"))
    more = written(more.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("_form"), F.col("form")).alias("form"), F.when(F.col("_form"), F.col("form_n")).alias("form_n")), "forms")
    roots = rooted(more.where("form is not null"))
    return more.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
