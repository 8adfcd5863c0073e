"""Toxicity by a noisy channel: obfuscated words are restored, then the restored text is scored.

A stretch of a text is a lattice: every character may be itself or a letter it is used for (leetspeak), a separator, the space
between tokens too, may be nothing, and a repeated character may be nothing. Viterbi finds the likeliest path under a letter
trigram model. Only stretches whose skeleton (leetspeak classes, no separators, no repeats) is that of a word of the lexicon are decoded:
no other can be restored to one. A naive-Bayes lexicon, learned from labelled documents, scores the restored text:
words that speak for toxicity add up, words of clean texts weigh against them, up to a bound.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import MEMO_LIMIT, WordHash, gram_hashes, small, written

#: Words of the lexicon and of the letter model.
LEXICON, MODEL_WORDS = 5_000, 20_000
#: Letters of a word at the least; a single letter is none.
LEAST = 2
#: Letters of a token that are looked at before its skeleton is made.
HEAD = 4
#: A lexicon word is in at least so many toxic texts, and its log-odds have this lower confidence bound. No share of the toxic
#: texts is asked, as it would drop the words of smaller languages.
SUPPORT, BOUND = 5, 2.0
#: Words of clean texts: the upper confidence bound of their log-odds is below this, and together they weigh so much at most.
CALM, CALM_MOST = -0.5, 0.5
#: What characters stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c"}
SEPARATORS = " .-_*~'/\\,:;"
WORD = re.compile(r"[^\W\d_]+")
EDGES = " .,:;!?\"'()[]{}<>#%&*=~|+-_/\\$@"
#: Those of them that stand for no letter.
MARKS = "".join(c for c in EDGES if c not in LEET)
ODD = re.compile(r"[0-9@$!|+€£(<.\-_*~'/\\,:;]|(.)\1")
#: Between words of one token.
BETWEEN = re.compile(r"[.\-_*~'/\\,:;]+")
#: What stands for letters and is no digit: of digits alone a number is likelier.
SYMBOLS = frozenset(c for c in LEET if not c.isdigit())
CHANGE, DROP_SEPARATOR, DROP_REPEAT, KEEP_ODD = -1.0, -0.3, -0.7, -6.0
#: Characters that can stand for the same letter are one in a skeleton; separators and what repeats the last one are left out.
CLASSES = ("il1!|£", "o0", "z2", "e3€", "a4@", "s5$", "gb689", "t7+", "c(<")
SKELETON = str.maketrans({c: k[0] for k in CLASSES for c in k} | dict.fromkeys(SEPARATORS, ""))
REPEATED = re.compile(r"(.)\1+")
LONG_RUN = re.compile(r"(.)\1{3,}")


class LetterModel:
    """Letter trigrams with interpolation; characters outside a-z share one symbol."""

    def __init__(self, words: dict[str, int]):
        three, two, one = Counter(), Counter(), Counter()
        for word, n in words.items():
            s = "^^" + "".join(self.symbol(c) for c in word) + "$"
            for k in range(2, len(s)):
                three[s[k - 2 : k + 1]] += n
                two[s[k - 2 : k]] += n
                one[s[k]] += n
        self.three, self.two, self.one = dict(three), dict(two), dict(one)
        self.total = sum(one.values()) + 40

    @staticmethod
    def symbol(c: str) -> str:
        return c if "a" <= c <= "z" or c == "$" else "?"

    def score(self, before: str, c: str) -> float:
        c = self.symbol(c)
        low = (self.one.get(c, 0) + 1) / self.total
        return math.log((self.three.get(before + c, 0) + 4 * low) / (self.two.get(before, 0) + 4))


def restore(token: str, model: LetterModel) -> str:
    """Likeliest letters behind a token: one best path for each pair of last letters."""
    paths: dict[str, tuple[float, str]] = {"^^": (0.0, "")}
    for k, c in enumerate(token):
        options = [(x, CHANGE) for x in LEET.get(c, "")]
        if c in SEPARATORS:
            options.append(("", DROP_SEPARATOR))
        if k and c == token[k - 1]:
            options.append(("", DROP_REPEAT))
        options.append((c, 0.0 if c.isalpha() else KEEP_ODD))
        new: dict[str, tuple[float, str]] = {}
        for before, (score, text) in paths.items():
            for x, cost in options:
                after = before[1] + LetterModel.symbol(x) if x else before
                s = score + cost + (model.score(before, x) if x else 0.0)
                if after not in new or s > new[after][0]:
                    new[after] = (s, text + x)
        paths = new
    return max((score + model.score(before, "$"), text) for before, (score, text) in paths.items())[1]


def skeleton(token: str) -> str:
    """What a token and all it can be restored to have in common."""
    return REPEATED.sub(r"\1", token.translate(SKELETON))


class Reader:
    """Finds the lexicon words of a text, as they stand or restored."""

    def __init__(self, lexicon: dict[str, float], model: LetterModel, usual: frozenset[str] = frozenset(), calm: dict[str, float] | None = None):
        """usual: words that stand for themselves, so a stretch of them alone is not one spaced-out word. calm: words of clean
        texts, which are found too, as they stand."""
        self.lexicon, self.model, self.usual, self.calm = lexicon, model, usual, calm or {}
        self.bones = {skeleton(w) for w in lexicon}
        self.starts = {b[:k] for b in self.bones for k in range(1, len(b))}
        reader, leads = self, self.starts | self.bones

        class Heads(dict):
            """(skeleton so far, first letters of what follows) -> whether a lexicon word's may go on so."""

            def __missing__(self, key: tuple[str, str]) -> bool:
                if len(self) >= MEMO_LIMIT:
                    self.clear()
                value = self[key] = REPEATED.sub(r"\1", key[0] + skeleton(key[1])) in leads
                return value

        self.heads = Heads()

        class Memo(dict):
            def __missing__(self, token: str):
                if len(self) >= MEMO_LIMIT:
                    self.clear()
                value = self[token] = reader.read(token)
                return value

        self.memo = Memo()

    def read(self, token: str) -> tuple[tuple[str, ...], str] | None:
        """Lexicon and calm words of a token, and its skeleton if that starts a lexicon word's; None for neither."""
        plain = WORD.findall(token)
        found = {w for w in plain if w in self.lexicon}
        core = token.strip(EDGES)
        if core not in self.usual and ODD.search(token) and any(c.isalpha() or c in SYMBOLS for c in token):
            # The whole token, and each of its parts, as it may be several words.
            parts = [p for p in BETWEEN.split(token) if len(p) >= LEAST and p not in self.usual and ODD.search(p) and any(c.isalpha() or c in SYMBOLS for c in p)]
            for form in dict.fromkeys((core, token.strip(".,:;?\"'()[]{}#%&=~"), *parts, *(p.strip(EDGES) for p in parts))):
                if (w := self.restored(form)) is not None:
                    found.add(w)
        found.update(w for w in plain if w in self.calm)
        bone = next((b for b in (skeleton(token.strip(MARKS)), skeleton(core)) if b in self.starts), "") if self.may_go_on("", token) else ""
        return (tuple(sorted(found)), bone) if found or bone else None

    def may_go_on(self, bone: str, token: str) -> bool:
        """Whether the skeleton of a token, behind this one, may lead to a lexicon word; by its first letters, if it starts with letters or digits."""
        head = token[:HEAD]
        return not head.isalnum() or self.heads[bone, head]

    def restored(self, form: str) -> str | None:
        """The lexicon word that a stretch is restored to, if any."""
        if skeleton(form) not in self.bones:
            return None
        # More than three of a character in a row say no more than three: all but one are left out.
        w = restore(LONG_RUN.sub(r"\1\1\1", form), self.model)
        return w if w in self.lexicon else None

    def words(self, text: str | None) -> set[str]:
        if not text:
            return set()
        tokens = text.lower().split()
        found, starts = set(), []
        for k, v in enumerate(map(self.memo.__getitem__, tokens)):
            if v is not None:
                found.update(v[0])
                if v[1]:
                    starts.append((k, v[1]))
        for k, bone in starts:
            if k + 1 == len(tokens) or not self.may_go_on(bone, tokens[k + 1]):
                continue
            more = self.spaced(tokens, k, bone)
            if more is None:
                tokens = self.squeezed(tokens)
                return found.union(*(self.spaced(tokens, k, v[1]) for k, v in enumerate(map(self.memo.__getitem__, tokens)) if v and v[1]))
            found |= more
        return found

    @staticmethod
    def squeezed(tokens: list[str]) -> list[str]:
        """Without tokens of separators only, and with three at most in a row that stand for one and the same letter: more say no more."""
        out, last, run = [], "", 0
        for t in tokens:
            bone = skeleton(t.strip(MARKS))
            run = run + 1 if len(bone) == 1 and bone == last else 0
            if bone and run < 3:
                out.append(t)
            last = bone or last
        return out

    def spaced(self, tokens: list[str], k: int, bone: str) -> set[str] | None:
        """Lexicon words whose pieces are token k and those after it: the lattice goes on over the spaces between them as long as
        its skeleton starts a lexicon word's. One piece at least must be no word of its own. None if more than three tokens in a
        row add nothing to the skeleton: those tokens have to be squeezed."""
        found, still, pieces = set(), 0, [tokens[k].strip(EDGES) or tokens[k]]
        if skeleton(pieces[0]) != bone:
            pieces = [tokens[k].strip(MARKS)]
        for end in range(k + 1, len(tokens)):
            # A token's last mark may be a letter or a mark.
            forms = dict.fromkeys((tokens[end].strip(MARKS), tokens[end].strip(EDGES)))
            longer = {form: REPEATED.sub(r"\1", bone + skeleton(form)) for form in forms}
            for form, whole in longer.items():
                if whole in self.bones and any(len(p) < LEAST or p not in self.usual for p in (*pieces, form)) and (w := self.restored(" ".join((*pieces, form)))):
                    found.add(w)
            form = next((f for f, whole in longer.items() if whole in self.starts), None)
            if form is None:
                break
            still = still + 1 if longer[form] == bone else 0
            if still > 3:
                return None
            bone = longer[form]
            pieces.append(form)
        return found


def learn(docs: DataFrame, labels: DataFrame, allowed: Column) -> tuple[dict[str, float], dict[str, int], float, frozenset[str], dict[str, float]]:
    """Lexicon (word -> lower confidence bound of its log-odds), words of the letter model with counts, prior log-odds, usual words,
    calm words (word -> upper confidence bound of its log-odds).

    All labelled rows are learned from. Copies, exact or near, count once: texts that share the least hash of their five-word shingles are one,
    and a word counts once for each pair of neighbours that it first stands between in a text of a label.
    """
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").where(allowed)
    chosen = small(written(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-labels"))
    given = docs.select("doc_id", "text").where("text is not null").where(allowed).join(chosen, "doc_id").select("toxic", "text")

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            keys, sizes = [], []
            for text in batch.column(1).to_pylist():
                h = hashes.of([w.encode("utf-8", "surrogatepass") for w in text.lower().split()])
                keys.append(int(gram_hashes(h, min(5, len(h))).min().view(np.int64)) if len(h) else 0)
                sizes.append(len(h))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), batch.column(1)], ["toxic", "key", "size", "text"])

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Many words of one label stand in several texts of a batch.
            found = set()
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = ["", *WORD.findall(text.lower()), ""]
                first: dict[str, int] = {}
                for k in range(1, len(words) - 1):
                    if len(w := words[k]) >= LEAST and w not in first:
                        first[w] = zlib.crc32(f"{words[k - 1]} {words[k + 1]}".encode("utf-8", "surrogatepass"))
                found.update((toxic, w, near) for w, near in first.items())
            columns = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64()), strict=True)], ["toxic", "word", "near"])

    texts = given.mapInArrow(keyed, "toxic int, key long, size long, text string").groupBy("key").agg(F.max_by("text", F.struct("toxic", "size", "text")).alias("text"), F.max("toxic").alias("toxic"))
    texts = written(texts.select("toxic", "text"), "toxic-texts")
    places = texts.mapInArrow(placed, "toxic int, word string, near long").distinct()
    counts = written(places.groupBy("word").agg(F.sum("toxic").alias("a"), F.count("*").alias("n")), "toxic-words")
    whole = texts.agg(F.sum("toxic"), F.count("*")).first()
    toxic, clean = whole[0] or 0, (whole[1] or 0) - (whole[0] or 0)
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("a") + 0.5) / (clean + 1))
    doubt = 1.64 * F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("n") - F.col("a") + 0.5))
    bound = odds - doubt
    rated = counts.where(F.col("a") >= SUPPORT).select("word", "a", bound.alias("bound")).where(F.col("bound") > BOUND)
    lexicon = {r.word: (r.bound, r.a) for r in rated.orderBy(F.desc("bound"), "word").limit(LEXICON).collect()}
    calm = {r.word: r.bound for r in counts.select("word", (odds + doubt).alias("bound")).where(F.col("bound") < CALM).orderBy("bound", "word").limit(LEXICON).collect()}
    common = counts.orderBy(F.desc("n"), "word").limit(MODEL_WORDS).collect()
    model = {r.word: r.n for r in common}
    model |= {w: max(model.get(w, 0), 20 * a) for w, (_, a) in lexicon.items()}
    usual = frozenset(r.word for r in common if r.n - r.a >= SUPPORT and r.word not in lexicon)
    return {w: o for w, (o, _) in lexicon.items()}, model, math.log((toxic + 1) / (clean + 1)), usual, calm


def score(docs: DataFrame, labels: DataFrame, allowed: Column, threshold: float = 0.7) -> DataFrame:
    """doc_id, score (0 to 1), predicted, n_hits for each row of docs (doc_id, text).

    labels: doc_id, toxic; allowed: condition on doc_id for the rows that may be learned from. Null and empty texts have
    the score of a text without lexicon words; without labels that is 0.5 in all. Texts and tokens of any length are read whole.
    Repeated rows are scored alike; of words of equal odds the first by name come into the lexicon; further columns aren't read; an
    empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, allowed))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, words, prior, usual, calm = model.value
        reader = Reader(lexicon, LetterModel(words), usual, calm)

        def weight(found: list[str]) -> float:
            against = sum(calm[w] for w in found if w not in lexicon)
            return prior + sum(lexicon[w] for w in found if w in lexicon) + max(-CALM_MOST, against)

        for batch in batches:
            found = [sorted(reader.words(t)) for t in batch.column(1).to_pylist()]
            scores = [1 / (1 + math.exp(-min(30.0, weight(ws)))) for ws in found]
            found = [[w for w in ws if w in lexicon] for ws in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(list(map(len, found)), pa.int32())], ["doc_id", "score", "predicted", "n_hits"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, "doc_id long, score double, predicted int, n_hits int")
