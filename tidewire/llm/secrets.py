"""Secret scans: a random forest removes the false positives of a wide candidate pattern.

Candidates are long runs of key-like characters with a digit or a key's change of case, without the NAME= before them; values of
known prefixes; what is assigned to a key-like name, of any characters, up to its closing quote or the next white space; what follows
`Bearer`; and blocks of private keys. The forest sees length, character
transitions, dictionary coverage, surroundings that look like a path, and neighbouring words, and is
trained from labelled findings: (text, start, end, secret).
"""

from __future__ import annotations

import base64
import math
import random
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import chosen_by_hash

CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/=.@-])[A-Za-z0-9_+/=.@-]{16,}(?![A-Za-z0-9_+/=@-])")
#: What makes a part of a candidate one: a digit, or three changes from a small to a capital letter.
KEYLIKE = re.compile(r"[0-9]|(?:[^0-9]*?[a-z][A-Z]){3}")
#: Values that are told by their head.
PREFIXED = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{12,}|gh[pousr]_[A-Za-z0-9]{20,}|sk_live_[A-Za-z0-9]{16,}|sk-[A-Za-z0-9]{16,}|xox[bp]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{20,}|glpat-[A-Za-z0-9_-]{16,}|eyJ[A-Za-z0-9_.-]{16,})(?![A-Za-z0-9_+/=@-])")
#: A name and its '=' at the head of a candidate; the value is what follows.
NAMED = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*=(?=[^=])")
#: Values assigned to key-like names: a sign, the end of what stands before it, what stands behind it, and the most characters before.
SIGN = re.compile(r"=>|[=:]")
KEY_NAME = re.compile(r"(?i)(?:token|secret|password|passwd|passphrase|pwd|api[_-]?key|auth|bearer|credential|(?:private|access|secret|signing|encryption)[_-]?key|(?<![A-Za-z])pass)(?:s|[_-][a-z0-9_-]{0,32})?[\"']?[ \t]{0,3}\Z")
#: A quoted value to its closing quote, another one to white space, a quote, or the next name of a query string.
VALUE = re.compile(r"[ \t]{0,3}[\"'`]?((?<=\")[^\"\n]{8,}(?=\")|(?<=')[^'\n]{8,}(?=')|(?<=`)[^`\n]{8,}(?=`)|(?!>)(?:(?!&[A-Za-z_][A-Za-z0-9_.-]*=)[^\s\"'`]){7,}(?!&[A-Za-z_][A-Za-z0-9_.-]*=)[^\s\"'`,;:.)\]}>])")
BEARER = re.compile(r"(?i)(?<![A-Za-z])bearer[ \t]{1,3}([^\s\"'`]{7,}[^\s\"'`,;:.)\]}>])")
PEM, PEM_END = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"), re.compile(r"-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----")
BEFORE = 64
#: Neighbouring words that speak for or against a secret, and word parts of ordinary names besides the dictionary's.
FOR = {"token", "secret", "password", "pass", "passwd", "pwd", "key", "apikey", "api_key", "api", "auth", "bearer", "credential", "credentials", "private", "access", "access_key", "secret_key", "access_token", "client_secret"}
AGAINST = {"commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "hash", "uuid", "id", "rev", "revision", "version", "isbn", "phone", "example", "sample", "dummy", "placeholder", "test", "mail", "email", "see", "file", "path", "etag", "build"}
#: Labelled findings that a forest is trained from, about, if a table of them is given.
LABELLED = 20_000
#: Letters of a dictionary word at the least and at the most that are looked up.
SHORTEST, LONGEST = 4, 14
PARTS = ("http", "www", "com", "org", "net", "mail", "example", "user", "file", "image", "page", "index", "html", "json", "test", "home", "data", "src", "lib", "main", "conf", "version", "release", "build", "tion", "ing", "ent", "the", "and", "der", "sch", "est", "que", "les", "ado", "mente")
NEAR = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
FEATURES = ("length", "entropy", "digits", "upper", "lower", "symbols", "switches", "longest_letters", "longest_digits", "coverage", "hex", "slashes", "dots", "at_sign", "uuid", "path_before", "assigned", "quoted", "for_words", "against_words", "prefix")
PREFIXES = ("AKIA", "ghp_", "gho_", "sk_live_", "sk-", "xoxb-", "xoxp-", "AIza", "glpat-", "eyJ")


@lru_cache(4)
def dictionary(path: str | None = None) -> frozenset[str]:
    """Words in small letters: a public tokenizer's pieces of SHORTEST to LONGEST letters (path: its ranks), and PARTS."""
    import public_tokenizers

    pieces = (base64.b64decode(line.split()[0]).strip().lower() for line in open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))
    return frozenset(p.decode() for p in pieces if SHORTEST <= len(p) <= LONGEST and p.isalpha() and p.isascii()) | frozenset(PARTS)


def covered(token: str, words: frozenset[str]) -> int:
    """Characters of a token that are in dictionary words: from the left, the longest one each time."""
    k = total = 0
    while k < len(token):
        n = next((n for n in range(min(LONGEST, len(token) - k), 2, -1) if token[k : k + n] in words), 0)
        total += n
        k += n or 1
    return total


def kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def features(text: str, start: int, end: int) -> list[float]:
    token = text[start:end]
    n = len(token)
    kinds = [kind(c) for c in token]
    counts = [kinds.count(k) / n for k in range(4)]
    freq = [token.count(c) / n for c in set(token)]
    low = token.lower()
    longest = lambda pattern: max(map(len, re.findall(pattern, token)), default=0)
    before, after = text[max(0, start - 40) : start], text[end : end + 24]
    near = [w.lower() for w in NEAR.findall(before)[-3:]]
    return [
        n, -sum(f * math.log2(f) for f in freq), counts[0], counts[1], counts[2], counts[3],
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1), longest(r"[A-Za-z]+"), longest(r"[0-9]+"), covered(low, dictionary()) / n,
        float(bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", token))), token.count("/"), token.count("."), float("@" in token), float(bool(re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", token))),
        float(before.endswith(("://", "/", "\\"))), float(bool(re.search(r"[=:]\s*[\"']?$", before))), float(before[-1:] in "\"'`" and after[:1] in "\"'`" and bool(before)),
        sum(w in FOR or any(p in FOR for p in w.split("_")) for w in near), sum(w in AGAINST for w in near), float(token.startswith(PREFIXES)),
    ]


class Forest:
    """Random forest of Gini trees in numpy; a tree is an array of (feature, cut, left, right, share)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 25, depth: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.trees = []
        for _ in range(trees):
            pick = rng.integers(0, len(y), len(y))
            nodes: list[list[float]] = []
            self._grow(x[pick], y[pick], depth, rng, nodes)
            self.trees.append(np.array(nodes))

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator, nodes: list[list[float]]) -> int:
        k = len(nodes)
        nodes.append([-1, 0, 0, 0, float(y.mean())])
        if depth == 0 or len(y) < 6 or y.min() == y.max():
            return k
        best = (np.inf, -1, 0.0)
        for f in rng.choice(x.shape[1], max(1, int(math.sqrt(x.shape[1])) + 1), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            cut = np.flatnonzero(v[1:] > v[:-1])
            if not len(cut):
                continue
            n1 = cut + 1.0
            n2 = len(y) - n1
            p1, p2 = ones[cut] / n1, (ones[-1] - ones[cut]) / n2
            impurity = n1 * p1 * (1 - p1) + n2 * p2 * (1 - p2)
            j = int(impurity.argmin())
            if impurity[j] < best[0]:
                best = (float(impurity[j]), int(f), float(v[cut[j]] + v[cut[j] + 1]) / 2)
        if best[1] < 0:
            return k
        left = x[:, best[1]] <= best[2]
        nodes[k][:2] = [best[1], best[2]]
        nodes[k][2] = self._grow(x[left], y[left], depth - 1, rng, nodes)
        nodes[k][3] = self._grow(x[~left], y[~left], depth - 1, rng, nodes)
        return k

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for t in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                f = t[at, 0].astype(np.int64)
                inner = np.flatnonzero(f >= 0)
                if not len(inner):
                    break
                here = at[inner]
                at[inner] = np.where(x[inner, f[inner]] <= t[here, 1], t[here, 2], t[here, 3]).astype(np.int64)
            total += t[at, 4]
        return total / len(self.trees)


def example_findings(n: int = 3_000, seed: int = 13) -> list[tuple[str, int, int, bool]]:
    """Labelled findings made by rule: keys as they leak, and the look-alikes that wide patterns find."""
    r = random.Random(seed)
    chars = lambda alphabet, k: "".join(r.choice(alphabet) for _ in range(k))
    hexa, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    word = lambda: "".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ti", "es", "or", "te", "of", "ción", "sch"]) for _ in range(r.randint(1, 4)))
    prose = lambda: " ".join(word() for _ in range(r.randint(2, 6)))
    pieces = sorted(dictionary())
    out = []
    for k in range(n):
        if k % 2:
            name = r.choice(["token", "api_key", "secret", "password", "auth_token", "access_token", "client_secret", "private_key", "SECRET_KEY", "TOKEN", "API_KEY", "DB_PASS", "pass", "DB_PASSWORD", "pwd"])
            value = r.choice([lambda: chars(hexa, r.choice([32, 40, 40, 48, 64])), lambda: chars(hexa, 40).upper(), lambda: chars(alnum, r.randint(20, 64)), lambda: "AKIA" + chars("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16), lambda: "ghp_" + chars(alnum, 36), lambda: "sk_live_" + chars(alnum, 24), lambda: chars(alnum + "+/", 40) + "==", lambda: chars(alnum, r.randint(8, 15)), lambda: chars(alnum[:52], r.randint(12, 28)), lambda: "AKIA" + chars(alnum[:26], 16), lambda: word() + str(r.randint(1, 9999)) + word(), lambda: chars(alnum + "!&#$%^*?", r.randint(10, 24)), lambda: word() + r.choice("!&#$%") + chars(alnum + "!&#$%", r.randint(6, 12)), lambda: r.choice(pieces) + str(r.randint(0, 999)) + r.choice(["", "!", "#", "$"]) + r.choice(pieces), lambda: chars(alnum[26:], r.randint(9, 14))])()
            join = r.choice([' = "', '="', ": ", "=", ": '", " = '", ' = "', ' = "', "=", "="])
            if r.random() < 0.15 and (re.match("AKIA|ghp_|sk_live_", value) or len(value) >= 24 and value.isalpha()):
                name, join = word(), " "
            if r.random() < 0.05:
                name, join = r.choice(["Authorization: Bearer", "bearer"]), " "
            lead = r.choice(["", "", "", "export ", "http://" + word() + ".example.com/" + word() + "?", "x=1&"]) if join == "=" else ""
            before, after = f"{prose()} {lead}{name}{join}", join[-1].strip(" =:") + " " + prose()
            if r.random() < 0.03:
                lines = "\n".join(chars(alnum + "+/", 64) for _ in range(r.randint(2, 26)))
                label = r.choice(["", "RSA ", "EC ", "OPENSSH ", "ENCRYPTED "])
                before, value, after = prose() + " ", f"-----BEGIN {label}PRIVATE KEY-----\n{lines}\n-----END {label}PRIVATE KEY-----", "\n" + prose()
        else:
            before, value, after = r.choice([
                lambda: (prose() + ' the secret: "', prose(), '" '),
                lambda: (prose() + " ", f"{word()}.{r.randint(1, 99)}@mail{r.randint(1, 9)}.example.com", " "),
                lambda: (prose() + " ", chars("0123456789", r.choice([16, 16, 19, 20])), " "),
                lambda: (prose() + " commit ", chars(hexa, 40), " "),
                lambda: (prose() + " sha256: ", chars(hexa, 64), " "),
                lambda: (prose() + ' checksum = "', chars(hexa, r.choice([32, 40])), '" '),
                lambda: (prose() + " id = ", "-".join(chars(hexa, m) for m in (8, 4, 4, 4, 12)), " "),
                lambda: (prose() + " http:", f"//www.{word()}.example.com/{word()}/{r.randint(1, 9999)}/{word()}.html", " "),
                lambda: (prose() + " file ", f"/home/{word()}/src/{word()}{r.randint(1, 99)}/{word()}_{r.randint(1, 9)}.json", " "),
                lambda: (prose() + " ", f"{word()}_{word()}_{word()}{r.randint(1, 2030)}_{word()}", " "),
                lambda: (prose() + " version ", f"{r.randint(1, 20)}.{r.randint(0, 20)}.{r.randint(0, 99)}-release-build{r.randint(1, 999)}", " "),
                lambda: (prose() + ' password = "', f"example-{word()}-{word()}-placeholder{r.randint(0, 9)}", '" '),
                lambda: (f"{prose()} {r.choice(['token', 'password', 'secret', 'Auth', 'api_key'])}{r.choice([': ', '=', ' = '])}", f"{word()}{word()}{word()}{word()}ing", " "),
                lambda: (f"{prose()} {r.choice(['commit', 'id', 'etag', 'sha1', 'width'])}=", chars(hexa, r.choice([32, 40])), " "),
                lambda: (f"{prose()} {word()}=", f"{word()}-{word()}_{word()}.{r.randint(100, 9999)}", " "),
                lambda: (prose() + " ", f"{word()}{word()}{word()}{r.randint(0, 99)}{word()}{word()}", ". "),
                lambda: (prose() + " ", r.choice(["get", "set", "make"]) + "".join(r.choice(["Element", "Name", "Value", "Index", "Field", "With", "From", "Page", "Class", word().title()]) for _ in range(5)), "() "),
            ])()
        text, start, end = before + value + after, len(before), len(before) + len(value)
        # The spans are those that a scan finds.
        start, end = next(((a, b) for a, b in candidates(text) if a < end and start < b), (start, end))
        out.append((text, start, end, bool(k % 2)))
    return out


def assigned(text: str) -> list[tuple[int, int]]:
    """Start and end of each value that is assigned to a key-like name. Signs are few, so names are looked for before them alone."""
    out, end = [], 0
    for m in SIGN.finditer(text):
        if m.start() >= end and KEY_NAME.search(text, max(end, m.start() - BEFORE), m.start()) and (v := VALUE.match(text, m.end())):
            out.append(v.span(1))
            end = v.end()
    return out


def private_keys(text: str) -> list[tuple[int, int]]:
    """Blocks of private keys, to their last line; to the end of the text where that is missing."""
    out, end = [], 0
    while m := PEM.search(text, end):
        last = PEM_END.search(text, m.end())
        end = last.end() if last else len(text)
        out.append((m.start(), end))
    return out


def merged(first: list[tuple[int, int]], more: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order; of the second list those that overlap none of the first. Each list is in order."""
    free, k = [], 0
    for a, b in more:
        while k < len(first) and first[k][1] <= a:
            k += 1
        if k == len(first) or b <= first[k][0]:
            free.append((a, b))
    return sorted(first + free)


def candidates(text: str) -> list[tuple[int, int]]:
    """Start and end of each candidate, in order and apart from each other."""
    out = assigned(text)
    for found in ([m.span(1) for m in BEARER.finditer(text)] if "earer" in text.lower() else [], [m.span() for m in PREFIXED.finditer(text)]):
        out = merged(out, found)
    if "PRIVATE KEY-----" in text:
        blocks = private_keys(text)
        out = merged(blocks, merged([], out))
    values, k = list(out), 0
    for m in CANDIDATE.finditer(text):
        a, end = m.span()
        while k < len(values) and values[k][1] <= a:
            k += 1
        # What is assigned to a key-like name is a candidate already; what lies before and behind it may be another.
        holes = []
        for j in range(k, len(values)):
            if values[j][0] >= end:
                break
            holes.append(values[j])
        for lo, hi in zip([a, *(h for _, h in holes)], [*(v for v, _ in holes), end], strict=True):
            while n := NAMED.match(text, lo, hi):
                lo = n.end()
            if hi - lo >= 16 and KEYLIKE.search(text[lo:hi]):
                out.append((lo, hi))
    return sorted(out)


def train(findings: list[tuple[str, int, int, bool]]) -> Forest:
    x = np.array([features(t, a, b) for t, a, b, _ in findings])
    return Forest(x, np.array([float(s) for *_, s in findings]))


def spans(text: str | None, forest: Forest) -> list[tuple[int, int, float]]:
    """Candidates of a text with the forest's share of secret votes."""
    if not text:
        return []
    at = candidates(text)
    if not at:
        return []
    return [(a, b, float(p)) for (a, b), p in zip(at, forest.predict(np.array([features(text, a, b) for a, b in at])), strict=True)]


Findings = list[tuple[str, int, int, bool]]


def labelled_findings(labelled: DataFrame, rows: int = LABELLED) -> Findings:
    """About `rows` rows of a table (text, start, length, secret), chosen by a hash; rows with a null in any of them don't count."""
    labelled = labelled.select("text", F.col("start").cast("long").alias("start"), F.col("length").cast("long").alias("length"), F.col("secret").cast("boolean").alias("secret")).dropna()
    chosen = labelled.where(chosen_by_hash(F.xxhash64("text", "start", "length"), rows, labelled.count()))
    # Only what surrounds a finding is read.
    near = F.greatest(F.col("start") - 80, F.lit(0))
    cut = chosen.select(F.expr("substring(text, cast(greatest(start - 80, 0) + 1 as int), cast(length + 160 as int))").alias("text"), (F.col("start") - near).alias("start"), "length", "secret")
    return sorted((r.text, r.start, r.start + r.length, r.secret) for r in cut.collect())


def forest_of(labelled: DataFrame | Findings | None) -> Forest:
    """Trained from a table, a list, or the findings made by rule."""
    if isinstance(labelled, DataFrame):
        labelled = labelled_findings(labelled)
    return train(labelled or example_findings())


def findings(docs: DataFrame, labelled: DataFrame | Findings | None = None, threshold: float = 0.5) -> DataFrame:
    """doc_id, start, length, score, is_secret for each candidate in docs (doc_id, text); start counts characters from 0.

    labelled: findings the forest is trained from: a table (text, start, length, secret), of which about LABELLED rows are used, a list,
    or by default those of example_findings. Candidates have 16 characters at least, with a digit or three changes of case, or 8 of any kind after a key-like
    name or `Bearer`; values of known prefixes and blocks of private keys are candidates too. Null and empty texts and empty
    tables have no candidates. Repeated rows have theirs each; texts of any length are scanned whole; further columns aren't read.
    """
    forest = docs.sparkSession.sparkContext.broadcast(forest_of(labelled))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, a, b - a, p, p >= threshold) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for a, b, p in spans(text, forest.value)]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()], strict=True)], ["doc_id", "start", "length", "score", "is_secret"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, start long, length long, score double, is_secret boolean")


def redacted(docs: DataFrame, labelled: DataFrame | Findings | None = None, threshold: float = 0.5, mark: str = "[SECRET]") -> DataFrame:
    """docs with every secret of its text replaced by mark; all rows and columns stay, null texts too. labelled: as for findings."""
    forest = docs.sparkSession.sparkContext.broadcast(forest_of(labelled))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index("text")
            texts = batch.column(k).to_pylist()
            for i, text in enumerate(texts):
                parts, end = [], 0
                for a, b, p in spans(text, forest.value):
                    if p >= threshold:
                        parts += [text[end:a], mark]
                        end = b
                if parts:
                    texts[i] = "".join(parts) + text[end:]
            yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))

    return docs.mapInArrow(run, docs.schema)
