"""Spelling variants, conversation tries and personal data: brute force, odd inputs, and cases made for each."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import pii, prefix_trie, spelling

# Spelling variants


def one_edit(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    if len(x) > len(y):
        x, y = y, x
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute_variants(counts, times=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if counts[v] >= times * counts[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items())


def made_words(seed, n, letters="abé", low=1, high=7):
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randint(low, high))) for _ in range(n)}
    return {w: rng.choice([5, 5, 6, 7, 30, 31, 200, 1200]) for w in sorted(words)}


@pytest.mark.parametrize(("group", "rows"), [(20_000, 100_000), (3, 100_000), (3, 1), (1, 7)])
def test_variants_brute_force(spark, monkeypatch, group, rows):
    """Words of few letters, where nearly all are near; windows halved down to single positions, blocks of a group each."""
    monkeypatch.setattr(spelling, "BLOCK_ROWS", rows)
    counts = made_words(group + rows, 260) | made_words(3, 40, "xy", 20, 23) | {"z" * 300: 9, "z" * 299: 50, "z" * 150 + "y" + "z" * 149: 8}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    monkeypatch.setattr(spelling, "near", lambda w, near=spelling.near: near(w, group))
    got = sorted(map(tuple, spelling.variants(words).collect()), key=lambda r: r[0])
    assert got == brute_variants(counts)


def test_wavelet_reports_rectangles():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 64, 65, 500):
        values = rng.permutation(n)
        tree = spelling.Wavelet(values)
        low, least = rng.integers(0, n, 40), rng.integers(0, n, 40)
        high, end = low + rng.integers(0, n - low + 1), least + rng.integers(0, n - least + 1)
        q, v = tree.report(low, high, least, end)
        want = [(k, x) for k in range(40) for x in values[low[k] : high[k]] if least[k] <= x < end[k]]
        assert sorted(zip(q.tolist(), v.tolist(), strict=True)) == sorted(want)


def brute_words(docs, letters, least, every):
    total = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if every and h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= letters:
                total[w] += 1
    return {w: n for w, n in total.items() if n >= least}


def test_words_are_counted_in_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 3)
    rng = random.Random(1)
    docs = [(i, " ".join("".join(rng.choices("aBÉé", k=rng.randint(1, 5))) + rng.choice(["", "_", "9", "ĀŸ", "×"]) for _ in range(60))) for i in range(40)]
    docs += [(7, None), (8, ""), (None, "abab " * 9), (9, "×÷ß " * 30), (9, "×÷ß " * 30), (10, "a" * 150_000 + " end"), (11, "\x00aaa\U0001f600aaa")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, word string").repartition(4)
    got = dict(map(tuple, spelling.counted(df, 3, 2, 3).collect()))
    assert got == brute_words(docs, 3, 2, 3)
    assert dict(map(tuple, spelling.counted(df, 4, 1).collect())) == brute_words(docs, 4, 1, 0)


def test_ties_and_chains_of_forms(spark):
    counts = {"colour": 1000, "color": 1000, "coloor": 5, "colooor": 5, "abcdef": 1, "abcdeg": 5, "abcdeh": 25, "xbcdeh": 125, "lonely": 3}
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got["coloor"].form == "color" and got["colooor"].form is None and got["colour"].form is None
    assert got["abcdef"].form == "abcdeh" and got["abcdef"].root == "xbcdeh"
    assert (got["lonely"].form, got["lonely"].root, got["lonely"].n_near) == (None, "lonely", 0)


def test_no_words(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.counted(none, 6, 5, 199)).count() == 0
    alone = spark.createDataFrame([(1, "single " * 5)], "doc_id long, text string")
    assert [tuple(r) for r in spelling.variants(spelling.counted(alone, 6, 5)).collect()] == [("single", None, "single", 5, 0, None)]


# Conversation tries


def brute_trie(convs):
    """convs: conv_id -> list of (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        ends[tuple(convs[c])].append(c)
    children = Counter(q[:-1] for q in members if q)
    leaves, saved = Counter(), Counter()
    for q, m in members.items():
        for d in range(len(q) + 1):
            leaves[q[:d]] += not children[q]
            saved[q[:d]] += (len(m) - 1) * len(q[-1][1].encode()) if q else 0
    return sorted((m[0], len(q), members[q[:-1]][0] if q else None, len(m), children[q], leaves[q], saved[q], hashlib.sha256(",".join(map(str, ends[q])).encode()).hexdigest()) for q, m in members.items())


def brute_graft(rows, base, head):
    token = lambda r, t: hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{t or ''}".encode()).hexdigest()
    plain = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            plain[c].append((turn is not None, turn or 0, role or "", token(role, text), text or ""))
    ordered = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in plain.items()}
    return {c: (ordered.get(base(c), [])[: head(c)]) + own[head(c) :] for c, own in ordered.items()}


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def tried(spark, rows, base, head):
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "conv_id long, turn long, role string, text string, digest string, depth int").repartition(6)
    turns, convs = prefix_trie.grafted(prefix_trie.ordered(df), base, head)
    return sorted((tuple(r) for r in prefix_trie.trie(turns, convs).select(*COLUMNS).collect()), key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize(("block", "ends"), [(1024, 200_000), (2, 1), (1, 4)])
def test_trie_brute_force(spark, monkeypatch, block, ends):
    """Conversations of one to nine turns of few texts, many of them copies, one long, with turns in blocks of every size."""
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "ENDS", ends)
    rng = random.Random(block)
    rows = []
    for c in range(-7, 70):
        same = rng.random() < 0.3
        rows += [(c, k if rng.random() < 0.95 else None, rng.choice(["user", "user", None]), "hello" if same else rng.choice(["a", "é", "", None, "long " * 50])) for k in range(rng.randint(1, 9))]
    rows += [(500, k, "user", f"turn {k // 3}") for k in range(60)] + [(503, k, "user", f"turn {k // 3}") for k in range(40)]
    rows += [(600, None, None, None)] * 3 + [(None, 1, "user", "nobody's")] * 2
    mod = lambda c: c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
    head = lambda c: zlib.crc32(str(c).encode()) % 9
    got = tried(spark, rows, F.col("conv_id") - F.col("conv_id") % 5, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9)
    assert got == sorted(brute_trie(brute_graft(rows, mod, head)), key=lambda r: (r[1], r[0]))


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "b"), (2, 1, "bot", "c")]
    got = tried(spark, rows, F.lit(99), F.lit(1))
    nothing = hashlib.sha256(b"").hexdigest()
    assert got == [(1, 0, None, 2, 1, 1, 0, hashlib.sha256(b"1").hexdigest()), (2, 1, 1, 1, 0, 1, 0, hashlib.sha256(b"2").hexdigest())]
    assert nothing not in {r[-1] for r in got}


def test_turns_of_other_lengths_are_told_apart(spark):
    """("ab", "c") and ("a", "bc") are different turns."""
    got = tried(spark, [(1, 0, "ab", "c"), (2, 0, "a", "bc")], F.lit(0), F.lit(0))
    assert [r[1] for r in got] == [0, 1, 1]


def test_no_conversations(spark):
    assert tried(spark, [(None, 1, "user", "x")], F.lit(0), F.lit(0)) == []


# Personal data

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_base(text):
    out = []
    for kind, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m.group())
            if kind == pii.IP and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == pii.CARD and not (16 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0):
                continue
            if kind == pii.PHONE and not 8 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_brute_force():
    rng = random.Random(4)
    for letters in ("a@.-", "a@.1", "012.", "19.5 ", "+12 ()-.", "4 -10", "é@a.b", "0123456789", "25+. (0"):
        for _ in range(1500):
            text = "".join(rng.choices(letters, k=rng.randint(0, 40)))
            assert sorted(pii.base_spans(text)) == sorted(brute_base(text)), text
    for text in ("4111 1111-1111 1111", "x+1 (555) 010-9999y", "a@b.c@d.e", "001.002.0000000003.255 256.1.1.1.1", "mail a.b+c@x-y.org."):
        assert sorted(pii.base_spans(text)) == sorted(brute_base(text))


@pytest.mark.parametrize("text", ["9" * 400_000, "1." * 200_000, "a" * 300_000 + "@", "a@" * 200_000, "+1" + "(" * 300_000, "+" * 300_000, "1 " * 200_000, "(at) " * 60_000, "9a" * 150_000])
def test_long_texts_take_linear_time(text):
    began = time.perf_counter()
    base = pii.base_spans(text)
    list(pii.candidates(text, base))
    assert time.perf_counter() - began < 5


def found(spark, docs, **kw):
    df = spark.createDataFrame([(i, t, 3, "y") for i, t in docs], "doc_id long, text string, n_email int, spans string").repartition(3)
    return {r.doc_id: r for r in pii.found_in(df).collect()}


def number(k):
    return f"+1 (555) {k % 900 + 100}-{7 * k % 9000 + 1000}"


def test_patterns_find_unseen_identifiers(spark):
    """Phones without + stand where phones do; a second pattern is only learned from what the first one found."""
    docs = [(k, f"some words here. call me at: {number(k)} today") for k in range(60)]
    docs += [(100 + k, f"some words here. call me at: 555-{k + 100}-{3 * k + 2000} today") for k in range(9)]
    docs += [(200 + k, f"my extension reads 555-{k + 100}-{3 * k + 2000} sometimes") for k in range(9)]
    docs += [(300, "my extension reads 777-123-4567 sometimes"), (301, "order number 12345678 shipped"), (302, "built in 1998"), (303, None), (304, "")]
    got = found(spark, docs)
    assert all(got[k].n_phone == 1 and got[k].n_added == 0 for k in range(60))
    text = docs[60][1]
    at = text.index("555-")
    assert got[100].spans == f"phone:{at}:{at + len('555-100-2000')}" and got[100].n_phone == 0
    assert all(got[100 + k].n_added == 1 for k in range(9))
    assert all(got[200 + k].n_added == 1 for k in range(9))
    assert got[300].n_added == 1
    assert [got[k].spans for k in (301, 302, 303, 304)] == [""] * 4
    assert got[303].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_one_round_finds_less(spark):
    docs = [(k, f"call me at: {number(k)} today") for k in range(60)] + [(100 + k, f"call me at: 555-{k + 100}-{3 * k + 2000} today") for k in range(9)]
    docs += [(200 + k, f"my extension reads 555-{k + 100}-{3 * k + 2000} sometimes") for k in range(9)] + [(300, "my extension reads 777-123-4567 sometimes")]
    scans = pii.scanned(spark.createDataFrame(docs, "doc_id long, text string"))
    mentions = scans.select(F.explode("mentions").alias("m")).select("m.*")
    score = lambda rounds: {r.instance for r in pii.bootstrapped(mentions, rounds).collect()}
    assert "n:7771234567" not in score(1) and "n:7771234567" in score(6) and len(score(1)) == 9


def test_mails_that_the_base_misses(spark):
    docs = [(k, f"write to person{k}@host{k}.example.org soon") for k in range(40)] + [(100, "write to jane.doe (at) example (dot) org soon"), (101, "write to root@localhost soon"), (102, "write to 12345678 soon")]
    got = found(spark, docs)
    assert [got[k].spans for k in (100, 101, 102)] == ["email:9:40", "email:9:23", ""]


def test_patterns_of_mixed_kinds_find_nothing(spark):
    """Where mails, addresses, cards and phones stand alike, a number that is none of them stays out."""
    card = lambda k: next(f"4{k:014d}{c}" for c in range(10) if pii.luhn(f"4{k:014d}{c}"))
    docs = [(k, "value is " + (f"p{k}@x{k}.org", f"10.1.{k}.7", card(k), number(k))[k % 4]) for k in range(120)]
    docs += [(200 + k, f"value is {k + 10_000_000}") for k in range(30)]
    got = found(spark, docs)
    assert all(got[k].n_added == 0 for k, _ in docs)
    assert all(got[k].n_email + got[k].n_ip + got[k].n_card + got[k].n_phone >= 1 for k in range(120))


def test_pii_odd(spark):
    odd = [(1, None), (2, ""), (3, " \n"), (4, "word " * 30_000 + "a@b.cd"), (6, "é 10.0.0.1"), (6, "é 10.0.0.1"), (7, "\U0001f600 \x00 a@b.cd"), (None, "a@b.cd")]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in odd], "doc_id long, text string, kind string, start int")
    rows = sorted(((str(r.doc_id), r.n_email, r.n_ip, r.spans) for r in pii.found_in(df).collect()))
    assert rows == [("1", 0, 0, ""), ("2", 0, 0, ""), ("3", 0, 0, ""), ("4", 1, 0, "email:150000:150006"), ("6", 0, 1, "ip:2:10"), ("6", 0, 1, "ip:2:10"), ("7", 1, 0, "email:4:10"), ("None", 1, 0, "email:0:6")]
    assert pii.found_in(df.limit(0)).count() == 0
