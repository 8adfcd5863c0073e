"""Personal data by bootstrapping: what the base rules find are seeds, their contexts induce patterns, and patterns that hold find further identifiers.

Base spans: email, ip, card and phone by fixed expressions and checks. A candidate is a number of MIN_DIGITS to MAX_DIGITS digits with the letters and digits that touch it,
or a mail address that the base misses (`name (at) host (dot) org`, `name@host`). A pattern is what stands around a mention: the word before,
the two before, the word before and the one behind. Patterns and instances (texts without separators, in small letters) are a graph, each pair
counted once however often copies repeat it. Each round scores patterns by the instances of a kind among all of theirs (the lower end of
Wilson's interval), and instances by the patterns that hold (noisy or); found instances count in the next round. Seeds are never
scored anew, so base spans stay.

Null texts are empty. Equal rows are scanned each and get the same spans. Texts are scanned whole, in time linear in their length. A mention of an instance
that ties between kinds takes the first of KINDS. No documents: no rows; without seeds nothing is added. Further columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import small, utf8, written

#: In the order of results.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Digits of a candidate.
MIN_DIGITS, MAX_DIGITS = 5, 32
#: Instances of its kind that a pattern needs, how sure it must be, and how sure an instance. Eight of eight instances are 0.68 sure.
SUPPORT, PATTERN_SURE, INSTANCE_SURE, Z = 8, 0.5, 0.6, 2.0
ROUNDS = 6

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
NUMBERS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARDS = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONES = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CANDIDATES = re.compile(r"[0-9](?:[ ().-]{0,2}[0-9])++")
AT = re.compile(r" ?[\[(] ?(?:at|AT) ?[\])] ?|@")
LOOSE_HOST = re.compile(r"[A-Za-z0-9-]++(?: ?(?:\.|[\[(] ?(?:dot|DOT) ?[\])]) ?[A-Za-z0-9-]++)*+")
TOKENS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]")
WORD = re.compile(r"[A-Za-z0-9_]*+")
SEPARATORS = re.compile(r"[\s().\[\]-]+")
#: Characters of a text that are looked at before and behind a mention.
BEFORE, BEHIND = 48, 32

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of the mail expression: each has one @, so the local part is what fits between the last match, or the last @, and it."""
    end, last, at = 0, 0, text.find("@")
    while at >= 0:
        low = max(end, last)
        start = low + len(text[low:at].rstrip(LOCAL))
        if start < at and (m := HOST.match(text, at + 1)):
            yield EMAIL, start, m.end()
            end = m.end()
        last, at = at + 1, text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    found = list(emails(text))
    for m in NUMBERS.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((IP, m.start(), m.end()))
    for m in CARDS.finditer(text):
        digits = digits_of(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((CARD, m.start(), m.end()))
    if "+" in text:
        found += ((PHONE, m.start(), m.end()) for m in PHONES.finditer(text) if 8 <= len(digits_of(m.group())) <= 15)
    return found


def candidates(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """Places of candidates that touch no base span, in order of their kind of search; numbers in order of place."""
    taken = sorted((s, e) for _, s, e in base)

    def free(found: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        k = 0
        for s, e in found:
            while k < len(taken) and taken[k][1] <= s:
                k += 1
            if k == len(taken) or taken[k][0] >= e:
                yield s, e

    def numbers() -> Iterator[tuple[int, int]]:
        end = 0
        for m in CANDIDATES.finditer(text):
            if m.start() < end or len(m.group()) < MIN_DIGITS:
                continue
            start = m.start()
            while start > end and (c := text[start - 1]).isascii() and (c.isalnum() or c == "_"):
                start -= 1
            end = WORD.match(text, m.end()).end()
            if MIN_DIGITS <= sum("0" <= c <= "9" for c in text[start:end]) <= MAX_DIGITS:
                yield start, end

    def mails() -> Iterator[tuple[int, int]]:
        last = 0
        for m in AT.finditer(text):
            start = last + len(text[last : m.start()].rstrip(LOCAL))
            if start < m.start() and (host := LOOSE_HOST.match(text, m.end())):
                yield start, host.end()
            last = m.end()

    yield from free(numbers())
    if "@" in text or "at)" in text or "at]" in text or "AT)" in text or "AT]" in text or "at )" in text or "at ]" in text:
        yield from free(mails())


def instance_of(text: str) -> str:
    """Mails start with m, numbers with n; letters are small, separators left out."""
    at = AT.sub("@", text)
    return ("m:" if "@" in at else "n:") + SEPARATORS.sub("" if "@" not in at else ".", at).strip(".").lower()


def contexts(text: str, start: int, end: int) -> list[str]:
    """The patterns of a place: words and signs around it, in small letters, numbers as 0; ^ and $ are the ends of a text."""
    low, high = max(0, start - BEFORE), min(len(text), end + BEHIND)
    before = ["0" if t[0].isdigit() else t for t in TOKENS.findall(text[low:start].lower())]
    if low and before:
        before = before[1:]  # may be cut
    behind = TOKENS.findall(text[end:high].lower())
    one = before[-1] if before else "^"
    two = before[-2] if len(before) > 1 else "^"
    after = ("0" if behind[0][0].isdigit() else behind[0]) if behind else "$"
    return [f"{one} _", f"{two} {one} _", f"{one} _ {after}"]


MENTION = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, mentions, _row (its number) of each document: its base spans (kind) and candidates (kind null), with instance and patterns. Written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in utf8(batch.column("text")):
                text = raw.decode(errors="replace") if raw else ""
                base = base_spans(text)
                places = [(k, s, e) for k, s, e in base] + [(None, s, e) for s, e in candidates(text, base)]
                out.append([{"kind": k, "start": s, "end": e, "instance": instance_of(text[s:e]), "patterns": contexts(text, s, e)} for k, s, e in places])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(MENTION))], ["doc_id", "mentions"])

    rows = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, mentions array<struct<kind:int,start:int,end:int,instance:string,patterns:array<string>>>")
    return written(rows.withColumn("_row", F.monotonically_increasing_id()), "mentions")


def wilson(hits: Column, of: Column) -> Column:
    """The lower end of Wilson's interval for a share, at Z deviations."""
    share, z2 = hits / of, Z * Z
    return (share + z2 / (2 * of) - Z * F.sqrt((share * (1 - share) + z2 / (4 * of)) / of)) / (1 + z2 / of)


def bootstrapped(mentions: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """instance, kind, score: unseen identifiers, from mentions (kind: null for candidates; instance; patterns). Each round is a written table; it
    ends when a round finds nothing more, or after so many rounds."""
    edges = mentions.select("instance", "kind", F.explode(F.array_distinct("patterns")).alias("pattern")).groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    edges = written(edges, "edges")
    # A pattern of fewer instances can't hold, and one without candidates finds nothing.
    useful = edges.groupBy("pattern").agg(F.count("*").alias("n"), F.count_if(F.col("kind").isNull()).alias("open")).where((F.col("n") > SUPPORT) & (F.col("open") > 0)).select("pattern")
    edges = written(edges.join(small(written(useful, "useful")), "pattern", "left_semi"), "useful-edges")
    votes = mentions.where("kind is not null").groupBy("instance", "kind").agg(F.count("*").alias("n"))
    seeds = written(votes.groupBy("instance").agg(F.max_by("kind", F.struct("n", -F.col("kind"))).alias("kind")).withColumn("score", F.lit(1.0)), "seeds")
    edges = edges.select("pattern", "instance")
    found, size = None, 0
    for _ in range(rounds):
        known = seeds if found is None else seeds.union(found)
        weight = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0))
        scored = edges.join(known, "instance", "left").groupBy("pattern").agg(F.count("*").alias("n"), *(weight(k).alias(f"w{k}") for k in range(len(KINDS))))
        top = reduce(lambda a, b: F.greatest(a, b), (F.struct(F.col(f"w{k}").alias("w"), F.lit(-k).alias("k")) for k in range(len(KINDS))))
        held = scored.withColumn("top", top).where(F.col("top.w") >= SUPPORT).select("pattern", (-F.col("top.k")).alias("kind"), wilson(F.col("top.w"), F.col("n")).alias("sure"))
        held = small(written(held.where(F.col("sure") >= PATTERN_SURE), "patterns"))
        fits = (F.col("kind") == EMAIL) == F.col("instance").startswith("m:")
        unseen = edges.join(held, "pattern").where(fits).join(seeds.select("instance"), "instance", "left_anti")
        each = unseen.groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("sure"))))).alias("score")).where(F.col("score") >= INSTANCE_SURE)
        found = written(each.groupBy("instance").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"), F.max("score").alias("score")), "found")
        before, size = size, found.count()
        if size == before:
            break
    return found


def spans_text(spans: Column) -> Column:
    """kind:start:end of spans, by kind as listed, then start, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    text = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return F.array_join(text, ",")


def found_in(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all, the method's too), n_added; one row a document."""
    scans = scanned(docs)
    mentions = scans.select("_row", F.explode("mentions").alias("m")).select("_row", "m.*")
    found = small(bootstrapped(mentions).select("instance", F.col("kind").alias("_kind")))
    added = mentions.where("kind is null").join(found, "instance").groupBy("_row").agg(F.collect_list(F.struct(F.col("_kind").alias("kind"), "start", "end")).alias("added"))
    added = written(added, "added")
    base = F.transform(F.filter("mentions", lambda m: m["kind"].isNotNull()), lambda m: F.struct(m["kind"], m["start"], m["end"]))
    out = scans.select("doc_id", "_row", base.alias("base")).join(small(added), "_row", "left")
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    kinds = F.transform("base", lambda m: m["kind"])
    counts = [F.size(F.array_remove(kinds, k)).cast("long") for k in range(len(KINDS))]
    counts = [(F.size("base") - n).alias(f"n_{name}") for n, name in zip(counts, KINDS, strict=True)]
    more = F.coalesce("added", none)
    return out.select("doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.concat("base", more)).alias("spans"), F.size(more).cast("long").alias("n_added"))
