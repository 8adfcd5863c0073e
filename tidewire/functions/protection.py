"""Field-level data protection as Column expressions: none, remove, hash, mask, truncate, generalize, encrypt, tokenize.

Everything fails closed: a value that can't be protected becomes null, and a rule that can't be applied raises. The strongest of
several matching rules wins by rank, and the first added on ties.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, NumericType, StringType, StructType, VariantType

from tidewire.functions import documents as D
from tidewire.functions.names import column

#: From weakest to strongest.
LEVELS = ("none", "truncate", "generalize", "mask", "tokenize", "hash", "encrypt", "remove")


#: Hash names with a built-in function; every other name that hashlib has runs as a vectorised UDF.
BUILT_IN: dict[str, Callable[[Column], Column]] = {"md5": F.md5, "sha1": F.sha1} | {f"sha{n}": (lambda text, n=n: F.sha2(text, n)) for n in (224, 256, 384, 512)}


def base64_of(raw: Column) -> Column:
    """In one line; Spark breaks long ones."""
    return F.translate(F.base64(raw), "\r\n", "")


def hashed(value: Column, path: str | Column = "", algorithm: str = "sha256") -> Column:
    """hash: and the base 64 of the digest of path and value."""
    text = F.concat(F.lit(path) if isinstance(path, str) else path, value.cast("string"))
    if algorithm in BUILT_IN:
        return F.concat(F.lit("hash:"), base64_of(F.unhex(BUILT_IN[algorithm](text))))
    if algorithm not in hashlib.algorithms_available or algorithm.startswith("shake"):
        raise ValueError(f"unknown hash {algorithm!r}")

    @F.pandas_udf("binary")
    def digest(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield s.map(lambda x: None if x is None else hashlib.new(algorithm, x.encode()).digest())

    return F.concat(F.lit("hash:"), base64_of(digest(text)))


def masked(value: Column, left: int = 0, right: int | None = None, char: str = "X") -> Column:
    """Middle characters become char; four stay on the right when neither side is given."""
    right = (4 if left == 0 else 0) if right is None else right
    text = value.cast("string")
    n = F.length(text)
    shown_left = F.least(F.lit(left), n)
    shown_right = F.least(F.lit(right), n - shown_left)
    return F.concat(F.left(text, shown_left), F.repeat(F.lit(char), n - shown_left - shown_right), F.when(shown_right > 0, F.right(text, shown_right)).otherwise(""))


def truncated(value: Column, most: int = 10, suffix: str = "...") -> Column:
    text = value.cast("string")
    cut = F.lit(suffix) if most <= len(suffix) else F.concat(F.left(text, F.lit(most - len(suffix))), F.lit(suffix))
    return F.when(F.length(text) <= most, text).otherwise(cut)


def ranged(value: Column, ranges: Sequence[tuple[float, float, str]], other: str = "other") -> Column:
    out = F.lit(other)
    for low, high, label in reversed(ranges):
        out = F.when(value.between(low, high), label).otherwise(out)
    return F.when(value.isNotNull(), out)


def rounded(value: Column, places: int = 0) -> Column:
    """Half-even."""
    return F.bround(value, places)


def categorised(value: Column, categories: dict[str, str], rules: Sequence[tuple[str, str]] = ()) -> Column:
    """An exact category, else the rules (regular expression, replacement) in turn."""
    text = out = value.cast("string")
    for pattern, replacement in rules:
        out = F.regexp_replace(out, pattern, replacement)
    for key, label in categories.items():
        out = F.when(text == key, label).otherwise(out)
    return out


UNITS = ("year", "month", "quarter")


def dated(value: Column, unit: str) -> Column:
    """year, month or quarter of a date."""
    if unit not in UNITS:
        raise ValueError(f"unknown unit {unit!r}")
    if unit == "quarter":
        return F.concat(F.year(value).cast("string"), F.lit("-Q"), F.quarter(value).cast("string"))
    return F.date_format(value, {"year": "yyyy", "month": "yyyy-MM"}[unit])


def tokenized(value: Column, path: str | Column = "", prefix: str = "TOK", length: int = 10) -> Column:
    """prefix, _ and the first characters of the hash's base 64."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.substring_index(hashed(value, path), ":", -1), 1, length))


def derived_key(password: str, salt: bytes, rounds: int = 100_000) -> bytes:
    return hashlib.pbkdf2_hmac("sha256", password.encode(), salt, rounds, 32)


def encrypted(value: Column, key: bytes, context: str | Column = "") -> Column:
    """enc: and AES-GCM in base 64, different at every call; context is authenticated."""
    sealed = F.aes_encrypt(F.encode(value.cast("string"), "UTF-8"), F.lit(key), F.lit("GCM"), F.lit("DEFAULT"), F.lit(b""), F.lit(context.encode()) if isinstance(context, str) else F.encode(context, "UTF-8"))
    return F.concat(F.lit("enc:"), base64_of(sealed))


def decrypted(value: Column, key: bytes, context: str = "") -> Column:
    raw = F.unbase64(F.substring(value, 5, 2**30))
    return F.decode(F.aes_decrypt(raw, F.lit(key), F.lit("GCM"), F.lit("DEFAULT"), F.lit(context.encode())), "UTF-8")


#: Options of each level; a generalization needs one of its own.
OPTIONS = {
    "none": (), "remove": (), "hash": ("salt", "algorithm"), "mask": ("left", "right", "char"), "truncate": ("most", "suffix"),
    "tokenize": ("prefix", "length"), "encrypt": (), "generalize": ("ranges", "places", "categories", "rules", "unit"),
}

Matcher = str | re.Pattern | Callable[[str], bool]


@dataclass(frozen=True)
class Rule:
    """matcher: dotted path with * and [*], a compiled pattern (matched from the start), or a function of the path."""

    matcher: Matcher
    level: str
    options: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.level not in LEVELS:
            raise ValueError(f"unknown protection level {self.level!r}")
        if not self.matcher:
            raise ValueError("a rule needs a matcher")
        if unknown := set(self.options) - set(OPTIONS[self.level]):
            raise ValueError(f"{self.level} has no option {sorted(unknown)[0]!r}")
        if self.level == "generalize" and not self.options:
            raise ValueError("generalize needs one of " + ", ".join(OPTIONS["generalize"]))
        if self.options.get("unit", "year") not in UNITS:
            raise ValueError(f"unknown unit {self.options['unit']!r}")


def level_name(rule: Rule | None) -> str:
    """The level of a rule as text; none without one."""
    return rule.level if rule else "none"


def segments(path: str) -> list[str]:
    return re.findall(r"[^.\[\]]+|\[[^.\[\]]+\]", path)


def path_matches(path: str, matcher: Matcher) -> bool:
    """Segments must be equally many; * stands for one name, [*] for one index."""
    if not path or not matcher:
        return False
    if callable(matcher):
        return bool(matcher(path))
    if isinstance(matcher, re.Pattern):
        return matcher.match(path) is not None
    own, wanted = segments(path), segments(matcher)
    fits = lambda a, b: a == b or (b == "*" and a[0] != "[") or (b == "[*]" and a[0] == "[")
    return len(own) == len(wanted) and all(map(fits, own, wanted))


def by_strength(rules: Sequence[Rule]) -> list[Rule]:
    """Strongest first; equally strong ones as they were added."""
    return sorted(rules, key=lambda r: -LEVELS.index(r.level))


def chosen_rule(path: str, rules: Sequence[Rule]) -> Rule | None:
    return next((r for r in by_strength(rules) if path_matches(path, r.matcher)), None)


@dataclass(frozen=True)
class Path:
    """Where a value stands. names: field names, and None for an array's index or a map's key, which each row has its own of."""

    names: tuple[str | None, ...] = ()
    kinds: tuple[str, ...] = ()  # name, index or key
    own: tuple[Column | None, ...] = ()

    def field(self, name: str) -> Path:
        return Path((*self.names, name), (*self.kinds, "name"), (*self.own, None))

    def index(self, k: Column) -> Path:
        return Path((*self.names, None), (*self.kinds, "index"), (*self.own, F.concat(F.lit("["), k.cast("string"), F.lit("]"))))

    def key(self, k: Column) -> Path:
        return Path((*self.names, None), (*self.kinds, "key"), (*self.own, k.cast("string")))

    @property
    def fixed(self) -> bool:
        return None not in self.names

    def text(self) -> str:
        """As rules are written, with [*] and * for what rows have their own of."""
        parts = [n if n is not None else {"index": "[*]", "key": "*"}[k] for n, k in zip(self.names, self.kinds, strict=True)]
        return "".join(p if p.startswith("[") or not i else f".{p}" for i, p in enumerate(parts))

    def column(self) -> Column:
        """Each row's path."""
        parts = []
        for i, (n, k, c) in enumerate(zip(self.names, self.kinds, self.own, strict=True)):
            parts += [F.lit(".")] if i and k != "index" else []
            parts.append(F.lit(n) if c is None else c)
        return F.concat(*parts)

    def fits(self, matcher: Matcher) -> bool | Column:
        """Whether a matcher fits: known from the schema, or told for each row."""
        if self.fixed:
            return path_matches(self.text(), matcher)
        if isinstance(matcher, str):
            wanted, rest = segments(matcher), []
            if len(wanted) != len(self.names):
                return False
            for w, n, k, c in zip(wanted, self.names, self.kinds, self.own, strict=True):
                if n is not None:
                    if n != w and w != "*":
                        return False
                elif w != {"index": "[*]", "key": "*"}[k]:
                    if (w[0] == "[") != (k == "index"):
                        return False
                    rest.append(c == w)
            return reduce(lambda a, b: a & b, rest) if rest else True
        if isinstance(matcher, re.Pattern):
            flags = "".join(f for f, on in (("i", re.IGNORECASE), ("m", re.MULTILINE), ("s", re.DOTALL), ("x", re.VERBOSE)) if matcher.flags & on)
            return self.column().rlike(f"^(?{flags}:{matcher.pattern})" if flags else f"^(?:{matcher.pattern})")
        raise ValueError(f"a function can't tell the paths below {self.text()!r}, which each row has its own of: give a path or a pattern")


#: Paths whose rule a worker remembers; documents whose leaves it holds at once.
PATHS, WALKED = 100_000, 1_000
LEAF = "struct<rule:int,path:string,text:string>"


class Rules:
    """Which rule holds for a path of a document, as a place in `rules`, strongest first; remembered."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = by_strength(rules)
        self._known: dict[tuple[str, bool], int] = {}

    def of(self, path: str, leaf: bool) -> int:
        """-1: none. Of objects and arrays only a rule that names them holds."""
        if (found := self._known.get((path, leaf))) is None:
            if len(self._known) >= PATHS:
                self._known.clear()
            fits = (k for k, r in enumerate(self.rules) if path_matches(path, r.matcher) and (leaf or _names(r, path)))
            found = next(fits, -1)
            found = self._known[path, leaf] = found if found < 0 or self.rules[found].level != "none" else -1
        return found


def _names(rule: Rule, path: str) -> bool:
    """Whether a rule is a path whose last segment is no * or [*]."""
    return isinstance(rule.matcher, str) and segments(rule.matcher)[-1] not in ("*", "[*]")


class Protector:
    """Applies rules to the leaves of a DataFrame's schema: fields of structs, elements of arrays, values of maps; and to those of documents of any
    shape: JSON text by documents(), columns of VARIANT as they stand.

    What a schema tells is made of Column expressions alone. There a rule whose path names an object, an array or a map raises, as only leaves are
    protected; so does a function as matcher where a path depends on the row, and a VARIANT inside an array or a map. keep: columns, or first
    names of documents, that aren't looked into.

    Documents and VARIANTs are walked one by one, whatever types their fields have: each leaf by the rule of its own path. An object or an array
    whose path a rule names can't be protected and is left out.
    """

    def __init__(self, rules: Sequence[Rule], key: bytes | None = None, keep: Sequence[str] = ()):
        self.rules, self.key, self.keep = list(rules), key, set(keep)

    def _leaf(self, value: Column, kind: DataType, path: str | Column, rule: Rule) -> Column:
        o = rule.options
        match rule.level:
            case "remove":
                return F.lit(None).cast(kind)
            case "hash":
                return hashed(value, path if o.get("salt", True) else "", o.get("algorithm", "sha256"))
            case "mask":
                return masked(value, o.get("left", 0), o.get("right"), o.get("char", "X"))
            case "truncate":
                return truncated(value, o.get("most", 10), o.get("suffix", "..."))
            case "tokenize":
                return tokenized(value, path, o.get("prefix", "TOK"), o.get("length", 10))
            case "encrypt":
                if self.key is None:
                    raise ValueError("encryption needs a key")
                return encrypted(value, self.key, path)
            case "generalize":
                if "ranges" in o:
                    return ranged(value.try_cast("double"), o["ranges"])
                if "unit" in o:
                    return dated(F.try_to_timestamp(value.cast("string")), o["unit"])
                if "places" in o:
                    # Text is read as a number; what is none is lost, not shown.
                    return rounded(value if isinstance(kind, NumericType) else value.try_cast("double"), o["places"])
                return categorised(value, o.get("categories", {}), o.get("rules", ()))
        return value

    def documents(self, text: Column, prefix: str = "", noted: bool = False) -> Column:
        """text: JSON with its leaves protected; fields: path -> level of those that a rule held for, also written to the document as _protected where
        noted. prefix: where the value itself stands.

        Leaves with a rule are taken out, protected by Column expressions, and put in again. Null and what is no JSON become null.
        """
        if self.key is None and any(r.level == "encrypt" for r in self.rules):
            raise ValueError("encryption needs a key")
        rules, keep = Rules(self.rules), frozenset(self.keep)

        def walked(x: str, put: Callable[[Rule, str, object], object]) -> object:
            """A document with what put() makes of each value with a rule; the value itself stands below prefix."""

            def visit(path: str, v: object, leaf: bool) -> object:
                k = rules.of(path, leaf)
                return D.STAYS if k < 0 else put(rules.rules[k], path, v)

            value = D.loads(x)
            return D.rewritten({prefix: value}, visit).get(prefix, D.GONE) if prefix else D.rewritten(value, visit, keep=keep)

        @F.pandas_udf(f"array<{LEAF}>")
        def taken(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            def one(x: str | None) -> list[dict]:
                found: list[dict] = []

                def note(rule: Rule, path: str, v: object) -> object:
                    found.append({"rule": rules.rules.index(rule), "path": path, "text": _own_hash(rule, path, _text(v))})
                    return None

                if x is not None and _is_json(x):
                    walked(x, note)
                return found

            for s in texts:
                for k in range(0, len(s), WALKED):
                    yield s.iloc[k : k + WALKED].map(one)

        @F.pandas_udf("struct<text:string,fields:map<string,string>>")
        def put(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            def one(x: str | None, made: Sequence[str | None]) -> tuple[str | None, dict[str, str]]:
                fields, new = {}, iter(made)

                def fill(rule: Rule, path: str, v: object) -> object:
                    out = _put(rule, v, next(new))
                    fields[path] = "remove" if out is D.GONE else rule.level
                    return out

                if x is None or not _is_json(x):
                    return None, {}
                value = walked(x, fill)
                if noted and fields and isinstance(value, dict):
                    value["_protected"] = dict(sorted(fields.items()))
                return None if value is D.GONE else D.dumps(value), fields

            for texts, made in frames:
                for k in range(0, len(texts), WALKED):
                    rows = [one(x, n) for x, n in zip(texts.iloc[k : k + WALKED], made.iloc[k : k + WALKED], strict=True)]
                    yield pd.DataFrame({"text": [r[0] for r in rows], "fields": [r[1] for r in rows]})

        def one(leaf: Column) -> Column:
            new = F.lit(None).cast("string")
            for k, rule in enumerate(rules.rules):
                if rule.level in ("none", "remove"):
                    continue
                made = leaf["text"] if _by_hand(rule) else self._leaf(leaf["text"], StringType(), leaf["path"], rule).cast("string")
                if "places" in rule.options:
                    whole = leaf["text"].try_cast("bigint")
                    made = F.when(leaf["text"].rlike("^-?[0-9]{1,18}$"), rounded(whole, rule.options["places"]).cast("string")).otherwise(made)
                new = F.when(leaf["rule"] == k, made).otherwise(new)
            return new

        return put(text, F.transform(taken(text), one))

    def protected_documents(self, df: DataFrame, name: str, where: Column | None = None) -> DataFrame:
        """df with the JSON documents of a column protected (where: only these), _protected among their fields where a rule held."""
        at = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
        made = self.documents(F.when(at, column(name)), noted=True)["text"]
        return df.withColumn(name, F.when(at, made).otherwise(column(name)))

    def _options(self, path: Path) -> list[tuple[Rule, bool | Column]]:
        """Rules that fit or may fit, strongest first, up to the first that surely does."""
        out = []
        for rule in by_strength(self.rules):
            fits = path.fits(rule.matcher)
            if fits is not False:
                out.append((rule, fits))
            if fits is True:
                break
        return out

    def _value(self, value: Column, kind: DataType, path: Path, found: dict[str, str]) -> tuple[Column | None, Column | None]:
        """The protected value (None: leave it out), and where only rows tell: when to leave it out."""
        if isinstance(kind, StructType | ArrayType | MapType):
            named = [r for r in self.rules if isinstance(r.matcher, str) and r.level != "none" and segments(r.matcher)[-1] not in ("*", "[*]") and (path.fits(r.matcher) is True or "*" not in r.matcher and path.fits(r.matcher) is not False)]
            if named:
                raise ValueError(f"rule {named[0].matcher!r} names {path.text()!r}, which is no leaf: give rules for what is in it")
            return self._inner(value, kind, path, found), None
        if isinstance(kind, VariantType):
            if not path.fixed:
                raise ValueError(f"{path.text()!r} is a VARIANT inside an array or a map, which can't be looked into: give the document as JSON text")
            made = self.documents(F.to_json(value), path.text())
            self._walked.append(made["fields"])
            return F.try_parse_json(made["text"]), None
        options = self._options(path)
        if not options or options[0][0].level == "none" and options[0][1] is True:
            return value, None
        found[path.text()] = options[0][0].level
        at = path.text() if path.fixed else path.column()
        if options[0][1] is True:
            return (None, None) if options[0][0].level == "remove" else (self._leaf(value, kind, at, options[0][0]), None)
        # Each row's path chooses; what is protected as text makes all of them text.
        parts = [(fits, rule, self._leaf(value, kind, at, rule)) for rule, fits in options]
        text = any(rule.level not in ("none", "remove") for _, rule, _ in parts)
        cast = (lambda c: c.cast("string")) if text else (lambda c: c)
        out, gone = cast(value), F.lit(False)
        for fits, rule, made in reversed(parts):
            when = F.lit(True) if fits is True else F.coalesce(fits, F.lit(True))
            out = F.when(when, cast(made)).otherwise(out)
            gone = F.when(when, F.lit(rule.level == "remove")).otherwise(gone)
        return out, gone

    def _inner(self, value: Column, kind: DataType, path: Path, found: dict[str, str]) -> Column:
        if isinstance(kind, StructType):
            kept = []
            for f in kind.fields:
                c, _ = self._value(value[f.name], f.dataType, path.field(f.name), found)
                if c is not None:
                    kept.append(c.alias(f.name))
            return F.when(value.isNotNull(), F.struct(*kept)) if kept else F.lit(None)
        if isinstance(kind, ArrayType):

            def element(x: Column, k: Column) -> Column:
                c, _ = self._value(x, kind.elementType, path.index(k), found)
                return F.lit(None).cast(kind.elementType) if c is None else c

            return F.transform(value, element)

        def entry(e: Column) -> Column:
            c, gone = self._value(e["value"], kind.valueType, path.key(e["key"]), found)
            c = F.lit(None).cast(kind.valueType) if c is None else c
            return F.struct(e["key"].alias("key"), c.alias("value"), (F.lit(False) if gone is None else gone).alias("gone"))

        # Every value under a rule that fits all keys is left out.
        whole = self._options(path.key(F.lit("")))
        if whole and whole[0][1] is True and whole[0][0].level == "remove" and not isinstance(kind.valueType, StructType | ArrayType | MapType):
            found[path.key(F.lit("")).text()] = "remove"
            return F.when(value.isNotNull(), F.create_map().cast(kind))
        entries = F.filter(F.transform(F.map_entries(value), entry), lambda e: ~e["gone"])
        return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["value"])))

    def __call__(self, df: DataFrame) -> DataFrame:
        """Protected columns, and _protected: path -> level, when some rule applies."""
        found: dict[str, str] = {}
        self._walked: list[Column] = []
        cols = []
        for f in df.schema.fields:
            c = column(f.name)
            if f.name not in self.keep:
                c, _ = self._value(c, f.dataType, Path().field(f.name), found)
            if c is not None:
                cols.append(c.alias(f.name))
        if found or self._walked:
            known = F.create_map(*(F.lit(x) for kv in sorted(found.items()) for x in kv)).cast("map<string,string>")
            cols.append(F.map_concat(known, *self._walked).alias("_protected"))
        return df.select(*cols)


def _by_hand(rule: Rule) -> bool:
    """Whether a rule's hash has no built-in function."""
    return rule.level == "hash" and rule.options.get("algorithm", "sha256") not in BUILT_IN


def _own_hash(rule: Rule, path: str, text: str | None) -> str | None:
    """text, or its hash where no built-in function makes it."""
    if text is None or not _by_hand(rule):
        return text
    digest = hashlib.new(rule.options["algorithm"], ((path if rule.options.get("salt", True) else "") + text).encode()).digest()
    return "hash:" + base64.b64encode(digest).decode()


def _text(value: object) -> str | None:
    """A leaf as text; null for objects, arrays and null."""
    return None if value is None or isinstance(value, dict | list) else str(value).lower() if isinstance(value, bool) else str(value)


def _is_json(text: str) -> bool:
    try:
        D.loads(text)
    except ValueError:
        return False
    return True


def _put(rule: Rule, old: object, new: str | None) -> object:
    """What stands in a document for a protected value: nothing for what is removed and for objects and arrays, null for what can't be protected."""
    if rule.level == "remove" or isinstance(old, dict | list):
        return D.GONE
    if old is None or new is None:
        return None
    return D.Number(new) if "places" in rule.options else new


def contains(names: str) -> re.Pattern:
    """A path with one of these names anywhere in it, in small letters or capitals."""
    return re.compile(f".*({names}).*", re.IGNORECASE)


#: Rules for personal data and for payments.
PII_RULES = (
    Rule(contains("email"), "mask", {"left": 2, "right": 0, "char": "*"}),
    Rule(contains("phone"), "mask", {"right": 4, "char": "*"}),
    # Postal codes come before numbers, which they are, too.
    Rule(contains("address"), "generalize", {"rules": ((r"\b\d{5}(-\d{4})?\b", "[POSTAL]"), (r"\b\d+\b", "[NUMBER]"), (r"(?i)\b(apt|unit|suite|#)\s*[-#]?\s*\w+\b", "[UNIT]"))}),
    Rule("*.card_number", "mask", {"right": 4, "char": "X"}),
    Rule(contains("cvv|cvc|security_code"), "remove"),
    Rule(contains("ssn|social_security"), "remove"),
)
PAYMENT_RULES = (
    Rule(contains("card.*number"), "mask", {"right": 4, "char": "X"}),
    Rule(contains("cvv|cvc|security_code"), "remove"),
    Rule(contains("expiry|expiration"), "generalize", {"unit": "month"}),
    Rule(contains("amount|total|price"), "generalize", {"places": 0}),
)
