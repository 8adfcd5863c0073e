"""Versioned document contracts on JSON documents: rules compiled to one array of errors, and migration between versions."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The field that holds a document's version.
VERSION = "_schema_version"
RFC3339 = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$"


@dataclass(frozen=True)
class FieldRule:
    name: str
    kind: str = "string"
    required: bool = False
    minimum: int | None = None
    among: tuple[str, ...] = ()
    date_time: bool = False


#: The contracts, version 1.
CONTRACTS: dict[tuple[str, str], tuple[FieldRule, ...]] = {
    ("inventory", "v1"): (
        FieldRule("_schema_version", required=True, among=("v1",)),
        FieldRule("product_id", required=True),
        FieldRule("warehouse_id", required=True),
        FieldRule("quantity", "integer", True, minimum=0),
        FieldRule("last_updated", required=True, date_time=True),
        *map(FieldRule, ("category", "brand", "sku")),
        FieldRule("threshold_min", "integer", minimum=0),
        FieldRule("threshold_max", "integer", minimum=0),
    ),
    ("transaction", "v1"): (
        FieldRule("_schema_version", required=True, among=("v1",)),
        *(FieldRule(n, required=True) for n in ("transaction_id", "product_id", "warehouse_id")),
        FieldRule("quantity", "integer", True),
        FieldRule("transaction_type", required=True, among=("sale", "restock", "return", "adjustment")),
        FieldRule("timestamp", required=True, date_time=True),
        *map(FieldRule, ("order_id", "customer_id", "notes")),
    ),
}


def number_of(version: str) -> int:
    return int(version.removeprefix("v"))


class Contracts:
    def __init__(self, contracts: dict[tuple[str, str], tuple[FieldRule, ...]] | None = None):
        self.contracts = dict(CONTRACTS if contracts is None else contracts)

    def versions(self, doc_type: str) -> list[str]:
        return sorted((v for t, v in self.contracts if t == doc_type), key=number_of)

    def latest(self, doc_type: str) -> str:
        """By number: v10 is later than v9."""
        return self.versions(doc_type)[-1]

    def is_version(self, doc_type: str, version: str) -> bool:
        return (doc_type, version) in self.contracts

    def rules(self, doc_type: str, version: str | None = None) -> tuple[FieldRule, ...]:
        key = (doc_type, version or self.latest(doc_type))
        if key not in self.contracts:
            raise ValueError(f"Invalid schema version for {doc_type}: {key[1]}")
        return self.contracts[key]


def doc_type_of(collection: Column) -> Column:
    return F.when(collection == "inventory", "inventory").otherwise("transaction")


def errors(json: Column, rules: tuple[FieldRule, ...], strict_times: bool = True) -> Column:
    """Names of broken rules of a JSON object, as 'field: rule'; a text that isn't a JSON object breaks 'document: object'.

    Required asks for the key; a null breaks the type. Integers may be written 1.0 but not true. The document is parsed once: the rules read a lambda's variable.
    """
    parsed = F.array(F.try_parse_json(json))
    return F.element_at(F.transform(parsed, lambda doc: _broken(doc, rules, strict_times)), 1)


def _broken(doc: Column, rules: tuple[FieldRule, ...], strict_times: bool) -> Column:
    fields = {r.name: F.try_variant_get(doc, f"$.{r.name}", "variant") for r in rules}
    return F.when(_is_object(doc), _broken_rules(fields, rules, strict_times)).otherwise(F.array(F.lit("document: object")))


def _is_object(doc: Column) -> Column:
    return F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))


def _broken_rules(fields: dict[str, Column], rules: tuple[FieldRule, ...], strict_times: bool = True) -> Column:
    """Broken rules of a document's fields, each a variant that is null where the document lacks it."""
    found = []
    for r in rules:
        value = fields[r.name]
        kind = F.schema_of_variant(value)
        here = value.isNotNull()
        text = F.try_variant_get(value, "$", "string")
        number = F.try_variant_get(value, "$", "double")
        if r.required:
            found.append(F.when(value.isNull(), F.lit(f"{r.name}: required")))
        if r.kind == "integer":
            numeric = kind.rlike("^(BIGINT|DECIMAL.*|DOUBLE)$") & (number % 1 == 0)
            found.append(F.when(here & ~F.coalesce(numeric, F.lit(False)), F.lit(f"{r.name}: integer")))
            if r.minimum is not None:
                found.append(F.when(here & numeric & (number < r.minimum), F.lit(f"{r.name}: minimum")))
        else:
            found.append(F.when(here & ~F.coalesce(kind == "STRING", F.lit(False)), F.lit(f"{r.name}: string")))
        if r.among:
            found.append(F.when(here & ~F.coalesce(text.isin(*r.among), F.lit(False)), F.lit(f"{r.name}: enum")))
        if r.date_time and strict_times:
            real = text.rlike(RFC3339) & F.try_to_timestamp(F.substring(text, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNotNull()
            found.append(F.when((kind == "STRING") & ~F.coalesce(real, F.lit(False)), F.lit(f"{r.name}: date-time")))
    return F.array_compact(F.array(*found))


def _with_fields(df: DataFrame, json: str, names: set[str]) -> tuple[DataFrame, dict[str, Column]]:
    """df with each document parsed once and each field taken out of it once; they stand in projections of their own."""
    names = sorted(names)
    df = df.withColumn("_doc", F.try_parse_json(json))
    df = df.withColumns({f"_field{k}": F.try_variant_get("_doc", f"$.{n}", "variant") for k, n in enumerate(names)})
    return df, {n: F.col(f"_field{k}") for k, n in enumerate(names)}


def once(found: Column) -> Column:
    """As it is, but computed where it stands: a filter on it isn't pushed below, where each use would read the documents again,
    and a function of Python isn't called again by each use."""
    return F.when(F.monotonically_increasing_id() >= 0, found)


def with_broken(df: DataFrame, json: str, rules: tuple[FieldRule, ...], out: str = "errors") -> DataFrame:
    """df with the broken rules of the JSON documents in a column, as errors() gives them."""
    parsed, fields = _with_fields(df, json, {r.name for r in rules})
    return parsed.select(*df.columns, once(F.when(_is_object(F.col("_doc")), _broken_rules(fields, rules)).otherwise(F.array(F.lit("document: object")))).alias(out))


def validated(df: DataFrame, json: str, doc_type: Column, contracts: Contracts | None = None, out: str = "errors") -> DataFrame:
    """df with the broken rules of each document by the contract of its own type and version in a column.

    A document whose _schema_version is missing, null or empty is read by the latest contract; one with a version that has none
    breaks 'Invalid schema version for <type>: <version>'.
    """
    contracts = contracts or Contracts()
    kinds = sorted({t for t, _ in contracts.contracts})
    parsed, fields = _with_fields(df, json, {r.name for rules in contracts.contracts.values() for r in rules} | {VERSION})
    version = F.nullif(F.try_variant_get(fields[VERSION], "$", "string"), F.lit(""))
    latest = reduce(lambda c, kind: F.when(doc_type == kind, contracts.latest(kind)).otherwise(c), kinds, F.lit(None).cast("string"))
    parsed = parsed.withColumns({"_kind": doc_type, "_version": F.coalesce(version, latest), "_object": _is_object(F.col("_doc"))})
    # Each contract in a column of its own, read by its documents alone. The version chooses it, so the version's own rule is met.
    each = {f"_broken{k}": (kind, v) for k, (kind, v) in enumerate((kind, v) for kind in kinds for v in contracts.versions(kind))}
    mine = lambda kind, v: F.col("_object") & (F.col("_kind") == kind) & (F.col("_version") == v)
    parsed = parsed.withColumns({name: F.when(mine(kind, v), _broken_rules(fields, tuple(r for r in contracts.rules(kind, v) if r.name != VERSION))) for name, (kind, v) in each.items()})
    unknown = F.when(F.col("_kind").isin(kinds), F.concat(F.lit("Invalid schema version for "), "_kind", F.lit(": "), "_version")).otherwise(F.concat(F.lit("unknown document type: "), F.coalesce("_kind", F.lit("null"))))
    found = F.when(~F.col("_object"), F.array(F.lit("document: object"))).otherwise(F.coalesce(*each, F.array(unknown)))
    return parsed.select(*df.columns, once(found).alias(out))


class Migrations:
    """Functions DataFrame -> DataFrame between versions of a document type, composed along the shortest path."""

    def __init__(self) -> None:
        self._edges: dict[str, dict[tuple[str, str], Callable[[DataFrame], DataFrame]]] = {}

    def register(self, doc_type: str, old: str, new: str, fn: Callable[[DataFrame], DataFrame]) -> None:
        self._edges.setdefault(doc_type, {})[old, new] = fn

    def path(self, doc_type: str, old: str, new: str) -> list[tuple[str, str]]:
        edges = self._edges.get(doc_type, {})
        todo, seen = deque([(old, [])]), {old}
        while todo:
            at, steps = todo.popleft()
            if at == new:
                return steps
            for a, b in edges:
                if a == at and b not in seen:
                    seen.add(b)
                    todo.append((b, [*steps, (a, b)]))
        raise ValueError(f"no migration of {doc_type} from {old} to {new}")

    def versions(self, doc_type: str) -> list[str]:
        """Versions that some migration starts from or leads to."""
        return sorted({v for edge in self._edges.get(doc_type, {}) for v in edge}, key=number_of)

    def apply(self, df: DataFrame, doc_type: str, new: str, versions: list[str] | None = None, column: str = VERSION) -> DataFrame:
        """Rows of each version (by default all that migrations know) migrate apart and meet again by name; a missing or empty version counts as v1.

        No row is lost: those of other versions, or without a path, keep what they have and say so in _migration_error.
        """
        df = df.withColumn(column, F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit("v1")))
        none = F.lit(None).cast("string")
        out = df.where(F.col(column) == new).withColumn("_migration_error", none)
        done = [new]
        for old in versions if versions is not None else self.versions(doc_type):
            if old == new:
                continue
            try:
                steps = self.path(doc_type, old, new)
            except ValueError:
                continue
            part = df.where(F.col(column) == old)
            for step in steps:
                part = self._edges[doc_type][step](part)
            out = out.unionByName(part.withColumn(column, F.lit(new)).withColumn("_migration_error", none), allowMissingColumns=True)
            done.append(old)
        lost = F.concat(F.lit(f"no migration of {doc_type} from "), F.col(column), F.lit(f" to {new}"))
        return out.unionByName(df.where(~F.col(column).isin(done)).withColumn("_migration_error", lost), allowMissingColumns=True)
