"""Document transformations: an ordered registry, and the transformations that documents are published with."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType, VariantType

from tidewire.functions import documents as D
from tidewire.functions.names import column
from tidewire.operators.matching import matched, reached

Transform = Callable[[DataFrame], DataFrame]
#: A document's fields that its schema lacks, as JSON text of an object. What the transformations here do to fields they do to these, too.
REST = "_rest_of_document"
STAGES = ("pre_validation", "post_validation", "pre_publish")


class TransformError(Exception):
    """A transformation failed or didn't return a DataFrame."""


class Registry:
    """Ordered transformations for each stage and document type."""

    def __init__(self) -> None:
        self._by: dict[tuple[str, str], list[Transform]] = {}

    def register(self, stage: str, doc_type: str, fn: Transform, position: int | None = None) -> None:
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage!r}")
        fns = self._by.setdefault((stage, doc_type), [])
        fns.insert(len(fns) if position is None else min(position, len(fns)), fn)

    def registered(self, doc_type: str, *stages: str) -> bool:
        """Whether a document type has any transformation at these stages."""
        return any(self._by.get((stage, doc_type)) for stage in stages or STAGES)

    def clear(self, stage: str | None = None, doc_type: str | None = None) -> None:
        for key in [k for k in self._by if stage in (None, k[0]) and doc_type in (None, k[1])]:
            del self._by[key]

    def apply(self, df: DataFrame, stage: str, doc_type: str) -> DataFrame:
        def step(d: DataFrame, fn: Transform) -> DataFrame:
            try:
                out = fn(d)
            except Exception as e:
                raise TransformError(f"{getattr(fn, '__name__', fn)} failed: {e}") from e
            if not isinstance(out, DataFrame):
                raise TransformError(f"{getattr(fn, '__name__', fn)} returned {type(out).__name__}")
            return out

        return reduce(step, self._by.get((stage, doc_type), []), df)


def compose(*fns: Transform) -> Transform:
    def composed(df: DataFrame) -> DataFrame:
        return reduce(lambda d, f: f(d), fns, df)

    composed.__name__ = "_".join(["composed", *(f.__name__ for f in fns)])
    return composed


def without_fields(paths: Sequence[str], now: datetime | None = None) -> Transform:
    """Drop dotted paths; unknown ones and those under plain values are passed over."""

    def drop(kind: StructType, value: Column | None, under: list[list[str]]) -> list[Column]:
        out = []
        for f in kind.fields:
            mine = [p for p in under if p[0] == f.name]
            c = column(f.name) if value is None else value[f.name]
            if any(len(p) == 1 for p in mine):
                continue
            inner = [p[1:] for p in mine]
            if mine and isinstance(f.dataType, StructType):
                c = F.when(c.isNotNull(), F.struct(*drop(f.dataType, c, inner)))
            if mine and isinstance(f.dataType, VariantType):
                c = D.edited_variant(c, lambda v: D.without(v, inner))
            if value is None and f.name == REST and (rest := [p for p in under if p[0] not in kind.names]):
                c = D.edited(c, lambda v: D.without(v, rest))
            out.append(c.alias(f.name))
        return out

    def remove_fields(df: DataFrame) -> DataFrame:
        at = F.lit(now) if now else F.current_timestamp()
        kept = df.select(*drop(df.schema, None, [p.split(".") for p in paths if p != REST]))
        return kept.withColumn("_security_metadata", F.struct(F.array(*map(F.lit, paths)).alias("removed_fields"), at.alias("sanitized_at")))

    return remove_fields


def with_prefix(prefix: str, fields: Sequence[str] | None = None, now: datetime | None = None) -> Transform:
    """Rename fields to prefix_name: all at every struct level, or the listed original paths; names with _ first stay as they are.
    _security_metadata then tells of the prefix, in place of what it told before."""

    def rename(kind: StructType, value: Column | None, path: str) -> list[Column]:
        out = []
        for f in kind.fields:
            c = column(f.name) if value is None else value[f.name]
            own = f"{path}.{f.name}" if path else f.name
            if f.name == REST and value is None and (fields is None or any(p.split(".")[0] not in kind.names for p in fields)):
                c = D.edited(c, lambda v: D.with_prefixes(v, prefix, fields))
            if f.name.startswith("_"):
                out.append(c.alias(f.name))
                continue
            if isinstance(f.dataType, StructType):
                c = F.when(c.isNotNull(), F.struct(*rename(f.dataType, c, own)))
            if isinstance(f.dataType, VariantType):
                c = D.edited_variant(c, lambda v, own=own: D.with_prefixes(v, prefix, fields, own))
            out.append(c.alias(f"{prefix}_{f.name}" if fields is None or own in fields else f.name))
        return out

    def add_prefix(df: DataFrame) -> DataFrame:
        at = F.lit(now) if now else F.current_timestamp()
        listed = F.lit(None).cast("array<string>") if fields is None else F.array(*map(F.lit, fields))
        about = F.struct(F.lit(prefix).alias("field_prefix"), at.alias("prefixed_at"), listed.alias("prefixed_fields"))
        return df.select(*rename(df.schema, None, "")).withColumn("_security_metadata", about)

    return add_prefix


def with_processing_metadata(now: datetime | None = None, version: str = "1.0") -> Transform:
    def add_metadata(df: DataFrame) -> DataFrame:
        at = F.lit(now) if now else F.current_timestamp()
        return df.withColumn("_processing_metadata", F.struct(at.alias("processed_at"), F.lit(version).alias("processor_version")))

    return add_metadata


#: What the default transformations take out of transactions, and which of their fields they give the prefix.
PRIVATE = ("customer_email", "customer_phone", "customer.address", "payment.card_number", "payment.cvv", "shipping.address")
LOCAL = ("product_id", "warehouse_id", "location", "shelf")


def default_registry(warehouse: str, now: datetime | None = None) -> Registry:
    """The transformations that documents are published with: a warehouse's prefix, no private fields, processing metadata."""
    registry, prefix = Registry(), f"wh_{warehouse}_"
    registry.register("pre_publish", "inventory", with_prefix(prefix, now=now))
    registry.register("pre_publish", "transaction", without_fields(PRIVATE, now))
    registry.register("pre_publish", "transaction", with_prefix(prefix, LOCAL, now))
    for kind in ("inventory", "transaction"):
        registry.register("pre_publish", kind, with_processing_metadata(now))
    return registry


def not_cancelled(df: DataFrame, status: str = "status") -> DataFrame:
    """Without cancelled events, however the word is written; those without a status stay."""
    return df.where(F.col(status).isNull() | ~F.upper(F.trim(status)).isin("CANCELLED", "CANCELED"))


def normalised_numbers(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Columns as numbers, text with spaces around and thousands' commas too; what is no number becomes null."""
    return df.withColumns({c: F.translate(F.trim(F.col(c).cast("string")), ",", "").try_cast(kind) for c in columns})


#: Names that change streams use, and the columns and paths that they stand for here.
EVENT_PATHS = {"operationType": ["operation_type"], "fullDocument": ["full_document"], "documentKey._id": ["document_key"], "ns.coll": ["collection"], "clusterTime": ["cluster_time"]}
#: Operators on a column of a plain type, as conditions that a scan can be given.
PLAIN = {"$eq": lambda c, v: c.eqNullSafe(F.lit(v)), "$ne": lambda c, v: ~c.eqNullSafe(F.lit(v)), "$gt": lambda c, v: c > v, "$gte": lambda c, v: c >= v, "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v, "$in": lambda c, v: c.isin(list(v)), "$nin": lambda c, v: ~F.coalesce(c.isin(list(v)), F.lit(False)), "$exists": lambda c, v: c.isNotNull() if v else c.isNull(), "$regex": lambda c, v: c.rlike(v)}


def condition(df: DataFrame, spec: dict) -> Column:
    """The condition of a $match stage on a DataFrame's columns: those of plain types by their own comparisons, paths into documents (VARIANT, structs,
    maps, arrays, and the JSON of full_document) as in operators.matching."""

    def placed(path: list[str]) -> tuple[str, list[str]]:
        for name, at in EVENT_PATHS.items():
            own = name.split(".")
            if path[: len(own)] == own and own[0] not in df.columns and at[0] in df.columns:
                return at[0], path[len(own) :]
        return path[0], path[1:]

    def values(path: list[str]) -> Column:
        name, rest = placed(path)
        if name not in df.columns:
            return F.array().cast("array<variant>")
        kind, c = df.schema[name].dataType, column(name)
        if isinstance(kind, StructType | MapType | ArrayType):
            c = F.to_variant_object(c)
        elif isinstance(kind, StringType) and (name == "full_document" or rest):
            c = F.try_parse_json(c)
        elif not isinstance(kind, VariantType):
            c = c.cast("variant")
        return reached(c, rest)

    def plain(spec: dict, surely: bool) -> Column:
        """surely: never null, as a condition that is negated has to be."""
        out = F.lit(True)
        for key, want in spec.items():
            if key in ("$and", "$or", "$nor"):
                parts = [plain(s, surely or key == "$nor") for s in want]
                if not parts:
                    raise ValueError(f"{key} needs a list of conditions")
                out &= reduce(lambda a, b: a & b, parts) if key == "$and" else reduce(lambda a, b: a | b, parts) if key == "$or" else ~reduce(lambda a, b: a | b, parts)
                continue
            name, rest = placed(key.split("."))
            tests = want if isinstance(want, dict) and any(k.startswith("$") for k in want) else {"$eq": want}
            atomic = not rest and name in df.columns and name != "full_document" and not isinstance(df.schema[name].dataType, StructType | MapType | ArrayType | VariantType)
            if atomic and "$options" not in tests and all(op in PLAIN or op == "$not" and isinstance(v, dict) and set(v) <= set(PLAIN) for op, v in tests.items()):
                for op, v in tests.items():
                    made = ~reduce(lambda a, b: a & b, (F.coalesce(PLAIN[o](column(name), x), F.lit(False)) for o, x in v.items())) if op == "$not" else PLAIN[op](column(name), v)
                    out &= F.coalesce(made, F.lit(False)) if surely else made
            else:
                out &= matched({key: want}, values)
        return out

    return plain(spec, False)


def watch_filter(df: DataFrame, pipeline: Sequence[dict]) -> DataFrame:
    """A list of $match, $project, $unset, $addFields, $set and $replaceRoot stages as DataFrame operations."""
    value = lambda v: F.col(v[1:]) if isinstance(v, str) and v.startswith("$") else F.lit(v)
    for stage in pipeline:
        if not isinstance(stage, dict) or len(stage) != 1:
            raise ValueError("a pipeline stage is a dictionary with one key")
        (name, spec), = stage.items()
        match name:
            case "$match":
                df = df.where(condition(df, spec))
            case "$project":
                df = df.select(*(F.col(k) if v in (1, True) else value(v).alias(k) for k, v in spec.items())) if any(v not in (0, False) for v in spec.values()) else df.drop(*spec)
            case "$unset":
                df = df.drop(*([spec] if isinstance(spec, str) else spec))
            case "$addFields" | "$set":
                df = df.withColumns({k: value(v) for k, v in spec.items()})
            case "$replaceRoot":
                df = df.select(spec["newRoot"].removeprefix("$") + ".*")
            case _:
                raise ValueError(f"unknown pipeline stage {name!r}")
    return df
