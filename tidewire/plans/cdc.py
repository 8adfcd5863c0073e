"""The change-data plan: events are deduplicated, transformed, migrated, validated, protected, enveloped and routed; invalid ones are set aside.

The order: deduplication, transformations before validation, migration, those after it, validation of each document by its own
version, transformations and protection before publishing, the envelope. What is published is the document so made.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegralType, LongType, MapType, NumericType, StringType, StructField, StructType, VariantType

from tidewire.functions.names import column, struct_of
from tidewire.functions.protection import Protector
from tidewire.functions.serialization import JSON_OPTIONS, iso_time, serialized
from tidewire.operators.keyed import fresh
from tidewire.operators.transforms import REST, Registry
from tidewire.operators.validation import VERSION, Contracts, Migrations, doc_type_of, once, validated
from tidewire.session import ship
from tidewire.sources.scratch import written

EVENT = ("resume_token", "collection", "operation_type", "document_key", "cluster_time", "full_document")
#: Where an event's other columns wait while its document is transformed.
HELD = "_change_event"


def dedup_key(collection: Column, key: Column, operation: Column) -> Column:
    return F.when(key.isNotNull() & (key != ""), F.concat_ws(":", collection, key, operation))


def deduplicated(events: DataFrame, arrival: str = "resume_token", bucket: Column | None = None) -> DataFrame:
    """The first change of each key and operation, and those newer than all before them; bucket: of arrival, as for keyed.running, where a key has too
    many changes for one task."""
    keyed = events.withColumn("_key", dedup_key(F.col("collection"), F.col("document_key"), F.col("operation_type")))
    return fresh(keyed, ["_key"], "cluster_time", arrival, bucket).drop("_key")


def looked_up(events: DataFrame, current: DataFrame) -> DataFrame:
    """Updates without a document get the current one of their collection and key (current: collection, document_key, document; one row each)."""
    now = current.select(F.col("collection").alias("_c"), F.col("document_key").alias("_k"), F.col("document").alias("_doc"))
    joined = events.join(now, (events.collection == F.col("_c")) & (events.document_key == F.col("_k")), "left")
    return joined.withColumn("full_document", F.coalesce("full_document", F.when(F.col("operation_type") == "update", F.col("_doc")))).drop("_c", "_k", "_doc")


@dataclass
class Plan:
    """What is done to documents; by default they are validated and published as they are.

    protectors: by document type. schemas: the fields of a type's documents that transformations read as columns, by default those of its contracts
    (text and whole numbers; a VARIANT where versions differ). What a schema lacks is kept in the column transforms.REST.
    """

    registry: Registry = field(default_factory=Registry)
    migrations: Migrations = field(default_factory=Migrations)
    contracts: Contracts = field(default_factory=Contracts)
    protectors: dict[str, Protector] = field(default_factory=dict)
    schemas: dict[str, StructType | str] = field(default_factory=dict)

    def types(self) -> list[str]:
        return sorted({t for t, _ in self.contracts.contracts})

    def schema(self, doc_type: str) -> StructType:
        """The columns that a type's documents are transformed in."""
        given = self.schemas.get(doc_type)
        if given is None:
            kinds: dict[str, DataType] = {}
            for rule in (r for (t, _), rules in self.contracts.contracts.items() if t == doc_type for r in rules):
                kind = LongType() if rule.kind == "integer" else StringType()
                kinds[rule.name] = kind if kinds.get(rule.name, kind) == kind else VariantType()
            given = StructType([StructField(name, kind) for name, kind in kinds.items()])
        schema = StructType.fromDDL(given) if isinstance(given, str) else given
        return schema if VERSION in schema.names else StructType([*schema.fields]).add(VERSION, "string")

    def before_publishing(self, doc_type: str) -> list[Callable[[DataFrame], DataFrame]]:
        return [lambda df: self.registry.apply(df, "pre_publish", doc_type)] if self.registry.registered(doc_type, "pre_publish") else []

    def before_validation(self, doc_type: str) -> list[Callable[[DataFrame], DataFrame]]:
        if not self.migrations.versions(doc_type) and not self.registry.registered(doc_type, "pre_validation", "post_validation"):
            return []
        migrate = [lambda df: self.migrations.apply(df, doc_type, self.contracts.latest(doc_type))] if self.migrations.versions(doc_type) else []
        return [lambda df: self.registry.apply(df, "pre_validation", doc_type), *migrate, lambda df: self.registry.apply(df, "post_validation", doc_type)]


def has_document(operation: Column, body: Column) -> Column:
    """Documents of inserts and updates are read; other operations are published as they are."""
    return operation.isin("insert", "update") & body.isNotNull()


def schema_of(events: DataFrame, body: str = "full_document") -> StructType:
    """The schema that all documents of a batch have in common, for Plan.schemas; fields of several types are variants."""
    found = events.agg(F.schema_of_variant_agg(F.try_parse_json(body))).first()[0]
    return struct_of(found)


#: What else an event holds while its document is transformed: its document as it came, and as the schema read it.
RAW, READ = "_raw_document", "_read_document"
NUMERIC = "^(BIGINT|DECIMAL.*|DOUBLE)$"


def _read(value: Column, kind: DataType) -> Column:
    """A variant as a type that holds all of it; null for what the type can't hold whole."""
    said, name = F.schema_of_variant(value), kind.simpleString()
    if isinstance(kind, VariantType):
        return value
    if isinstance(kind, StringType | BooleanType):
        return F.when(said == F.lit(name.upper()), F.try_variant_get(value, "$", name))
    if isinstance(kind, IntegralType):
        number = F.try_variant_get(value, "$", "double")
        return F.when(said.rlike(NUMERIC) & (number % 1 == 0), F.try_variant_get(value, "$", name))
    if isinstance(kind, NumericType):
        return F.when(said.rlike(NUMERIC), F.try_variant_get(value, "$", name))
    read = F.try_variant_get(value, "$", name)
    if isinstance(kind, StructType | ArrayType | MapType):
        return F.when(F.to_json(F.try_parse_json(F.to_json(read, JSON_OPTIONS))) == F.to_json(value), read)
    return F.when(said == "STRING", read)


def _without(fields: Column, names: Sequence[str]) -> Column:
    return F.map_filter(fields, lambda k, _: ~k.isin(list(names)))


def _same(a: Column, b: Column, kind: DataType) -> Column:
    if any(word in kind.simpleString() for word in ("map<", "variant")):
        return F.to_json(F.struct(a.alias("x"))).eqNullSafe(F.to_json(F.struct(b.alias("x"))))
    return a.eqNullSafe(b)


def _field(name: str) -> Column:
    """A document's field as a variant; null where the document lacks it."""
    if name.isidentifier() and name.isascii():
        return F.try_variant_get(RAW, f"$.{name}", "variant")
    return F.try_element_at(F.col(RAW).cast("map<string,variant>"), F.lit(name))


def prepared(events: DataFrame, schemas: dict[str, StructType]) -> DataFrame:
    """events with their documents taken apart, each by the schema of its type: what the schema read, what it lacks, and why it can't hold some. The columns
    of other types are null; so are all where there is no JSON object to be read."""
    kind = doc_type_of(F.col("collection"))
    df = events.withColumn("_kind", F.when(kind.isin(list(schemas)) & has_document(F.col("operation_type"), F.col("full_document")), kind))
    df = df.withColumn(RAW, F.when(F.col("_kind").isNotNull(), F.try_parse_json("full_document")))
    df = df.withColumn("_kind", F.when(F.schema_of_variant(RAW).startswith("OBJECT"), F.col("_kind")))
    place = {name: f"_field{k}" for k, name in enumerate(sorted({f.name for s in schemas.values() for f in s.fields}))}
    df = df.withColumns({c: _field(name) for name, c in place.items()})
    reads = {t: f"{READ}_{t}" for t in schemas}
    df = df.withColumns({reads[t]: F.when(F.col("_kind") == t, F.struct(*(_read(F.col(place[f.name]), f.dataType).alias(f.name) for f in s.fields))) for t, s in schemas.items()})
    rest, misfit = F.lit(None).cast("map<string,variant>"), F.lit(None).cast("array<string>")
    for t, s in schemas.items():
        odd = (F.when(F.col(place[f.name]).isNotNull() & ~F.is_variant_null(place[f.name]) & F.col(reads[t])[f.name].isNull(), F.lit(f"{f.name}: not of its schema's type")) for f in s.fields)
        misfit = F.when(F.col("_kind") == t, F.array_compact(F.array(*odd))).otherwise(misfit)
        rest = F.when(F.col("_kind") == t, _without(F.col(RAW).cast("map<string,variant>"), s.names)).otherwise(rest)
    return df.select(*events.columns, "_kind", RAW, *reads.values(), rest.alias("_rest"), misfit.alias("_misfit"))


def reshaped(rows: DataFrame, doc_type: str, schema: StructType, steps: Sequence[Callable[[DataFrame], DataFrame]], held: Sequence[str]) -> DataFrame:
    """The events of a type (prepared) with their documents' fields sent through the steps as columns, and made documents again; nothing is lost on the way.

    Fields that the schema lacks stand in transforms.REST. A field that the steps leave as it was, a null too, is written as it came. A document that
    a migration leaves behind keeps its reason in _migration_error.
    """
    read = F.col(f"{READ}_{doc_type}")
    inside = rows.where((F.col("_kind") == doc_type) & (F.size("_misfit") == 0)).select(*held, RAW, read.alias(READ), F.when(F.size("_rest") > 0, F.to_json("_rest")).alias(REST))
    documents = inside.select(F.struct(*held, RAW, READ).alias(HELD), F.col(READ + ".*"), REST)
    for step in steps:
        documents = step(documents)

    own = [c for c in documents.columns if c not in (HELD, REST, "_migration_error")]
    as_was = F.col(HELD)[RAW].cast("map<string,variant>")
    stays = [F.lit(None).cast("string")]
    for f in schema.fields:
        if f.name in own and documents.schema[f.name].dataType == f.dataType:
            null = F.is_variant_null(F.try_element_at("_was", F.lit(f.name)))
            stays.append(F.when(_same(column(f.name), F.col(HELD)[READ][f.name], f.dataType) & (column(f.name).isNotNull() | F.coalesce(null, F.lit(False))), F.lit(f.name)))
    why = F.col("_migration_error") if "_migration_error" in documents.columns else F.lit(None).cast("string")
    others = F.try_parse_json(REST).cast("map<string,variant>") if REST in documents.columns else F.lit(None).cast("map<string,variant>")
    new = F.try_parse_json(F.to_json(F.struct(*map(column, own)), JSON_OPTIONS)).cast("map<string,variant>")
    made = documents.withColumns({"_was": as_was, "_new": new, "_others": others}).select(*(F.col(HELD)[c].alias(c) for c in held), why.alias("_migration_error"), "_was", "_new", "_others", F.array_compact(F.array(*stays)).alias("_stays"))
    empty = F.create_map().cast("map<string,variant>")
    parts = (
        F.map_filter("_new", lambda k, _: ~F.array_contains("_stays", k)), F.map_filter("_was", lambda k, _: F.array_contains("_stays", k)),
        F.coalesce(_without(F.col("_others"), own), empty),
    )
    # The protectors' functions and the envelope read the document, which is made once for all of them.
    return made.select(*held, once(F.to_json(F.map_concat(*parts))).alias("full_document"), "_migration_error", F.lit(None).cast("array<string>").alias("_misfit"))


def by_type(events: DataFrame, plan: Plan, steps_of: Callable[[str], list]) -> DataFrame:
    """events with the documents of each type that has something to be done sent through its steps; _migration_error and _misfit say why some weren't.

    A document with a field that its type's schema can't hold passes by, as its steps would see a null instead; so do events without a JSON
    object. The documents are taken apart once for all types, and written.
    """
    kinds = [t for t in plan.types() if steps_of(t)]
    none = F.lit(None).cast("string")
    if not kinds:
        return events.withColumns({"_migration_error": none, "_misfit": F.lit(None).cast("array<string>")})
    rows = written(prepared(events, {t: plan.schema(t) for t in kinds}), "prepared")
    held = [c for c in events.columns if c != "full_document"]
    aside = rows.where(F.col("_kind").isNull() | (F.size("_misfit") > 0)).select(*held, "full_document", none.alias("_migration_error"), "_misfit")
    return reduce(lambda a, b: a.unionByName(b), (reshaped(rows, t, plan.schema(t), steps_of(t), held) for t in kinds), aside)


def checked(events: DataFrame, plan: Plan | None = None, dedup: bool = True) -> DataFrame:
    """events after deduplication and migration, with errors: broken rules of inserted and updated documents."""
    plan = plan or Plan()
    fresh = deduplicated(events) if dedup else events
    if any(plan.before_validation(t) for t in plan.types()):
        ship(events.sparkSession)
    columns = fresh.columns
    found = validated(by_type(fresh, plan, plan.before_validation), "full_document", doc_type_of(F.col("collection")), plan.contracts, "_found")
    read = has_document(F.col("operation_type"), F.col("full_document"))
    nothing = F.array().cast("array<string>")
    broken = F.when(F.size("_found") > 0, F.col("_found")).otherwise(F.coalesce("_misfit", nothing))
    errors = F.when(F.col("_migration_error").isNotNull(), F.array("_migration_error")).when(read, broken).otherwise(nothing)
    return found.select(*columns, errors.alias("errors"))


def published(fine: DataFrame, plan: Plan | None = None) -> DataFrame:
    """Valid events with their documents as they are published, and errors: why some can't be."""
    plan = plan or Plan()
    if plan.protectors or any(plan.before_publishing(t) for t in plan.types()):
        ship(fine.sparkSession)
    out = by_type(fine, plan, plan.before_publishing)
    for doc_type, protector in sorted(plan.protectors.items()):
        mine = (doc_type_of(F.col("collection")) == doc_type) & has_document(F.col("operation_type"), F.col("full_document"))
        out = protector.protected_documents(out, "full_document", mine)
    return out.select(*fine.columns, F.coalesce("_misfit", F.array().cast("array<string>")).alias("errors"))


def tag(name: str, value: Column) -> Column:
    """A value as a tagged object."""
    return F.to_variant_object(F.struct(F.lit(name).alias("__type__"), value.alias("value")))


def enveloped(events: DataFrame, topics: dict[str, str], form: str = "json", tags: bool = True) -> DataFrame:
    """topic, value, attributes. Consumers find the change under data, its document as an object, by the names that change streams use.

    tags: in MessagePack, cluster times and keys of 24 hexadecimal digits are tagged with their types. value is null where a document can't
    be written (a whole number beyond 64 bits in MessagePack).
    """
    return events.select(*_envelope(topics, form, tags))


def _envelope(topics: dict[str, str], form: str, tags: bool) -> list[Column]:
    topic = reduce(lambda c, kv: c.when(F.col("collection") == kv[0], kv[1]), topics.items(), F.when(F.lit(False), ""))
    seconds, id_ = F.unix_timestamp("cluster_time"), F.col("document_key")
    at = seconds
    if tags and form == "msgpack":
        at = F.when(seconds.isNotNull(), tag("Timestamp", seconds))
        id_ = F.when(id_.rlike("^[0-9a-f]{24}$"), tag("ObjectId", id_)).otherwise(id_.cast("variant"))
    key = F.when(F.col("document_key").isNotNull(), F.struct(id_.alias("_id")))
    data = F.struct(F.col("resume_token").alias("_id"), F.col("operation_type").alias("operationType"), key.alias("documentKey"), at.alias("clusterTime"), F.try_parse_json("full_document").alias("fullDocument"), iso_time(F.timestamp_seconds(seconds)).alias("wallTime"))
    body = F.struct(F.col("collection"), F.col("operation_type").alias("operation"), seconds.alias("timestamp"), data.alias("data"))
    version = F.coalesce(F.nullif(F.get_json_object("full_document", f"$.{VERSION}"), F.lit("")), F.lit("v1"))
    attributes = F.create_map(*(x for k, v in (("collection", F.col("collection")), ("operation", F.col("operation_type")), ("schema_version", version), ("serialization_format", F.lit(form))) for x in (F.lit(k), v)))
    return [topic.alias("topic"), serialized(body, form).alias("value"), attributes.alias("attributes")]


def split(rows: DataFrame, topics: dict[str, str], form: str = "json", plan: Plan | None = None, tags: bool = True) -> tuple[DataFrame, DataFrame]:
    """(messages, dead letters) of checked rows. Dead are invalid documents, those that can't be transformed for publishing, and those whose message can't be written."""
    plan = plan or Plan()
    fine, bad = rows.where(F.size("errors") == 0).drop("errors"), rows.where(F.size("errors") > 0)
    out = published(fine, plan)
    if any(plan.before_publishing(t) for t in plan.types()):
        bad = bad.unionByName(out.where(F.size("errors") > 0))
        out = out.where(F.size("errors") == 0)
    if form == "json":
        return enveloped(out, topics, form, tags), bad
    both = out.select("*", *_envelope(topics, form, tags)).withColumn("value", once(F.col("value")))
    lost = both.where(F.col("value").isNull()).select(*out.columns).withColumn("errors", F.array(F.lit(f"message: no {form} form")))
    return both.where(F.col("value").isNotNull()).select("topic", "value", "attributes"), bad.unionByName(lost)


def pipeline(events: DataFrame, topics: dict[str, str], form: str = "json", plan: Plan | None = None, store: str | None = None, tags: bool = True) -> tuple[DataFrame, DataFrame]:
    """(messages, dead letters). store: a shared folder; checked rows are written there once, for whoever wants both. Without one they are
    written to the session's, where types have steps of their own before publishing."""
    plan = plan or Plan()
    rows = checked(events, plan)
    if store is not None:
        rows.write.parquet(store)
        rows = events.sparkSession.read.schema(rows.schema).parquet(store)
    elif any(plan.before_publishing(t) for t in plan.types()):
        rows = written(rows, "checked")
    return split(rows, topics, form, plan, tags)


def heartbeat(events: DataFrame, now: Column) -> DataFrame:
    """One status row per collection."""
    return events.groupBy("collection").agg(F.max("cluster_time").alias("last_change_time"), F.count("*").alias("changes"), F.bool_or(F.col("resume_token").isNotNull()).alias("has_resume_token")).withColumn("seconds_since_last_change", F.unix_timestamp(now) - F.unix_timestamp("last_change_time"))


def resume_positions(events: DataFrame) -> DataFrame:
    return events.groupBy("collection").agg(F.max_by("resume_token", F.struct("cluster_time", "resume_token")).alias("token"), F.max("cluster_time").alias("updated_at"))


def fan_in(parts: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (d.withColumn("collection", F.lit(name)) for name, d in parts))
