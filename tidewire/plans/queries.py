"""Registered queries and their SQL for DuckDB."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions import protection as P
from tidewire.functions import serialization as S
from tidewire.operators import history as H
from tidewire.operators import inventory as I
from tidewire.operators import keyed as K
from tidewire.operators import seasonal
from tidewire.operators import transforms as T
from tidewire.operators.validation import CONTRACTS, Contracts, FieldRule, Migrations, with_broken
from tidewire.plans import cdc
from tidewire.session import ship
from tidewire.sources import changes, ledger, scratch, sinks
from tidewire.streaming.stateful import sessions, windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TOPICS = {"inventory": "inventory-changes", "transactions": "transaction-changes"}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if it has one."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def t(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*columns) if columns else df


#: The changes that sources.changes.from_events makes, in SQL.
EVENTS = """with ev as (select *, case when user_id % 2 = 0 then 'inventory' else 'transactions' end as collection,
  case event_id % 3 when 0 then 'insert' when 1 then 'update' else 'delete' end as operation_type,
  cast(floor(value) as bigint) - case when event_id % 7 = 0 then 1000 else 0 end as quantity,
  ['sale', 'restock', 'return', 'adjustment', 'gift'][event_id % 5 + 1] as kind from events),
dd as (select * from (select *, max(ts) over (partition by collection, user_id, operation_type order by event_id rows between unbounded preceding and 1 preceding) as before from ev) where before is null or ts > before),
er as (select *, case when operation_type = 'delete' then 0 when collection = 'inventory' then case when quantity < 0 then 1 else 0 end else case when kind = 'gift' then 1 else 0 end end as bad from dd)
"""


#: The envelope of a row (doc: its document's JSON text, null for none), in SQL.
VALUE = """'{"collection":"' || collection || '","operation":"' || operation_type || '","timestamp":' || sec || ',"data":{"_id":"' || lpad(cast(event_id as varchar), 12, '0') || '","operationType":"' || operation_type ||
  '","documentKey":{"_id":"' || user_id || '"},"clusterTime":' || sec || coalesce(',"fullDocument":' || doc, '') || ',"wallTime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') || '"}}'"""
#: Valid events, with the parts of their documents.
VALID = EVENTS + """, ok as (select *, cast(floor(epoch(ts)) as bigint) as sec, 'P' || user_id % 50 as p, 'W' || user_id % 5 as w, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as stamp, collection = 'inventory' as inv from er where bad = 0)
"""
PLAIN = """case when operation_type = 'delete' then null when inv then '{"_schema_version":"v1","last_updated":"' || stamp || '","product_id":"' || p || '","quantity":' || quantity || ',"warehouse_id":"' || w || '"}'
  else '{"_schema_version":"v1","product_id":"' || p || '","quantity":' || quantity || ',"timestamp":"' || stamp || '","transaction_id":"T' || event_id || '","transaction_type":"' || kind || '","warehouse_id":"' || w || '"}' end"""
MESSAGE = "select case collection when 'inventory' then 'inventory-changes' else 'transaction-changes' end as topic, operation_type as operation, collection, 'v1' as schema_version, 'json' as serialization_format, "


def shown(messages: DataFrame) -> DataFrame:
    """Messages with their bytes as text and each attribute in a column."""
    names = ("operation", "collection", "schema_version", "serialization_format")
    return messages.select("topic", *(F.col("attributes")[n].alias(n) for n in names), F.decode("value", "UTF-8").alias("value"))


@query(VALID + f", m as (select *, {PLAIN} as doc from ok) " + MESSAGE + f"{VALUE} as value from m")
def cdc_pipeline(spark, sf):
    """Flagship: deduplicate, validate, envelope, route; every message with its body and attributes."""
    messages, _ = cdc.pipeline(changes.from_events(spark, sf), TOPICS)
    return shown(messages)


AT = datetime(2024, 6, 1, tzinfo=UTC)
SEEN = "2024-06-01T00:00:00.000000+00:00"


@query(VALID + f""", m as (select *, case when operation_type = 'delete' then null when inv then
  '{{"_processing_metadata":{{"processed_at":"{SEEN}","processor_version":"1.0"}},"_protected":{{"wh_W9__product_id":"tokenize"}},"_schema_version":"v1","_security_metadata":{{"field_prefix":"wh_W9_","prefixed_at":"{SEEN}"}},"wh_W9__last_updated":"' || stamp ||
  '","wh_W9__product_id":"TOK_' || left(to_base64(unhex(sha256('wh_W9__product_id' || p))), 10) || '","wh_W9__quantity":' || quantity || ',"wh_W9__warehouse_id":"' || w || '"}}'
  else '{{"_processing_metadata":{{"processed_at":"{SEEN}","processor_version":"1.0"}},"_schema_version":"v1","_security_metadata":{{"field_prefix":"wh_W9_","prefixed_at":"{SEEN}","prefixed_fields":["product_id","warehouse_id","location","shelf"]}},"quantity":' || quantity ||
  ',"timestamp":"' || stamp || '","transaction_id":"T' || event_id || '","transaction_type":"' || kind || '","wh_W9__product_id":"' || p || '","wh_W9__warehouse_id":"' || w || '"}}' end as doc from ok) """ + MESSAGE + f"{VALUE} as value from m")
def published_documents(spark, sf):
    """The plan with the transformations that documents are published with, and a rule that protects inventory."""
    plan = cdc.Plan(T.default_registry("W9", AT), protectors={"inventory": P.Protector([P.Rule("wh_W9__product_id", "tokenize")])})
    messages, _ = cdc.pipeline(changes.from_events(spark, sf), TOPICS, plan=plan)
    return shown(messages)


@query(VALID + """select lpad(cast(event_id as varchar), 12, '0') as resume_token, '{"email":"so***********","home_phone":"********' || lpad(cast(user_id % 10000 as varchar), 4, '0') || '","note":"[NUMBER] Main St [UNIT], [POSTAL]"}' as customer,
  'XXXXXXXXXXXX' || lpad(cast(event_id % 10000 as varchar), 4, '0') as card, false as has_cvv from ok where not inv and operation_type <> 'delete'""")
def protected_documents(spark, sf):
    """The plan with the rules for personal data, on documents that have some in a struct and in a map."""
    def with_people(df):
        customer = F.struct(F.lit("someone@x.org").alias("email"), F.concat(F.lit("55500000"), F.lpad((F.col("_change_event.document_key").cast("long") % 10000).cast("string"), 4, "0")).alias("home_phone"), F.lit("12 Main St Suite B, 90210").alias("address_note"))
        return df.withColumn("customer", customer).withColumn("payment", F.create_map(F.lit("card_number"), F.concat(F.lit("411111111111"), F.substring(F.col("_change_event.resume_token"), -4, 4)), F.lit("cvv"), F.lit("123")))

    registry = T.Registry()
    registry.register("pre_publish", "transaction", with_people)
    plan = cdc.Plan(registry, protectors={"transaction": P.Protector(P.PII_RULES)})
    messages, _ = cdc.pipeline(changes.from_events(spark, sf).where("collection = 'transactions'"), TOPICS, plan=plan)
    doc = lambda path: F.get_json_object(F.decode("value", "UTF-8"), "$.data" + path)
    customer = F.struct(doc(".fullDocument.customer.email").alias("email"), doc(".fullDocument.customer.home_phone").alias("home_phone"), doc(".fullDocument.customer.address_note").alias("note"))
    found = messages.where("attributes.operation <> 'delete'").select(doc("._id").alias("resume_token"), F.to_json(customer).alias("customer"), doc(".fullDocument.payment.card_number").alias("card"), doc(".fullDocument.payment.cvv").isNotNull().alias("has_cvv"))
    return found


MIXED = EVENTS + """, n as (select *, event_id % 6 as n, case when quantity < 0 then 'quantity: minimum' end as low from dd where collection = 'inventory' and operation_type <> 'delete'),
w as (select *, concat_ws(';', case when n = 3 then 'quantity: integer' else low end, case when n = 4 then 'brand: string' end, case when n = 5 then 'threshold_min: integer' end) as error from n)
select lpad(cast(event_id as varchar), 12, '0') as resume_token, case when error <> '' then '' else case n when 0 then '{"email":"so***********"}' when 1 then 'x' when 2 then '["a",{}]' else '' end end as customer, error from w"""


def mixed(spark: SparkSession, sf: str, schemas: dict[str, str]) -> DataFrame:
    """Documents whose fields have several types, wrong ones and nulls among them, through a transformation before validation and the rules for personal data."""
    registry = T.Registry()
    registry.register("pre_validation", "inventory", lambda d: d)
    plan = cdc.Plan(registry, protectors={"inventory": P.Protector(P.PII_RULES)}, schemas=schemas)
    n = F.col("resume_token").cast("long") % 6
    more = F.element_at(F.array(*map(F.lit, ('"customer":{"ssn":"1","email":"someone@x.org"}', '"customer":"x"', '"customer":["a",{"ssn":"2"}]', '"extra":1', '"brand":null', '"threshold_min":"abc"'))), (n + 1).cast("int"))
    body = F.concat(F.lit("{"), more, F.lit(","), F.substring("full_document", 2, 2**30))
    body = F.when(n == 3, F.regexp_replace(body, '"quantity":-?[0-9]+', '"quantity":"x"')).otherwise(body)
    events = changes.from_events(spark, sf).where("collection = 'inventory' and operation_type <> 'delete'").withColumn("full_document", body)
    messages, dead = cdc.pipeline(events, TOPICS, plan=plan)
    found = lambda path: F.coalesce(F.get_json_object(F.decode("value", "UTF-8"), "$.data" + path), F.lit(""))
    fine = messages.select(found("._id").alias("resume_token"), found(".fullDocument.customer").alias("customer"), F.lit("").alias("error"))
    return fine.union(dead.select("resume_token", F.lit(""), F.concat_ws(";", "errors")))


@query(MIXED)
def mixed_documents(spark, sf):
    """Read by the fields of their contract."""
    return mixed(spark, sf, {})


@query(MIXED)
def mixed_documents_by_schema(spark, sf):
    """Read by a schema that the plan gives."""
    return mixed(spark, sf, {"inventory": "product_id string, quantity bigint, threshold_min bigint, brand string, customer variant"})


@query(EVENTS + """, vs as (select *, case event_id % 11 when 0 then 'v999' when 3 then 'v2' else 'v1' end as version from dd where operation_type <> 'delete')
select lpad(cast(event_id as varchar), 12, '0') as resume_token, case when version = 'v999' then 'no migration of ' || case collection when 'inventory' then 'inventory' else 'transaction' end || ' from v999 to v2'
  when collection = 'inventory' then case when quantity < 0 then 'quantity: minimum' end when kind = 'gift' then 'transaction_type: enum' end as error,
  case when version = 'v999' then 'v999' else 'v2' end as version, case version when 'v1' then 'migrated' when 'v2' then 'new' end as origin from vs""")
def migrated_documents(spark, sf):
    """Documents of three versions, one unknown: migrated to the latest contract, validated by it, or set aside with the reason."""
    contracts = Contracts(CONTRACTS | {(t, "v2"): (*rules, FieldRule("origin", required=True)) for (t, _), rules in CONTRACTS.items()})
    migrations = Migrations()
    for kind in ("inventory", "transaction"):
        migrations.register(kind, "v1", "v2", lambda d: d.withColumn("origin", F.lit("migrated")))
    events = changes.from_events(spark, sf).where("operation_type <> 'delete'")
    n = F.col("resume_token").cast("long") % 11
    body = F.when(n == 0, F.replace("full_document", F.lit('"v1"'), F.lit('"v999"'))).when(n == 3, F.replace("full_document", F.lit('"v1"'), F.lit('"v2","origin":"new"'))).when(n == 5, F.replace("full_document", F.lit('"_schema_version":"v1",'), F.lit(""))).otherwise(F.col("full_document"))
    rows = cdc.checked(events.withColumn("full_document", body), cdc.Plan(migrations=migrations, contracts=contracts))
    return rows.select("resume_token", F.try_element_at("errors", F.lit(1)).alias("error"), F.get_json_object("full_document", "$._schema_version").alias("version"), F.get_json_object("full_document", "$.origin").alias("origin"))


@query(EVENTS + """select lpad(cast(event_id as varchar), 12, '0') as resume_token, case event_id % 5 when 0 then case when collection = 'inventory' then 'Invalid schema version for inventory: v999' else 'Invalid schema version for transaction: v999' end
  when 4 then 'document: object' else case when collection = 'inventory' then case when quantity < 0 then 'quantity: minimum' end when kind = 'gift' then 'transaction_type: enum' end end as error from dd where operation_type <> 'delete'""")
def versions_of_documents(spark, sf):
    """Each document by its own version: one unknown, one null, one missing, and what is no document."""
    n = F.col("resume_token").cast("long") % 5
    edited = lambda new: F.replace("full_document", F.lit('"_schema_version":"v1",'), F.lit(new))
    body = F.when(n == 0, edited('"_schema_version":"v999",')).when(n == 1, edited('"_schema_version":null,')).when(n == 2, edited("")).when(n == 4, F.lit("[1]")).otherwise(F.col("full_document"))
    events = changes.from_events(spark, sf).where("operation_type <> 'delete'")
    return cdc.checked(events.withColumn("full_document", body)).select("resume_token", F.try_element_at("errors", F.lit(1)).alias("error"))


@query(VALID + "select lpad(cast(event_id as varchar), 12, '0') as resume_token, operation_type as operation, form, sec, case when operation_type <> 'delete' then p else '' end as product, case when operation_type <> 'delete' then quantity else 0 end as quantity from ok cross join (select unnest(['json', 'msgpack']) as form)")
def consumed_messages(spark, sf):
    """Messages of both forms, read again by a consumer."""
    ship(spark)
    schema = "operation string, data struct<_id:string,clusterTime:bigint,fullDocument:struct<product_id:string,quantity:bigint>>"
    # Both forms are made of rows that are checked once.
    rows = scratch.written(cdc.checked(changes.from_events(spark, sf)), "checked")
    out = None
    for form in ("json", "msgpack"):
        messages, _ = cdc.split(rows, TOPICS, form)
        m = messages.select(S.parsed(F.col("value"), form, schema).alias("m"), F.col("attributes.serialization_format").alias("form"))
        m = m.select(F.col("m.data._id").alias("resume_token"), F.col("m.operation").alias("operation"), "form", F.col("m.data.clusterTime").alias("sec"), F.coalesce("m.data.fullDocument.product_id", F.lit("")).alias("product"), F.coalesce("m.data.fullDocument.quantity", F.lit(0)).alias("quantity"))
        out = m if out is None else out.union(m)
    return out


@query(EVENTS + """, last as (select collection, max(ts) as ts from ev group by all)
select collection, '{"type":"heartbeat","collection":"' || collection || '","timestamp":1893456000,"status":{"is_running":true,"last_change_time":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when extract(microsecond from ts) % 1000000 <> 0 then strftime(ts, '.%f') else '' end ||
  '+00:00","time_since_last_change":' || (1893456000 - cast(floor(epoch(ts)) as bigint)) || ',"has_resume_token":true}}' as value from last""")
def status_messages(spark, sf):
    now = F.lit("2030-01-01").cast("timestamp")
    return sinks.status_messages(cdc.heartbeat(changes.from_events(spark, sf), now), now).select(F.col("attributes.collection").alias("collection"), "value")


@query(EVENTS + "select lpad(cast(event_id as varchar), 12, '0') as resume_token, case when collection = 'inventory' then 'quantity: minimum' else 'transaction_type: enum' end as error from er where bad = 1")
def dead_letters(spark, sf):
    _, bad = cdc.pipeline(changes.from_events(spark, sf), TOPICS)
    return bad.select("resume_token", F.explode("errors").alias("error"))


@query(EVENTS + "select collection, operation_type, count(*) as n from dd group by all")
def dedup_latest_wins(spark, sf):
    return cdc.deduplicated(changes.from_events(spark, sf)).groupBy("collection", "operation_type").agg(F.count("*").alias("n"))


@query("""with b as (select *, max(ts) over (partition by event_id % 3 order by event_id rows between unbounded preceding and 1 preceding) as before from events)
select lpad(cast(event_id as varchar), 12, '0') as resume_token from b where before is null or ts > before""")
def dedup_hot_key(spark, sf):
    """All changes are of one document; their tokens' ranges are buckets that no task has all of."""
    events = changes.from_events(spark, sf).withColumns({"document_key": F.lit("k"), "collection": F.lit("inventory")})
    return cdc.deduplicated(events, bucket=F.floor(F.col("resume_token").cast("long") / IDS)).select("resume_token")


@query("""with ev as (select *, case when user_id % 2 = 0 then 'inventory' else 'transactions' end as collection, event_id % 3 as op from events),
b as (select *, max(ts) over (partition by collection, user_id, op order by event_id rows between unbounded preceding and 1 preceding) as before from ev)
select lpad(cast(event_id as varchar), 12, '0') as resume_token from b where user_id % 5 = 0 or before is null or ts > before""")
def dedup_without_keys(spark, sf):
    """Changes whose key is null or empty are never duplicates."""
    events = changes.from_events(spark, sf)
    k = F.col("document_key").cast("long")
    key = F.when(k % 10 == 0, F.lit(None)).when(k % 5 == 0, F.lit("")).otherwise(F.col("document_key"))
    return cdc.deduplicated(events.withColumn("document_key", key)).select("resume_token")


@query(EVENTS + "select collection, lpad(cast(max(event_id) as varchar), 12, '0') as token from (select collection, event_id from ev qualify rank() over (partition by collection order by ts desc) = 1) group by all")
def resume_position(spark, sf):
    return cdc.resume_positions(changes.from_events(spark, sf)).select("collection", "token")


@query("""with ev as (select *, event_id % 3 as batch, case when user_id % 2 = 0 then 'inventory' else 'transactions' end as collection, case event_id % 3 when 0 then 'insert' when 1 then 'update' else 'delete' end as op,
  cast(floor(value) as bigint) - case when event_id % 7 = 0 then 1000 else 0 end as quantity, event_id % 5 = 4 as gift from events),
dd as (select *, max(ts) over (partition by batch, collection, user_id, op order by event_id rows between unbounded preceding and 1 preceding) as before from ev),
er as (select *, op <> 'delete' and case when collection = 'inventory' then quantity < 0 else gift end as bad from dd where before is null or ts > before),
n as (select collection, batch, count(*) filter (where not bad) as messages, count(*) filter (where bad) as dead from er group by all),
s as (select collection, batch, count(*) as changes, lpad(cast(arg_max(event_id, (ts, event_id)) as varchar), 12, '0') as position from ev group by all)
select s.collection, cast(s.batch as bigint) as batch, changes, messages, dead, position from s join n on n.collection = s.collection and n.batch = s.batch""")
def ledger_of_batches(spark, sf):
    """Three batches written and committed, one of them twice."""
    out = f"{scratch.shared_root(spark)}/sink-{uuid.uuid4().hex}"
    atexit.register(scratch.removed, spark, out)
    events, write = changes.from_events(spark, sf), sinks.batch_writer(out, TOPICS)
    for number in (0, 1, 1, 2):
        write(events.where(F.col("resume_token").cast("long") % 3 == number), number)
    return ledger.rows(spark, out).select("collection", "batch", "changes", "messages", "dead", "position")


@query(EVENTS + "select collection, max(ts) as last_change_time, count(*) as changes from ev group by all")
def heartbeat_status(spark, sf):
    return cdc.heartbeat(changes.from_events(spark, sf), F.lit("2030-01-01").cast("timestamp")).select("collection", F.col("last_change_time").cast("timestamp_ntz").alias("last_change_time"), "changes")


@query(EVENTS + """select lpad(cast(e.event_id as varchar), 12, '0') as resume_token, case when collection = 'inventory' then 'stock of ' || c.c_name else c.c_name end as document from ev e left join customer c on c.c_custkey = e.user_id where operation_type = 'update'""")
def update_lookup(spark, sf):
    now = t(spark, sf, "customer", "c_custkey", "c_name").select(F.explode(F.array(F.lit("inventory"), F.lit("transactions"))).alias("collection"), F.col("c_custkey").cast("string").alias("document_key"), F.col("c_name").alias("document"))
    now = now.withColumn("document", F.when(F.col("collection") == "inventory", F.concat(F.lit("stock of "), "document")).otherwise(F.col("document")))
    ev = changes.from_events(spark, sf).where("operation_type = 'update'").withColumn("full_document", F.lit(None).cast("string"))
    return cdc.looked_up(ev, now).select("resume_token", F.col("full_document").alias("document"))


@query("select event_id, event_type, value from events where event_type = 'click' and value > 10 and user_id not in (1, 2, 3)")
def watch_filter(spark, sf):
    return T.watch_filter(t(spark, sf, "events"), [{"$match": {"event_type": "click", "value": {"$gt": 10}, "user_id": {"$nin": [1, 2, 3]}}}, {"$project": {"event_id": 1, "event_type": 1, "value": 1}}])


@query(EVENTS + "select lpad(cast(event_id as varchar), 12, '0') as resume_token from ev where collection = 'inventory' and operation_type <> 'delete' and quantity < 10 and not quantity < -990 and 'P' || user_id % 50 like 'P1%'")
def watch_documents(spark, sf):
    """Changes by conditions on their documents."""
    match = {"ns.coll": "inventory", "fullDocument.quantity": {"$lt": 10, "$not": {"$lt": -990}}, "fullDocument.product_id": {"$regex": "^p1", "$options": "i"}, "$nor": [{"operationType": "delete"}, {"fullDocument.quantity": {"$exists": False}}]}
    return T.watch_filter(changes.from_events(spark, sf), [{"$match": match}]).select("resume_token")


@query("""with e as (select *, case event_id % 2 when 0 then 'a' else 'b' end as c, user_id % 50 as k from events),
v as (select c, k, ts, arg_max(case event_type when 'signup' then '' else 'bought ' || event_id end, event_id) as doc from e where event_type in ('purchase', 'signup') group by all)
select lpad(cast(e.event_id as varchar), 12, '0') as resume_token, coalesce(v.doc, '') as document from (select * from e where event_type = 'view') e asof left join v on e.c = v.c and e.k = v.k and e.ts >= v.ts""")
def lookup_as_of(spark, sf):
    """Views with their user group's last purchase at that time, in two collections that share keys; a signup deletes it."""
    e = t(spark, sf, "events", "event_id", "event_type", "user_id", "ts")
    kind = F.col("event_type")
    operation = F.when(kind == "purchase", "insert").when(kind == "signup", "delete").when(kind == "view", "update")
    rows = e.select(F.lpad(F.col("event_id").cast("string"), 12, "0").alias("resume_token"), F.when(F.col("event_id") % 2 == 0, "a").otherwise("b").alias("collection"), operation.alias("operation_type"), (F.col("user_id") % 50).cast("string").alias("document_key"), F.col("ts").cast("timestamp").alias("cluster_time"), F.when(kind == "purchase", F.concat(F.lit("bought "), F.col("event_id").cast("string"))).alias("full_document"))
    found = H.looked_up_as_of(rows.where("operation_type = 'update'"), H.versions(rows.where("operation_type in ('insert', 'delete')")))
    return found.select("resume_token", F.coalesce("full_document", F.lit("")).alias("document"))


@query(EVENTS + """, last as (select * from ev where collection = 'inventory' qualify row_number() over (partition by user_id order by event_id desc) = 1),
d as (select 'W' || user_id % 5 as w, 'P' || user_id % 50 as p, quantity from last where operation_type <> 'delete')
select coalesce(w, '') as warehouse, coalesce(p, '') as product, cast(2 - grouping(w) - grouping(p) as integer) as level, cast(sum(quantity) as bigint) as total, count(*) as n from d group by rollup (w, p)""")
def stock_by_retractions(spark, sf):
    """Totals kept up over three batches of changes: old images are taken out, new ones put in."""
    rows = H.retracted(H.images(changes.from_events(spark, sf).where("collection = 'inventory'")))
    doc = lambda name: F.get_json_object("document", f"$.{name}")
    rows = rows.select("resume_token", "sign", doc("warehouse_id").alias("warehouse"), doc("product_id").alias("product"), doc("quantity").cast("long").alias("quantity"))
    levels, batch = ["warehouse", "product"], F.pmod(F.floor(F.col("resume_token").cast("long") / IDS), F.lit(3))
    parts = [H.deltas(rows.where(batch == k), levels, F.col("quantity")) for k in range(3)]
    totals = H.merged(levels, H.merged(levels, *parts[:2]), parts[2])
    return totals.select(*(F.coalesce(c, F.lit("")).alias(c) for c in levels), "level", "total", "n")


@query("select c_custkey as wh_c_custkey, c_mktsegment as wh_c_mktsegment from customer")
def remove_and_prefix(spark, sf):
    chain = T.compose(T.without_fields(["c_acctbal", "c_name", "c_nationkey"]), T.with_prefix("wh"))
    return chain(t(spark, sf, "customer")).drop("_security_metadata")


@query("select l_orderkey, l_linenumber, case when not (l_quantity >= 0 and l_quantity < 40) then 1 else 0 end + case when l_returnflag not in ('A', 'N') then 1 else 0 end as n_errors from (select l_orderkey, l_linenumber, l_returnflag, 40 - l_quantity - 1 as q, l_quantity from lineitem)")
def contract_errors(spark, sf):
    rules = (FieldRule("flag", required=True, among=("A", "N")), FieldRule("left", "integer", True, minimum=0))
    doc = F.to_json(F.struct(F.col("l_returnflag").alias("flag"), (39 - F.col("l_quantity")).alias("left")))
    rows = t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity").select("l_orderkey", "l_linenumber", doc.alias("doc"))
    return with_broken(rows, "doc", rules).select("l_orderkey", "l_linenumber", F.size("errors").alias("n_errors"))


@query("select c_custkey, 'hash:' || to_base64(unhex(sha256('c_name' || c_name))) as hashed from customer")
def protect_hash(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", P.hashed(F.col("c_name"), "c_name").alias("hashed"))


@query("select c_custkey, left(c_name, 2) || repeat('*', greatest(length(c_name) - 5, 0)) || right(c_name, 3) as masked from customer")
def protect_mask(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", P.masked(F.col("c_name"), 2, 3, "*").alias("masked"))


@query("select p_partkey, case when length(p_name) <= 10 then p_name else left(p_name, 7) || '...' end as short from part")
def protect_truncate(spark, sf):
    return t(spark, sf, "part").select("p_partkey", P.truncated(F.col("p_name")).alias("short"))


@query("select p_partkey, case when p_size between 1 and 10 then 'small' when p_size between 11 and 30 then 'medium' else 'other' end as size_range, case p_brand when 'Brand#11' then 'house' else regexp_replace(p_brand, '[0-9]+', 'N', 'g') end as brand from part")
def protect_generalize(spark, sf):
    return t(spark, sf, "part").select("p_partkey", P.ranged(F.col("p_size"), [(1, 10, "small"), (11, 30, "medium")]).alias("size_range"), P.categorised(F.col("p_brand"), {"Brand#11": "house"}, [("[0-9]+", "N")]).alias("brand"))


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m') as month, year(o_orderdate) || '-Q' || quarter(o_orderdate) as quarter from orders")
def protect_dates(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", P.dated(F.col("o_orderdate"), "month").alias("month"), P.dated(F.col("o_orderdate"), "quarter").alias("quarter"))


@query("select c_custkey, 'TOK_' || left(to_base64(unhex(sha256('c_name' || c_name))), 10) as token from customer")
def protect_tokenize(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", P.tokenized(F.col("c_name"), "c_name").alias("token"))


@query("select c_custkey, c_name from customer")
def protect_encrypt_round_trip(spark, sf):
    key = P.derived_key("example", b"salt")
    return t(spark, sf, "customer").select("c_custkey", P.decrypted(P.encrypted(F.col("c_name"), key, "c_name"), key, "c_name").alias("c_name"))


@query("select c_custkey, repeat('X', greatest(length(c_name) - 4, 0)) || right(c_name, 4) as name, 'hash:' || to_base64(unhex(sha256('contact.segment' || c_mktsegment))) as segment from customer")
def protect_rules(spark, sf):
    doc = t(spark, sf, "customer").select("c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("cvv")).alias("contact"))
    rules = [P.Rule("contact.name", "mask"), P.Rule("contact.*", "truncate"), P.Rule("contact.segment", "hash"), *P.PII_RULES]
    return P.Protector(rules)(doc).select("c_custkey", "contact.name", "contact.segment")


@query("select p_partkey, round_even(p_size / 2.0, 0)::double as half, p_type as kind, case when p_size % 2 = 0 then 'XXX' || right('000' || p_partkey, 2) else 'clear' end as code, 1 as n_fields from part")
def protect_levels(spark, sf):
    """Rounding, no protection and removal, in a struct and for one index of an array."""
    p = t(spark, sf, "part", "p_partkey", "p_size", "p_type")
    code = F.concat(F.lit("000"), F.right(F.concat(F.lit("000"), F.col("p_partkey").cast("string")), F.lit(2)))
    doc = p.select("p_partkey", "p_size", F.struct((F.col("p_size") / 2).alias("half"), F.col("p_type").alias("kind"), F.lit("x").alias("ssn")).alias("d"), F.array(F.lit("clear"), code).alias("codes"), F.create_map(F.lit("ssn"), F.lit("1"), F.lit("note"), F.lit("2")).alias("m"))
    rules = [P.Rule("d.half", "generalize", {"places": 0}), P.Rule("d.kind", "none"), P.Rule("codes[1]", "mask", {"right": 2}), *P.PII_RULES]
    out = P.Protector(rules)(doc)
    return out.select("p_partkey", "d.half", "d.kind", F.when(F.col("p_size") % 2 == 0, F.element_at("codes", 2)).otherwise(F.element_at("codes", 1)).alias("code"), F.size("m").alias("n_fields"))


@query("select event_id, '{\"event_id\":' || event_id || ',\"user_id\":' || user_id || ',\"event_type\":\"' || event_type || '\"}' as body from events")
def serialize_round_trip(spark, sf):
    ship(spark)
    body = F.to_json(F.struct("event_id", "user_id", "event_type"))
    return t(spark, sf, "events").select("event_id", S.msgpack_to_json(S.json_to_msgpack(body)).alias("body"))


@query("select event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S+00:00') as wall_time from events")
def wall_times(spark, sf):
    return t(spark, sf, "events").select("event_id", S.wall_time(F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("wall_time"))


#: Ids of a bucket of events: keys are few, so a key's rows are spread over its buckets.
IDS = 4096


@query("select event_id, cast((row_number() over (partition by user_id order by event_id) - 1) // 5 as bigint) as batch_id from events")
def message_batches(spark, sf):
    return K.batched(t(spark, sf, "events", "event_id", "user_id"), ["user_id"], ["event_id"], 5, F.floor(F.col("event_id") / IDS)).select("event_id", "batch_id")


def recursive(source: str, key: str, order: str, start: str, step: str, out: str) -> str:
    """SQL of an ordered fold: rows of source get a number n in each key; start are the state's columns before the first, step those after row o
    following state r, in two parts: what is computed first (|) and from it."""
    first, _, then = step.partition("|")
    return f"""with recursive src as ({source}), o as (select *, row_number() over (partition by {key} order by {order}) as n from src),
r as (select {start}, * from (select *, 0 as n from (select * exclude (n) from o where n = 1))
  union all select {then}, x.* exclude (st0, {', '.join(c.split(' as ')[-1] for c in first.split(';'))}) from (select o.*, 0 as st0, {first.replace(';', ', ')} from r join o on o.{key} = r.{key} and o.n = r.n + 1) x)
select {out} from r where n > 0"""


SECONDS = "select event_id, event_type, cast(floor(epoch(ts)) as double) as s from events"


def timed(spark, sf):
    return t(spark, sf, "events", "event_id", "event_type", "ts").select("event_id", "event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double").alias("s"))


@query(recursive(SECONDS, "event_type", "s, event_id", "5.0::double as tokens, null::double as at, false as granted", "case when r.at is null then 5.0::double else least(5.0::double, r.tokens + (o.s - r.at) * 0.001::double) end as have | case when have >= 1 then have - 1 else have end, s, have >= 1", "event_id, event_type, s, granted"))
def token_bucket(spark, sf):
    ship(spark)
    return K.token_bucket(timed(spark, sf), ["event_type"], "s", 0.001, 5, ["event_id"])


@query(recursive(SECONDS, "event_type", "s, event_id", "null::double as last, false as kept", "r.last is null or o.s - r.last >= 600 as keep; r.last as was | case when keep then s else was end, keep", "event_id, event_type") + " and kept")
def rate_limited_sample(spark, sf):
    ship(spark)
    return K.spaced(timed(spark, sf), ["event_type"], "s", 600.0, ["event_id"]).where("kept").select("event_id", "event_type")


@query("""with recursive e as (select event_id, cast(floor(epoch(ts)) as double) as s from events),
k(s) as (select min(s) from e union all select (select min(e.s) from e where e.s >= k.s + 600) from k where exists (select 1 from e where e.s >= k.s + 600))
select min(event_id) as event_id from e join k on e.s = k.s group by k.s""")
def spaced_hot_key(spark, sf):
    """One sample in ten minutes of all events: a key that no task holds."""
    ship(spark)
    rows = timed(spark, sf).withColumn("all", F.lit("all"))
    return K.spaced(rows, ["all"], "s", 600.0, ["event_id"], most=1000).where("kept").select("event_id")


@query(recursive("select event_id, event_type, cast(event_id as double) as s, value < 50 as ok from events", "event_type", "s", "'closed' as state, 0 as fails, 0.0::double as since",
    "case when r.state = 'open' and o.s - r.since >= 20 then 'half_open' else r.state end as was; case when r.state = 'open' then 0 else r.fails end as had; r.since as before | "
    "case when was = 'open' then 'open' when was = 'half_open' then case when not ok then 'open' when had + 1 >= 3 then 'closed' else 'half_open' end when ok or had + 1 < 3 then 'closed' else 'open' end, "
    "case when was = 'open' then had when was = 'half_open' then case when ok and had + 1 < 3 then had + 1 else 0 end when ok or had + 1 >= 3 then 0 else had + 1 end, case when was = 'open' then before else s end", "event_id, event_type, s, ok, state"))  # fmt: skip
def circuit_breaker_states(spark, sf):
    ship(spark)
    e = t(spark, sf, "events", "event_id", "event_type", "value").select("event_id", "event_type", F.col("event_id").cast("double").alias("s"), (F.col("value") < 50).alias("ok"))
    return K.circuit_breaker(e, ["event_type"], "s", "ok", reset=20.0)


@query(recursive("select event_type, cast(epoch(date_trunc('day', ts)) as bigint) as day, avg(case when value < 80 then 1.0::double else 0 end) as success_rate from events group by all", "event_type", "day", "1000.0::double as rate",
    "r.rate as was | case when success_rate >= 0.95::double then least(5000.0::double, was * 1.1::double) when success_rate <= 0.8::double then greatest(100.0::double, was * 0.8::double) else was end", "event_type, day, success_rate, rate"))
def adaptive_rates(spark, sf):
    ship(spark)
    e = t(spark, sf, "events", "event_type", "ts", "value").withColumn("h", F.date_trunc("day", "ts"))
    return K.adaptive_rate(K.success_metrics(e, ["event_type", "h"], F.col("value") < 80).select("event_type", F.unix_timestamp(F.col("h").cast("timestamp")).alias("day"), "success_rate"), ["event_type"], ["day"], "success_rate")


@query(recursive(SECONDS, "event_type", "s, event_id", "0::bigint as batch_id, 0 as count, 0.0::double as first",
    "r.count > 0 and (r.count >= 8 or o.s - r.first >= 3600) as closed; r.batch_id as b; r.count as c; r.first as f | case when closed then b + 1 else b end, case when closed then 1 else c + 1 end, case when closed or c = 0 then s else f end", "event_id, batch_id"))
def timed_batches(spark, sf):
    """Batches of eight messages, or of what an hour brings."""
    ship(spark)
    return K.batched_in_time(timed(spark, sf), ["event_type"], "s", 8, 3600.0, ["event_id"]).select("event_id", "batch_id")


@query("select n as attempt, least(pow(2.5, n), 60.0) as delay from range(12) t(n)")
def reconnect_delays(spark, sf):
    return spark.range(12).select(F.col("id").alias("attempt"), K.jittered_backoff(F.col("id"), 1.0, 2.0, 0.5, 60.0).alias("delay"))


@query("select event_type, count(*) as operations, cast(sum(case when value < 80 then 1 else 0 end) as bigint) as ok from events group by all")
def success_counts(spark, sf):
    m = K.success_metrics(t(spark, sf, "events"), ["event_type"], F.col("value") < 80)
    return m.select("event_type", "operations", F.round(F.col("success_rate") * F.col("operations")).cast("bigint").alias("ok"))


@query("select event_type, count(*) as count from events group by all order by count desc, event_type limit 10")
def top_types(spark, sf):
    return K.top_counts(t(spark, sf, "events"), "event_type")


@query("select distinct p_size, least(cast(pow(2, p_size % 8) as double), 30.0) as delay, case when p_size >= 40 then 'critical' when p_size >= 20 then 'warning' else 'normal' end as pressure, case p_size % 3 when 0 then 'retryable' when 1 then 'transient' else 'fatal' end as class from part")
def resilience_rules(spark, sf):
    p = t(spark, sf, "part").select("p_size").distinct()
    return p.select("p_size", K.backoff_seconds(F.col("p_size") % 8).alias("delay"), K.ladder(F.col("p_size"), [(20, "warning"), (40, "critical")], "normal").alias("pressure"), K.classified((F.col("p_size") % 3).cast("string"), {"0": "retryable", "1": "transient"}).alias("class"))


@query("select event_type, bool_and(value < 100) as healthy from events group by all")
def component_health(spark, sf):
    return K.health(t(spark, sf, "events"), ["event_type"], F.col("value") < 100)


@query("select event_id from events where cast('0x' || left(md5(event_id || '|' || event_type), 7) as bigint) % 100 < 25")
def deterministic_sample(spark, sf):
    return K.hashed_sample(t(spark, sf, "events"), ["event_id", "event_type"], 25).select("event_id")


@query("select event_id from (select event_id, row_number() over (partition by event_type order by event_id) as n from events) where n % 10 = 0")
def systematic_sample(spark, sf):
    return K.systematic_sample(t(spark, sf, "events", "event_id", "event_type"), ["event_type"], ["event_id"], 10, F.floor(F.col("event_id") / IDS)).select("event_id")


@query("select event_id, case when event_type = 'click' and user_id % 2 = 0 then 0.5 when event_type = 'click' then 0.25 else 1.0 end as rate from events")
def sampling_rules(spark, sf):
    e = t(spark, sf, "events")
    kind = (F.col("user_id") % 2).cast("string")
    return e.select("event_id", K.sampling_rate(F.col("event_type"), kind, {("click", "0"): 0.5, ("click", None): 0.25}, 1.0).alias("rate"))


@query("select event_id, ts from events order by ts desc, event_id desc limit 100")
def newest_rows(spark, sf):
    return K.newest(t(spark, sf, "events", "event_id", "ts"), "ts", 100, "event_id")


@query("select event_id, event_type from events order by md5('7|' || event_id || '|' || event_type), event_id limit 50")
def reservoir(spark, sf):
    return K.reservoir_sample(t(spark, sf, "events", "event_id", "event_type"), 50, ["event_id", "event_type"], 7)


@query("select true as as_many, true as each_once from (select 1)")
def random_share(spark, sf):
    """A random fifth of events has that share, within five deviations, and no event twice."""
    e = t(spark, sf, "events", "event_id")
    n, got = e.agg(F.count("*").alias("n")), K.random_sample(e, 0.2, 7).agg(F.count("*").alias("got"), F.count_distinct("event_id").alias("ids"))
    both = n.crossJoin(got)  # one row each
    return both.select((F.abs(F.col("got") - 0.2 * F.col("n")) <= 5 * F.sqrt(0.16 * F.col("n"))).alias("as_many"), (F.col("got") == F.col("ids")).alias("each_once"))


@query("select o_orderkey, o_orderstatus, cast(round(o_totalprice) as bigint) as price from orders where o_orderstatus <> 'F'")
def not_cancelled(spark, sf):
    """Cancelled events are left out, numbers are read from text with commas."""
    o = t(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    o = o.withColumn("status", F.when(F.col("o_orderstatus") == "F", " Cancelled ").when(F.col("o_orderstatus") == "O", "open"))
    o = T.not_cancelled(o.withColumn("price", F.concat(F.lit(" "), F.format_number(F.round("o_totalprice"), 0))))
    return T.normalised_numbers(o, ["price"], "bigint").select("o_orderkey", "o_orderstatus", "price")


MOVES = "select l_orderkey, l_linenumber, l_suppkey as wh, l_partkey as sku, l_shipdate as ts, l_returnflag, cast(l_quantity as bigint) as q, case l_returnflag when 'N' then -cast(l_quantity as bigint) else cast(l_quantity as bigint) end as impact from lineitem"


def moves(spark, sf):
    q = F.col("l_quantity").cast("bigint")
    kind = F.when(F.col("l_returnflag") == "N", "sale").when(F.col("l_returnflag") == "A", "restock").otherwise("return")
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("wh"), F.col("l_partkey").alias("sku"), F.col("l_shipdate").alias("ts"), "l_returnflag", q.alias("q"), I.impact(kind, q).alias("impact"))


@query(f"with m as ({MOVES}) select l_orderkey, l_linenumber, wh || ':' || sku as key, cast(sum(impact) over (partition by wh, sku order by ts, l_orderkey, l_linenumber rows unbounded preceding) as bigint) as stock from m")
def running_stock(spark, sf):
    return I.running_stock(moves(spark, sf), ["wh", "sku"], ["ts", "l_orderkey", "l_linenumber"], "impact").select("l_orderkey", "l_linenumber", I.stock_key(F.col("wh"), F.col("sku")).alias("key"), "stock")


@query(f"""with m as ({MOVES}), s as (select *, case when l_orderkey % 10 = 0 then q end as snap from m),
e as (select *, count(snap) over (partition by wh, sku order by ts, l_orderkey, l_linenumber rows unbounded preceding) as epoch from s)
select l_orderkey, l_linenumber, cast(sum(coalesce(snap, impact)) over (partition by wh, sku, epoch order by ts, l_orderkey, l_linenumber rows unbounded preceding) as bigint) as stock from e""")
def stock_with_snapshots(spark, sf):
    m = moves(spark, sf).withColumn("snap", F.when(F.col("l_orderkey") % 10 == 0, F.col("q")))
    return I.running_stock(m, ["wh", "sku"], ["ts", "l_orderkey", "l_linenumber"], "impact", "snap").select("l_orderkey", "l_linenumber", "stock")


@query(f"with m as ({MOVES}) select wh, sku, cast(sum(impact) as bigint) as stock, count(*) as transactions, max(ts) as last_change, cast(sum(impact) as bigint) - count(*) as available from m group by all")
def stock_state(spark, sf):
    s = I.current_state(moves(spark, sf), ["wh", "sku"], "ts", "impact")
    return s.withColumn("available", I.available(F.col("stock"), F.col("transactions")))


@query(f"with m as ({MOVES}) select p_brand, p_type, cast(sum(impact) as bigint) as total, count(*) as n, cast(2 - grouping(p_brand) - grouping(p_type) as integer) as level from m join part on p_partkey = sku group by rollup (p_brand, p_type)")
def stock_rollup(spark, sf):
    m = moves(spark, sf).join(t(spark, sf, "part", "p_partkey", "p_brand", "p_type"), F.col("sku") == F.col("p_partkey"))
    return I.rolled_up(m, ["p_brand", "p_type"], "impact")


@query(f"with m as ({MOVES}) select p_brand, cast(sum(impact) as bigint) as total, count(*) as n from m join part on p_partkey = sku group by all")
def drill_down(spark, sf):
    return I.at_level(stock_rollup(spark, sf), 1).select("p_brand", "total", "n")


@query(f"with m as ({MOVES}) select sku, cast(sum(impact) as bigint) as stock, count(distinct wh) as warehouses from m group by all")
def cross_warehouse(spark, sf):
    return I.across_warehouses(moves(spark, sf), "wh", "sku", "impact")


@query(f"""with m as ({MOVES}), d as (select wh, sku, datediff('day', date '1970-01-01', cast(ts as date)) as day, impact from m), k as (select wh, sku, max(day) - min(day) + 1 as days, sum(impact) as change from d group by all)
select wh, sku, cast(days as bigint) as days, cast(change as bigint) as change, greatest(-change / days, 0.0::double) as per_day from k""")
def depletion_rates(spark, sf):
    m = moves(spark, sf).select("wh", "sku", F.unix_date(F.to_date("ts")).alias("day"), "impact")
    return I.depletion(m, ["wh", "sku"], "day", "impact")


@query(f"with m as ({MOVES}), s as (select wh, sku, sum(impact) as stock, max(ts) as last_change, count(*) as transactions from m group by all) select wh, sku, cast(stock as bigint) as stock, transactions, last_change from s where epoch(timestamp '1998-06-01') - epoch(last_change) <= 86400 * 365")
def unexpired_state(spark, sf):
    s = I.current_state(moves(spark, sf), ["wh", "sku"], "ts", "impact")
    return I.unexpired(s, "last_change", F.lit("1998-06-01").cast("timestamp"), 86400 * 365)


@query("""with u as (select user_id, ts, max(cast(floor(value) as bigint)) as threshold from events where event_type = 'purchase' group by all)
select e.event_id, coalesce(u.threshold, -1) as threshold from (select * from events where event_type = 'view') e asof left join u on e.user_id = u.user_id and e.ts >= u.ts""")
def threshold_updates(spark, sf):
    """Each view with the threshold that its user's last purchase set."""
    e = t(spark, sf, "events", "event_id", "event_type", "user_id", "ts", "value")
    updates = e.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max(F.floor("value")).alias("threshold"))
    return I.current_thresholds(e.where("event_type = 'view'").select("event_id", "user_id", "ts"), updates, ["user_id"], "ts").select("event_id", F.coalesce("threshold", F.lit(-1)).alias("threshold"))


@query(f"""with m as ({MOVES}), d as (select sku, datediff('day', date '1970-01-01', cast(ts as date)) as day, cast(sum(q) as bigint) as sold from m where l_returnflag = 'N' group by all),
v as (select sku, day, sum(sold) over (partition by sku order by day range between 29 preceding and current row) / 30.0::double as per_day from d)
select sku, cast(day as integer) as day, cast(ceil(per_day * 14.0::double) as bigint) as threshold, case when per_day > 0 then 100 / per_day end as cover from v""")
def cover_thresholds(spark, sf):
    """The stock that lasts two weeks at the last month's sales, and how long a hundred pieces last."""
    d = moves(spark, sf).where("l_returnflag = 'N'").groupBy("sku", F.unix_date(F.to_date("ts")).alias("day")).agg(F.sum("q").alias("sold"))
    v = I.velocity(d, ["sku"], "day", "sold", 30)
    return v.select("sku", "day", I.cover_threshold(F.col("per_day"), 14).alias("threshold"), I.cover_days(F.lit(100), F.col("per_day")).alias("cover"))


@query(f"with m as ({MOVES}) select wh, round(avg(q) + 2 * coalesce(stddev_samp(q), 0), 6) as threshold from m group by all")
def dynamic_thresholds(spark, sf):
    return I.dynamic_threshold(moves(spark, sf), ["wh"], "q", 2).select("wh", F.round("threshold", 6).alias("threshold"))


@query("select l_returnflag as flag, cast(isodow(l_shipdate) as integer) as season, count(*) as n, true as within from lineitem group by all")
def seasonal_thresholds(spark, sf):
    """The nine-tenths quantile of each weekday's prices from daily sketches merged over all days, held against the exact ranks."""
    l = t(spark, sf, "lineitem", "l_returnflag", "l_shipdate", "l_extendedprice").withColumnRenamed("l_returnflag", "flag")  # noqa: E741
    season, price = seasonal.weekday(F.to_date("l_shipdate")), F.col("l_extendedprice")
    sketches = seasonal.daily(l, ["flag"], F.to_date("l_shipdate"), price)
    found = seasonal.quantile(seasonal.seasons(sketches, ["flag"], seasonal.weekday(F.col("day"))), 0.9)
    ranked = l.withColumn("season", season).join(found.select("flag", "season", "threshold", "n"), ["flag", "season"]).groupBy("flag", "season", "n")
    exact = ranked.agg(F.count("*").alias("rows"), F.avg((price < F.col("threshold")).cast("int")).alias("low"), F.avg((price <= F.col("threshold")).cast("int")).alias("high"))
    # Of few values one is more than the sketch's error.
    error = F.lit(seasonal.RANK_ERROR) + 1 / F.col("rows")
    return exact.select("flag", F.col("season").cast("int").alias("season"), "n", ((F.col("rows") == F.col("n")) & (F.col("low") <= 0.9 + error) & (F.col("high") >= 0.9 - error)).alias("within"))


@query(f"""with recursive m as ({MOVES}), st as (select *, sum(impact) over (partition by wh, sku order by ts, l_orderkey, l_linenumber rows unbounded preceding) as stock, epoch(ts) as sec from m),
b as (select *, stock <= 20 as now, coalesce(lag(stock <= 20) over (partition by wh, sku order by sec, l_orderkey, l_linenumber), false) as was from st),
g as (select *, sum(case when now and not was then 1 else 0 end) over (partition by wh, sku order by sec, l_orderkey, l_linenumber rows unbounded preceding) as run from b),
o as (select *, row_number() over (partition by wh, sku, run order by sec, l_orderkey, l_linenumber) as n from g where now),
r as (select wh, sku, run, n, l_orderkey, l_linenumber, sec as last, true as kept from o where n = 1
  union all select o.wh, o.sku, o.run, o.n, o.l_orderkey, o.l_linenumber, case when o.sec - r.last >= 2592000 then o.sec else r.last end, o.sec - r.last >= 2592000 from r join o on o.wh = r.wh and o.sku = r.sku and o.run = r.run and o.n = r.n + 1)
select wh, sku, l_orderkey, l_linenumber from r where kept""")
def cooled_alerts(spark, sf):
    """Low stock: an alert when it begins, and again a month after the last one while it lasts."""
    ship(spark)
    s = I.running_stock(moves(spark, sf), ["wh", "sku"], ["ts", "l_orderkey", "l_linenumber"], "impact")
    s = s.withColumn("sec", F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double")).select("wh", "sku", "l_orderkey", "l_linenumber", "stock", "sec")
    return I.alerts(s, ["wh", "sku"], "sec", ["l_orderkey", "l_linenumber"], F.col("stock") <= 20, 86400.0 * 30).select("wh", "sku", "l_orderkey", "l_linenumber")


@query("""select p_partkey, cast(case when p_partkey % 10 = 0 then p_size when p_brand = 'Brand#11' then 77 when p_type like 'PROMO%' then 55 else 9 end as bigint) as threshold from part""")
def threshold_resolution(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.col("p_partkey").cast("string").alias("sku"), "p_brand", "p_type", F.lit("W1").alias("warehouse"), "p_size")
    row = lambda df, level, value, amount: df.select(F.lit(level).alias("level"), value.cast("string").alias("value"), F.lit(None).cast("string").alias("warehouse"), amount.cast("bigint").alias("threshold"))
    th = row(p.where("p_partkey % 10 = 0"), "sku", F.col("sku"), F.col("p_size"))
    th = th.union(row(p.where("p_brand = 'Brand#11'").select("p_brand").distinct(), "brand", F.col("p_brand"), F.lit(77)))
    th = th.union(row(p.where("p_type like 'PROMO%'").select("p_type").distinct(), "category", F.col("p_type"), F.lit(55)))
    return I.resolved_thresholds(p, th, {"sku": "sku", "brand": "p_brand", "category": "p_type"}, 9, ["p_partkey"]).select("p_partkey", F.col("threshold").cast("bigint").alias("threshold"))


@query(f"""with m as ({MOVES}), d as (select sku, datediff('day', date '1970-01-01', cast(ts as date)) as day, cast(sum(q) as bigint) as sold from m where l_returnflag = 'N' group by all)
select sku, cast(day as integer) as day, cast(sum(sold) over (partition by sku order by day range between 29 preceding and current row) as bigint) as sold_30 from d""")
def sales_velocity(spark, sf):
    d = moves(spark, sf).where("l_returnflag = 'N'").groupBy("sku", F.unix_date(F.to_date("ts")).alias("day")).agg(F.sum("q").alias("sold"))
    return I.velocity(d, ["sku"], "day", "sold", 30).select("sku", "day", F.round(F.col("per_day") * 30).cast("bigint").alias("sold_30"))


@query(f"""with m as ({MOVES}), s as (select *, sum(impact) over (partition by wh, sku order by ts, l_orderkey, l_linenumber rows unbounded preceding) as stock from m),
b as (select *, stock <= 20 as now, coalesce(lag(stock <= 20) over (partition by wh, sku order by ts, l_orderkey, l_linenumber), false) as was from s)
select 'alt-' || strftime(ts, '%Y%m%d') || '-' || wh || '-' || sku as alert_id, l_orderkey, l_linenumber, case when stock <= 0 then 'stockout' when 2 * stock <= 20 then 'low_stock' else 'reorder' end as kind,
case when stock <= 0 then 'critical' when 2 * stock <= 20 then 'high' else 'medium' end as severity, s_name from b join supplier on s_suppkey = wh where now and not was""")
def stock_alerts(spark, sf):
    order = ["ts", "l_orderkey", "l_linenumber"]
    s = I.running_stock(moves(spark, sf), ["wh", "sku"], order, "impact")
    a = I.breaches(s, ["wh", "sku"], order, F.col("stock") <= 20).withColumn("kind", I.alert_kind(F.col("stock"), F.lit(20)))
    a = a.join(t(spark, sf, "supplier", "s_suppkey", "s_name"), F.col("wh") == F.col("s_suppkey"))
    return a.select(I.alert_id(F.col("ts"), F.col("wh").cast("string"), F.col("sku").cast("string")).alias("alert_id"), "l_orderkey", "l_linenumber", "kind", I.severity(F.col("kind")).alias("severity"), "s_name")


@query(f"with m as ({MOVES}), s as (select wh, sku, sum(impact) as stock from m group by all) select wh, count(*) as items, count(*) filter (where stock <= 0) as out_of_stock, count(*) filter (where stock <= 20) as below, count(*) filter (where stock <= 0) / count(*) as stockout_rate from s group by all")
def business_metrics(spark, sf):
    s = moves(spark, sf).groupBy("wh", "sku").agg(F.sum("impact").alias("stock"))
    return I.stock_metrics(s, ["wh"], 20)


@query("select date_trunc('hour', ts) as start, event_type, count(*) as n from events group by all")
def windowed(spark, sf):
    e = t(spark, sf, "events", "ts", "event_type").withColumn("ts", F.col("ts").cast("timestamp"))
    return windowed_counts(e, "ts", "event_type").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""with g as (select user_id, ts, case when lag(ts) over w is null or ts >= lag(ts) over w + interval 30 minute then 1 else 0 end as fresh from events window w as (partition by user_id order by ts)),
s as (select user_id, ts, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as k from g) select user_id, min(ts) as start, count(*) as n from s group by user_id, k""")
def user_sessions(spark, sf):
    e = t(spark, sf, "events", "ts", "user_id").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions(e, "ts", "user_id").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("select 'orders' as collection, count(*) as n, count(o_orderkey) as keys from orders union all select 'customers', count(*), 0 from customer union all select 'events', count(*), 0 from events")
def fan_in(spark, sf):
    """Collections from sources of their own, each with its own columns."""
    parts = [("orders", t(spark, sf, "orders", "o_orderkey")), ("customers", t(spark, sf, "customer", "c_name")), ("events", t(spark, sf, "events", "event_id", "event_type"))]
    return cdc.fan_in(parts).groupBy("collection").agg(F.count("*").alias("n"), F.count("o_orderkey").alias("keys"))
