"""Small cases of the functions and operators, with brute force for ordered folds."""

import json
import re
import struct
from datetime import UTC, datetime, timedelta
from enum import Enum

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewire.functions import protection as P
from tidewire.functions import serialization as S
from tidewire.operators import keyed as K
from tidewire.operators import transforms as T
from tidewire.operators import inventory as I
from tidewire.operators.validation import CONTRACTS, Contracts, FieldRule, Migrations, errors, validated
from tidewire.plans import cdc
from tidewire.sources import changes, config, sinks
from tidewire.streaming.control import Callbacks, heartbeat_of, send_heartbeats, stop_all
from tidewire.streaming.stateful import fresh_stream, sessions, stock_stream, windowed_counts

PLAIN = st.recursive(st.none() | st.booleans() | st.integers(-(2**63), 2**64 - 1) | st.floats(allow_nan=False) | st.text() | st.binary(), lambda x: st.lists(x) | st.dictionaries(st.text(), x), max_leaves=20)


@given(PLAIN)
def test_msgpack_round_trip(value):
    assert S.unpack(S.pack(value)) == value


#: Bytes that the public specification gives, not our own.
WIRE = [
    (None, "c0"), (True, "c3"), (False, "c2"), (0, "00"), (127, "7f"), (128, "cc80"), (255, "ccff"), (256, "cd0100"), (65536, "ce00010000"), (2**32, "cf0000000100000000"), (-1, "ff"), (-32, "e0"), (-33, "d0df"),
    (-128, "d080"), (-129, "d1ff7f"), (-32769, "d2ffff7fff"), (-(2**63), "d38000000000000000"), (1.5, "cb3ff8000000000000"), ("", "a0"), ("a", "a161"), ("x" * 32, "d920" + "78" * 32), ("x" * 256, "da0100" + "78" * 256),
    (b"ab", "c4026162"), ([], "90"), ([1, 2], "920102"), ([0] * 16, "dc0010" + "00" * 16), ({}, "80"), ({"compact": True, "schema": 0}, "82a7636f6d70616374c3a6736368656d6100"), ({str(k): k for k in range(16)}, None),
]


@pytest.mark.parametrize(("value", "wire"), WIRE, ids=str)
def test_msgpack_wire(value, wire):
    assert wire is None or S.pack(value).hex() == wire
    assert S.unpack(S.pack(value)) == value


@pytest.mark.parametrize("raw", ["", "c1", "a2", "a261", "92", "9201", "81a161", "d9", "c5ffff", "0000", "ca00", "da"])
def test_not_msgpack(raw):
    with pytest.raises((ValueError, IndexError, struct.error)):
        S.unpack(bytes.fromhex(raw))


def test_tags():
    class Kind(Enum):
        SALE = "sale"

    at = datetime(2024, 1, 2, tzinfo=UTC)
    value = {"a": [at], "k": S.ObjectId("0" * 24), "t": S.Timestamp(7, 3), "e": Kind.SALE}
    assert S.tagged(value) == {"a": [{"__type__": "datetime", "value": "2024-01-02T00:00:00+00:00"}], "k": {"__type__": "ObjectId", "value": "0" * 24}, "t": {"__type__": "Timestamp", "value": 7}, "e": {"__type__": "Enum", "value": "sale"}}
    assert S.untagged(S.unpack(S.pack(S.tagged(value)))) == {"a": [at], "k": S.ObjectId("0" * 24), "t": S.Timestamp(7), "e": "sale"}
    assert json.loads(S.json_text(value)) == {"a": ["2024-01-02T00:00:00+00:00"], "k": "0" * 24, "t": 7, "e": "sale"}
    assert S.untagged({"__type__": "other", "value": 1}) == {"__type__": "other", "value": 1}


def test_messages_in_columns(spark):
    schema = "at timestamp, parts array<struct<at:timestamp>>, n double"
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5, 600), [(datetime(2024, 1, 2),)], 1.0), (None, None, None)], schema)
    body = F.struct("at", "parts", "n")
    got = [S.untagged(S.unpack(bytes(r.v))) for r in df.select(S.serialized(body, "msgpack", df.schema).alias("v")).collect()]
    assert got[0]["at"] == datetime(2024, 1, 2, 3, 4, 5, 600, UTC) and got[0]["parts"][0]["at"] == datetime(2024, 1, 2, tzinfo=UTC) and got[0]["n"] == 1.0
    back = df.select(S.parsed(S.serialized(body, "json"), "json", schema).alias("m")).select("m.*")
    assert back.collect() == df.collect()
    bad = spark.createDataFrame([(b"\xff\xfe",), (b"{",), (None,)], "v binary")
    for form in ("json", "msgpack"):
        assert [r.m for r in bad.select(S.parsed(F.col("v"), form, "a int").alias("m")).collect()] == [None] * 3
    with pytest.raises(ValueError):
        S.parsed(F.col("v"), "xml", "a int")


@pytest.mark.parametrize(("path", "matcher", "fits"), [("a.b", "a.b", True), ("a.b", "a.*", True), ("a.b.c", "a.*", False), ("a[0].b", "a[*].b", True), ("a[0].b", "a.*.b", False), ("a.b", "*", False), ("", "*", False), ("a.b", "", False), ("a.email", re.compile("a"), True), ("b", re.compile("a"), False)])
def test_paths(path, matcher, fits):
    assert P.path_matches(path, matcher) is fits


def test_strongest_rule_wins():
    rules = [P.Rule("a", "truncate"), P.Rule("a", "remove"), P.Rule("a", "hash")]
    assert P.chosen_rule("a", rules).level == "remove"
    with pytest.raises(ValueError):
        P.Rule("a", "hide")


def test_protector(spark):
    df = spark.createDataFrame([(json.loads(json.dumps({"email": "customer@x.org", "payment": {"card_number": "4111111111111111", "cvv": "123"}})),)], "customer struct<email:string,payment:struct<card_number:string,cvv:string>>")
    out = P.Protector([*P.PII_RULES, *P.PAYMENT_RULES])(df).first()
    assert out.customer.email == "cu************" and out.customer.payment.card_number == "XXXXXXXXXXXX1111"
    assert "cvv" not in out.customer.payment.asDict() and out._protected["customer.payment.cvv"] == "remove"


def test_arrays_are_protected(spark):
    df = spark.createDataFrame([([{"email": "ab@c"}, None],)], "people array<struct<email:string>>")
    out = P.Protector([P.Rule("people[*].email", "mask", {"left": 1, "right": 0, "char": "*"})])(df).first()
    assert [p and p.email for p in out.people] == ["a***", None]


def protected(spark, rules, value, schema):
    return json.loads(P.Protector(rules)(spark.createDataFrame([(value,)], schema)).toJSON().first())


def test_protection_of_single_elements(spark):
    """A rule for an index applies to that index alone."""
    people = [{"ssn": "1"}, {"ssn": "2"}, {"ssn": "3"}]
    out = protected(spark, [P.Rule("people[1].ssn", "hash", {"salt": False}), P.Rule("people[*].ssn", "truncate")], people, "people array<struct<ssn:string>>")
    assert [p["ssn"][:5] for p in out["people"]] == ["1", "hash:", "3"]
    out = protected(spark, [P.Rule("people[1].ssn", "remove")], people, "people array<struct<ssn:string>>")
    assert [p.get("ssn") for p in out["people"]] == ["1", None, "3"]


def test_protection_of_maps(spark):
    value = {"ssn": "123456789", "home_PHONE": "5551234567", "note": "x"}
    out = protected(spark, [P.Rule("m.ssn", "remove"), *P.PII_RULES], value, "m map<string,string>")
    assert out["m"] == {"home_PHONE": "******4567", "note": "x"}
    assert protected(spark, [P.Rule("m.*", "remove")], value, "m map<string,string>")["m"] == {}
    out = protected(spark, [P.Rule("m.b", "mask", {"right": 1})], {"a": 12, "b": 345}, "m map<string,int>")
    assert out["m"] == {"a": "12", "b": "XX5"}
    out = protected(spark, P.PII_RULES, {"x": [{"Email": "ab@c"}]}, "m map<string,array<struct<Email:string>>>")
    assert out["m"]["x"][0]["Email"] == "ab**"


def test_rules_that_cannot_apply_raise(spark):
    df = spark.createDataFrame([({"a": "x"}, [1], {"k": "v"})], "s struct<a:string>, n array<int>, m map<string,string>")
    for name in ("s", "n", "m"):
        with pytest.raises(ValueError, match="no leaf"):
            P.Protector([P.Rule(name, "mask")])(df)
    with pytest.raises(ValueError, match="function"):
        P.Protector([P.Rule(lambda path: True, "mask")])(df)
    for wrong in (("a", "generalize", {}), ("a", "mask", {"colour": 1}), ("a", "generalize", {"unit": "week"}), ("", "mask", {})):
        with pytest.raises(ValueError):
            P.Rule(*wrong)
    with pytest.raises(ValueError, match="key"):
        P.Protector([P.Rule("s.a", "encrypt")])(df)


@pytest.mark.parametrize("name", ["customer_email", "EMAIL_ADDR", "email", "x_Email_y"])
def test_personal_data_is_told_by_any_part_of_a_name(spark, name):
    assert protected(spark, P.PII_RULES[:1], "someone@x.org", f"`{name}` string")[name] == "so***********"


@pytest.mark.parametrize(("address", "shown"), [("123 Main St", "[NUMBER] Main St"), ("5 Elm, 90210-1234", "[NUMBER] Elm, [POSTAL]"), ("Main St Suite B", "Main St [UNIT]"), ("no number", "no number")])
def test_addresses(spark, address, shown):
    assert protected(spark, P.PII_RULES, address, "billing_address string")["billing_address"] == shown


def test_payments(spark):
    value = {"cardNumber": "4111111111111111", "CVC": "9", "expiration": "2027-03-01", "total_price": "12.5", "amount": 2.5, "price": "n/a"}
    out = protected(spark, P.PAYMENT_RULES, value, "p struct<cardNumber:string,CVC:string,expiration:string,total_price:string,amount:double,price:string>")
    assert out["p"] == {"cardNumber": "XXXXXXXXXXXX1111", "expiration": "2027-03", "total_price": 12.0, "amount": 2.0}


def test_other_hashes(spark):
    import base64
    import hashlib

    df = spark.createDataFrame([("a",), (None,)], "v string")
    for name in ("sha3_256", "blake2b", "md5", "sha384"):
        got = [r.h for r in df.select(P.hashed(F.col("v"), "p", name).alias("h")).collect()]
        assert got == ["hash:" + base64.b64encode(hashlib.new(name, b"pa").digest()).decode(), None]
    with pytest.raises(ValueError):
        P.hashed(F.col("v"), "p", "rot13")


def test_registry(spark):
    df, r = spark.range(1), T.Registry()
    seen = []
    for k in (1, 2):
        r.register("pre_publish", "inventory", lambda d, k=k: (seen.append(k), d)[1])
    r.register("pre_publish", "inventory", lambda d: (seen.append(3), d)[1], position=1)
    r.apply(df, "pre_publish", "inventory")
    assert seen == [1, 3, 2]
    r.clear("pre_publish")
    r.register("pre_publish", "inventory", lambda d: None)
    with pytest.raises(T.TransformError):
        r.apply(df, "pre_publish", "inventory")


def test_fields(spark):
    df = spark.createDataFrame([(1, {"x": "a", "y": "b"}, "m")], "a int, n struct<x:string,y:string>, _m string")
    out = T.with_prefix("p", ["a", "n.x"])(df)
    assert out.columns == ["p_a", "n", "_m", "_security_metadata"] and out.first()._security_metadata.prefixed_fields == ["a", "n.x"]
    assert T.with_prefix("p")(df).schema["p_n"].dataType.names == ["p_x", "p_y"]
    out = T.without_fields(["n.y", "a.b", "zz"])(df)
    assert out.schema["n"].dataType.names == ["x"] and out.first()._security_metadata.removed_fields == ["n.y", "a.b", "zz"]


VALID = {"_schema_version": "v1", "product_id": "P1", "warehouse_id": "W1", "quantity": 1, "last_updated": "2024-01-01T00:00:00Z"}


@pytest.mark.parametrize(("change", "broken"), [({}, []), ({"quantity": -5}, ["quantity: minimum"]), ({"quantity": "x"}, ["quantity: integer"]), ({"quantity": True}, ["quantity: integer"]), ({"quantity": 1.0}, []), ({"warehouse_id": None}, ["warehouse_id: string"]), ({"last_updated": "2024-01-01"}, ["last_updated: date-time"]), ({"last_updated": "2024-13-01T00:00:00Z"}, ["last_updated: date-time"]), ({"last_updated": "2024-01-01T25:00:00Z"}, ["last_updated: date-time"]), ({"last_updated": "2024-01-01T00:00:00.123-05:00"}, []), ({"extra": 1}, []), ({"_schema_version": "v999"}, ["_schema_version: enum"])])
def test_contract(spark, change, broken):
    df = spark.createDataFrame([(json.dumps(VALID | change),)], "j string")
    assert df.select(errors(F.col("j"), Contracts().rules("inventory")).alias("e")).first().e == broken


@pytest.mark.parametrize("text", ["", "[1]", "nonsense", None])
def test_no_document(spark, text):
    df = spark.createDataFrame([(text,)], "j string")
    assert df.select(errors(F.col("j"), Contracts().rules("inventory")).alias("e")).first().e == ["document: object"]


TIMES = {True: ["2024-03-14T12:00:00Z", "2024-03-14T12:00:00.123Z", "2024-03-14T12:00:00.123456Z", "2024-03-14T12:00:00+00:00", "2024-03-14T12:00:00.123+00:00", "2024-03-14T12:00:00-05:00"], False: ["2024-03-14", "12:00:00Z", "2024-03-14 12:00:00Z", "2024-03-14T12:00:00", "2024-03-14T12:00:00GMT", "2024-03-14T25:00:00Z", "2024-03-14T12:60:00Z", "2024-03-14T12:00:61Z", "2024-13-14T12:00:00Z", "2024-03-32T12:00:00Z", "not a time", "2024/03/14T12:00:00Z", "2024-03-14T12.00.00Z", "2023-02-29T12:00:00Z"]}


def test_times(spark):
    rows = [(json.dumps(VALID | {"last_updated": t}), fine) for fine, times in TIMES.items() for t in times]
    found = validated(spark.createDataFrame(rows, "j string, fine boolean"), "j", F.lit("inventory")).collect()
    assert len(found) == 20 and all((r.errors == []) is r.fine for r in found), [r for r in found if (r.errors == []) is not r.fine]


def test_arrays_in_arrays_are_protected(spark):
    rows = [([{"items": [{"details": {"price": 12.5, "sku": "S"}}], "customer": {"contact": [{"email": "a@b.c"}, {"email": None}]}}],)]
    df = spark.createDataFrame(rows, "orders array<struct<items:array<struct<details:struct<price:double,sku:string>>>,customer:struct<contact:array<struct<email:string>>>>>")
    out = json.loads(P.Protector([P.Rule("orders[*].items[*].details.price", "mask", {"right": 0}), P.Rule("orders[*].customer.contact[*].email", "hash")])(df).toJSON().first())
    assert out["orders"][0]["items"][0]["details"] == {"price": "XXXX", "sku": "S"} and out["orders"][0]["customer"]["contact"][0]["email"].startswith("hash:") and out["orders"][0]["customer"]["contact"][1] == {}
    assert out["_protected"] == {"orders[*].items[*].details.price": "mask", "orders[*].customer.contact[*].email": "hash"}


def test_nested_prefixes(spark):
    df = spark.createDataFrame([(1, 2, {"field1": 3, "field2": 4}, [1], "m")], "field1 int, field2 int, nested struct<field1:int,field2:int>, other array<int>, _metadata string")
    out = T.with_prefix("test", ["field1", "nested.field2"])(df).drop("_security_metadata")
    assert out.columns == ["test_field1", "field2", "nested", "other", "_metadata"] and out.schema["nested"].dataType.names == ["field1", "test_field2"]
    assert T.with_prefix("test")(df).columns[:5] == ["test_field1", "test_field2", "test_nested", "test_other", "_metadata"]


def test_versions():
    c = Contracts({("inventory", f"v{n}"): (FieldRule("a"),) for n in (1, 9, 10)})
    assert c.latest("inventory") == "v10" and c.is_version("inventory", "v9")
    with pytest.raises(ValueError, match="Invalid schema version"):
        c.rules("inventory", "v2")


def test_migrations(spark):
    m = Migrations()
    m.register("inventory", "v1", "v2", lambda d: d.withColumn("b", F.lit(2)))
    m.register("inventory", "v2", "v3", lambda d: d.withColumn("c", F.col("b") + 1))
    df = spark.createDataFrame([("v1", 1), ("v2", 1), (None, 5), ("", 6), ("v7", 8), ("v3", 9)], "_schema_version string, a int").withColumn("b", F.lit(7))
    out = m.apply(df, "inventory", "v3").collect()
    assert sorted((r.a, r.c) for r in out if r._migration_error is None and r.a != 9) == [(1, 3), (1, 8), (5, 3), (6, 3)]
    assert [(r.a, r._schema_version, r._migration_error) for r in out if r._migration_error] == [(8, "v7", "no migration of inventory from v7 to v3")]
    assert [(r._schema_version, r.b, r.c) for r in out if r.a == 9] == [("v3", 7, None)] and len(out) == 6
    with pytest.raises(ValueError):
        m.path("inventory", "v3", "v1")


INVENTORY = VALID
OWN_VERSION = [({}, None), ({"_schema_version": "v999"}, "Invalid schema version for inventory: v999"), ({"_schema_version": None}, None), ({"_schema_version": ""}, None), ({"_schema_version": 5}, "Invalid schema version for inventory: 5"), ({"quantity": None}, "quantity: integer"), ({"_schema_version": "v2"}, "size: required"), ({"_schema_version": "v2", "size": "L"}, None)]


@pytest.mark.parametrize(("change", "broken"), OWN_VERSION, ids=str)
def test_documents_are_read_by_their_own_version(spark, change, broken):
    contracts = Contracts(CONTRACTS | {("inventory", "v2"): (FieldRule("size", required=True),)})
    contracts = contracts if change.get("_schema_version") == "v2" else Contracts()
    df = spark.createDataFrame([(json.dumps(VALID | change),)], "j string")
    assert validated(df, "j", F.lit("inventory"), contracts).first().errors == ([broken] if broken else [])


def event(k, kind, document, collection="transactions", key="d1"):
    return (f"{k:03}", collection, kind, key, datetime(2024, 1, 1) + timedelta(seconds=k), None if document is None else json.dumps(document) if isinstance(document, dict) else document)


SALE = {"_id": "test1", "_schema_version": "v1", "transaction_id": "T123", "product_id": "P123", "warehouse_id": "W1", "quantity": 10, "transaction_type": "sale", "timestamp": "2024-01-01T00:00:00+00:00", "order_id": "O123", "customer_id": "C123", "notes": "Test transaction"}


def test_insert_update_delete(spark):
    """Three changes of one document are three messages."""
    rows = [event(1, "insert", SALE), event(2, "update", SALE | {"quantity": 15}), event(3, "delete", None)]
    messages, dead = cdc.pipeline(spark.createDataFrame(rows, changes.SCHEMA), {"transactions": "t"})
    got = sorted((json.loads(r.value) for r in messages.collect()), key=lambda m: m["timestamp"])
    assert [m["operation"] for m in got] == ["insert", "update", "delete"] and dead.count() == 0
    assert got[1]["data"]["fullDocument"] == SALE | {"quantity": 15} and "fullDocument" not in got[2]["data"]
    assert got[0]["data"]["documentKey"] == {"_id": "d1"} and got[0]["data"]["wallTime"] == "2024-01-01T00:00:01+00:00"


def test_documents_are_transformed_protected_and_set_aside(spark, tmp_path):
    person = {"customer_email": "someone@x.org", "customer": {"address": "1 Main St", "name": "N"}, "payment": {"card_number": "4111111111111111", "cvv": "123"}}
    rows = [event(1, "insert", SALE | person, key="a"), event(2, "insert", SALE | {"_schema_version": "v999"}, key="b"), event(3, "insert", "{not json", key="c"), event(4, "insert", SALE | {"transaction_type": "gift"}, key="d"), event(5, "replace", {"any": 1}, key="e"), event(5, "insert", SALE | {"x": 1}, key=None), event(6, "insert", SALE | {"x": 1}, key=None)]
    plan = cdc.Plan(T.default_registry("W1"), protectors={"transaction": P.Protector([P.Rule("notes", "mask"), *P.PII_RULES])})
    messages, dead = cdc.pipeline(spark.createDataFrame(rows, changes.SCHEMA), {"transactions": "t"}, plan=plan, store=str(tmp_path / "checked"))
    got = {(m := json.loads(r.value))["data"]["_id"]: m["data"] for r in messages.collect()}
    assert set(got) == {"001", "005", "006"}
    doc = got["001"]["fullDocument"]
    assert "someone" not in json.dumps(doc) and doc["customer"] == {"name": "N"} and not doc.get("payment") and doc["wh_W1__product_id"] == "P123"
    assert doc["notes"] == "XXXXXXXXXXXXtion" and doc["_processing_metadata"]["processor_version"] == "1.0" and doc["_security_metadata"]["field_prefix"] == "wh_W1_"
    assert {r.resume_token: r.errors for r in dead.collect()} == {"002": ["Invalid schema version for transaction: v999"], "003": ["document: object"], "004": ["transaction_type: enum"]}


def test_running_sums_in_buckets(spark):
    """The same as by one window, with null keys, null values and empty buckets; a snapshot starts anew across buckets."""
    import random

    r = random.Random(3)
    rows = [(r.choice(["a", "b", None]), k * r.choice([1, 1, 40]) + k, r.choice([None, 1, -2, 5]), r.choice([None] * 6 + [100])) for k in range(400)]
    rows = [(k, n, c, s) for n, (k, _, c, s) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, n long, change long, snap long")
    bucket = F.floor(F.col("n") / 37)
    for f in (lambda b: K.batched(df, ["k"], ["n"], 7, b), lambda b: K.systematic_sample(df, ["k"], ["n"], 9, b), lambda b: I.running_stock(df, ["k"], ["n"], "change", "snap", b)):
        one, two = (sorted(map(tuple, f(b).select(sorted(f(b).columns)).collect()), key=str) for b in (None, bucket))
        assert one == two and one
    plain = df.fillna(0, ["change"])
    one, two = (sorted((r.n, r.stock) for r in I.running_stock(plain, ["k"], ["n"], "change", bucket=b).collect()) for b in (None, bucket))
    assert one == two


def test_rows_without_a_key_are_spread(spark):
    rows = [(None, k, k) for k in range(2000)]
    out = K.fresh(spark.createDataFrame(rows, "k string, ts int, n int"), ["k"], "ts", "n")
    assert out.count() == 2000 and "_part" in out._jdf.queryExecution().optimizedPlan().toString()


def test_alerts_recover(spark):
    rows = [("a", float(s), low) for s, low in [(0, True), (5, True), (11, True), (12, False), (13, True), (14, True), (30, True)]]
    out = I.alerts(spark.createDataFrame(rows, "k string, s double, low boolean"), ["k"], "s", [], F.col("low"), 10.0)
    assert sorted(r.s for r in out.collect()) == [0, 11, 13, 30]


def test_thresholds_of_warehouses_come_first(spark):
    items = spark.createDataFrame([(1, "S1", "B1", "W1"), (2, "S2", "B1", "W2"), (3, "S3", "B9", "W2"), (4, "S4", None, "W3")], "id int, sku string, brand string, warehouse string")
    given = spark.createDataFrame([("sku", "S1", None, 10), ("sku", "S1", "W1", 11), ("brand", "B1", None, 20), ("brand", "B1", "W9", 21), ("global", None, "W2", 30), ("global", None, None, 31)], "level string, value string, warehouse string, threshold int")
    out = I.resolved_thresholds(items, given, {"sku": "sku", "brand": "brand"}, 99, ["id"])
    assert {r.id: r.threshold for r in out.collect()} == {1: 11, 2: 20, 3: 30, 4: 31}
    assert {r.threshold for r in I.resolved_thresholds(items, given.limit(0), {"sku": "sku"}, 99, ["id"]).collect()} == {99}


def test_fresh(spark):
    rows = [("a", 5, 1), ("a", 5, 2), ("a", 4, 3), ("a", 6, 4), (None, 1, 5), (None, 1, 6)]
    out = K.fresh(spark.createDataFrame(rows, "k string, ts int, n int"), ["k"], "ts", "n")
    assert sorted(r.n for r in out.collect()) == [1, 4, 5, 6]


def test_folds(spark):
    rows = [(k, float(s)) for k in "ab" for s in (0, 0, 0, 1, 1, 5)]
    out = K.token_bucket(spark.createDataFrame(rows, "k string, s double"), ["k"], "s", 1.0, 2.0)
    assert [r.granted for r in out.where("k = 'a'").orderBy("s").collect()].count(True) == 4
    out = K.spaced(spark.createDataFrame(rows, "k string, s double"), ["k"], "s", 1.0)
    assert out.where("kept and k = 'b'").count() == 3


def test_breaker(spark):
    calls = [("k", 0.0, False), ("k", 0.1, False), ("k", 0.2, False), ("k", 0.5, True), ("k", 1.5, True), ("k", 1.6, True), ("k", 1.7, True)]
    out = K.circuit_breaker(spark.createDataFrame(calls, "k string, s double, ok boolean"), ["k"], "s", "ok")
    assert [r.state for r in out.orderBy("s").collect()] == ["closed", "closed", "open", "open", "half_open", "half_open", "closed"]


def test_watch_filter(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    assert [r.c for r in T.watch_filter(df, [{"$match": {"$or": [{"a": 2}, {"b": "z"}]}}, {"$set": {"c": "$a"}}]).collect()] == [2]
    with pytest.raises(ValueError):
        T.watch_filter(df, [{"$group": {}}])


def test_config(tmp_path):
    f = tmp_path / "config.yaml"
    f.write_text("mongodb:\n  database: d\n  collections: [{name: a, topic: t, watch_filter: {}}]\npubsub: {project_id: p, publisher: {batch_settings: {max_messages: 5000}}}\n")
    assert config.find_file(str(tmp_path), {}) == f
    got = config.problems(config.load(f, {"MONGODB_URI": "mongodb://u"}))
    assert got == ["a: watch_filter is no list of dictionaries", "pubsub.publisher.batch_settings.max_messages must be at most 1000"]


RIGHT = {"mongodb": {"uri": "mongodb+srv://h", "database": "d-1_x", "collections": [{"name": "inventory", "topic": "inventory-changes"}]}, "pubsub": {"project_id": "p-1"}}
WRONG = [
    ("mongodb.uri", "http://h", "must start"), ("mongodb.database", "a b", "characters"), ("mongodb.collections", [], "empty"), ("mongodb.collections", [{"name": "a.b", "topic": "t"}], "characters"), ("mongodb.collections", [{"name": "a", "topic": "a_b"}], "no topic"),
    ("mongodb.collections", [{"name": "a", "topic": "t", "deduplication": {"enabled": True, "cleanup_interval": 90000}}], "at most 86400"), ("mongodb.collections", [{"name": "a", "topic": "t", "deduplication": {"enabled": True, "memory_max_size": 2000000}}], "at most"),
    ("mongodb.collections", [{"name": "a", "topic": "t", "log_sampling": {"enabled": True, "rate": 0}}], "more than 0"), ("mongodb.collections", [{"name": "a", "topic": "t", "log_sampling": {"enabled": True, "strategy": "odd"}}], "strategy"),
    ("pubsub.project_id", "p p", "no such name"), ("pubsub.status_topic", "a/b", "no such name"), ("pubsub.publisher.batch_settings.max_bytes", 0, "more than"), ("pubsub.publisher.batch_settings.max_latency", 601, "at most"), ("pubsub.publisher.circuit_breaker.half_open_max_calls", 6, "at most pubsub"),
    ("pubsub.publisher.backpressure.max_tokens_per_second", 100, "below"), ("pubsub.publisher.backpressure.error_decrease_factor", 1, "between"), ("pubsub.publisher.backpressure.success_increase_factor", 1, "more than 1"), ("retry.initial_delay", 61, "at most retry"), ("retry.max_attempts", 101, "at most"),
    ("firestore", {"collection": "a/b", "ttl": 1}, "no such name"), ("firestore", {"collection": "a", "ttl": 10**9}, "at most"), ("health.heartbeat.interval", 301, "at most"), ("health.readiness.timeout", 30, "below"), ("monitoring.logging.level", "LOUD", "no choice"), ("monitoring.tracing", {"endpoint": "e"}, "service_name"),
    ("mongodb.options.max_pool_size", 1001, "at most"), ("mongodb.options.max_pool_size", True, "whole number"), ("mongodb.options.connect_timeout_ms", 300001, "at most"), ("mongodb.options.w", 6, "no choice"), ("mongodb.options.ssl", "yes", "no choice"), ("mongodb.options.readPreference", "any", "no choice"),
    ("resource.memory_warning_threshold", 0.9, "at most resource"), ("resource.cpu_emergency_threshold", 1.5, "between 0 and 1"), ("resource.monitoring_interval", "x", "no number"), ("resource.tracked_types", [1], "list of names"),
]


@pytest.mark.parametrize(("path", "value", "said"), WRONG, ids=lambda x: str(x)[:30])
def test_config_problems(path, value, said):
    wrong = json.loads(json.dumps(RIGHT))
    at = wrong
    *parents, last = path.split(".")
    for p in parents:
        at = at.setdefault(p, {})
    at[last] = value
    found = config.problems(wrong)
    assert found and all(said in x for x in found), found
    with pytest.raises(ValueError, match=re.escape(found[0])):
        config.checked(wrong)


def test_config_without_problems():
    full = json.loads(json.dumps(RIGHT)) | {"retry": {"max_attempts": 100}, "firestore": {"collection": "c", "ttl": 60}, "monitoring": {"tracing": {"service_name": "s", "endpoint": "e"}}}
    full["mongodb"]["options"] = {"max_pool_size": 5, "min_pool_size": 0, "w": "majority", "ssl": True, "ssl_cert_reqs": "CERT_NONE"}
    assert config.checked(full) is full and config.setting(full, "health.heartbeat.interval") == 30


def test_stream_dedup(spark, tmp_path):
    df = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("a", 6, 3), ("b", 1, 4)], "k string, ts long, arrival long")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = fresh_stream(stream, "k", "ts", ttl_ms=None).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert sorted(r.arrival for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 3, 4]


def in_files(spark, path, batches, schema):
    """A folder with a file for each batch, to be read one a trigger, in order."""
    import os
    import time

    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
        newest = max((p for p in path.glob("*.parquet")), key=lambda p: p.stat().st_mtime_ns)
        os.utime(newest, (time.time() - 1000 + k, time.time() - 1000 + k))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def drained(df, tmp_path, mode="append", name="out"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    return q


def test_stream_dedup_forgets_and_ends(spark, tmp_path):
    """With a ttl: state goes once the watermark has passed it, rows without a key all stay, and the query ends."""
    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    batches = [[("a", at(0), 1), ("a", at(0), 2), (None, at(0), 3), (None, at(0), 4)], [("b", at(48), 5)], [("b", at(49), 6)], [("c", at(50), 7), ("b", at(49), 8)]]
    stream = in_files(spark, tmp_path / "in", batches, "k string, ts timestamp, arrival long")
    q = drained(fresh_stream(stream, "k", "ts", ttl_ms=3_600_000), tmp_path, name="fresh")
    assert sorted(r.arrival for r in spark.table("fresh").collect()) == [1, 3, 4, 5, 6, 7]
    # a was purged: only b and c are left.
    assert [s for p in q.recentProgress for s in p["stateOperators"]][-1]["numRowsTotal"] <= 2
    with pytest.raises(ValueError, match="ttl"):
        fresh_stream(spark.readStream.format("rate").load().withColumn("k", F.lit("a")), "k", "value", ttl_ms=5)


def test_stream_windows_close_and_late_rows_go(spark, tmp_path):
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    batches = [[(at(0), "a"), (at(30), "a")], [(at(100), "a")], [(at(101), "a")], [(at(10), "a"), (at(102), "a")], [(at(300), "a")]]
    stream = in_files(spark, tmp_path / "in", batches, "ts timestamp, k string")
    drained(windowed_counts(stream, "ts", "k"), tmp_path, name="windows")
    assert {(r.start, r.n) for r in spark.table("windows").collect()} == {(at(0), 2), (at(60), 3)}
    drained(sessions(stream, "ts", "k"), tmp_path, name="sessions")
    assert {(r.start, r.n) for r in spark.table("sessions").collect()} >= {(at(100), 3)}


def test_stream_stock(spark, tmp_path):
    batches = [[("a", 5, None, 1), ("a", -2, None, 2), ("b", 1, None, 3)], [("a", None, 50, 4), ("a", -1, None, 5)]]
    stream = in_files(spark, tmp_path / "in", batches, "k string, change long, snap long, n long")
    drained(stock_stream(stream, "k", "change", "snap", "n"), tmp_path, "update", "stock")
    assert sorted((r.k, r.stock, r.transactions) for r in spark.table("stock").collect()) == [("a", 3, 2), ("a", 49, 4), ("b", 1, 1)]
    drained(stock_stream(stream.where("change is not null"), "k", "change"), tmp_path, "update", "plain")
    assert ("a", 2, 3) in {(r.k, r.stock, r.transactions) for r in spark.table("plain").collect()}


def test_published_stream(spark, tmp_path):
    """Messages, dead letters and status of a stream, each once, also after a restart with what has come since."""
    rows = [event(1, "insert", SALE, key="a"), event(2, "insert", SALE | {"transaction_type": "gift"}, key="b")]
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    stream = in_files(spark, tmp_path / "in", [rows], changes.SCHEMA)
    assert sinks.publish(stream, out, check, {"transactions": "t"}).awaitTermination(120)
    in_files(spark, tmp_path / "in", [[event(3, "delete", None, key="a")]], changes.SCHEMA)
    assert sinks.publish(stream, out, check, {"transactions": "t"}).awaitTermination(120)
    messages = spark.read.parquet(f"{out}/messages")
    assert sorted(json.loads(r.value)["data"]["_id"] for r in messages.collect()) == ["001", "003"] and {r.topic for r in messages.collect()} == {"t"}
    assert [(r.resume_token, r.errors) for r in spark.read.parquet(f"{out}/dead").collect()] == [("002", ["transaction_type: enum"])]
    status = [json.loads(r.value) for r in spark.read.parquet(f"{out}/status").collect()]
    assert len(status) == 2 and all(s["type"] == "heartbeat" and s["status"]["has_resume_token"] for s in status)
    kafka = sinks.kafka_rows(messages).first()
    assert kafka.topic == "t" and {h.key for h in kafka.headers} == {"collection", "operation", "schema_version", "serialization_format"}


def test_a_batch_done_again_is_there_once(spark, tmp_path):
    batch = spark.createDataFrame([event(1, "insert", SALE)], changes.SCHEMA)
    write = sinks.batch_writer(str(tmp_path), {"transactions": "t"})
    write(batch, 0)
    write(batch, 0)
    assert spark.read.parquet(f"{tmp_path}/messages").count() == 1


def test_callbacks_heartbeats_and_stop(spark, tmp_path):
    import time

    calls, beats = Callbacks(), []
    spark.streams.addListener(calls)
    try:
        calls.register("progress", lambda p: 1 / 0)
        send_heartbeats(calls, beats.append)
        ended = []
        calls.register("terminated", ended.append)
        rate = spark.readStream.format("rate").option("rowsPerSecond", 50).load()
        rate.writeStream.format("noop").queryName("beat").option("checkpointLocation", str(tmp_path / "c")).start()
        until = time.time() + 60
        while not any(b["status"]["rows"] for b in beats) and time.time() < until:
            time.sleep(0.2)
        assert stop_all(spark, drain=False) == [] and not spark.streams.active
        while not ended and time.time() < until:
            time.sleep(0.2)
        assert ended and calls.failures and any(b["collection"] == "beat" and b["status"]["has_resume_token"] for b in beats if b["status"]["rows"])
    finally:
        spark.streams.removeListener(calls)
    with pytest.raises(ValueError):
        calls.register("noon", print)
    assert heartbeat_of({"timestamp": "t", "batchId": 1, "numInputRows": 0})["status"]["has_resume_token"] is False


def test_change_source(spark, tmp_path):
    spark.createDataFrame([("1", "inventory", "insert", "k", datetime(2024, 1, 1), "{}")], changes.SCHEMA).write.parquet(str(tmp_path / "in"))
    assert changes.read(spark, str(tmp_path / "in")).count() == 1
    assert changes.read(spark, str(tmp_path / "in"), stream=True, files_a_batch=1).isStreaming


def test_collections_of_several_sources(spark, tmp_path):
    for name in ("inventory", "transactions"):
        spark.createDataFrame([event(1, "delete", None, collection="other", key=name)], changes.SCHEMA).write.parquet(str(tmp_path / name))
    paths = {name: str(tmp_path / name) for name in ("inventory", "transactions")}
    assert sorted((r.collection, r.document_key) for r in changes.read_all(spark, paths).collect()) == [("inventory", "inventory"), ("transactions", "transactions")]
    stream = changes.read_all(spark, paths, stream=True, files_a_batch=1)
    topics = {"inventory": "i", "transactions": "t"}
    assert sinks.publish(stream, str(tmp_path / "out"), str(tmp_path / "c"), topics).awaitTermination(120)
    assert sorted(r.topic for r in spark.read.parquet(str(tmp_path / "out/messages")).collect()) == ["i", "t"]


def test_fields_of_any_name(spark):
    odd = {"a b": 1, "x-y": {"c.d": [1, 2.5, "s"]}, "VOID_DATE": "d", "OBJECT": "o", "q`r": "secret", "\u00e9": True, "n": None}
    rows = [event(1, "insert", SALE | odd)]
    plan = cdc.Plan(T.default_registry("W1"), protectors={"transaction": P.Protector([P.Rule("q`r", "mask", {"right": 1})])})
    messages, _ = cdc.pipeline(spark.createDataFrame(rows, changes.SCHEMA), {"transactions": "t"}, plan=plan)
    doc = json.loads(messages.first().value)["data"]["fullDocument"]
    assert doc["a b"] == 1 and doc["x-y"] == {"c.d": [1, 2.5, "s"]} and doc["VOID_DATE"] == "d" and doc["OBJECT"] == "o" and doc["q`r"] == "XXXXXt" and doc["\u00e9"] is True


def test_published_stream_without_duplicates(spark, tmp_path):
    """A change that comes again in a later batch is published once; changes without a key always are."""
    batches = [[event(1, "insert", SALE), event(9, "insert", SALE, key=None)], [event(1, "insert", SALE), event(2, "insert", SALE), event(9, "insert", SALE, key=None)]]
    stream = in_files(spark, tmp_path / "in", batches, changes.SCHEMA)
    assert sinks.publish(stream, str(tmp_path / "out"), str(tmp_path / "c"), {"transactions": "t"}, dedup=True).awaitTermination(120)
    got = [json.loads(r.value)["data"]["_id"] for r in spark.read.parquet(str(tmp_path / "out/messages")).collect()]
    assert sorted(got) == ["001", "002", "009", "009"]
