"""Documents of any shape through the change plan: nothing is lost before validation, nothing is published that a rule should hide."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.functions import documents as D
from tidewire.functions import protection as P
from tidewire.functions import serialization as S
from tidewire.operators import transforms as T
from tidewire.plans import cdc
from tidewire.sources import changes, scratch

STOCK = {"_schema_version": "v1", "product_id": "P1", "warehouse_id": "W1", "quantity": 10, "last_updated": "2024-01-01T00:00:00Z"}
SCHEMA = {"inventory": "product_id string, quantity bigint, threshold_min bigint, brand string"}


def events(spark, documents, operation="insert"):
    rows = [(f"{k:03}", "inventory", operation, f"k{k}", datetime(2024, 1, 1) + timedelta(seconds=k), d if isinstance(d, str) else json.dumps(d)) for k, d in enumerate(documents)]
    return spark.createDataFrame(rows, changes.SCHEMA)


def run(spark, documents, plan, form="json"):
    messages, dead = cdc.pipeline(events(spark, documents), {"inventory": "t"}, form, plan)
    text = F.col("value").cast("string") if form == "json" else S.msgpack_to_json("value")
    got = {(m := json.loads(r[0]))["data"]["_id"]: m["data"].get("fullDocument") for r in messages.select(text).collect()}
    return got, {r.resume_token: r.errors for r in dead.collect()}


def same_plan(stage="pre_validation", step=lambda d: d, **kw):
    registry = T.Registry()
    registry.register(stage, "inventory", step)
    return cdc.Plan(registry, **kw)


CHANGES = [
    ({"threshold_min": "abc"}, ["threshold_min: integer"]), ({"quantity": "x"}, ["quantity: integer"]), ({"brand": None}, ["brand: string"]), ({"brand": 5}, ["brand: string"]),
    ({"extra": {"a": [1, None]}}, None), ({"quantity": 10.0}, None), ({"quantity": 10.5}, ["quantity: integer"]), ({"quantity": True}, ["quantity: integer"]), ({"odd na'me\"": 1, "x.y": None}, None),
]


@pytest.mark.parametrize("schemas", [{}, SCHEMA], ids=["contract", "schema"])
def test_a_transformation_loses_nothing_before_validation(spark, schemas):
    """The same errors, and the same documents, as without a transformation."""
    documents = [STOCK | change for change, _ in CHANGES]
    want = {f"{k:03}": d for k, d in enumerate(documents) if not CHANGES[k][1]}, {f"{k:03}": errors for k, (_, errors) in enumerate(CHANGES) if errors}
    assert run(spark, documents, cdc.Plan()) == want
    # A number beyond the schema's is valid by the contract, but no column holds it: set aside, not cut.
    got, dead = run(spark, [*documents, STOCK | {"quantity": 2**70}], same_plan(schemas=schemas))
    assert dead.pop(f"{len(documents):03}") == ["quantity: not of its schema's type"] and (got, dead) == want


def test_one_documents_types_do_not_change_anothers_protection(spark):
    documents = [STOCK | {"customer": {"ssn": "1", "email": "ab@c.de"}}, STOCK | {"customer": "x"}, STOCK | {"customer": [{"ssn": 2}, ["ab", {"my_email": "cd@e.fg"}]]}, STOCK | {"ssn": 5}]
    got, dead = run(spark, documents, same_plan("pre_publish", protectors={"inventory": P.Protector(P.PII_RULES)}))
    assert not dead
    assert got["000"]["customer"] == {"email": "ab*****"} and got["000"]["_protected"] == {"customer.email": "mask", "customer.ssn": "remove"}
    assert got["001"]["customer"] == "x" and "_protected" not in got["001"]
    assert got["002"]["customer"] == [{}, ["ab", {"my_email": "cd*****"}]] and "ssn" not in got["003"]


def test_variants_are_walked(spark):
    df = spark.createDataFrame([('{"ssn":"1","k":[{"ssn":2,"n":1.50}]}',), ('"x"',), ("[]",), (None,)], "j string").select(F.try_parse_json("j").alias("v"), F.struct(F.try_parse_json("j").alias("email")).alias("s"))
    out = P.Protector(P.PII_RULES)(df).select(F.to_json("v"), F.to_json("s.email"), "_protected").collect()
    assert [r[0] for r in out] == ['{"k":[{"n":1.5}]}', '"x"', "[]", None]
    # What stands below a name that tells of mails is masked, or removed by the stronger rule.
    assert [r[1] for r in out] == ['{"k":[{"n":"1.*"}]}', '"x"', "[]", None]
    assert out[0]._protected["v.ssn"] == "remove" and out[0]._protected["v.k[0].ssn"] == "remove" and out[0]._protected["s.email.k[0].n"] == "mask"


def test_variants_that_cannot_be_walked_raise(spark):
    df = spark.createDataFrame([("{}",)], "j string").select(F.array(F.try_parse_json("j")).alias("a"))
    with pytest.raises(ValueError, match="VARIANT"):
        P.Protector(P.PII_RULES)(df)


def protect(spark, rules, document, **kw):
    df = spark.createDataFrame([(document if isinstance(document, str) else json.dumps(document),)], "j string")
    text = P.Protector(rules, **kw).protected_documents(df, "j").first().j
    return None if text is None else json.loads(text)


def test_rules_in_documents(spark):
    document = {"a": {"b": "secret", "c": 12.75, "d": [1, 2, 3]}, "a.b": "twice", "t": True, "n": None, "when": "2024-05-06", "_protected": 1}
    rules = [P.Rule("a.b", "hash", {"salt": False}), P.Rule("a.c", "generalize", {"places": 1}), P.Rule("a.d[1]", "remove"), P.Rule(lambda p: p == "t", "mask", {"right": 2, "char": "*"}), P.Rule("n", "hash"), P.Rule("when", "generalize", {"unit": "quarter"})]
    out = protect(spark, rules, document)
    assert out["a"]["b"].startswith("hash:") and out["a.b"].startswith("hash:") and out["a"]["b"] != out["a.b"]
    assert out["a"]["c"] == 12.8 and out["a"]["d"] == [1, None, 3] and out["t"] == "**ue" and out["n"] is None and out["when"] == "2024-Q2"
    assert out["_protected"] == {"a.b": "hash", "a.c": "generalize", "a.d[1]": "remove", "n": "hash", "t": "mask", "when": "generalize"}
    # The same values as of columns of known types.
    df = spark.createDataFrame([(("secret", 12.75),)], "a struct<b:string,c:double>")
    known = P.Protector(rules[:2])(df).first()
    assert (known.a.b, known.a.c) == (out["a"]["b"], out["a"]["c"])


def test_documents_fail_closed(spark):
    assert protect(spark, [P.Rule("a", "mask"), P.Rule("l", "hash")], {"a": {"x": 1}, "l": [1], "b": 2}) == {"b": 2, "_protected": {"a": "remove", "l": "remove"}}
    assert protect(spark, P.PII_RULES, '{"ssn": 1') is None
    assert protect(spark, [P.Rule("a", "generalize", {"places": 0})], {"a": "n/a"}) == {"a": None, "_protected": {"a": "generalize"}}
    with pytest.raises(ValueError, match="key"):
        protect(spark, [P.Rule("a", "encrypt")], {"a": 1})
    out = protect(spark, [P.Rule("a.*", "none"), P.Rule("a.b", "truncate")], {"a": {"b": "x" * 20, "c": "y" * 20}}, keep=["k"])
    assert out["a"] == {"b": "x" * 7 + "...", "c": "y" * 20}
    deep = json.loads("[" * 900 + "1" + "]" * 900)
    assert protect(spark, P.PII_RULES, {"a": deep, "email": "ab@c"})["a"] == deep


def test_numbers_stay_as_they_were_written():
    text = '{"a":1.50,"b":[123456789012345678901234567890,-0,1E400],"c":"\\u00e9\\n"}'
    assert D.dumps(D.loads(text)) == '{"a":1.50,"b":[123456789012345678901234567890,-0,1E400],"c":"é\\n"}'
    with pytest.raises(ValueError):
        D.loads('{"a":NaN}')


def test_transformations_reach_what_the_schema_lacks(spark):
    document = STOCK | {"customer": {"address": "1 Main St", "name": "N"}, "location": {"shelf": 3}}
    plan = cdc.Plan(T.default_registry("W1"))
    registry = T.Registry()
    registry.register("pre_publish", "inventory", T.without_fields(["customer.address", "brand"]))
    registry.register("pre_publish", "inventory", T.with_prefix("wh", ["location", "location.shelf", "customer.name", "product_id"]))
    got, _ = run(spark, [document], cdc.Plan(registry))
    doc = got["000"]
    assert doc["customer"] == {"wh_name": "N"} and doc["wh_location"] == {"wh_shelf": 3} if "wh_shelf" in doc["wh_location"] else doc["wh_location"] == {"shelf": 3}
    assert doc["wh_product_id"] == "P1" and doc["quantity"] == 10
    got, _ = run(spark, [document], plan)
    assert got["000"]["wh_W1__customer"] == {"wh_W1__address": "1 Main St", "wh_W1__name": "N"}


def test_a_document_that_a_step_drops_is_gone_and_one_it_cannot_read_is_set_aside(spark):
    plan = same_plan("pre_publish", lambda d: d.where("amount > 5").withColumn("amount", F.lit(None).cast("bigint")), schemas={"inventory": "amount bigint"})
    got, dead = run(spark, [STOCK | {"amount": 9}, STOCK | {"amount": 1}, STOCK | {"amount": "9"}], plan)
    assert got == {"000": STOCK} and dead == {"002": ["amount: not of its schema's type"]}


def test_the_plan_has_one_window(spark):
    plan = cdc.Plan(T.default_registry("W1"), protectors={"inventory": P.Protector(P.PII_RULES)})
    messages, _ = cdc.pipeline(events(spark, [STOCK]), {"inventory": "t"}, plan=plan)
    text = messages._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window ") == 0  # The rows that the window kept are written once.
    assert cdc.checked(events(spark, [STOCK]))._jdf.queryExecution().executedPlan().toString().count("Window ") <= 1


def test_lookups_stay_in_their_collection(spark):
    rows = [("1", c, "update", "k", datetime(2024, 1, 1), None) for c in ("a", "b", "c")]
    now = spark.createDataFrame([("a", "k", "of a"), ("b", "k", "of b")], "collection string, document_key string, document string")
    got = cdc.looked_up(spark.createDataFrame(rows, changes.SCHEMA), now).collect()
    assert {r.collection: r.full_document for r in got} == {"a": "of a", "b": "of b", "c": None}


def test_messages_that_cannot_be_written_are_dead_letters(spark):
    big = json.dumps(STOCK)[:-1] + ',"big":18446744073709551616}'
    fine, dead = run(spark, [STOCK, big], cdc.Plan(), "msgpack")
    assert fine == {"000": STOCK} and dead == {"001": ["message: no msgpack form"]}
    assert S.json_to_msgpack.func(iter([__import__("pandas").Series(["[" * 30_000 + "]" * 30_000])])).__next__()[0] is None


def test_keys_and_times_are_tagged(spark):
    rows = [("1", "inventory", "delete", "0" * 24, datetime(2024, 1, 1), None), ("2", "inventory", "delete", "k", datetime(2024, 1, 1), None)]
    source = spark.createDataFrame(rows, changes.SCHEMA)
    messages, _ = cdc.pipeline(source, {"inventory": "t"}, "msgpack")
    data = {(m := S.unpack(bytes(r.value)))["data"]["_id"]: m["data"] for r in messages.collect()}
    assert data["1"]["documentKey"] == {"_id": {"__type__": "ObjectId", "value": "0" * 24}} and data["1"]["clusterTime"] == {"__type__": "Timestamp", "value": 1704067200}
    assert data["2"]["documentKey"] == {"_id": "k"} and S.untagged(data["1"])["documentKey"]["_id"] == S.ObjectId("0" * 24)
    read = messages.select(S.parsed(F.col("value"), "msgpack", "data struct<documentKey:struct<_id:string>,clusterTime:bigint>").alias("m")).select("m.data.documentKey._id", "m.data.clusterTime")
    assert {tuple(r) for r in read.collect()} == {("0" * 24, 1704067200), ("k", 1704067200)}
    plain, _ = cdc.pipeline(source, {"inventory": "t"}, "msgpack", tags=False)
    assert {S.unpack(bytes(r.value))["data"]["clusterTime"] for r in plain.collect()} == {1704067200}


def test_scratch_is_cleared(spark):
    with scratch.cleared(spark):
        df = scratch.written(spark.range(3).toDF("x"), "numbers")
        assert df.count() == 3
        path = df.inputFiles()[0]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
        spark.read.parquet(path).count()
