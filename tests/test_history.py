"""Versions and images of documents, totals with retractions, rate limits without a task a key, conditions on documents."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.operators import history as H
from tidewire.operators import keyed as K
from tidewire.operators import matching as M
from tidewire.operators import transforms as T
from tidewire.sources import changes


def at(k):
    return datetime(2024, 1, 1) + timedelta(seconds=k)


def made_changes(seed, n, keys=4):
    rng = random.Random(seed)
    rows, seen = [], {}
    for k in range(n):
        key = rng.choice(["a", "b"]), rng.choice(["k1", "k2", "k3", "k4"][:keys])
        op = rng.choice(["insert", "update", "update", "delete", "touch"])
        doc = None if op in ("delete", "touch") else json.dumps({"brand": rng.choice("xy"), "kind": rng.choice("pq"), "n": rng.randint(0, 9)})
        rows.append((f"{k:04}", key[0], op, key[1], at(k // 2), doc))
        seen.setdefault(key, []).append(rows[-1])
    return rows, seen


def test_images_versions_and_lookups(spark):
    rows, seen = made_changes(1, 120)
    df = spark.createDataFrame(rows, changes.SCHEMA)
    now, want = {}, {}
    for token, c, op, key, _, doc in rows:
        before = now.get((c, key))
        now[c, key] = None if op == "delete" else doc if doc is not None else before
        want[token] = before, now[c, key]
    assert {r.resume_token: (r.before, r.after) for r in H.images(df).collect()} == want
    versions = H.versions(df)
    asked = [(f"q{k}", c, "update", key, at(k), None) for k in range(-2, 70, 3) for c in ("a", "b", "z", None) for key in ("k1", "k3")]
    got = {(r.resume_token, r.collection, r.document_key): r.full_document for r in H.looked_up_as_of(spark.createDataFrame(asked, changes.SCHEMA), versions).collect()}
    for token, c, _, key, t, _ in asked:
        last = [r for r in rows if (r[1], r[3]) == (c, key) and r[4] <= t]
        assert got[token, c, key] == (want[last[-1][0]][1] if last else None)
    assert len(got) == len(asked)
    whole = versions.collect()
    assert all(v.valid_to is None or v.valid_from < v.valid_to for v in whole) and sum(v.valid_to is None for v in whole) == len(seen)


def test_totals_with_retractions_are_those_of_what_is_there(spark):
    """However the changes are cut in batches, and however those are merged."""
    rows, _ = made_changes(2, 150)
    present = {}
    for _, c, op, key, _, doc in rows:
        if op == "delete":
            present.pop((c, key), None)
        elif doc is not None:
            present[c, key] = json.loads(doc)
    want = {}
    for d in present.values():
        for names in ((None, None), (d["brand"], None), (d["brand"], d["kind"])):
            total, n = want.get(names, (0, 0))
            want[names] = total + d["n"], n + 1
    all_rows = H.retracted(H.images(spark.createDataFrame(rows, changes.SCHEMA)))
    part = F.get_json_object("document", "$.brand").alias("brand"), F.get_json_object("document", "$.kind").alias("kind")
    all_rows = all_rows.select("*", *part, F.get_json_object("document", "$.n").cast("long").alias("n_"))
    for cuts in ([], [40], [10, 11, 90]):
        edges = [0, *cuts, 10_000]
        parts = [H.deltas(all_rows.where(F.col("resume_token").cast("int").between(a, b - 1)), ["brand", "kind"], F.col("n_")) for a, b in zip(edges, edges[1:], strict=False)]
        got = {(r.brand, r.kind): (r.total, r.n) for r in H.merged(["brand", "kind"], *parts).collect()}
        assert got == want


@pytest.mark.parametrize(("gap", "scale"), [(10.0, 1.0), (3.0, 1.0), (50.0, 1.0), (0.3, 0.1), (100.0, 1000.0)])
def test_spaced_widely_is_spaced(spark, monkeypatch, gap, scale):
    """Dense and sparse times, ties, null keys, ranges of few buckets."""
    monkeypatch.setattr(K, "RANGE", 3)
    rng = random.Random(int(gap * 10))
    rows = [(rng.choice(["a", "a", "a", "b", None]), float(rng.randint(-200, 200)) * scale, k) for k in range(400)] + [("a", None, 1000), ("c", 5.0, 1001)]
    df = spark.createDataFrame(rows, "k string, s double, n int").repartition(4)
    fold = {r.n for r in K.spaced(df, ["k"], "s", gap, ["n"]).where("kept").collect()}
    wide = K.spaced(df, ["k"], "s", gap, ["n"], most=0)
    assert {r.n for r in wide.where("kept").collect()} == fold and wide.count() == len(rows)
    assert {r.n for r in K.spaced(df, ["k"], "s", gap, ["n"], most=100).where("kept").collect()} == fold


DOC = {"a": 1, "b": {"c": [1, 2, {"d": "x"}], "e": None}, "l": [{"q": 1, "r": "u"}, {"q": 5, "r": "v"}], "s": "Hello", "t": True, "z": None, "f": 2.5, "empty": []}
TRUTH = [
    ({"a": 1}, True), ({"a": 1.0}, True), ({"a": "1"}, False), ({"a": {"$gt": 0, "$lt": 2}}, True), ({"a": {"$gt": "0"}}, False), ({"a": {"$ne": 1}}, False), ({"missing": {"$ne": 1}}, True),
    ({"b.c": 2}, True), ({"b.c": 3}, False), ({"b.c.d": "x"}, True), ({"b.c.2.d": "x"}, True), ({"b.c.0": 1}, True), ({"b.c.0": 2}, False), ({"b.e": None}, True), ({"z": None}, True), ({"missing": None}, True), ({"a": None}, False),
    ({"b.e": {"$exists": True}}, True), ({"missing": {"$exists": True}}, False), ({"missing.x": {"$exists": False}}, True), ({"l.q": {"$exists": True}}, True), ({"empty": {"$exists": True}}, True),
    ({"s": {"$regex": "^He"}}, True), ({"s": {"$regex": "^he"}}, False), ({"s": {"$regex": "^he", "$options": "i"}}, True), ({"s": {"$not": {"$regex": "^He"}}}, False), ({"missing": {"$not": {"$regex": "x"}}}, True), ({"a": {"$not": {"$gt": 5}}}, True),
    ({"l": {"$elemMatch": {"q": 1, "r": "u"}}}, True), ({"l": {"$elemMatch": {"q": 1, "r": "v"}}}, False), ({"l.q": 1, "l.r": "v"}, True), ({"b.c": {"$elemMatch": {"$gt": 1, "$lt": 3}}}, True), ({"b.c": {"$elemMatch": {"$gt": 2}}}, False), ({"l": {"$elemMatch": {"$or": [{"q": 9}, {"r": "v"}]}}}, True), ({"a": {"$elemMatch": {"$gt": 0}}}, False),
    ({"b.c": {"$size": 3}}, True), ({"b.c": {"$size": 2}}, False), ({"empty": {"$size": 0}}, True), ({"a": {"$size": 1}}, False), ({"b.c": {"$all": [1, 2]}}, True), ({"b.c": {"$all": [1, 7]}}, False), ({"b.c": {"$all": []}}, False),
    ({"a": {"$in": [5, 1]}}, True), ({"a": {"$nin": [5, 1]}}, False), ({"missing": {"$nin": [5]}}, True), ({"missing": {"$in": [None]}}, True), ({"b.c": {"$in": [2]}}, True),
    ({"$or": [{"a": 2}, {"s": "Hello"}]}, True), ({"$nor": [{"a": 2}, {"s": "Bye"}]}, True), ({"$nor": [{"missing": {"$gt": 1}}]}, True), ({"$and": [{"a": 1}, {"t": True}]}, True), ({"t": 1}, False), ({"t": {"$ne": False}}, True),
    ({"a": {"$type": "number"}}, True), ({"a": {"$type": "string"}}, False), ({"z": {"$type": "null"}}, True), ({"l": {"$type": "object"}}, True), ({"a": {"$mod": [2, 1]}}, True), ({"s": {"$mod": [2, 1]}}, False), ({"b": {"c": [1, 2, {"d": "x"}], "e": None}}, True), ({"l.0": {"q": 1, "r": "u"}}, True), ({"f": {"$gte": 2.5}}, True), ({}, True),
]


def test_conditions_on_documents(spark):
    df = spark.createDataFrame([(json.dumps(DOC),)], "j string").select(F.try_parse_json("j").alias("v"))
    for start in range(0, len(TRUTH), 12):
        part = TRUTH[start : start + 12]
        row = df.select(*(M.matches(F.col("v"), spec).alias(f"c{k}") for k, (spec, _) in enumerate(part))).first()
        assert [(spec, row[k]) for k, (spec, _) in enumerate(part)] == part


def test_watch_filter_on_changes(spark):
    rows = [("1", "inventory", "insert", "k1", at(1), json.dumps({"quantity": 3, "tags": [{"n": "x"}]})), ("2", "inventory", "update", "k2", at(2), json.dumps({"quantity": 30})), ("3", "sales", "delete", None, at(3), None), ("4", "sales", "insert", "k4", at(4), "no json")]
    df = spark.createDataFrame(rows, changes.SCHEMA)
    kept = lambda spec: [r.resume_token for r in T.watch_filter(df, [{"$match": spec}]).orderBy("resume_token").collect()]
    assert kept({"operationType": {"$in": ["insert", "update"]}, "fullDocument.quantity": {"$lt": 10}}) == ["1"]
    assert kept({"ns.coll": "sales"}) == ["3", "4"] and kept({"documentKey._id": {"$exists": False}}) == ["3"]
    assert kept({"fullDocument": {"$exists": True}}) == ["1", "2"] and kept({"fullDocument.tags": {"$elemMatch": {"n": "x"}}}) == ["1"]
    assert kept({"$nor": [{"documentKey._id": "k1"}, {"fullDocument.quantity": 30}]}) == ["3", "4"] and kept({"documentKey._id": {"$not": {"$eq": "k1"}}}) == ["2", "3", "4"]
    for wrong in ({"a": {"$near": 1}}, {"$where": 1}, {"$or": []}, {"a": {"$type": "x"}}):
        with pytest.raises(ValueError):
            T.watch_filter(df, [{"$match": wrong}])
    plan = T.watch_filter(df, [{"$match": {"operationType": "insert", "clusterTime": {"$gt": at(0)}}}])._jdf.queryExecution().optimizedPlan().toString()
    assert "variant" not in plan.lower() and "operation_type" in plan


def test_sketches_add_up(spark):
    """Daily sketches, merged by weekday and those again, keep quantiles within the stated error of their rank."""
    from tidewire.operators import seasonal as S

    rng = random.Random(9)
    rows = [("a", datetime(2024, 1, 1 + k % 28).date(), rng.gauss(100 + 10 * (k % 7), 30)) for k in range(20_000)] + [("b", datetime(2024, 1, 1).date(), None), ("b", datetime(2024, 1, 2).date(), 7.0)]
    df = spark.createDataFrame(rows, "item string, day date, value double").repartition(6)
    daily = S.daily(df, ["item"], F.col("day"), F.col("value"))
    weekly = S.seasons(daily, ["item"], S.weekday(F.col("day")))
    whole = S.seasons(weekly, ["item"], F.lit(0)).where("item = 'a'")
    values = {s: sorted(v for i, d, v in rows if i == "a" and s in (0, d.isoweekday())) for s in range(8)}
    for sketches in (weekly, whole):
        for share in (0.05, 0.5, 0.9, 0.99):
            for r in S.quantile(sketches.where("item = 'a'"), share).collect():
                own = values[r.season]
                rank = sum(v <= r.threshold for v in own) / len(own)
                assert r.n == len(own) and abs(rank - share) <= S.RANK_ERROR + 1 / len(own)
    few = S.quantile(weekly, 0.9).where("item = 'b'").collect()
    assert [(r.season, r.n, r.threshold) for r in few] == [(2, 1, 7.0)]
    above = S.above(df, S.quantile(weekly, 0.9), ["item"], S.weekday(F.col("day")), F.col("value"))
    assert abs(above.where("item = 'a'").count() / 20_000 - 0.1) < 0.02


@pytest.mark.parametrize("how", ["sum", "max", "last"])
@pytest.mark.parametrize("earlier", [False, True])
def test_running_values_in_buckets(spark, how, earlier):
    """The same as by one window, with null keys and values, and empty buckets."""
    rng = random.Random(len(how))
    rows = [(rng.choice(["a", "b", None]), 3 * k + 50 * (k // 40), rng.choice([None, None, 1, -2, 5])) for k in range(200)]
    df = spark.createDataFrame(rows, "k string, n long, v int").repartition(4)
    plain = K.running(df, ["k"], ["n"], F.col("v"), "out", None, how, earlier)
    parts = K.running(df, ["k"], ["n"], F.col("v"), "out", F.floor(F.col("n") / 17), how, earlier)
    assert sorted(map(str, map(tuple, plain.select("k", "n", "v", "out").collect()))) == sorted(map(str, map(tuple, parts.select("k", "n", "v", "out").collect())))


def test_histories_in_buckets(spark):
    rows, _ = made_changes(3, 90, 1)
    df = spark.createDataFrame(rows, changes.SCHEMA)
    bucket = F.floor(F.col("resume_token").cast("int") / 7)
    images = lambda b: {r.resume_token: (r.before, r.after) for r in H.images(df, bucket=b).collect()}
    assert images(None) == images(bucket)
    found = lambda b: sorted((r.resume_token, r.document or "") for r in H.as_of(df, H.versions(df), bucket=b).collect())
    assert found(None) == found(F.floor(F.unix_timestamp("cluster_time") / 5))
