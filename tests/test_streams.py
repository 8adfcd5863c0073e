"""Streams with state on RocksDB against the batch operators, over restarts."""

import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.operators import history as H
from tidewire.operators import inventory as I
from tidewire.plans import cdc
from tidewire.sources import changes
from tidewire.streaming import keyed_state as S


def at(k):
    return datetime(2024, 1, 1) + timedelta(minutes=k)


def add_file(spark, path, rows, schema, number):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
    newest = max(path.glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    os.utime(newest, (time.time() - 1000 + number, time.time() - 1000 + number))


def source(spark, path, schema):
    path.mkdir(exist_ok=True)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def drain(df, tmp_path, name):
    """What there is now, into files; restarted from the same checkpoint by calling it again."""
    q = df.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-c")).trigger(availableNow=True).start()
    assert q.awaitTermination(180)
    return df.sparkSession.read.parquet(str(tmp_path / name))


def change(k, op, key, minute, n=None, collection="inventory"):
    return (f"{k:03}", collection, op, key, at(minute), None if n is None else json.dumps({"n": n}))


BATCHES = [
    [change(1, "insert", "a", 5, 1), change(2, "insert", "a", 5, 2), change(3, "update", "a", 4, 3), change(4, "insert", None, 1, 4), change(5, "insert", "b", 9, 5)],
    [change(6, "insert", "a", 4, 6), change(7, "insert", "a", 6, 7), change(8, "delete", "b", 9), change(9, "insert", None, 1, 8), change(10, "insert", "a", 5, 9, "other")],
    [change(11, "update", "a", 4, 10), change(12, "update", "a", 7), change(13, "insert", "b", 8, 11), change(14, "insert", "b", 10, 12)],
]


def test_freshest_over_a_restart_is_the_batch(spark, tmp_path):
    everything = spark.createDataFrame([r for b in BATCHES for r in b], changes.SCHEMA)
    stream = source(spark, tmp_path / "in", changes.SCHEMA)
    for number, rows in enumerate(BATCHES[:2]):
        add_file(spark, tmp_path / "in", rows, changes.SCHEMA, number)
    drain(S.freshest(stream), tmp_path, "out")
    add_file(spark, tmp_path / "in", BATCHES[2], changes.SCHEMA, 2)
    got = drain(S.freshest(stream), tmp_path, "out")
    assert sorted(r.resume_token for r in got.collect()) == sorted(r.resume_token for r in cdc.deduplicated(everything).collect())


def test_freshest_knows_what_was_there_before(spark, tmp_path):
    known = spark.createDataFrame(BATCHES[0] + BATCHES[1], changes.SCHEMA)
    add_file(spark, tmp_path / "in", BATCHES[2], changes.SCHEMA, 0)
    got = drain(S.freshest(source(spark, tmp_path / "in", changes.SCHEMA), known=known), tmp_path, "out")
    everything = cdc.deduplicated(spark.createDataFrame([r for b in BATCHES for r in b], changes.SCHEMA)).where("resume_token > '010'")
    assert sorted(r.resume_token for r in got.collect()) == sorted(r.resume_token for r in everything.collect())


def test_a_key_expires_by_its_timer_alone(spark, tmp_path):
    """Nothing else comes for the key, no event time moves: it is forgotten, and the same change passes again."""
    add_file(spark, tmp_path / "in", [change(1, "insert", "a", 5, 1)], changes.SCHEMA, 0)
    q = S.freshest(source(spark, tmp_path / "in", changes.SCHEMA), idle_ms=1500).writeStream.format("memory").queryName("idle").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="300 milliseconds").start()
    try:
        def until(done):
            end = time.time() + 120
            while not done() and time.time() < end:
                time.sleep(0.3)
            return done()

        assert until(lambda: spark.table("idle").count() == 1)
        assert until(lambda: any(s["numRowsTotal"] == 0 for p in q.recentProgress[-2:] for s in p["stateOperators"]) and q.recentProgress[-1]["numInputRows"] == 0)
        add_file(spark, tmp_path / "in", [change(2, "insert", "a", 5, 2)], changes.SCHEMA, 1)
        assert until(lambda: spark.table("idle").count() == 2)
    finally:
        q.stop()


def test_images_and_totals_over_a_restart(spark, tmp_path):
    """Batch by batch the totals are those of all changes at once."""
    stream = source(spark, tmp_path / "in", changes.SCHEMA)
    parts, measure = [], F.get_json_object("document", "$.n").cast("long")
    before = None
    for number, rows in enumerate(BATCHES):
        add_file(spark, tmp_path / "in", rows, changes.SCHEMA, number)
        got = drain(S.images_stream(stream), tmp_path, "images")
        new = got if before is None else got.join(before, "resume_token", "left_anti")
        before = spark.createDataFrame(got.select("resume_token").collect(), "resume_token string")
        fresh = spark.createDataFrame(new.collect(), new.schema)
        parts.append(H.deltas(H.retracted(fresh), ["collection"], measure))
    everything = spark.createDataFrame([r for b in BATCHES for r in b if r[3]], changes.SCHEMA)
    want = H.images(everything)
    assert sorted((r.resume_token, r.before or "", r.after or "") for r in got.collect()) == sorted((r.resume_token, r.before or "", r.after or "") for r in want.collect())
    total = lambda *p: sorted((r.collection or "", r.level, r.total, r.n) for r in H.merged(["collection"], *p).collect())
    assert total(*parts) == total(H.deltas(H.retracted(want), ["collection"], measure))


def test_thresholds_that_change_while_stock_streams(spark, tmp_path):
    """Updates and events come in any order, some late: as the batch operator, but for what the watermark has left behind."""
    events = [("a", at(10), 1), ("a", at(30), 2), ("b", at(30), 3), ("a", at(30), 4), ("a", at(100), 5), ("b", at(101), 6), ("a", at(160), 7), ("z", at(120), 8)]
    updates = [("a", at(20), 5), ("a", at(30), 9), ("a", at(90), 7), ("b", at(102), 1), ("a", at(30), 8), ("z", at(119), 3), ("end", at(1000), 1)]
    shapes = "item string, ts timestamp, id long", "item string, ts timestamp, threshold long"
    for number, (lo, hi, ulo, uhi) in enumerate([(0, 3, 0, 1), (3, 5, 1, 3), (5, 8, 3, 6)]):
        add_file(spark, tmp_path / "events", events[lo:hi], shapes[0], number)
        add_file(spark, tmp_path / "updates", updates[ulo:uhi], shapes[1], number)
    for number in (3, 4):
        add_file(spark, tmp_path / "updates", [("end", at(1000 + number), 1)], shapes[1], number)
    streams = source(spark, tmp_path / "events", shapes[0]), source(spark, tmp_path / "updates", shapes[1])
    got = drain(S.thresholds_stream(*streams, "item", "ts", late="3 hours"), tmp_path, "out")
    best = spark.createDataFrame(updates, shapes[1]).groupBy("item", "ts").agg(F.max("threshold").alias("threshold"))
    want = I.current_thresholds(spark.createDataFrame(events, shapes[0]), best, ["item"], "ts")
    assert sorted((r.id, r.threshold) for r in got.collect()) == sorted((r.id, r.threshold) for r in want.collect())


def test_totals_are_kept_up_batch_by_batch(spark, tmp_path):
    """After each batch the totals are those of the documents that are there; a batch that is done again changes nothing; merges neither."""
    from tidewire.streaming.rollups import Totals, totals

    batches = [[r for r in b if r[3]] for b in BATCHES]
    stream, out = source(spark, tmp_path / "in", changes.SCHEMA), str(tmp_path / "out")
    measure = F.get_json_object("document", "$.n").cast("long")
    keep = Totals(out, {"collection": F.col("collection"), "odd": measure % 2 == 1}, measure, merge_after=2)
    twice = lambda batch, number: [keep(batch, number) for _ in range(2)] and None
    for number, rows in enumerate(batches):
        add_file(spark, tmp_path / "in", rows, changes.SCHEMA, number)
        q = S.images_stream(stream).writeStream.foreachBatch(twice).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        assert q.awaitTermination(180)
        present = {}
        for _, c, op, key, _, doc in [r for b in batches[: number + 1] for r in b]:
            if op == "delete":
                present.pop((c, key), None)
            elif doc is not None:
                present[c, key] = json.loads(doc)["n"]
        want = {}
        for (c, _), n in present.items():
            for names in ((None, None), (c, None), (c, n % 2 == 1)):
                total, k = want.get(names, (0, 0))
                want[names] = total + n, k + 1
        assert {(r.collection, r.odd): (r.total, r.n) for r in totals(spark, out, ["collection", "odd"]).collect()} == want
    assert (tmp_path / "out" / "merged").exists()
