"""Committed batches, resuming, replays, and windows that lose no row."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.sources import changes, ledger, sinks
from tidewire.streaming.windows import WindowCounts, accounted, window_counts

STOCK = {"_schema_version": "v1", "product_id": "P1", "warehouse_id": "W1", "quantity": 10, "last_updated": "2024-01-01T00:00:00Z"}
TOPICS = {"inventory": "t"}


def event(k, document=None, key=None, collection="inventory", seconds=None):
    document = STOCK if document is None else document
    return (f"{k:03}", collection, "insert", key or f"k{k}", datetime(2024, 1, 1) + timedelta(seconds=k if seconds is None else seconds), json.dumps(document))


def ids(df):
    return sorted(json.loads(r.value)["data"]["_id"] for r in df.collect())


def test_readers_follow_the_ledger_and_letters_are_replayed_once(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    write = sinks.batch_writer(out, TOPICS)
    bad = STOCK | {"quantity": -1}
    frame = lambda rows: spark.createDataFrame(rows, changes.SCHEMA)
    batches = [frame([event(1), event(2, bad), event(3, bad, key="k1")]), frame([event(4), event(5, bad)]), frame([event(6)])]
    assert ledger.committed(spark, out) is None and ledger.positions(spark, out).count() == 0 and ledger.open_letters(spark, out) is None
    write(batches[0], 0)
    # The driver is lost between the messages of the second batch and its commit.
    commit = ledger.commit
    monkeypatch.setattr(ledger, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        write(batches[1], 1)
    monkeypatch.setattr(ledger, "commit", commit)
    assert ids(ledger.committed(spark, out)) == ["001"] and {r.resume_token for r in ledger.open_letters(spark, out).collect()} == {"002", "003"}
    assert [(r.collection, r.position) for r in ledger.positions(spark, out).collect()] == [("inventory", "003")]
    everything = batches[0].union(batches[1]).union(frame([event(1, collection="new")]))
    assert sorted((r.collection, r.resume_token) for r in ledger.unread(everything, ledger.positions(spark, out)).collect()) == [("inventory", "004"), ("inventory", "005"), ("new", "001")]
    write(batches[1], 1)
    write(batches[2], 2)
    assert ids(ledger.committed(spark, out)) == ["001", "004", "006"]
    assert sorted((r.batch, r.changes, r.messages, r.dead, r.position) for r in ledger.rows(spark, out).collect()) == [(0, 3, 1, 2, "003"), (1, 2, 1, 1, "005"), (2, 1, 1, 0, "006")]

    # Two letters are corrected, one twice, one wrongly; one is no letter. k1's is older than what was published of its key.
    fixed = frame([event(2), event(2), event(3, key="k1", seconds=0), event(5, bad), event(4), event(99)])
    assert ledger.replay(spark, out, fixed, 1, TOPICS) == 2
    assert ledger.replay(spark, out, fixed, 1, TOPICS) == 2 and ledger.replay(spark, out, fixed, 2, TOPICS) == 0
    assert ids(ledger.committed(spark, out)) == ["001", "002", "003", "004", "006"]
    assert [r.resume_token for r in ledger.open_letters(spark, out).collect()] == ["005"]
    assert ledger.replay(spark, out, frame([event(5)]), 3, TOPICS) == 1 and ledger.open_letters(spark, out).count() == 0
    assert [r.position for r in ledger.positions(spark, out).collect()] == ["006"]
    with pytest.raises(ValueError):
        ledger.replay(spark, out, fixed, 0, TOPICS)


def test_no_row_of_a_window_is_unaccounted(spark, tmp_path):
    """A stream over a restart: the counted and the late rows are all there are, and a window's count is that of its rows in time."""
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    parts = [[(at(0), "a", 1), (at(30), "a", 2), (at(31), "b", 3), (None, "a", 4)], [(at(150), "a", 5), (at(40), "a", 6)], [(at(10), "a", 7), (at(100), "b", 8), (at(151), "a", 9)], [(at(125), "a", 10)]]
    out, schema = str(tmp_path / "out"), "ts timestamp, k string, id int"
    counter = WindowCounts(out, "ts", "k", "10 minutes", "1 hour", "30 minutes")
    for number, rows in enumerate(parts):
        counter(spark.createDataFrame(rows, schema), number)
        if number == 2:
            counter(spark.createDataFrame(rows, schema), number)
    newest, want, late = None, {}, []
    for rows in parts:
        mark = None if newest is None else newest - timedelta(minutes=10)
        for t, k, i in rows:
            if t is None:
                continue
            for s in range(-30, 180, 30):
                if at(s) <= t < at(s + 60):
                    if mark is not None and at(s + 60) <= mark:
                        late.append((i, at(s)))
                    else:
                        want[at(s), k] = want.get((at(s), k), 0) + 1
        newest = max([t for t, *_ in rows if t] + ([newest] if newest else []))
    got = window_counts(spark, out).collect()
    assert {(r.start, r.k): r.n for r in got} == want and {r.closed for r in got if r.end <= at(141)} == {True} and {r.closed for r in got if r.end > at(141)} == {False}
    assert sorted((r.id, r.window.start) for r in spark.read.parquet(f"{out}/late").collect()) == sorted(late) and late
    rows = {r.batch: r for r in accounted(spark, out).collect()}
    assert all(2 * (r.rows - r.untimed) == r.counted + r.late for r in rows.values()) and rows[0].untimed == 1 and sum(r.late for r in rows.values()) == len(late)
    assert [r.id for r in spark.read.parquet(f"{out}/untimed").collect()] == [4]


def test_counts_of_a_stream(spark, tmp_path):
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    spark.createDataFrame([(at(0), "a"), (at(5), "a")], "ts timestamp, k string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, k string").parquet(str(tmp_path / "in"))
    q = stream.writeStream.foreachBatch(WindowCounts(str(tmp_path / "out"), "ts", "k")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert [(r.start, r.k, r.n) for r in window_counts(spark, str(tmp_path / "out")).collect()] == [(at(0), "a", 2)]
    assert accounted(spark, str(tmp_path / "out")).agg(F.sum("rows")).first()[0] == 2


def test_a_stream_that_fails_is_started_anew(spark, tmp_path):
    """From its checkpoint: what failed is done again, what was done isn't."""
    from tidewire.streaming.control import kept_running

    for k in range(3):
        spark.createDataFrame([(k,)], "n long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    seen, waits, told, broken = [], [], [], {1: 2}

    def write(batch, number):
        if broken.get(number, 0):
            broken[number] -= 1
            raise OSError("the sink is away")
        seen.append(number)

    def start(fn=write, name="c"):
        stream = spark.readStream.schema("n long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        return stream.writeStream.foreachBatch(fn).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()

    kept_running(start, first=0.5, told=told.append, sleep=waits.append)
    assert seen == [0, 1, 2] and waits == [0.5, 1.0] or waits == [0.5, 0.5]
    assert len(told) == 2 and "away" in told[0]["error"]

    def hopeless(batch, number):
        raise OSError("never")

    with pytest.raises(Exception, match="never"):
        kept_running(lambda: start(hopeless, "d"), tries=2, sleep=waits.append)

    def wrong(batch, number):
        raise ValueError("no such field")

    count = len(waits)
    with pytest.raises(Exception, match="no such field"):
        kept_running(lambda: start(wrong, "e"), sleep=waits.append)
    assert len(waits) == count
