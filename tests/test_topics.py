"""Topics as a data source: two-phase writes, readers that follow commits, over restarts at every point."""

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewire.plans import cdc
from tidewire.sources import changes, topics


@pytest.fixture(autouse=True)
def registered(spark):
    spark.dataSource.register(topics.Topics)


def rows(spark, numbers):
    return spark.createDataFrame([("t" if k % 2 else "u", f"m{k}".encode(), {"n": str(k)}) for k in numbers], topics.SCHEMA)


def values(df):
    return sorted(bytes(r.value).decode() for r in df.collect())


def test_batches_of_messages(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "topics")
    read = lambda: spark.read.format("tidewire_topics").option("path", path).load()
    assert read().count() == 0
    rows(spark, range(5)).write.format("tidewire_topics").option("path", path).mode("append").save()
    rows(spark, range(5, 8)).select("attributes", "value", "topic").write.format("tidewire_topics").option("path", path).mode("append").save()
    assert values(read()) == [f"m{k}" for k in range(8)] and read().where("topic = 't'").count() == 4
    assert {(r.topic, r.attributes["n"]) for r in read().collect()} == {("t" if k % 2 else "u", str(k)) for k in range(8)}
    with pytest.raises(Exception, match="path"):
        spark.read.format("tidewire_topics").load().count()


def test_a_batch_is_committed_once(tmp_path):
    """Killed before the manifest: done again. Killed behind it: known, and its second files go."""
    log = topics.Log(str(tmp_path))
    writer = topics.StreamWriter.__new__(topics.StreamWriter)
    writer.path, writer.names = str(tmp_path), topics.ARROW.names
    part = lambda k: writer.write(iter([("t", f"m{k}".encode(), {"a": "b"}), ("t", None, None)]))
    lost = part(0)
    assert log.numbers() == [] and log.last() == -1
    again = part(0)
    writer.commit([again, None, writer.write(iter(()))], 0)
    assert log.numbers() == [0] and log.parts(0) == [again] and lost.file != again.file
    third = part(0)
    writer.commit([third], 0)
    assert log.parts(0) == [again] and not Path(tmp_path, third.file).exists() and Path(tmp_path, again.file).exists()
    aborted = part(1)
    writer.abort([aborted, None], 1)
    assert log.numbers() == [0] and not Path(tmp_path, aborted.file).exists()


def stream(spark, df, path, check):
    q = df.writeStream.format("tidewire_topics").option("path", path).option("checkpointLocation", check).trigger(availableNow=True).start()
    assert q.awaitTermination(180)


def test_every_message_once_over_restarts(spark, tmp_path):
    """A stream of changes into topics and on from there; the checkpoint's last commit is taken away, as if the driver had been lost between the sink's commit and its own."""
    stock = {"_schema_version": "v1", "product_id": "P1", "warehouse_id": "W1", "quantity": 10, "last_updated": "2024-01-01T00:00:00Z"}
    event = lambda k: (f"{k:03}", "inventory", "insert", f"k{k}", datetime(2024, 1, 1) + timedelta(seconds=k), json.dumps(stock))
    source = lambda: spark.readStream.schema(changes.SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, check = str(tmp_path / "topics"), str(tmp_path / "c")
    put = lambda ks: spark.createDataFrame([event(k) for k in ks], changes.SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    messages = lambda df: cdc.enveloped(df, {"inventory": "stock"})
    put([1, 2])
    put([3])
    stream(spark, messages(source()), out, check)
    read = lambda: sorted(json.loads(bytes(r.value))["data"]["_id"] for r in spark.read.format("tidewire_topics").option("path", out).load().collect())
    assert read() == ["001", "002", "003"] and topics.Log(out).numbers() == [0, 1]
    for f in (tmp_path / "c" / "commits").glob("*1*"):
        f.unlink()
    put([4])
    stream(spark, messages(source()), out, check)
    assert read() == ["001", "002", "003", "004"] and topics.Log(out).numbers() == [0, 1, 2]
    # What was begun and never committed is seen by no reader.
    (Path(out) / "parts" / "begun.parquet").write_bytes(b"half")
    assert read() == ["001", "002", "003", "004"]

    on = lambda: spark.readStream.format("tidewire_topics").option("path", out).option("batches_a_trigger", "1").load()
    copy, copy_check = str(tmp_path / "copy"), str(tmp_path / "cc")
    q = on().writeStream.format("parquet").option("path", copy).option("checkpointLocation", copy_check).trigger(processingTime="0 seconds").start()
    q.processAllAvailable()
    q.stop()
    put([5, 6])
    stream(spark, messages(source()), out, check)
    q = on().writeStream.format("parquet").option("path", copy).option("checkpointLocation", copy_check).trigger(processingTime="0 seconds").start()
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(copy).select(F.get_json_object(F.col("value").cast("string"), "$.data._id")).collect()
    assert sorted(r[0] for r in got) == [f"{k:03}" for k in range(1, 7)]


def test_published_to_topics_and_to_kafkas_rows(spark, tmp_path):
    """The plan's messages in topics, once each, also when a batch is done again; and in the rows that Kafka's sink takes."""
    from tidewire.sources import sinks

    stock = {"_schema_version": "v1", "product_id": "P1", "warehouse_id": "W1", "quantity": 10, "last_updated": "2024-01-01T00:00:00Z"}
    rows = [("1", "inventory", "insert", "a", datetime(2024, 1, 1), json.dumps(stock)), ("2", "inventory", "insert", "b", datetime(2024, 1, 1), "{}")]
    batch = spark.createDataFrame(rows, changes.SCHEMA)
    write = sinks.batch_writer(str(tmp_path / "out"), {"inventory": "stock"}, sink=sinks.to_topics(str(tmp_path / "topics")))
    write(batch, 0)
    write(batch, 0)
    got = spark.read.format("tidewire_topics").option("path", str(tmp_path / "topics")).load().collect()
    assert [(r.topic, json.loads(bytes(r.value))["data"]["_id"], r.attributes["operation"]) for r in got] == [("stock", "1", "insert")]
    sinks.batch_writer(str(tmp_path / "again"), {"inventory": "stock"}, sink=sinks.to_kafka(format="parquet", path=str(tmp_path / "kafka")))(batch, 0)
    row = spark.read.parquet(str(tmp_path / "kafka")).first()
    assert row.topic == "stock" and json.loads(bytes(row.value))["operation"] == "insert" and {h.key for h in row.headers} >= {"collection", "operation"}
