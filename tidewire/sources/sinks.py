"""Sinks of the change plan: messages by topic, dead letters and status, each batch written once under its number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.functions.serialization import iso_time
from tidewire.plans import cdc
from tidewire.sources import ledger, scratch
from tidewire.sources.topics import Topics
from tidewire.streaming.keyed_state import freshest
from tidewire.streaming.stateful import fresh_stream


def status_messages(status: DataFrame, now: Column) -> DataFrame:
    """value (JSON), attributes: a heartbeat for each row of cdc.heartbeat."""
    parts = F.struct(F.lit(True).alias("is_running"), iso_time(F.col("last_change_time")).alias("last_change_time"), F.col("seconds_since_last_change").alias("time_since_last_change"), F.col("has_resume_token"))
    body = F.struct(F.lit("heartbeat").alias("type"), F.col("collection"), F.unix_timestamp(now).alias("timestamp"), parts.alias("status"))
    return status.select(F.to_json(body).alias("value"), F.create_map(F.lit("message_type"), F.lit("heartbeat"), F.lit("collection"), F.col("collection")).alias("attributes"))


def kafka_rows(messages: DataFrame) -> DataFrame:
    """Messages in the columns that Spark's Kafka sink writes: topic, value, headers; for any such sink's options."""
    headers = F.transform(F.map_entries("attributes"), lambda e: F.struct(e["key"].alias("key"), F.encode(e["value"], "UTF-8").alias("value")))
    return messages.select("topic", F.col("value").cast("binary").alias("value"), headers.alias("headers"))


Sink = Callable[[DataFrame, int], None]


def to_topics(path: str) -> Sink:
    """Messages go to the topics of a path (sources.topics), each batch once under its number."""

    def write(messages: DataFrame, number: int) -> None:
        messages.sparkSession.dataSource.register(Topics)
        messages.write.format(Topics.name()).option("path", path).option("batch", number).mode("append").save()

    return write


def to_kafka(**options: str) -> Sink:
    """Messages go to Kafka, or to another sink that takes its rows (format: its name); at least once, as that sink has no transactions."""

    def write(messages: DataFrame, number: int) -> None:
        rest = {k: v for k, v in options.items() if k != "format"}
        kafka_rows(messages).write.format(options.get("format", "kafka")).options(**rest).mode("append").save()

    return write


def batch_writer(out: str, topics: dict[str, str], form: str = "json", plan: cdc.Plan | None = None, now: Callable[[], Column] = F.current_timestamp, sink: Sink | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: out/messages, out/dead and out/status, a folder for each batch and topic, then its row in out/ledger, which commits it.

    A batch that is done again, after a lost driver, overwrites its own folders: every message is there once. Its rows are
    deduplicated and validated once for all three, and written to the shared folder meanwhile. sink: takes the messages, besides their table.
    """

    def write(batch: DataFrame, number: int) -> None:
        with scratch.cleared(batch.sparkSession):
            messages, dead = cdc.split(scratch.written(cdc.checked(batch, plan), "checked"), topics, form, plan)
            messages.write.mode("overwrite").partitionBy("topic").parquet(f"{out}/messages/batch={number}")
            dead = scratch.written(dead, "dead")
            dead.write.mode("overwrite").parquet(f"{out}/dead/batch={number}")
            if sink is not None:
                sink(batch.sparkSession.read.schema(messages.schema).parquet(f"{out}/messages/batch={number}").select(*messages.columns), number)
            status_messages(cdc.heartbeat(batch, now()), now()).write.mode("overwrite").parquet(f"{out}/status/batch={number}")
            ledger.commit(out, number, batch, dead, now())

    return write


def publish(stream: DataFrame, out: str, checkpoint: str, topics: dict[str, str], form: str = "json", plan: cdc.Plan | None = None, every: str | None = None, name: str | None = None, dedup: bool = False, ttl_ms: int | None = None, idle_ms: int | None = None, sink: Sink | None = None) -> StreamingQuery:
    """Start the change plan on a stream. every: a processing interval; without one it reads what there is and ends.

    dedup: changes are held against those of all earlier batches, not only against those of their own, by state that is kept for ttl_ms of event time, or
    until a key has been idle for idle_ms, or for good. sink: as for batch_writer.
    """
    if dedup and ttl_ms is not None:
        keyed = stream.withColumn("_key", cdc.dedup_key(F.col("collection"), F.col("document_key"), F.col("operation_type")))
        stream = fresh_stream(keyed, "_key", "cluster_time", ttl_ms, arrival="resume_token").drop("_key")
    elif dedup:
        stream = freshest(stream, idle_ms)
    writer = stream.writeStream.foreachBatch(batch_writer(out, topics, form, plan, sink=sink)).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
