"""The ledger of a sink's committed batches: what readers follow, where reading may resume, and which dead letters were replayed.

A batch counts once its row is in out/ledger; folders of a batch that was begun and not committed are seen by no reader, and are overwritten when it is done
again. Numbers of replays are negative.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.plans import cdc
from tidewire.sources import changes, scratch

ROW = "collection string, changes long, messages long, dead long, position string, up_to timestamp, committed_at timestamp, batch long"
LETTER = ["collection", "resume_token"]


def _table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A table, or None where nothing was written yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e):
            return None
        raise


def commit(out: str, number: int, batch: DataFrame, dead: DataFrame, now: Column) -> None:
    """Write the row of each collection of a batch whose messages and dead letters are there. dead: events, as written."""
    lost = dead.groupBy("collection").agg(F.count("*").alias("_dead"))
    seen = batch.groupBy("collection").agg(F.count("*").alias("changes"), F.max_by("resume_token", F.struct("cluster_time", "resume_token")).alias("position"), F.max("cluster_time").alias("up_to"))
    sent = _table(batch.sparkSession, f"{out}/messages/batch={number}", "value binary, attributes map<string,string>, topic string")
    sent = None if sent is None else sent.groupBy(F.col("attributes.collection").alias("collection")).agg(F.count("*").alias("_sent"))
    rows = seen.join(lost, "collection", "left")
    rows = rows.withColumn("_sent", F.lit(0).cast("long")) if sent is None else rows.join(sent, "collection", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    rows = rows.select("collection", "changes", count("_sent").alias("messages"), count("_dead").alias("dead"), "position", "up_to", now.alias("committed_at"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{out}/ledger/batch={number}")


def rows(spark: SparkSession, out: str) -> DataFrame:
    """A row for each collection of each committed batch."""
    found = _table(spark, f"{out}/ledger", ROW)
    return spark.createDataFrame([], ROW) if found is None else found


def committed(spark: SparkSession, out: str, what: str = "messages") -> DataFrame | None:
    """The messages, dead letters or status of committed batches alone; None before the first."""
    found = _table(spark, f"{out}/{what}")
    return None if found is None else found.join(rows(spark, out).select("batch").distinct(), "batch", "left_semi")


def positions(spark: SparkSession, out: str) -> DataFrame:
    """collection, position, up_to: how far each collection's committed changes go, to resume from; replays don't count."""
    last = rows(spark, out).where("batch >= 0")
    return last.groupBy("collection").agg(F.max_by("position", F.struct("up_to", "position")).alias("position"), F.max("up_to").alias("up_to"))


def unread(events: DataFrame, positions: DataFrame) -> DataFrame:
    """The changes behind each collection's position, for a reader that starts from the ledger without its checkpoint."""
    known = positions.select(F.col("collection").alias("_c"), F.struct(F.col("up_to").alias("t"), F.col("position").alias("p")).alias("_at"))
    here = F.struct(F.col("cluster_time").alias("t"), F.col("resume_token").alias("p"))
    return events.join(known, events.collection.eqNullSafe(F.col("_c")), "left").where(F.col("_at").isNull() | (here > F.col("_at"))).drop("_c", "_at")


def open_letters(spark: SparkSession, out: str, besides: int | None = None) -> DataFrame | None:
    """Dead letters that no committed replay (besides one) has published; a letter that came in several batches is one."""
    letters = committed(spark, out, "dead")
    if letters is None:
        return None
    done = committed(spark, out, "replayed")
    letters = letters.drop("batch").dropDuplicates(LETTER)
    if done is None:
        return letters
    done = done if besides is None else done.where(F.col("batch") != besides)
    return letters.join(done.select(*LETTER), LETTER, "left_anti")


def replay(spark: SparkSession, out: str, corrected: DataFrame, number: int, topics: dict[str, str], form: str = "json", plan: cdc.Plan | None = None, now: Callable[[], Column] = F.current_timestamp) -> int:
    """Publish corrected dead letters (changes, with the collection and resume_token of open letters) as replay `number`, from 1; how many were.

    What is no open letter is left out, and what is still invalid stays open. A replay that is done again, after a lost driver or by mistake, writes
    the same folders: every letter is published once. Letters aren't deduplicated by key and time, as they are changes that were held back.
    """
    if number < 1:
        raise ValueError("replays are numbered from 1")
    letters = open_letters(spark, out, -number)
    if letters is None:
        return 0
    with scratch.cleared(spark):
        chosen = corrected.select(*changes.NAMES).join(letters.select(*LETTER), LETTER, "left_semi").dropDuplicates(LETTER)
        checked = scratch.written(cdc.checked(chosen, plan, dedup=False), "replay")
        messages, still = cdc.split(checked, topics, form, plan)
        still = scratch.written(still, "still")
        published = checked.join(still.select(*LETTER), LETTER, "left_anti").select(*LETTER)
        messages.write.mode("overwrite").partitionBy("topic").parquet(f"{out}/messages/batch={-number}")
        published.write.mode("overwrite").parquet(f"{out}/replayed/batch={-number}")
        commit(out, -number, chosen, still, now())
        return spark.read.parquet(f"{out}/replayed/batch={-number}").count()
