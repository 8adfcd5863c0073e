"""What documents were at any time: their versions, images before and after each change, and totals that are kept by taking old images out and putting new ones in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.operators.keyed import running

KEYS = ("collection", "document_key")
TIME, ARRIVAL = "cluster_time", "resume_token"


def images(changes: DataFrame, keys: Sequence[str] = KEYS, arrival: str = ARRIVAL, bucket: Column | None = None) -> DataFrame:
    """changes with the document before and after each, in order of arrival: null before the first and after a delete. A change that brings no
    document, but is no delete, leaves it as it was. A document's changes pass through one task as a sorted stream, or through many by a bucket (as for
    keyed.running)."""
    gone = F.col("operation_type") == "delete"
    now = F.when(gone | F.col("full_document").isNotNull(), F.struct(F.when(~gone, F.col("full_document")).alias("d")))
    known = running(changes, keys, [arrival], now, "_earlier", bucket, "last", earlier=True)
    return known.withColumns({"before": F.col("_earlier.d"), "after": F.coalesce(now, F.col("_earlier"))["d"]}).drop("_earlier")


def versions(changes: DataFrame, keys: Sequence[str] = KEYS, ts: str = TIME, arrival: str = ARRIVAL, bucket: Column | None = None) -> DataFrame:
    """keys, document, valid_from, valid_to: the intervals in which a document was the same, from its changes in order of time (of equal times the last counts).
    valid_to is null for the present version; a deleted document is null while it is gone."""
    last = images(changes, keys, arrival, bucket).groupBy(*keys, F.col(ts).alias("valid_from")).agg(F.max_by("after", arrival).alias("document"))
    return last.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from")))


def as_of(events: DataFrame, versions: DataFrame, keys: Sequence[str] = KEYS, ts: str = TIME, out: str = "document", bucket: Column | None = None) -> DataFrame:
    """events with the document of their keys as it was at their time: that of the version with valid_from <= ts < valid_to, null for none.

    Versions and events of a document are read in the order of time: no join by ranges. Rows without a key have no document. bucket: of ts, as for
    keyed.running, so that no task has all rows of a document.
    """
    rows = events.withColumn("_version", F.lit(None).cast("struct<d:string>")).withColumn("_event", F.lit(True))
    begun = versions.select(*keys, F.col("valid_from").alias(ts), F.struct(F.col("document").alias("d")).alias("_version"), F.lit(False).alias("_event"))
    known = F.lit(True)
    for k in keys:
        known &= F.col(k).isNotNull()
    both = running(rows.where(known).unionByName(begun.where(known), allowMissingColumns=True), keys, [ts, "_event"], F.col("_version"), "_held", bucket, "last")
    both = both.withColumn(out, F.col("_held.d")).drop("_held")
    keyless = rows.where(~known).withColumn(out, F.lit(None).cast("string"))
    return both.where("_event").unionByName(keyless).drop("_event", "_version")


def looked_up_as_of(events: DataFrame, versions: DataFrame) -> DataFrame:
    """Updates without a document get that of their collection and key as it was at their time."""
    found = as_of(events, versions, out="_found")
    return found.withColumn("full_document", F.coalesce("full_document", F.when(F.col("operation_type") == "update", F.col("_found")))).drop("_found")


def retracted(images: DataFrame) -> DataFrame:
    """document, sign and all else of a change, without its images: the old image with -1, the new one with 1. Their sums are those of the present documents."""
    parts = F.array(F.struct(F.col("before").alias("document"), F.lit(-1).alias("sign")), F.struct(F.col("after").alias("document"), F.lit(1).alias("sign")))
    rest = [c for c in images.columns if c not in ("before", "after", "full_document")]
    return images.where(~F.col("before").eqNullSafe(F.col("after"))).select(*rest, F.explode(parts).alias("p")).select(*rest, "p.*").where("document is not null")


def deltas(retracted: DataFrame, levels: Sequence[str], measure: Column) -> DataFrame:
    """What changes alter the totals of each level by: levels, level (how many names are set), total, n."""
    signed = retracted.withColumn("_measure", measure * F.col("sign"))
    level = (F.lit(len(levels)) - F.bit_count(F.grouping_id())).cast("int")
    return signed.rollup(*levels).agg(level.alias("level"), F.sum("_measure").alias("total"), F.sum(F.col("sign").cast("long")).alias("n"))


def merged(levels: Sequence[str], *parts: DataFrame) -> DataFrame:
    """Totals after further deltas: sums by level; those without any document left go. Parts may be taken in any grouping."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy(*levels, "level").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).where("n <> 0")
