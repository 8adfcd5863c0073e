"""Change events from files, in batch or as a stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "resume_token string, collection string, operation_type string, document_key string, cluster_time timestamp, full_document string"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def read(spark: SparkSession, path: str, form: str = "parquet", *, stream: bool = False, files_a_batch: int | None = None) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).schema(SCHEMA).format(form)
    if stream and files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.load(path)


def read_all(spark: SparkSession, paths: dict[str, str], form: str = "parquet", *, stream: bool = False, files_a_batch: int | None = None) -> DataFrame:
    """The changes of several collections, each from a path of its own, whose name they then have."""
    parts = [read(spark, path, form, stream=stream, files_a_batch=files_a_batch).withColumn("collection", F.lit(name)) for name, path in paths.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table seen as changes of two collections; arrival is event_id."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    collection = F.when(F.col("user_id") % 2 == 0, "inventory").otherwise("transactions")
    operation = F.element_at(F.array(*map(F.lit, ("insert", "update", "delete"))), (F.col("event_id") % 3 + 1).cast("int"))
    quantity = F.floor("value").cast("long") - F.when(F.col("event_id") % 7 == 0, 1000).otherwise(0)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    inventory = F.struct(F.lit("v1").alias("_schema_version"), F.concat(F.lit("P"), F.col("user_id") % 50).alias("product_id"), F.concat(F.lit("W"), F.col("user_id") % 5).alias("warehouse_id"), quantity.alias("quantity"), stamp.alias("last_updated"))
    kind = F.element_at(F.array(*map(F.lit, ("sale", "restock", "return", "adjustment", "gift"))), (F.col("event_id") % 5 + 1).cast("int"))
    moved = F.struct(F.lit("v1").alias("_schema_version"), F.concat(F.lit("T"), F.col("event_id")).alias("transaction_id"), F.concat(F.lit("P"), F.col("user_id") % 50).alias("product_id"), F.concat(F.lit("W"), F.col("user_id") % 5).alias("warehouse_id"), quantity.alias("quantity"), kind.alias("transaction_type"), stamp.alias("timestamp"))
    body = F.when(collection == "inventory", F.to_json(inventory)).otherwise(F.to_json(moved))
    return e.select(F.lpad(F.col("event_id").cast("string"), 12, "0").alias("resume_token"), collection.alias("collection"), operation.alias("operation_type"), F.col("user_id").cast("string").alias("document_key"), F.col("ts").cast("timestamp").alias("cluster_time"), F.when(operation != "delete", body).alias("full_document"))
