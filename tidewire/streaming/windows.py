"""Counts by sliding windows of a stream that lose no row: those behind the watermark go to a table of their own.

Spark's own aggregations drop late rows. Here a batch's counts are a small table that adds up with those of other batches, so windows of any
age can be summed, and what is late is a decision that is written down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.sources.ledger import _table

LEDGER = "newest timestamp, rows long, counted long, late long, untimed long, batch long"


class WindowCounts:
    """For foreachBatch: out/counts, out/late and out/untimed, a folder for each batch, then its row in out/ledger, which commits it.

    A row counts in each of its windows whose end the watermark, `late` behind the newest time of the batches before, hasn't passed. Where it has, the
    row and the window stand in out/late; rows without a time stand in out/untimed. A batch that is done again writes the same.
    """

    def __init__(self, out: str, ts: str, key: str, late: str = "10 minutes", size: str = "1 hour", slide: str | None = None):
        self.out, self.ts, self.key, self.late, self.size, self.slide = out, ts, key, late, size, slide

    def _newest(self, spark: SparkSession, number: int) -> object:
        ledger = _table(spark, f"{self.out}/ledger", LEDGER)
        return None if ledger is None else ledger.where(F.col("batch") < number).agg(F.max("newest")).first()[0]

    def __call__(self, batch: DataFrame, number: int) -> None:
        newest = self._newest(batch.sparkSession, number)
        mark = F.lit(newest).cast("timestamp") - F.expr(f"interval {self.late}")
        rows = batch.where(F.col(self.ts).isNotNull())
        # A row stands in size / slide windows.
        placed = rows.select("*", F.window(self.ts, self.size, self.slide or self.size).alias("window"))
        over = F.coalesce(F.col("window.end") <= mark, F.lit(False))
        counts = placed.where(~over).groupBy("window", self.key).agg(F.count("*").alias("n"))
        at = lambda what: f"{self.out}/{what}/batch={number}"
        counts.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), self.key, "n").write.mode("overwrite").parquet(at("counts"))
        placed.where(over).write.mode("overwrite").parquet(at("late"))
        batch.where(F.col(self.ts).isNull()).write.mode("overwrite").parquet(at("untimed"))
        seen = batch.agg(F.greatest(F.max(self.ts), F.lit(newest).cast("timestamp")).alias("newest"), F.count("*").alias("rows"), F.count_if(F.col(self.ts).isNull()).alias("untimed"))
        both = placed.agg(F.count_if(~over).alias("counted"), F.count_if(over).alias("late"))
        seen.crossJoin(both).select("newest", "rows", "counted", "late", "untimed").write.mode("overwrite").parquet(at("ledger"))  # one row each


def window_counts(spark: SparkSession, out: str, late: str = "10 minutes") -> DataFrame:
    """start, end, the key, n and closed (whether the watermark has passed its end) of each window, over all committed batches."""
    ledger = spark.read.schema(LEDGER).parquet(f"{out}/ledger")
    counts = spark.read.parquet(f"{out}/counts").join(ledger.select("batch"), "batch", "left_semi").drop("batch")
    names = [c for c in counts.columns if c != "n"]
    mark = ledger.agg((F.max("newest") - F.expr(f"interval {late}")).alias("_mark"))
    return counts.groupBy(*names).agg(F.sum("n").alias("n")).crossJoin(mark).select(*names, "n", F.coalesce(F.col("end") <= F.col("_mark"), F.lit(False)).alias("closed"))


def accounted(spark: SparkSession, out: str) -> DataFrame:
    """batch, rows, counted, late, untimed, newest: where each batch's rows went; counted and late are of rows and their windows."""
    return spark.read.schema(LEDGER).parquet(f"{out}/ledger").select("batch", "rows", "counted", "late", "untimed", "newest")
