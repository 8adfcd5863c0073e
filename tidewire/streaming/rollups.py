"""Totals by the levels of a hierarchy that are kept up as documents change: each batch adds its deltas, and deltas are merged now and then."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import history as H
from tidewire.sources.ledger import _table

LEDGER = "upto long, batch long"


class Totals:
    """For foreachBatch over keyed_state.images_stream: out/deltas, a folder for each batch, then its row in out/ledger, which commits it.

    levels: name -> column of `document`, from the widest to the narrowest; measure: of `document`. After every `merge_after` batches all that is
    committed is merged to one folder, so readers open a bounded number. A batch that is done again writes the same.
    """

    def __init__(self, out: str, levels: dict[str, Column], measure: Column, merge_after: int = 100):
        self.out, self.levels, self.measure, self.merge_after = out, levels, measure, merge_after

    def __call__(self, batch: DataFrame, number: int) -> None:
        rows = H.retracted(batch).select("sign", self.measure.alias("_of"), *(c.alias(name) for name, c in self.levels.items()))
        deltas = H.deltas(rows, list(self.levels), F.col("_of"))
        deltas.write.mode("overwrite").parquet(f"{self.out}/deltas/batch={number}")
        spark = batch.sparkSession
        spark.createDataFrame([(number,)], "upto long").coalesce(1).write.mode("overwrite").parquet(f"{self.out}/ledger/batch={number}")
        if (number + 1) % self.merge_after == 0:
            merged = totals(spark, self.out, list(self.levels), number)
            merged.write.mode("overwrite").parquet(f"{self.out}/merged/upto={number}")
            # The folder counts once it is named here.
            spark.createDataFrame([(number,)], "upto long").coalesce(1).write.mode("overwrite").parquet(f"{self.out}/snapshots/batch={number}")


def totals(spark: SparkSession, out: str, levels: Sequence[str], upto: int | None = None) -> DataFrame:
    """levels, level, total, n over all committed batches (up to one): the last merge before it, and the deltas since."""
    committed = spark.read.schema(LEDGER).parquet(f"{out}/ledger").select("batch")
    deltas = spark.read.parquet(f"{out}/deltas").join(committed, "batch", "left_semi")
    snapshots = _table(spark, f"{out}/snapshots", LEDGER)
    start = None
    if snapshots is not None:
        start = (snapshots if upto is None else snapshots.where(F.col("batch") < upto)).agg(F.max("batch")).first()[0]
    if upto is not None:
        deltas = deltas.where(F.col("batch") <= upto)
    if start is None:
        return H.merged(levels, deltas.drop("batch"))
    whole = spark.read.parquet(f"{out}/merged/upto={start}")
    return H.merged(levels, whole, deltas.where(F.col("batch") > start).select(*whole.columns))
