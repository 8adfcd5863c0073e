"""Tables written to the folder that the driver and all executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: The paths of the tables that the current thread's `cleared` block writes.
_open = threading.local()


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; a local one only where the session names none and all runs in one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = getattr(spark, "_tidewire_scratch", None)
        if root is None:
            root = spark._tidewire_scratch = "file://" + tempfile.mkdtemp(prefix="tidewire-")
    return root.rstrip("/") + "/tidewire"


def stored(df: DataFrame, name: str) -> str:
    """Write df to the shared folder; its path. It is deleted with the `cleared` block that it is written in, or when Python ends."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    paths = getattr(_open, "paths", None)
    if paths is None:
        atexit.register(removed, spark, path)
    else:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as by stored, and read again."""
    return df.sparkSession.read.schema(df.schema).parquet(stored(df, name))


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread writes in the block are deleted at its end."""
    before = getattr(_open, "paths", None)
    _open.paths = []
    try:
        yield
    finally:
        for path in _open.paths:
            removed(spark, path)
        _open.paths = before


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder, if the session still runs."""
    jvm = getattr(spark.sparkContext, "_jvm", None)
    if jvm is None or spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
