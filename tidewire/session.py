"""Session helpers: a local session for tests and benches, and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, app: str = "tidewire") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIDEWIRE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: Bytes of an Arrow batch that a Python worker gets at once, and Spark's own value: rows of long texts make batches of the same size.
BATCH_BYTES, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per Spark context, so that their Python workers can import it, and bound what
    they get at once to 4 MB where the session hasn't a bound of its own."""
    sc = spark.sparkContext
    if spark.conf.get(BATCH_BYTES) == BATCH_DEFAULT:
        spark.conf.set(BATCH_BYTES, str(4 << 20))
    if getattr(sc, "_tidewire_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tidewire-ship-")) / "tidewire_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._tidewire_shipped = True
    return spark
