"""Session helpers shared by every part of the library."""

from __future__ import annotations

import gc
import io
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no shared folder (single-machine tests).
LOCAL_SHARED = "file:///tmp/checkpoints/judgex"


def local_session(cores: str = "8", **extra: str) -> SparkSession:
    """A single-machine session with the settings the tests and the bench use."""
    conf = {
        "spark.master": f"local[{cores}]",
        "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.host": "127.0.0.1",
    } | extra
    return SparkSession.builder.config(map=conf).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or on a single machine a local one where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or LOCAL_SHARED).rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/judgex/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This ends the lineage: a lost executor costs at most the tasks of the stage that is
    running. Shuffle files behind the written table become garbage, and are given back.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    del df
    release(spark)
    return spark.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner see shuffles nobody refers to any more; it acts on JVM collections only."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows and bytes in an Arrow batch sent to Python (one longer row is a batch of its own), so that a batch of very long texts still fits in a worker.
LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}
_shipped: set[str] = set()


def bounded(spark: SparkSession) -> None:
    """Set the batch size for this session's Python stages, unless the session already asks for smaller ones."""
    for name, most in LIMITS.items():
        if not 0 < int(re.sub(r"\D*$", "", spark.conf.get(name))) <= most:
            spark.conf.set(name, str(most))


def ship(spark: SparkSession | None) -> None:
    """Give the executors this package, once per application, and Python stages bounded batches; nothing without a session."""
    if spark is None:
        return
    bounded(spark)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    path = os.path.join(tempfile.mkdtemp(prefix="judgex-"), "judgex_pkg.zip")
    Path(path).write_bytes(blob.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
