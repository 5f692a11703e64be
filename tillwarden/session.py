"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings the operators rely on; all can be changed after start-up.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Arrow batches of long texts stay small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # decimals in the canonical tables must fail loudly or be exact, never wrap
    "spark.sql.decimalOperations.allowPrecisionLoss": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session that somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "*", app: str = "tillwarden", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go at the end of each query, not when the driver happens to collect garbage.

    For runs of several queries, each of which is executed once.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables and stream checkpoints.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  Only a
    local session may fall back to a temporary folder of the machine, because
    executors elsewhere could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tillwarden-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tillwarden/{name}-{uuid.uuid4().hex}"
