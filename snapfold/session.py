"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# What the operators rely on, settable on any running session:
# - ANSI: overflows and bad casts abort a load instead of turning into NULL.
# - Generated methods beyond 8000 bytes are never JIT-compiled; wide projections
#   run faster outside whole-stage code generation than in one such method.
# - Bucketed tables are written as one sorted file per bucket; joins may use that.
RUNTIME = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}

# AQE: shuffle partitions are sized from what was really written, skew is split.
SETTINGS = {
    **RUNTIME,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Put the settings the operators rely on into a session made elsewhere."""
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def local_session(
    cores: str | int = "*",
    shuffle_partitions: int = 8,
    memory: str = "8g",
    app: str = "snapfold",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": memory,
        "spark.ui.showConsoleProgress": "false",
        **(extra or {}),
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder all executors can reach, private to this application.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset
    (local tests) a temporary folder is made and named there, and removed at exit.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="snapfold-")
        spark.conf.set("spark.checkpoint.dir", shared)
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return os.path.join(shared, spark.sparkContext.applicationId, name)
