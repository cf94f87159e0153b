"""Session defaults and the shared folder that long lineages are cut in."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lexmill", cpus: str | int = "*", shuffle: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEXMILL_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def find_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever their folder.

    Where the executors' machines lack that path the package is shipped with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def checkpoint_folder(spark: SparkSession) -> str:
    """The context's checkpoint folder, set first: what ``spark.checkpoint.dir`` names, or one of this machine if the session is local."""
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="lexmill-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df``, written to and read back from the session's checkpoint folder.

    Spark removes what is no longer referred to where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession, rows: int, rows_per_partition: int) -> int:
    """Partitions for ``rows`` such that one holds about ``rows_per_partition``.

    Never fewer than the session's own width, so small inputs still use every core.
    """
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(own, -(-rows // max(1, rows_per_partition)))
