"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench. A cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("palaver")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a machine-local
    folder would not outlive a lost executor, so elsewhere the setting is required.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="palaver-checkpoint-")
    context.setCheckpointDir(folder)
