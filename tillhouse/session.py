"""Session settings the results depend on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Calendar columns are UTC. Session windows collapse inside each map task before the
# shuffle, so one busy user does not send every event to one reducer.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillhouse")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = prepare(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one named by ``spark.checkpoint.dir``.

    Executors on other machines read what is written here, so a machine-local folder
    is used only where the setting is absent and the master is local.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors reach")
        shared = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
