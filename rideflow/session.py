"""Session settings and the shared folder for checkpoints and written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Times are wall-clock, so the zone is pinned; ANSI stays on and the code uses try_ forms.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "rideflow", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators expect; extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_time_zone(spark: SparkSession) -> SparkSession:
    """Wall-clock semantics on a session that was built elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: Greatest bytes of a split and of a shuffled piece. Packed rows grow ten-fold and more in memory, where grouping or sorting those of
#: a larger one spills; with these a table that grows gets more tasks and not larger ones.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 8 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}


def bound_tasks(spark: SparkSession) -> SparkSession:
    """Lower the session's sizes of splits and of shuffled pieces to ``TASK_BYTES``; smaller ones stay."""
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for setting, most in TASK_BYTES.items():
        if in_bytes(spark.conf.get(setting)) > most:
            spark.conf.set(setting, f"{most}b")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the cluster; a temporary one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="rideflow-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Point reliable checkpoints at the shared folder."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def materialize(df: DataFrame) -> DataFrame:
    """Compute a frame once and cut its lineage through a reliable checkpoint."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)
