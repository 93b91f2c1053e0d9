"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. AQE splits skewed join and rebalance
# partitions at run time; UTC keeps event-time arithmetic zone-free.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Keyed state (`transformWithState`) needs the RocksDB store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "millrace") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Applies the run-time settings to a session made elsewhere."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    scratch_root(spark)
    return spark


def _path_of(uri: str) -> str:
    """The path of a URI without scheme and host."""
    return "/" + re.sub(r"^[A-Za-z0-9+.-]+:(//[^/]*)?", "", uri).strip("/")


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``, as a full URI.

    Only a local session may fall back to a temporary folder of this machine; on a
    cluster such a folder is not visible to the executors, so the setting is required.
    """
    context = spark.sparkContext
    wanted = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if wanted and (current is None or not _path_of(current).startswith(_path_of(wanted) + "/")):
        context.setCheckpointDir(wanted)
    elif current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir().rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared checkpoint folder once and goes on from there."""
    scratch_root(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; nothing is there yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
