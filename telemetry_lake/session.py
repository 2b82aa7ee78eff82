"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Settings every job wants. Reducer sizes are left to adaptive execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # A key written twice in one JSON object counts once, with its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Streaming state lives off-heap and is checkpointed as changelogs.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows of a store costs a look-up per row that is written or removed.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

_DEFAULT_PARTITIONS = "200"


def build_session(app: str = "telemetry-lake", master: str | None = None, **extra) -> SparkSession:
    """Session with the settings above; ``extra`` adds or overrides (``__`` stands for a dot)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(name, value)
    return _size_shuffles(builder.getOrCreate())


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else built."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return _size_shuffles(spark)


def _size_shuffles(spark: SparkSession) -> SparkSession:
    """Let the number of shuffle partitions follow the cores, unless somebody chose it.

    It is the upper bound from which adaptive execution merges small partitions, and the number
    of state stores of a new streaming query. A cluster never gets fewer than Spark's default.
    """
    name = "spark.sql.shuffle.partitions"
    context = spark.sparkContext
    if spark.conf.get(name) == _DEFAULT_PARTITIONS and context.getConf().get(name) is None:
        cores = context.defaultParallelism
        wanted = cores if context.master.startswith("local") else max(3 * cores, int(_DEFAULT_PARTITIONS))
        spark.conf.set(name, str(wanted))
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="telemetry-lake-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for checkpoints and intermediate tables.

    It lies under ``spark.checkpoint.dir``, which on a cluster names shared storage.
    Only a local-mode session without that setting gets a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
