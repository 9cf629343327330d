"""Session set-up and the shared scratch location.

Every job runs with a UTC session clock (dates in the data model are UTC
calendar days).  Intermediate tables that must survive executor loss are
written below the folder the cluster names in ``spark.checkpoint.dir``; a
private folder is only created when that setting is absent (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the engine relies on.  All can be changed on a live
# session, so they are applied to sessions handed to us as well.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":      # state on local disk; a started query keeps what it began with
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",      # a document that repeats a member keeps the last one
}


#: Bytes a scan task gets where the session leaves Spark's default: landed files are compressed, their text is some
#: ten times larger, and a task sorts its rows before the shuffle.
SPLIT, SPLIT_BYTES, DEFAULT_SPLIT = "spark.sql.files.maxPartitionBytes", "32m", ("134217728b", "134217728", "128m", "128MB")

#: Bytes of an Arrow batch where the session leaves Spark's default: a task holds a batch several times (Arrow buffers in
#: the JVM, the batch and its decoded columns in Python), beside the executor's heap.
BATCH, BATCH_BYTES, DEFAULT_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "4m", ("67108864b", "67108864", "64m", "64MB")

#: Rows a Parquet scan decodes at once where the session leaves Spark's default: 4,096 texts make column vectors of 8 to
#: 32 MB in one piece, for which the JVM grows its heap by far more than it has live.
SCAN, SCAN_ROWS, DEFAULT_SCAN = "spark.sql.parquet.columnarReaderBatchSize", "512", ("4096",)


def get_session(
    master: str | None = None,
    app_name: str = "engagelake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark.conf.get(SPLIT) in DEFAULT_SPLIT:
        spark.conf.set(SPLIT, SPLIT_BYTES)
    if spark.conf.get(BATCH) in DEFAULT_BATCH:
        spark.conf.set(BATCH, BATCH_BYTES)
    if spark.conf.get(SCAN) in DEFAULT_SCAN:
        spark.conf.set(SCAN, SCAN_ROWS)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors for intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir); a local session without one gets a private folder, a
    cluster without one an error (its executors do not share ``/tmp``).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder below the shared root."""
    return f"{shared_root(spark)}/engagelake/{purpose}-{uuid.uuid4().hex[:12]}"

