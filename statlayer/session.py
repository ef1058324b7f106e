"""SparkSession construction and the shared scratch / checkpoint folder.

Cluster rule: lineage is cut with ``checkpoint()`` or a written table under the folder the cluster
names in ``spark.checkpoint.dir``. We read that setting from the session and only set our own when it
is unset (local tests). Never a machine-local temp folder on a cluster, never ``localCheckpoint``.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of the engine wants. AQE re-plans joins at runtime from real shuffle sizes
# (broadcast only when the materialised side is small), coalesces small partitions and splits skewed
# ones; the Spark UI is a server and stays off.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# Join strategy: no broadcast from file-size ESTIMATES (a 10 MB compressed fact file would be collected
# through the driver). Fixed-size dimensions are broadcast explicitly (``operators.joins.fixed_dim``);
# anything else is broadcast only by AQE after the shuffle has MEASURED it below the cap, otherwise it
# stays a sort-merge join. These are runtime SQL settings, applied to any session the entry points get.
JOIN_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": os.environ.get("STATLAYER_RUNTIME_BROADCAST_CAP", "8MB"),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot key's partition is split also where that costs another shuffle for what follows the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows a batch to Python: whole documents in batches of 10,000 make executors hold large buffers outside the heap
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # the shuffle files of a finished query go at once; otherwise a job of many steps holds those of all its steps
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
DEFAULT_CONF.update(JOIN_CONF)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's runtime SQL settings (join strategy, AQE) to a session built elsewhere."""
    for key, value in JOIN_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def get_spark(app: str = "statlayer", master: str | None = None, shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's ``spark.checkpoint.dir`` if set, else a fresh
    local one (only ever reached in local tests, where there is no cluster-wide folder)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master == "local" or sc.master.startswith("local["):     # not local-cluster[...]
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="statlayer-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage (checkpoints and "
                           "intermediate tables must survive the loss of any machine)")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/statlayer-scratch/{uuid.uuid4().hex}/{name}"


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder: survives executor loss, ends long lineages."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def data_dir(default: str = "/root/testdata/sf0.01") -> str:
    return os.environ.get("STATLAYER_DATA", default)


def size_parallelism(spark: SparkSession, input_bytes: int, target_bytes: int = 256 << 20) -> int:
    """Size shuffles for an input: partitions of about ``target_bytes`` (fits executor memory without
    spilling), never fewer than the cluster's task slots; AQE coalesces the small ones at runtime and
    splits skewed ones. Scans use the same target for their splits."""
    slots = spark.sparkContext.defaultParallelism
    partitions = max(slots, -(-int(input_bytes) // int(target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(target_bytes, 128 << 20)))
    return partitions


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the given inputs on the cluster file system (metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)
