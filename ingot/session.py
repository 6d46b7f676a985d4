"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for the jobs of this package.  UTC is the display zone only (no
# result depends on the session zone); AQE re-plans joins from measured
# sizes, coalesces small partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # delete reliable checkpoint files once their RDD is garbage-collected,
    # so repeated runs do not pile up copies in the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Target bytes per shuffle partition / scan split: small enough to sort and
# aggregate in executor memory without heavy spill, large enough to keep
# task overhead low.
PARTITION_BYTES = 128 * 1024 * 1024
SPLIT_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Initial shuffle partition count for a job reading `input_bytes`.

    One partition per `partition_bytes` of input (an upper bound on what a
    shuffle carries), at least 8; AQE coalesces the ones that turn out small.
    100 TB gives about 800,000.
    """
    return max(8, -(-int(input_bytes) // partition_bytes))


def build_session(
    master: str | None = None,
    app_name: str = "ingot",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    `input_bytes` (the size of the data a job reads) sizes the shuffles:
    `spark.sql.shuffle.partitions` from `shuffle_partitions_for`, AQE's
    advisory partition size and the scan split size, so partitions fit in
    executor memory at any scale.  `shuffle_partitions` sets the count
    directly (tests, local runs).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_bytes))
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(PARTITION_BYTES)
        conf["spark.sql.files.maxPartitionBytes"] = str(SPLIT_BYTES)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    On a cluster the folder is named by ``spark.checkpoint.dir`` (a shared
    file system); it is only read here.  A folder of our own is created
    solely for local-mode sessions where nothing is configured (tests).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a shared folder "
            "(HDFS/S3/ABFS) before running jobs that cut lineage"
        )
    local = tempfile.mkdtemp(prefix="ingot-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(local)
    return local


def reliable_checkpoint(df, eager: bool = True):
    """`DataFrame.checkpoint` into the session's shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def drop_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder that a job of ours wrote and no longer needs."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
