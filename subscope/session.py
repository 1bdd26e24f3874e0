"""Session defaults and the shared folder for written intermediates."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app="subscope", master=None, **conf):
    """A session with the settings the jobs rely on; a cluster's own settings win where given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_settings(shuffled_bytes, cores, partition_bytes=128 * 2**20):
    """Shuffle settings for a cluster and the largest expected shuffle.

    The adaptive planner merges small shuffle partitions and splits skewed ones, but starts from a fixed
    number: enough to keep a partition near ``partition_bytes``, and at least two per core.
    """
    wanted = max(-(-shuffled_bytes // partition_bytes), 2 * cores)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(wanted),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
    }


_local_roots = {}


def shared_root(spark):
    """``spark.checkpoint.dir``; only a local session may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="subscope-")
    return _local_roots[context.applicationId]


def model_root(spark):
    """Where stored models lie, the same for all sessions of one shared folder."""
    return f"{shared_root(spark)}/models"


def shared_dir(spark, name):
    """A new folder below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def settled(df, name):
    """The same rows as a written table, whose size Spark knows.

    A join with it is a broadcast if it is below ``spark.sql.autoBroadcastJoinThreshold``, and a shuffle join
    otherwise. From an aggregate alone Spark cannot tell, and would shuffle the large side to be safe.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
