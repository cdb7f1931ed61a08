"""Session helpers: local test sessions and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "framelake") -> SparkSession:
    """A local session configured the way the tests and the bench expect.

    On a cluster, use the session the platform gives you; nothing here is required
    by the operators except ``spark.sql.session.timeZone=UTC`` for oracle parity.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("FRAMELAKE_DRIVER_MEMORY", "8g"))
    )
    active = SparkSession.getActiveSession()
    if active is None or not active.sparkContext.getConf().get(CHECKPOINT_CONF, None):
        builder = builder.config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="framelake-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_to_workers(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...), which
    is used as is. Only a session without that setting (a local test) gets a fresh
    scratch folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns checkpointing
        return spark.conf.get(CHECKPOINT_CONF, None) or ""
    path = sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share (master is {sc.master})")
        path = tempfile.mkdtemp(prefix="framelake-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint folder (streams, staged tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def materialize(df):
    """Cut lineage of a small derived table that several plans read.

    Reliable checkpoint into the shared checkpoint folder (never a local one), so
    the table is computed once and a lost executor re-reads it instead of
    recomputing its whole lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df, name: str = "table"):
    """Write a derived table that several plans read to the shared checkpoint folder, and read it back.

    Parquet, so that a reader takes only the columns it needs and the planner knows the table's size; a lost executor
    reads it again instead of deriving it again.
    """
    path = checkpoint_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_to_workers(spark: SparkSession, *extra_paths: str) -> None:
    """Make this package (and ``extra_paths``) importable by Python workers.

    Workers are started with the SparkContext environment, so adding the package
    root to its PYTHONPATH lets functions defined here be unpickled there. On a
    cluster, install the package on the executors (or ship it with --py-files).
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    try:
        env = spark.sparkContext.environment
    except Exception:  # Spark Connect: install the package on the server side instead
        return
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    for p in (root, *extra_paths):
        if p not in have:
            have.append(p)
    env["PYTHONPATH"] = os.pathsep.join(have)


def cluster_conf(input_bytes: int, total_cores: int, image_scoring: bool = False) -> dict[str, str]:
    """Settings this library expects on a large cluster, sized from the input.

    * shuffle partitions: ~200 MB per partition, at least 2 per core (AQE
      coalesces small ones; explicit-count range slices keep this number);
    * 256 MB file splits; AQE with skew-join splitting on;
    * broadcast only under 64 MB as measured at run time;
    * small Arrow batches when the UDF runs an image model.
    """
    partitions = max(2 * total_cores, int(input_bytes // (200 * 1024 * 1024)) + 1)
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.exchange.reuse": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.python.worker.reuse": "true",
    }
    if image_scoring:
        conf["spark.sql.execution.arrow.maxRecordsPerBatch"] = "64"
    return conf
