"""Session helpers.

Library code never creates its own session; it takes the caller's.  The
helpers here are for tests, the bench and command-line use, plus the one
piece of shared state operators need: a checkpoint folder that every
executor can reach.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every session built here gets.  AQE re-plans joins and
# coalesces/splits shuffle partitions at runtime from real sizes; the
# session zone is pinned so that timestamp <-> text conversions agree
# with the UTC clocks the data was written with.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app_name: str = "tidepool", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (``local[cores]``)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    # keep local catalog tables out of the working directory
    conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="tidepool-warehouse-")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Streaming state in RocksDB; a batch's checkpoint is its changes, and snapshots
# are made in the background.
ROCKSDB_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def rocksdb_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streaming state is in RocksDB: the
    setting holds for the queries started on it and for no other."""
    own = spark.newSession()
    for k in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"):
        own.conf.set(k, spark.conf.get(k))
    for k, v in ROCKSDB_CONF.items():
        own.conf.set(k, v)
    return own


MB = 1 << 20


def cluster_conf(shuffle_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Settings for a large cluster, sized from the expected shuffle volume.

    Initial shuffle partitions are sized so each holds about
    ``target_partition_mb`` at the expected volume (at least 3 per core);
    AQE then coalesces small ones and splits skewed ones from runtime sizes.
    Scan splits match the target, so one task reads about that much.  Large
    streaming state (the detector's windows) goes to RocksDB, off the heap.
    """
    parts = max(3 * total_cores, shuffle_bytes // (target_partition_mb * MB) + 1)
    conf = dict(BASE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        **ROCKSDB_CONF,
    })
    return conf


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    when neither is set *and* the master is local (tests, the bench) do we
    pick a fresh scratch folder; on a cluster an unset value is an error,
    since a machine-local folder would not survive losing an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no context: the conf is all there is
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if sc is not None:
            sc.setCheckpointDir(conf)
            return sc.getCheckpointDir() or conf
        return conf
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if master.startswith("local"):
        path = tempfile.mkdtemp(prefix="tidepool-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(path)
            return sc.getCheckpointDir() or path
        return path
    raise RuntimeError(
        "spark.checkpoint.dir is not set; set it to a shared folder (HDFS/object store) "
        "so iterative operators can cut lineage reliably")


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a folder the library wrote itself (scratch tables, emptied partitions)."""
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def remove_uri(spark: SparkSession, uri: str) -> None:
    """``remove_tree`` for a URI as Spark reports it (``input_file_name``): encoded,
    so a folder named ``p=x y`` reads ``p=x%20y``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def reliable_checkpoint(df):
    """Materialise ``df`` to the shared checkpoint folder and cut its lineage.

    Reliable (not local) checkpointing: the files live in the shared folder,
    so losing an executor afterwards does not force a recompute of the
    whole lineage.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
