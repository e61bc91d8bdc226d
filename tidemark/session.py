"""Spark session helpers.

The library never creates a session behind the user's back: every
operator takes DataFrames and returns DataFrames.  ``build_session`` is
the one place tests, the bench and the examples get a session from, so
that the settings the operators rely on (UTC session zone, AQE with
skew-join splitting, no UI) are set in one spot.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library should carry.  They are
# deliberately few: Catalyst and AQE pick physical strategies.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partition is skewed when it is 4x the median and over 64 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # Keep dt partition values as strings when a dt-partitioned table is read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Streaming state (dedup keys) in RocksDB: large key sets spill to local
    # disk instead of the JVM heap; snapshots go to the checkpoint folder.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Stream-stream joins keep both sides in one RocksDB instance per partition instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs (cluster jobs bring their own)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Dates and hours are derived in UTC, like the test oracle."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_disk_state(spark: SparkSession) -> None:
    """State of data-sized streams in RocksDB; Spark's default keeps all of it in the JVM heap.

    A stream that has a checkpoint goes on with the store it was started with.
    """
    for key in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.join.stateFormatVersion"):
        if spark.conf.get(key, None) != BASE_CONF[key]:
            spark.conf.set(key, BASE_CONF[key])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3,
    ...) and is used as is.  Only a local session without it (tests, a
    laptop) gets a fresh folder under the system temp directory; on a
    cluster its absence is an error, as executors do not see such a folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = sc.master if sc is not None else "connect"
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (master is {master})")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # a core config some sessions refuse to set at run time
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder.

    Each call gets its own folder, so nothing is ever cleared or reused.
    """
    base = ensure_checkpoint_dir(spark)
    # getCheckpointDir() returns a per-application sub folder; keep it.
    path = f"{base}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
    local = _local_path(path)
    if local is not None:
        os.makedirs(local, exist_ok=True)
    return path


def _local_path(path: str) -> str | None:
    """The local file-system path of ``path``, or None for a remote URI.

    Plain paths and ``file:`` URIs are local; anything with another scheme
    (hdfs:, s3a:, abfss:, ...) is left to the writers, which create it.
    """
    scheme = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):", path)
    if scheme is None:
        return path
    if scheme.group(1).lower() == "file":
        return re.sub(r"^file:(//)?", "", path)
    return None
