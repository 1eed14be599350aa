"""Spark session defaults and shared storage locations.

Every operator in this package is a plain DataFrame function; the session only
carries configuration.  Two settings matter for correctness:

* ``spark.sql.session.timeZone = UTC``: the driver's Parquet timestamps are
  ``timestamp_ntz`` and are cast to ``timestamp``; all day and minute buckets
  are UTC.
* ``spark.checkpoint.dir``: the shared folder the cluster names for lineage
  cuts, stream checkpoints and intermediate tables.  It is read from the
  session and only set here when it is missing (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "funnelspark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Session with the defaults the operators assume.

    On a cluster ``master`` is left to ``spark-submit`` and the checkpoint
    folder comes from the cluster's ``spark.checkpoint.dir``; only a local
    master without one gets a fresh local folder.  Shuffle partitions are a
    starting point, AQE coalesces and splits them at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master and master.startswith("local") and not checkpoint_dir:
        checkpoint_dir = tempfile.mkdtemp(prefix="funnelspark-ckpt-")
    if checkpoint_dir:
        builder = builder.config(_CHECKPOINT_CONF, checkpoint_dir)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Streaming state (one row per (window, user) for the live KPIs) lives
        # off-heap in RocksDB, so large state does not pressure the JVM heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_session_defaults(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> None:
    """Runtime settings every query relies on (safe to call repeatedly)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder: from ``spark.checkpoint.dir`` if the
    cluster names one, else a fresh local folder (local mode and tests only)."""
    global _LOCAL_ROOT
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no JVM context on this client
        sc = None
    root = (sc.getConf().get(_CHECKPOINT_CONF, None) if sc is not None
            else spark.conf.get(_CHECKPOINT_CONF, None))
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: a machine-local "
                               "folder cannot hold tables and checkpoints on a cluster")
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="funnelspark-ckpt-")
        root = _LOCAL_ROOT
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


_LOCAL_ROOT: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "table"):
    """Compute ``df`` once, write it as Parquet into the shared checkpoint
    folder and read it back: the lineage is cut (a lost executor recomputes
    nothing before this point) and the copy keeps column statistics for
    filter pushdown.  Unlike an RDD checkpoint the input is not computed twice."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- shared files
def _file_system(spark: SparkSession, path: str):
    """(file system, path object) through the cluster's Hadoop configuration.  A client
    without a JVM can't see the cluster's files and must not look at its own."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception as e:  # noqa: BLE001
        raise RuntimeError("this needs a session with a JVM (spark-submit or a local master)") from e
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(conf), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (works for any scheme)."""
    fs, hpath = _file_system(spark, path)
    return bool(fs.exists(hpath))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it doesn't exist)."""
    fs, hpath = _file_system(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath)) if fs.exists(hpath) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _file_system(spark, path)
    fs.delete(hpath, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there as a whole or not at all: it is written
    beside the target and renamed.  An existing target is an error."""
    fs, target = _file_system(spark, path)
    temporary = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(temporary, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(temporary, target):
        fs.delete(temporary, False)
        raise FileExistsError(path)


__all__ = [
    "build_session", "ensure_session_defaults", "checkpoint_root", "scratch_path", "materialize",
    "path_exists", "list_names", "delete_path", "read_text", "publish_text",
]
